"""Language identification by prediction by partial matching (PPM).

Every language has a byte context tree of orders 0 to 3 over lower-cased
UTF-8. A byte seen after its context costs -log2(n / (n + d)) bits there (n
uses of the context, d distinct followers: escape method C); otherwise the
escape d / (n + d) is paid and the next shorter context, with the followers
excluded, decides, down to the uniform order -1. The probabilities after each
context sum to one, so a text's cost is an exact code length. Statistics are
frozen after training. The language of the shortest code wins.

Cost tables are worked out once. Languages go in panels of ``PANEL``; a panel
has hashed rows for the three- and four-byte grams that one of its languages
has seen, and dense ones only for up to two bytes. So tables grow with the
grams seen, in proportion to the number of languages, which has no bound. A
text is then scored by table look-ups over Arrow batches.

Training reads a bounded sample of whole texts: about ``sample_docs`` distinct
texts of each language, chosen by hash (all, where a language has fewer), so
copies neither fill nor empty the sample. Scoring reads every whole text. The
driver holds the gram counts of the sample, some 10^5 rows a language.

Defined cases: null text, or one without a letter: ``und`` with score 0; an
empty training set makes every text ``und`` and rejects none; null or repeated
ids and further columns are passed through untouched; ties go to the smaller
language name; an empty table gives no row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import carried, crc_fold, hash_fraction, stored, unpacked
from ._text import SLICE, slices, text_bytes

UND = "und"
ORDER = 3
VERDICT = ("lang_pred", "score", "bits_per_byte")
#: Languages that share tables.
PANEL = 4
_LETTER = re.compile(r"[^\W\d_]")
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Rows:
    """An open-addressed table from keys to the rows 0 to n - 1; row n stands for keys that aren't held."""

    def __init__(self, keys: np.ndarray) -> None:
        bits, self.missing = max(4, int(np.ceil(np.log2(4 * max(1, len(keys)))))), len(keys)
        self.table, self.row, self.shift = np.full(1 << bits, -1, np.int64), np.full(1 << bits, len(keys), np.int32), np.uint64(64 - bits)
        slot, todo = self.slots(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.table[slot[todo]] == -1]
            self.table[slot[free]] = keys[free]  # of several for one slot the last stays
            self.row[slot[free]] = free
            todo = todo[self.table[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & ((1 << bits) - 1)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _ODD >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot, mask = self.slots(keys), len(self.table) - 1
        held = self.table[slot]
        out = np.where(held == keys, self.row[slot], self.missing)
        open_ = np.flatnonzero((held != keys) & (held != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & mask
            held = self.table[slot[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self.row[slot[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
        return out


@dataclass
class Panel:
    langs: list[str]
    grams: Rows  # four-byte grams seen
    gram_bits: np.ndarray  # their bits by language
    contexts: Rows  # three-byte grams seen
    third_bits: np.ndarray  # bits of the third byte after the first two, by language
    third_escape: np.ndarray  # bits to leave the three bytes as a context; last row: 0
    second_bits: np.ndarray  # (two bytes, language): bits of the second after the first
    second_escape: np.ndarray  # bits to leave the two bytes as a context


@dataclass
class PpmModel:
    panels: list[Panel]

    @property
    def langs(self) -> list[str]:
        return [x for p in self.panels for x in p.langs]


def _lowered(column: pa.Array) -> pa.Array:
    return pa.array([x.lower() if x else "" for x in column.to_pylist()], pa.large_string())


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text after ORDER line ends, which serve as its first context; and the texts' first positions."""
    n = len(offsets) - 1
    starts = offsets[:-1] + ORDER * np.arange(1, n + 1)
    out = np.full(len(data) + ORDER * n, 10, np.uint8)
    keep = np.ones(len(out), bool)
    for k in range(1, ORDER + 1):
        keep[starts - k] = False
    out[keep] = data
    return out, starts


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the four-byte grams of stretches of whole texts."""
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for at, to in slices(batch.column(0), 8 * SLICE):
            by: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(langs[at:to], _lowered(batch.column(0).slice(at, to - at)).to_pylist(), strict=True):
                raw = np.frombuffer(b"\n" * ORDER + text.encode(), np.uint8)
                for low in range(0, max(1, len(raw) - ORDER), 8 * SLICE):
                    part = raw[low : low + 8 * SLICE + ORDER].astype(np.int64)
                    gram, n = np.unique(part[:-3] << 24 | part[1:-2] << 16 | part[2:-1] << 8 | part[3:], return_counts=True)
                    by.setdefault(lang, []).append((gram, n))
            for lang, found in by.items():
                gram, back = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
                n = np.bincount(back, np.concatenate([n for _, n in found]), len(gram)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram)), pa.array(gram), pa.array(n)], ["lang", "gram", "n"])


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_docs: int = 3000, seed: int = 3) -> PpmModel:
    """Learn from rows with text and language; see the module for the bounds of the sample."""
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    # A row for each language and for each language and distinct text, told apart by hash.
    key, fraction = F.xxhash64("text"), hash_fraction("text", seed=seed)
    sizes = rows.select("lang", key.alias("key")).distinct().groupBy("lang").agg(F.count("*").alias("docs")).select(F.col("lang").alias("of"), "docs")
    # Written first, so that its size is known and the texts need no shuffle for it.
    sizes = stored(sizes, "languages")
    drawn = rows.join(sizes, F.col("lang") == F.col("of")).where(fraction < F.lit(float(sample_docs)) / F.col("docs"))
    drawn = drawn.groupBy("lang", key.alias("key")).agg(F.first("text").alias("text")).select("text", "lang")
    counts = drawn.mapInArrow(_gram_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    if not counts.num_rows:
        return PpmModel([])
    return freeze(counts.column("lang").to_pylist(), counts.column("gram").to_numpy(), counts.column("n").to_numpy().astype(np.float64))


def freeze(lang: list[str], gram: np.ndarray, n: np.ndarray, panel: int = PANEL) -> PpmModel:
    """Cost tables from counts of four-byte grams by language."""
    langs, which = np.unique(np.asarray(lang, object).astype(str), return_inverse=True)
    return PpmModel([_panel(langs[at : at + panel].tolist(), which - at, gram, n) for at in range(0, len(langs), panel)])


def _panel(langs: list[str], which: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Panel:
    size = len(langs)
    mine = (which >= 0) & (which < size)
    which, gram, n = which[mine], gram[mine], n[mine]
    # As contexts and as ends of contexts, all stretches of three bytes.
    keys4, keys3 = np.unique(gram), np.unique(np.concatenate([gram >> 8, gram & 0xFFFFFF]))
    gram_bits = np.empty((len(keys4), size), np.float32)
    third_bits, third_escape = np.empty((len(keys3), size), np.float32), np.zeros((len(keys3) + 1, size), np.float32)
    second_bits, second_escape = np.empty((1 << 16, size), np.float32), np.zeros((1 << 16, size), np.float32)
    for k in range(size):
        own = which == k
        at, m = np.unique(gram[own], return_inverse=True)
        full = np.bincount(m, n[own], len(at))
        # orders -1 to 1: the distribution of a byte after none and after one byte
        lower = np.full(256, 1 / 256)
        for order in range(2):
            cells = np.bincount(at & ((1 << 8 * (order + 1)) - 1), full, 1 << 8 * (order + 1)).reshape(-1, 256)
            total, kinds = cells.sum(1), (cells > 0).sum(1)
            left = np.maximum(((cells == 0) * lower).sum(1), 1e-12)
            rest = np.where(total > 0, kinds / np.maximum(total + kinds, 1) / left, 1.0)
            lower = np.where(cells > 0, cells / np.maximum(total + kinds, 1)[:, None], rest[:, None] * lower)
            lower = lower.reshape(256) if order == 0 else lower.reshape(-1)
        second_bits[:, k] = -np.log2(lower)

        def after(context: np.ndarray, lower_p: np.ndarray, uses: np.ndarray) -> tuple[np.ndarray, ...]:
            """(contexts, factor of the shorter context's probabilities after an escape, p of each use)."""
            held, back = np.unique(context, return_inverse=True)
            total, kinds = np.bincount(back, uses, len(held)), np.bincount(back, minlength=len(held))
            left = np.maximum(1 - np.bincount(back, lower_p, len(held)), 1e-12)
            return held, kinds / (total + kinds) / left, uses / (total + kinds)[back]

        # order 2: three-byte grams after their first two bytes
        grams3, m = np.unique(at & 0xFFFFFF, return_inverse=True)
        uses3 = np.bincount(m, full, len(grams3))
        held, factor, p3 = after(grams3 >> 8, lower[grams3 & 0xFFFF], uses3)
        second_escape[held, k] = -np.log2(factor)
        third_bits[:, k] = second_escape[keys3 >> 8, k] + second_bits[keys3 & 0xFFFF, k]
        third_bits[np.searchsorted(keys3, grams3), k] = -np.log2(p3)
        # order 3: four-byte grams after their first three bytes
        place = np.searchsorted(keys3, at & 0xFFFFFF)
        held, factor, p4 = after(at >> 8, 2.0 ** -third_bits[place, k].astype(np.float64), full)
        third_escape[np.searchsorted(keys3, held), k] = -np.log2(factor)
        gram_bits[:, k] = third_escape[np.searchsorted(keys3, keys4 >> 8), k] + third_bits[np.searchsorted(keys3, keys4 & 0xFFFFFF), k]
        gram_bits[np.searchsorted(keys4, at), k] = -np.log2(p4)
    return Panel(langs, Rows(keys4), gram_bits, Rows(keys3), third_bits, third_escape, second_bits, second_escape)


def code_lengths(model: PpmModel, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bits of each text under each language, bytes of each lower-cased text)."""
    data, offsets = text_bytes(column)
    padded, starts = _padded(data, offsets)
    sizes = np.diff(offsets)
    bits = np.zeros((len(sizes), len(model.langs)))
    ends = starts + sizes
    for low in range(0, len(padded), SLICE):
        high = min(len(padded), low + SLICE)
        part = padded[max(0, low - ORDER) : high].astype(np.int64)
        if low == 0:
            part = np.concatenate([np.full(ORDER, 10), part])
        third = part[:-2] << 16 | part[1:-1] << 8 | part[2:]  # third[i]: the three bytes that end at low - 1 + i
        now, gram = third[1:], third[:-1] << 8 | part[3:]
        first, last = np.searchsorted(ends, low, side="right"), np.searchsorted(starts, high)
        s, e = np.clip(starts[first:last], low, high) - low, np.clip(ends[first:last], low, high) - low
        column = 0
        for panel in model.panels:
            cost = np.empty((high - low, len(panel.langs)), np.float32)
            at = panel.grams.find(gram)
            known = at < panel.grams.missing
            cost[known] = panel.gram_bits[at[known]]
            other = np.flatnonzero(~known)
            row = panel.contexts.find(third)
            short = row[1:][other]
            seen = short < panel.contexts.missing
            rest = np.empty((len(other), len(panel.langs)), np.float32)
            rest[seen] = panel.third_bits[short[seen]]
            two = now[other[~seen]]
            rest[~seen] = panel.second_escape[two >> 8] + panel.second_bits[two & 0xFFFF]
            cost[other] = rest + panel.third_escape[row[:-1][other]]
            if last > first:
                sums = np.vstack([np.zeros((1, cost.shape[1])), np.cumsum(cost, axis=0, dtype=np.float64)])
                bits[first:last, column : column + cost.shape[1]] += sums[e] - sums[s]
            column += cost.shape[1]
    return bits, sizes


def _predict(batches: Iterator[pa.RecordBatch], shared, place: int, width: int) -> Iterator[pa.RecordBatch]:
    """The first ``width`` columns and the verdict on the text in column ``place``."""
    model = shared.value
    for batch in batches:
        texts = batch.column(place)
        for at, to in slices(texts, 8 * SLICE):
            part = _lowered(texts.slice(at, to - at))
            columns = [c.slice(at, to - at) for c in batch.columns[:width]] + _judged(model, part)
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:width], *VERDICT])


def _judged(model: PpmModel, texts: pa.Array) -> list[pa.Array]:
    if not model.langs:
        return [pa.array([UND] * len(texts)), pa.array([0.0] * len(texts)), pa.nulls(len(texts), pa.float64())]
    bits, sizes = code_lengths(model, texts)
    best = bits.argmin(1)
    gap = bits - bits.min(1, keepdims=True)
    gap *= (48 / np.maximum(sizes, 48))[:, None]  # beyond 48 bytes, the mean gap of so many
    sure = 1 / np.exp2(-np.minimum(gap, 1000)).sum(1)
    rate = bits.min(1) / np.maximum(sizes, 1)
    has = np.array([bool(t) and _LETTER.search(t) is not None for t in texts.to_pylist()], bool)
    names = [model.langs[k] if h else UND for k, h in zip(best.tolist(), has.tolist(), strict=True)]
    return [pa.array(names, pa.string()), pa.array(np.where(has, sure, 0.0)), pa.array(rate, mask=~has)]


def predict(docs: DataFrame, model: PpmModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all, if None) and lang_pred, score, bits_per_byte of every row.

    Columns of ``docs`` with these three names give way to the new ones.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c not in VERDICT]
    out = T.StructType([docs.schema[c] for c in names]).add("lang_pred", "string").add("score", "double").add("bits_per_byte", "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    width = len(names)
    # A text that is kept anyway goes to Python once.
    place = names.index(text) if text in names else width
    rows = docs.select(*names, *([] if text in names else [F.col(text).alias("__text")]))
    return rows.mapInArrow(lambda it: _predict(it, shared, place, width), out)


def held_out() -> F.Column:
    return crc_fold() == 2


def identify(docs: DataFrame, **bounds) -> DataFrame:
    """Train on the rows with a language outside the held-out fold, then predict every row."""
    model = train(docs.where(~held_out()), **bounds)
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model, keep=["doc_id", "held_out"])


#: A text whose best code takes more bits a byte is in none of the learned languages.
MAX_BITS = 6.0


def accept(docs: DataFrame, max_bits: float = MAX_BITS, **bounds) -> DataFrame:
    """The rows whose text is in a learned language, with their own columns only, whatever their names.

    Rejected: ``und``, and texts that cost more than ``max_bits`` bits a byte
    under every language, as no prose of a learned language does. With no
    labelled text at all nothing can be judged, and all rows stay.
    """
    names = docs.columns
    model = train(docs.where(~held_out()), **bounds)
    if not model.langs:
        return docs
    judged = predict(carried(docs, "text"), model)
    judged = judged.where((F.col("lang_pred") != UND) & (F.col("bits_per_byte") <= max_bits))
    return unpacked(judged, names, ("text",))
