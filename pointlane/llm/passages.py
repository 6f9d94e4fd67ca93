"""Removal of passages that recur, located by Aho-Corasick automata over words.

A window is ``WINDOW`` consecutive words of one text. Words that a window covers
whose words also start elsewhere are removed.

1. *Chunks.* Texts are dealt into chunks of about ``CHUNK`` bytes, written once
   and bucketed by chunk, so that later steps bring small lists to them and
   never shuffle the texts again.
2. *Anchors.* Of the ``ANCHOR``-word grams in a window the one of least hash is
   its anchor: equal windows have equal anchors, and neighbouring windows share
   them, about one for eight words. Anchors that occur twice are candidates.
3. *Confirmed passages.* Windows of candidate anchors are counted by 96 bits of
   two hashes. The first place of every window that occurs twice is canonical;
   the words that canonical windows cover, cut along a grid of ``GRID`` words,
   are the passages.
4. *Automata.* A chunk gets the passages that its own windows name. They are cut
   into tiles of (WINDOW + 1) / 2 words, one of which lies in any window, and
   compiled into the chunk's automaton: it is as large as what recurs there. All
   texts of the chunk stream through it; at each place of a tile the words on
   both sides are compared with the passage, and stretches of a window or more
   are removed. So hashes only route; what is removed was compared word by word.

A key has at most one row for each chunk when it is counted, which bounds the
share of the hottest anchor or window by one in the number of anchors of a
chunk; a passage that all chunks need is sent by a join that Spark can split.

Defined cases: a null or empty text has no words; a text of fewer words than a
window keeps all; rows that repeat are texts like others, so copies lose all
their words if they have a window; a null doc_id stays null; a long text is a
chunk alone (memory in proportion to it); columns other than those named are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import new_path, stored
from ._text import byte_table, mix64, slices, text_bytes, word_hashes
from ._words import spelled, word_ids

WINDOW = 35
ANCHOR = 20
#: Bytes of text in a chunk.
CHUNK = 2 << 20
#: Words of the grid along which passages are cut (64 or fewer places in a bit mask, twice).
GRID = 128
#: Place of a word in all chunks: partition, chunk of the partition, word of the chunk.
_CHUNK_BITS, _WORD_BITS = 12, 30
_GRID_BITS = _WORD_BITS - 7
#: Pairs of a tile's place in a text and in a passage that are compared at once.
PAIRS = 1 << 19

_CASED = byte_table(b" \t\n\v\f\r", fold_case=False)
_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def _grams(hashes: np.ndarray, size: int, multiplier: np.uint64) -> np.ndarray:
    """A hash of the ``size`` words from each word on."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    powers = np.full(len(hashes) + 1, multiplier, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers[:-1], out=sums[1:])
    inverse = np.full(n, pow(int(multiplier), -1, 1 << 64), np.uint64)
    inverse[0] = 1
    np.multiply.accumulate(inverse, out=inverse)
    return mix64((sums[size:] - sums[:n]) * inverse)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least (leftmost) of ``width`` values from each place on; ``width`` is a power of two."""
    at, low = np.arange(len(values)), values
    step = 1
    while step < width:
        better = low[step:] < low[:-step]
        at = np.where(better, at[step:], at[:-step])
        low = np.where(better, low[step:], low[:-step])
        step *= 2
    return at


class _Places:
    """Windows and anchors of the texts of a chunk."""

    def __init__(self, column: pa.Array):
        parts, firsts, done = [], [np.zeros(1, np.int64)], 0
        for low, high in slices(column, 1 << 20):
            hashes, first = word_hashes(*text_bytes(column.slice(low, high - low)), _CASED)
            parts.append(hashes)
            firsts.append(first[1:] + done)
            done += len(hashes)
        self.hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.first = np.concatenate(firsts)
        n = len(self.hashes)
        self.starts = np.zeros(0, np.int64)
        self.anchor = self.value = np.zeros(0, np.uint64)
        if n < WINDOW:
            return
        text = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        self.starts = np.flatnonzero(text[WINDOW - 1 :] == text[: n - WINDOW + 1])
        grams = _grams(self.hashes, ANCHOR, _MULTIPLIERS[0])
        self.anchor = _least(grams, WINDOW - ANCHOR + 1)[self.starts]
        self.value = grams


def _packed(column: pa.Array) -> bytes:
    """Texts as words with one space between, a line each, compressed."""
    ids, vocabulary, first = word_ids(column)
    lines = spelled(ids, vocabulary, first, np.ones(len(ids), bool))
    return zstandard.ZstdCompressor(level=3).compress("\n".join(lines.to_pylist()).encode())


def _unpacked(blob: bytes, n: int) -> pa.Array:
    if n == 0:
        return pa.array([], pa.large_string())
    data = zstandard.ZstdDecompressor().decompress(blob) + b"\n"
    letters = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(letters == 10)
    lines = pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(np.concatenate([[0], ends + 1]).astype(np.int64)), pa.py_buffer(data)])
    return lines  # the line feed at a line's end separates words like a space


def _list(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


_CHUNKS = T.StructType(
    [
        T.StructField("chunk", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("blob", T.BinaryType()),
        T.StructField("anchors", T.ArrayType(T.LongType())),
    ]
)


def _chunks(docs: DataFrame, size: int) -> DataFrame:
    """The chunks, in a table bucketed by chunk. Anchors that a chunk holds more than once are listed twice."""
    spark = docs.sparkSession

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth = 0
        for batch in batches:
            for low, high in slices(batch.column(1), size):
                if nth >= 1 << _CHUNK_BITS:
                    raise ValueError("a partition holds too many chunks; repartition the documents")
                part = batch.slice(low, high - low)
                places = _Places(part.column(1))
                if len(places.hashes) >= 1 << _WORD_BITS:
                    raise ValueError("a text has more than 2^30 words")
                anchors, times = np.unique(places.value[np.unique(places.anchor)].view(np.int64) if len(places.anchor) else np.zeros(0, np.int64), return_counts=True)
                both = np.concatenate([anchors, anchors[times > 1]])
                chunk = (TaskContext.get().partitionId() << _CHUNK_BITS) + nth
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int64()), _list(part.column(0), pa.int64()), pa.array([_packed(part.column(1))], pa.binary()), _list(both, pa.int64())], _CHUNKS.names
                )
                nth += 1

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"chunks_{uuid.uuid4().hex}"
    docs.mapInArrow(work, _CHUNKS).repartition(n, "chunk").write.bucketBy(n, "chunk").option("path", new_path(spark, "chunks")).saveAsTable(name)
    return spark.table(name)


_WINDOWS = "chunk bigint, a bigint, b int, low bigint, times int"
_PASSAGES = "piece bigint, words string"
_CLEAN = "doc_id bigint, n_words bigint, spans array<struct<begin:bigint,end:bigint>>, kept string"


def _windows(chunk: pa.Table, listed: pa.Table) -> pa.Table:
    """The distinct windows of a chunk that have one of its listed anchors: two hashes, first place, times (2: or more)."""
    names = [c.split()[0] for c in _WINDOWS.split(", ")]
    if not chunk.num_rows:
        return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32())], names)
    key = chunk["chunk"][0].as_py()
    places = _Places(_unpacked(chunk["blob"][0].as_py(), len(chunk["doc_ids"][0])))
    wanted = np.isin(places.value.view(np.int64)[places.anchor], np.asarray(listed["anchor"])) if len(places.anchor) else np.zeros(0, bool)
    at = places.starts[wanted]
    a = _grams(places.hashes, WINDOW, _MULTIPLIERS[0])[at].view(np.int64)
    b = (_grams(places.hashes, WINDOW, _MULTIPLIERS[1])[at] >> np.uint64(33)).astype(np.int32)
    order = np.lexsort((at, b, a))
    a, b, at = a[order], b[order], at[order]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    heads = np.flatnonzero(fresh)
    times = np.minimum(2, np.diff(np.append(heads, len(a)))).astype(np.int32)
    low = (np.int64(key) << _WORD_BITS) + at[heads]
    return pa.table([pa.array(np.full(len(heads), key)), pa.array(a[heads]), pa.array(b[heads]), pa.array(low), pa.array(times)], names)


def _cut(chunk: pa.Table, canonical: pa.Table) -> pa.Table:
    """The passages of a chunk by grid piece: covered words, a line for each unbroken stretch within a text."""
    kinds = pa.schema([("piece", pa.int64()), ("words", pa.string())])
    if not chunk.num_rows or not canonical.num_rows:
        return kinds.empty_table()
    pieces = np.asarray(canonical["piece"])
    masks = [np.asarray(canonical[c]).view(np.uint64) for c in ("m0", "m1")]
    bits = np.concatenate([(m[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1) for m in masks], 1).astype(bool)
    ids, vocabulary, first = word_ids(_unpacked(chunk["blob"][0].as_py(), len(chunk["doc_ids"][0])))
    base = (pieces & ((1 << _GRID_BITS) - 1)) * GRID
    texts = []
    begins = np.zeros(len(ids) + 1, bool)
    begins[first] = True
    for low, row in zip(base, bits, strict=True):
        starts = low + np.flatnonzero(row)
        # Stretches that windows cover without a gap; windows never leave their text.
        cover = np.zeros(GRID + WINDOW, np.int64)
        np.add.at(cover, starts - low, 1)
        np.add.at(cover, starts - low + WINDOW, -1)
        covered = low + np.flatnonzero(np.cumsum(cover) > 0)
        split = np.flatnonzero((np.diff(covered) > 1) | begins[covered[1:]]) + 1
        texts.append("\n".join(b" ".join(vocabulary.take(pa.array(ids[s])).to_pylist()).decode() for s in np.split(covered, split)))
    return pa.table([pa.array(pieces), pa.array(texts, pa.string())], schema=kinds)


def locate(ids: np.ndarray, first: np.ndarray, passages: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Which words of the texts lie in a stretch of WINDOW words or more that a passage holds too.

    ``passages``: word ids of all passages one after another; ``stops``: where each begins, and the end.
    """
    tile = (WINDOW + 1) // 2
    removed = np.zeros(len(ids), bool)
    heads = np.concatenate([np.arange(s, e - tile + 1, tile) for s, e in zip(stops[:-1], stops[1:], strict=True)] or [np.zeros(0, np.int64)])
    if not len(heads) or not len(ids):
        return removed
    top = int(max(ids.max(), passages.max())) + 1
    # One word apart, so that no tile reaches over the end of a text or passage.
    side = tile
    data, place = _apart(ids, first, top, side)
    held, at = _apart(passages, stops, top + 1, side)
    rows = held[at[heads][:, None] + np.arange(tile)]
    kinds, kind = np.unique(rows, axis=0, return_inverse=True)
    kind = kind.ravel()
    order = np.argsort(kind, kind="stable")
    bounds = np.searchsorted(kind[order], np.arange(len(kinds) + 1))
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for i, row in enumerate(kinds.tolist()):
        automaton.add_word(tuple(row), i)
    automaton.make_automaton()
    hits = np.array(list(automaton.iter(tuple(data.tolist()))), np.int64).reshape(-1, 2)
    if not len(hits):
        return removed
    x, t = hits[:, 0] - tile + 1, hits[:, 1]
    many = bounds[t + 1] - bounds[t]
    done = np.cumsum(many)
    change = np.zeros(len(data) + 1, np.int64)
    low = 0
    while low < len(x):
        high = max(low + 1, int(np.searchsorted(done, (done[low - 1] if low else 0) + PAIRS, side="right")))
        for part in range(0, int(many[low:high].max()), PAIRS):  # one tile may stand in very many passages
            n = np.clip(many[low:high] - part, 0, PAIRS)
            each = np.repeat(np.arange(low, high), n)
            nth = part + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
            y = at[heads[order[bounds[t[each]] + nth]]]
            u = x[each]
            left, right = np.zeros(len(u), np.int64), np.zeros(len(u), np.int64)
            for back, out in ((True, left), (False, right)):
                live = np.arange(len(u))
                for step in range(tile - 1):
                    i, j = (u[live] - 1 - step, y[live] - 1 - step) if back else (u[live] + tile + step, y[live] + tile + step)
                    live = live[data[i] == held[j]]
                    if not len(live):
                        break
                    out[live] += 1
            good = left + tile + right >= WINDOW
            np.add.at(change, u[good] - left[good], 1)
            np.add.at(change, u[good] + tile + right[good], -1)
        low = high
    return (np.cumsum(change)[:-1] > 0)[place]


def _apart(ids: np.ndarray, first: np.ndarray, stop: int, side: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequences with ``side`` stop symbols before, between and after; and the new place of every word."""
    which = np.repeat(np.arange(len(first) - 1), np.diff(first))
    place = np.arange(len(ids)) + side * (which + 1)
    data = np.full(len(ids) + side * len(first), stop, np.int64)
    data[place] = ids
    return data, place


def _removed(chunk: pa.Table, passages: pa.Table) -> pa.Table:
    names = ["doc_id", "n_words", "spans", "kept"]
    spans_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    if not chunk.num_rows:
        return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), spans_type, pa.string())], names)
    doc_ids = chunk["doc_ids"].combine_chunks().flatten()
    n = len(doc_ids)
    texts = _unpacked(chunk["blob"][0].as_py(), n)
    stretches = pc.list_flatten(pc.split_pattern(passages["words"].combine_chunks(), "\n")).cast(pa.large_string()) if passages.num_rows else pa.array([], pa.large_string())
    ids, vocabulary, first = word_ids(pa.concat_arrays([texts, stretches]))
    words, own = first[n], first[: n + 1]
    gone = locate(ids[:words], own, ids[words:], first[n:] - words)
    kept = spelled(ids[:words], vocabulary, own, ~gone)
    # Spans of removed words, by text.
    flat = np.concatenate([[False], gone, [False]])
    text = np.repeat(np.arange(n), np.diff(own))
    edge = np.zeros(words + 1, bool)
    edge[own] = True
    begin = np.flatnonzero(gone & (~flat[:-2] | edge[:-1]))
    end = np.flatnonzero(gone & (~flat[2:] | edge[1:])) + 1
    of = text[begin]
    pairs = pa.StructArray.from_arrays([pa.array(begin - own[of]), pa.array(end - own[of])], ["begin", "end"])
    spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(n + 1)).astype(np.int32)), pairs)
    return pa.table([doc_ids, pa.array(np.diff(own)), spans, kept.cast(pa.string())], names)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK) -> DataFrame:
    """doc_id, n_words, the spans of words removed, and the words kept, joined by one space."""
    chunks = _chunks(docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")), chunk_bytes)
    texts = chunks.select("chunk", "doc_ids", "blob")
    # A chunk lists an anchor once or twice, so a group has two rows a chunk at most.
    anchors = chunks.select(F.col("chunk").alias("of"), F.explode("anchors").alias("anchor"))
    recurring = anchors.withColumn("n", F.count("*").over(Window.partitionBy("anchor"))).where("n > 1").select("of", "anchor")
    windows = texts.groupBy("chunk").cogroup(recurring.groupBy("of")).applyInArrow(_windows, _WINDOWS)
    same = Window.partitionBy("a", "b")
    confirmed = windows.select("chunk", F.sum("times").over(same).alias("n"), F.min("low").over(same).alias("low")).where("n > 1")
    place = F.col("low").bitwiseAND(GRID - 1).cast("int")
    bit = lambda half: F.when(F.shiftright(place, 6) == half, F.expr(f"shiftleft(1L, cast(low & 63 as int))")).otherwise(F.lit(0).cast("long"))  # noqa: E731, F541
    needs = stored(
        confirmed.select(F.col("chunk").alias("of"), F.shiftright("low", 7).alias("piece"), bit(0).alias("m0"), bit(1).alias("m1"))
        .groupBy("of", "piece").agg(F.bit_or("m0").alias("m0"), F.bit_or("m1").alias("m1")),
        "needs",
    )
    home = F.shiftright("piece", _GRID_BITS)
    # Every window stands in its canonical chunk too, so that chunk's own row has all of a piece's windows.
    canonical = needs.where(F.col("of") == home).select("of", "piece", "m0", "m1")
    pieces = stored(texts.groupBy("chunk").cogroup(canonical.groupBy("of")).applyInArrow(_cut, _PASSAGES), "passages")
    sent = needs.select("of", "piece").join(pieces, "piece").select("of", "words")
    return texts.groupBy("chunk").cogroup(sent.groupBy("of")).applyInArrow(_removed, _CLEAN)


def digests(clean: DataFrame) -> DataFrame:
    """Of what ``remove_repeats`` returns: counts, and a digest of the words kept."""
    gone = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["begin"])
    return clean.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
