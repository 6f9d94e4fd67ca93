"""Toxicity scores by a small convolutional text classifier trained in numpy.

Words (ASCII letters and digits and all bytes beyond ASCII; A-Z folded) are
hashed into ``BUCKETS`` embeddings; a word's vector is that of the word plus
that of its first ``PREFIX`` bytes, so that forms of one stem share. Filters over one, two and three
neighbouring words, a ReLU and the maximum over the whole text give the
features of a logistic layer; so one toxic phrase counts in a text of any
length. Training (Adam, cross-entropy with equal class weight) runs on a
bounded sample of labelled texts, chosen by hash of id and text and sent to the
driver as word buckets: of each class about ``sample_docs`` distinct texts, and
about ``sample_bytes`` bytes of text, whichever is fewer.

For scoring, embedding times filter is worked out once for each bucket and
filter position; a text then takes table look-ups and sums over Arrow batches.

``calibrate`` adds thresholds by language from labelled scores of texts that
the model has not learned from: a share ``APART`` of the ids is kept out of
every sample. A language never changes a score; it only picks the threshold of
``toxic_in_lang``.

Defined cases: a null or wordless text has the score of an empty text; rows
without a label aren't learned from, of several labels of one id the largest
holds; ids and further columns pass through; without labelled rows of both
classes every score is near 0 (near 1, if all labels are 1); an empty table
gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import crc_fold, hash_fraction, stored
from ._text import ALNUM_WORDS, slices, text_bytes, word_hashes

BUCKET_BITS, PREFIX, DIM, WIDTHS, FILTERS = 16, 5, 12, (1, 2, 3), 8
BUCKETS = 1 << BUCKET_BITS
#: A word is learned only from so many texts of the sample at least.
MIN_TEXTS = 6
LEAST_STEPS = 1000
#: Share of the labelled ids that only thresholds are learned from.
APART = 0.15
#: The row of the embedding, of zeros, that stands between texts.
BLANK = 2 * BUCKETS


@dataclass
class CnnModel:
    embed: np.ndarray  # words' buckets, prefixes' buckets, BLANK -> DIM
    filters: list[np.ndarray]  # for each width: (width, DIM, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    base: float

    def tables(self) -> list[list[np.ndarray]]:
        return [[self.embed @ w[j] for j in range(len(w))] for w in self.filters]


def buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(embedding rows of each word: its own and its prefix's, first word of each text)."""
    data, offsets = text_bytes(column)
    hashes, firsts, heads = word_hashes(data, offsets, ALNUM_WORDS, PREFIX)
    cut = np.uint64(64 - BUCKET_BITS)
    return np.stack([hashes >> cut, (heads >> cut) + np.uint64(BUCKETS)], 1).astype(np.int32), firsts


def _bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, to in slices(batch.column(0), 1 << 22):
            ids, firsts = buckets(batch.column(0).slice(at, to - at))
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(2 * firsts.astype(np.int32)), pa.array(ids.ravel())), batch.column(1).slice(at, to - at)], ["ids", "label"])


def _spread(ids: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket sequence with enough separators after each text, and the texts' first positions."""
    gap, n = max(WIDTHS) - 1, len(firsts) - 1
    gap = max(gap, 1)
    starts = firsts[:-1] + gap * np.arange(n)
    out = np.full((len(ids) + gap * n + max(WIDTHS) - 1, 2), BLANK, np.int32)
    out[np.arange(len(ids)) + gap * np.repeat(np.arange(n), np.diff(firsts))] = ids
    return out, starts


def known_labels(labels: DataFrame, label: str = "toxic") -> DataFrame:
    """(doc_id, label, apart) of every labelled id outside the held-out fold."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (crc_fold() != 2))
    return known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label")).withColumn("apart", hash_fraction("doc_id", seed=41) < APART)


def draw(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", sample_docs: int = 4000, sample_bytes: int = 8 << 20, seed: int = 4) -> DataFrame:
    """(doc_id, key, label) of the sample of distinct labelled texts, key being a text's hash."""
    known = known_labels(labels, label).where(~F.col("apart")).select(F.col("doc_id").alias("of"), "label")
    texts = docs.where(F.col(text).isNotNull()).select("doc_id", F.xxhash64(text).alias("key"), F.octet_length(text).alias("bytes"))
    texts = stored(texts.join(known, F.col("doc_id") == F.col("of")).groupBy("doc_id", "key").agg(F.max("label").alias("label"), F.max("bytes").alias("bytes")), "labelled")
    share = {}
    for r in texts.groupBy("label").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).collect():  # two rows
        share[r["label"]] = min(1.0, sample_docs / r["n"], sample_bytes / max(r["bytes"], 1))
    fraction = hash_fraction("doc_id", "key", seed=seed)
    return texts.where(fraction < F.when(F.col("label") == 1, share.get(1, 1.0)).otherwise(share.get(0, 1.0))).select("doc_id", "key", "label")


def train(docs: DataFrame, drawn: DataFrame, text: str = "text", seed: int = 4, epochs: int = 6) -> CnnModel:
    """Learn from the texts of ``docs`` that are in ``drawn``, which ``draw`` bounds."""
    ids = F.broadcast(drawn.select(F.col("doc_id").alias("__drawn"), F.col("key").alias("__key"), F.col("label").alias("__label")))
    rows = docs.select(F.col("doc_id").alias("__id"), F.col(text).alias("__text"))
    rows = rows.join(ids, (F.col("__id") == F.col("__drawn")) & (F.xxhash64("__text") == F.col("__key")))
    rows = rows.groupBy("__drawn", "__key").agg(F.first("__text").alias("text"), F.first("__label").alias("label")).select("text", "label")
    drawn = rows.mapInArrow(_bucket_rows, "ids array<int>, label int").toArrow()
    texts = [np.asarray(x.values, np.int32).reshape(-1, 2) for chunk in drawn.column("ids").chunks for x in chunk]
    labels = np.asarray(drawn.column("label").to_numpy())
    if len(set(labels.tolist())) < 2:  # nothing to tell apart
        size = len(WIDTHS) * FILTERS
        flat = [np.zeros((w, DIM, FILTERS), np.float32) for w in WIDTHS]
        return CnnModel(np.zeros((BLANK + 1, DIM), np.float32), flat, np.zeros(size, np.float32), np.zeros(size, np.float32), 20.0 if len(labels) and labels[0] == 1 else -20.0)
    order = sorted(range(len(texts)), key=lambda k: (texts[k].tobytes(), labels[k]))
    return fit([texts[k] for k in order], labels[order], seed, epochs)


def known_words(texts: list[np.ndarray], least: int = MIN_TEXTS) -> list[np.ndarray]:
    """Words of fewer than ``least`` of the texts become separators: nothing general can be learned from them."""
    held = np.zeros(BLANK + 1, np.int64)
    for ids in texts:
        held[np.unique(ids)] += 1
    return [np.where(held[ids] >= least, ids, BLANK) for ids in texts]


def forward(model: CnnModel, ids: np.ndarray, starts: np.ndarray) -> tuple:
    """(probability of each text, hidden layer, it before the ReLU, word vectors, and where each filter has its maximum)."""
    n = len(ids) - max(WIDTHS) + 1
    x = model.embed[ids].sum(1)
    tops, spots = [], []
    for w, f in zip(WIDTHS, model.filters, strict=True):
        conv = sum(x[j : n + j] @ f[j] for j in range(w))
        spot = np.array([s + conv[s:e].argmax(0) for s, e in zip(starts, [*starts[1:], n], strict=True)])
        spots.append(spot)
        tops.append(conv[spot, np.arange(FILTERS)])
    raw = np.concatenate(tops, 1) + model.bias
    hidden = np.maximum(raw, 0)
    return 1 / (1 + np.exp(-(hidden @ model.out + model.base))), hidden, raw, x, spots


def backward(model: CnnModel, ids: np.ndarray, g: np.ndarray, hidden: np.ndarray, raw: np.ndarray, x: np.ndarray, spots: list[np.ndarray]) -> tuple:
    """From the loss by each text's logit: gradients of filters, bias and out layer, and (rows, values) of the embedding's."""
    gh = g[:, None] * model.out * (raw > 0)
    grads, rows, values = [], [], []
    for k, (w, f, spot) in enumerate(zip(WIDTHS, model.filters, spots, strict=True)):
        own = gh[:, k * FILTERS : (k + 1) * FILTERS]
        gf = np.zeros_like(f)
        for j in range(w):
            gf[j] = np.einsum("bf,bfd->df", own, x[spot + j])
            rows += [ids[spot + j, 0].ravel(), ids[spot + j, 1].ravel()]
            values += [(own[:, :, None] * f[j].T[None]).reshape(-1, DIM)] * 2
        grads.append(gf)
    return [*grads, gh.sum(0), hidden.T @ g], np.concatenate(rows), np.concatenate(values)


def fit(texts: list[np.ndarray], labels: np.ndarray, seed: int = 4, epochs: int = 6, batch: int = 32, rate: float = 0.01) -> CnnModel:
    rng = np.random.default_rng(seed)
    embed = (rng.standard_normal((BLANK + 1, DIM)) * 0.1).astype(np.float32)
    texts = known_words(texts)
    seen = np.zeros(BLANK + 1, bool)
    for ids in texts:
        seen[ids] = True
    seen[BLANK] = False
    embed[~seen] = 0
    filters = [(rng.standard_normal((w, DIM, FILTERS)) / np.sqrt(w * DIM)).astype(np.float32) for w in WIDTHS]
    size = len(WIDTHS) * FILTERS
    model = CnnModel(embed, filters, np.zeros(size, np.float32), (rng.standard_normal(size) * 0.3).astype(np.float32), 0.0)
    m_embed, v_embed = np.zeros_like(embed), np.zeros_like(embed)
    small = [*filters, model.bias, model.out]
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in small]
    m_base = v_base = 0.0
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
    step = 0
    for _ in range(max(epochs, -(-LEAST_STEPS * batch // len(texts)))):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            step += 1
            which = order[at : at + batch]
            firsts = np.concatenate([[0], np.cumsum([len(texts[k]) for k in which])])
            ids, starts = _spread(np.concatenate([texts[k] for k in which]), firsts)
            p, hidden, raw, x, spots = forward(model, ids, starts)
            g = ((p - labels[which]) * weight[which] / len(which)).astype(np.float32)
            grads, rows, values = backward(model, ids, g, hidden, raw, x, spots)
            scale = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for p_, (m, v), d in zip(small, moments, grads, strict=True):
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                p_ -= scale * m / (np.sqrt(v) + 1e-7)
            db = float(g.sum())
            m_base += 0.1 * (db - m_base)
            v_base += 0.001 * (db * db - v_base)
            model.base -= scale * m_base / (v_base**0.5 + 1e-7)
            at_rows, back = np.unique(rows, return_inverse=True)
            d = np.zeros((len(at_rows), DIM), np.float32)
            np.add.at(d, back, values)
            d[at_rows == BLANK] = 0
            m_embed[at_rows] += 0.1 * (d - m_embed[at_rows])
            v_embed[at_rows] += 0.001 * (d * d - v_embed[at_rows])
            embed[at_rows] -= scale * m_embed[at_rows] / (np.sqrt(v_embed[at_rows]) + 1e-7)
    return model


def score_ids(model: CnnModel, tables: list[list[np.ndarray]], ids: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    if len(firsts) == 1:
        return np.zeros(0)
    spread, starts = _spread(ids, firsts)
    n = len(spread) - max(WIDTHS) + 1
    top = np.full((len(starts), len(WIDTHS) * FILTERS), -np.inf, np.float32)
    span = 1 << 16
    for low in range(0, n, span):
        high = min(n, low + span)
        first, last = np.searchsorted(starts, low, side="right") - 1, np.searchsorted(starts, high)
        cuts = np.maximum(starts[first:last], low) - low
        for k, tabs in enumerate(tables):
            conv = 0
            for j, tab in enumerate(tabs):
                conv = conv + tab[spread[low + j : high + j, 0]] + tab[spread[low + j : high + j, 1]]
            part = top[first:last, k * FILTERS : (k + 1) * FILTERS]
            np.maximum(part, np.maximum.reduceat(conv, cuts, axis=0), out=part)
    return 1 / (1 + np.exp(-(np.maximum(top + model.bias, 0).astype(np.float64) @ model.out + model.base)))


def _score(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    tables = None
    for batch in batches:
        model = shared.value
        tables = tables or model.tables()
        texts, found = batch.column(batch.num_columns - 1), [np.zeros(0)]
        for at, to in slices(texts, 1 << 22):
            found.append(score_ids(model, tables, *buckets(texts.slice(at, to - at))))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.concatenate(found))], names=[*batch.schema.names[:-1], "score"])


def score(docs: DataFrame, model: CnnModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all, if None) and score, the probability of label 1; an old ``score`` gives way."""
    names = [c for c in (docs.columns if keep is None else keep) if c != "score"]
    out = T.StructType([docs.schema[c] for c in names]).add("score", "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(*names, F.col(text).alias("__text")).mapInArrow(lambda it: _score(it, shared), out)


def calibrate(scored: DataFrame, lang: str = "lang", label: str = "label", bins: int = 100) -> DataFrame:
    """lang, threshold: of ``bins`` even thresholds the one of best F1 on labelled scores, ties to the one nearest 0.5.

    Counts of a histogram, so its size is languages times bins.
    """
    cell = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
    cells = scored.where(F.col(label).isin(0, 1)).groupBy(F.col(lang).alias("lang"), cell.alias("cell")).agg(F.sum(F.col(label).cast("long")).alias("hit"), F.count("*").alias("n"))
    cuts = cells.sparkSession.range(bins).select(F.col("id").cast("int").alias("cut"))
    sums = cells.join(F.broadcast(cuts), F.lit(True)).groupBy("lang", "cut").agg(
        F.sum(F.when(F.col("cell") >= F.col("cut"), F.col("hit")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("cell") >= F.col("cut"), F.col("n")).otherwise(0)).alias("said"),
        F.sum("hit").alias("all"),
    )
    f1 = 2.0 * F.col("tp") / F.greatest(F.col("said") + F.col("all"), F.lit(1))
    rank = F.struct(f1.alias("f1"), (-F.abs(F.col("cut") - bins / 2)).alias("near"), (-F.col("cut")).alias("low"))
    return sums.groupBy("lang").agg(F.max_by(F.col("cut") / F.lit(float(bins)), rank).alias("threshold"), F.max(f1).alias("f1"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **bounds) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= threshold), and lang_threshold and toxic_in_lang of every row of ``docs`` (doc_id, text, lang).

    Trained on labelled rows outside the held-out fold; the thresholds by
    language come from labelled rows that are in neither. A language without
    such rows has ``threshold``.
    """
    docs = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    model = train(docs, draw(docs, labels, **bounds))
    kept = docs.select("doc_id", (crc_fold() == 2).alias("held_out"), "lang", "text")
    scored = stored(score(kept, model, keep=["doc_id", "held_out", "lang"]), "scored")
    known = known_labels(labels).where("apart").select(F.col("doc_id").alias("__id"), "label")
    unseen = scored.join(known, F.col("doc_id") == F.col("__id"))
    cuts = calibrate(unseen).where("f1 > 0").select(F.col("lang").alias("__lang"), "threshold")
    out = scored.join(cuts, F.col("lang").eqNullSafe(F.col("__lang")), "left").withColumn("lang_threshold", F.coalesce("threshold", F.lit(threshold)))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "lang_threshold", (F.col("score") >= F.col("lang_threshold")).cast("int").alias("toxic_in_lang"))
