"""A sparse document-term matrix over Spark, and the audit of filters that reads its rows.

``encode`` deals documents into shards of about ``shard_bytes`` of text and
builds each as compressed sparse rows (CSR) over the shard's own words. The
distinct words of all shards get global ids, once each, and every shard's
columns are translated to these. What is shuffled is a row for each word of a
shard, not for each word of a text; a word that all shards hold is a row a
shard, which Spark's joins can split.

``audit`` counts how filters act in every order. A document fails A or B by its
row of the matrix: the sum of its counts are its words, the number of its
entries its distinct words. Flags of the bytes (C, D) are taken while the text
is there; E compares SHA-256 digests over the table. What a filter removes in
an order depends on the set of filters that a document fails alone, so 32
counts a part decide all 120 orders.

Defined cases: a null text is empty (it fails A); a null source is the part
``''``; a null doc_id is neither smaller nor larger than another, so E holds
neither by it nor against it; repeated rows are documents of their own; several
labels of one id count as one that has what any of them has; a very long text
is a shard alone (memory is proportional to it); an empty table has no parts.
Columns beside those named are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, PandasCogroupedOps
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import stored
from ._text import slices, text_bytes
from ._words import word_ids

#: Bytes of text in a shard; a longer text is one alone.
SHARD_BYTES = 16 << 20
#: The filters by letter, as bits of a mask from the least.
FILTERS = "ABCDE"
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_MARK = np.zeros(256, np.int64)
_MARK[list(b"#$%&*|")] = 1
_POINT = np.ones(256, np.int64)
_POINT[0x80:0xC0] = 0


class Matrix(NamedTuple):
    """words: word (binary), word_id. shards: shard, rows (array of structs), row_ends, columns (word ids), counts. parts: each shard packed, beside its words' ids."""

    words: DataFrame
    shards: DataFrame
    parts: PandasCogroupedOps


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def text_facts(column: pa.Array) -> dict[str, pa.Array]:
    """Of every text: capitals A-Z, code points, marks of ``#$%&*|``, and the SHA-256 of its UTF-8."""
    found: dict[str, list] = {"capitals": [], "points": [], "marks": [], "digest": []}
    for low, high in slices(column, 1 << 20):
        data, offsets = text_bytes(column.slice(low, high - low))
        for name, table in (("capitals", _UPPER), ("points", _POINT), ("marks", _MARK)):
            found[name].append(_sums(table[data], offsets))
        found["digest"] += [hashlib.sha256(data[a:b]).digest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    longs = {k: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for k, v in found.items() if k != "digest"}
    return longs | {"digest": pa.array(found["digest"], pa.binary())}


_FACTS = T.StructType([T.StructField(k, T.LongType()) for k in ("capitals", "points", "marks")] + [T.StructField("digest", T.BinaryType())])


def csr(ids: np.ndarray, first: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(end of each row, columns, counts) of texts given as word ids; columns ascend within a row."""
    texts = len(first) - 1
    ends, columns, counts = np.zeros(texts, np.int64), [], []
    low = done = 0
    while low < texts:  # sorts about a million words at once
        high = max(low + 1, int(np.searchsorted(first, first[low] + (1 << 20), side="right")) - 1)
        span = ids[first[low] : first[high]]
        row = np.repeat(np.arange(high - low), np.diff(first[low : high + 1]))
        key, count = np.unique(row * n_words + span, return_counts=True)
        ends[low:high] = done + np.searchsorted(key, np.arange(1, high - low + 1) * n_words)
        columns.append((key % n_words).astype(np.int32) if n_words else key.astype(np.int32))
        counts.append(count.astype(np.int32))
        done += len(key)
        low = high
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return ends, join(columns), join(counts)


def _packed(columns: np.ndarray, counts: np.ndarray) -> bytes:
    """Entries of the matrix for disk and shuffle: steps between columns and counts, byte by byte, compressed."""
    both = np.stack([np.diff(columns, prepend=np.int32(0)), counts]).astype("<i4")
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(both.reshape(-1).view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    both = np.ascontiguousarray(planes.T).view("<i4").reshape(2, -1)
    return np.cumsum(both[0], dtype=np.int32), both[1]


def _lists(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _global(shard: pa.Table, ids: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(columns as global word ids, counts) of the one shard of a group."""
    to = np.zeros(ids.num_rows, np.int64)
    to[np.asarray(ids["at"])] = np.asarray(ids["word_id"])
    columns, counts = _unpacked(shard["entries"][0].as_py())
    return to[columns], counts


def encode(docs: DataFrame, keep: list[str], text: str = "text", shard_bytes: int = SHARD_BYTES) -> Matrix:
    """The document-term matrix of ``docs``; each row carries the columns ``keep`` and facts of its text."""
    spark = docs.sparkSession
    rows_type = T.StructType([T.StructField(c, docs.schema[c].dataType) for c in keep] + [T.StructField("facts", _FACTS)])
    schema = T.StructType(
        [
            T.StructField("shard", T.LongType()),
            T.StructField("rows", T.ArrayType(rows_type)),
            T.StructField("row_ends", T.ArrayType(T.LongType())),
            T.StructField("entries", T.BinaryType()),
            T.StructField("words", T.ArrayType(T.BinaryType())),
        ]
    )

    def encoded(shard: int, part: pa.RecordBatch) -> pa.RecordBatch:
        ids, words, first = word_ids(part.column(0))
        ends, columns, counts = csr(ids, first, len(words))
        del ids
        facts = text_facts(part.column(0))
        rows = pa.StructArray.from_arrays([*part.columns[1:], pa.StructArray.from_arrays(list(facts.values()), list(facts))], [*keep, "facts"])
        fields = [pa.array([shard], pa.int64()), _lists(rows), _lists(pa.array(ends)), pa.array([_packed(columns, counts)], pa.binary()), _lists(words.cast(pa.binary()))]
        return pa.RecordBatch.from_arrays(fields, schema.names)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        for batch in batches:
            for low, high in slices(batch.column(0), shard_bytes):
                yield encoded(shard, batch.slice(low, high - low))
                shard += 1

    local = stored(docs.select(text, *keep).mapInArrow(shards, schema), "shards")
    # One id a distinct word; written, so that the ids stay as they are.
    words = stored(local.select(F.explode("words").alias("word")).distinct().select("word", F.monotonically_increasing_id().alias("word_id")), "words")
    own = local.select(F.col("shard").alias("of"), F.posexplode("words").alias("at", "word"))
    globally = own.join(words, "word").select("of", "at", "word_id")
    out = T.StructType([schema["shard"], schema["rows"], schema["row_ends"], T.StructField("columns", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.IntegerType()))])

    def translate(shard: pa.Table, ids: pa.Table) -> pa.Table:
        fields = [shard["shard"], shard["rows"], shard["row_ends"]]
        if not shard.num_rows:
            return pa.Table.from_arrays([*fields, pa.array([], pa.list_(pa.int64())), pa.array([], pa.list_(pa.int32()))], out.names)
        columns, counts = _global(shard, ids)
        return pa.Table.from_arrays([*fields, _lists(pa.array(columns)), _lists(pa.array(counts))], out.names)

    parts = local.drop("words").groupBy("shard").cogroup(globally.groupBy("of"))
    return Matrix(words, parts.applyInArrow(translate, out), parts)


def row_counts(matrix: Matrix) -> DataFrame:
    """One row a document: what it carries, n_words (sum of its row), n_distinct (entries of its row).

    A shard's rows are summed in the task that translates it, so its entries don't leave the task.
    """
    fields = matrix.shards.schema["rows"].dataType.elementType
    schema = T.StructType([*fields.fields, T.StructField("n_words", T.LongType()), T.StructField("n_distinct", T.LongType())])

    def counted(shard: pa.Table, ids: pa.Table) -> pa.Table:
        rows = shard["rows"].combine_chunks().flatten()
        ends = np.concatenate([[0], *(np.asarray(x.values) for x in shard["row_ends"])]).astype(np.int64)
        columns, counts = _global(shard, ids) if shard.num_rows else (np.zeros(0, np.int64),) * 2
        # An entry of every distinct word of a row: as many as its columns.
        found = [pa.array(_sums(counts.astype(np.int64), ends)), pa.array(_sums(np.ones(len(columns), np.int64), ends))]
        return pa.Table.from_arrays([*rows.flatten(), *found], schema.names)

    return matrix.parts.applyInArrow(counted, schema)


def failures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, part and ``mask``, whose bit i says that the document fails the filter FILTERS[i]."""
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(source), F.lit("")).alias("part"), F.col(text).alias("text"))
    counts = stored(row_counts(encode(plain, ["doc_id", "part"])), "row_counts")
    firsts = stored(counts.groupBy(F.col("facts.digest").alias("digest")).agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n"), "firsts")
    joined = counts.withColumn("digest", F.col("facts.digest")).join(firsts, "digest", "left")
    fails = [
        F.col("n_words") < 200,
        100 * F.col("n_distinct") < 50 * F.col("n_words"),
        100 * F.col("facts.capitals") > 2 * F.col("facts.points"),
        F.col("facts.marks") > 0,
        F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)),
    ]
    return joined.select("doc_id", "part", sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0)).alias("mask"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a part, order of the filters and step; see the module's text and the query's contract."""
    by_id = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    marked = failures(docs).join(stored(by_id, "labels"), "doc_id", "left")
    count = lambda c: F.coalesce(F.count_if(F.col(c)), F.lit(0)).cast("long")
    masks = marked.groupBy("part", "mask").agg(F.count("*").alias("n"), count("good").alias("good"), count("toxic").alias("toxic"))
    # At most 32 rows a part become three arrays by mask.
    named = masks.groupBy("part").agg(*[F.map_from_entries(F.collect_list(F.struct("mask", c))).alias(c) for c in ("n", "good", "toxic")])
    every = F.sequence(F.lit(0), F.lit(31))
    by_mask = lambda c: F.transform(every, lambda m: F.coalesce(F.element_at(F.col(c), m), F.lit(0))).alias(c)
    arrays = named.select("part", *[by_mask(c) for c in ("n", "good", "toxic")])
    steps = [(''.join(order), step + 1, 1 << FILTERS.index(letter), sum(1 << FILTERS.index(x) for x in order[:step])) for order in permutations(FILTERS) for step, letter in enumerate(order)]
    listed = F.from_json(F.lit("[" + ",".join(f'{{"o":"{o}","s":{s},"own":{own},"before":{before}}}' for o, s, own, before in steps) + "]"), "array<struct<o:string,s:int,own:int,before:int>>")
    rows = arrays.select("part", "n", "good", "toxic", F.explode(listed).alias("x")).select("part", "n", "good", "toxic", "x.*")

    def total(values: str, kept) -> F.Column:
        """Sum of the counts of the masks for which ``kept`` holds."""
        return F.aggregate(F.transform(F.col(values), lambda v, m: F.when(kept(m), v).otherwise(F.lit(0))), F.lit(0).cast("long"), lambda a, v: a + v)

    own, before = F.col("own"), F.col("before")
    here = lambda m: (m.bitwiseAND(own) != 0) & (m.bitwiseAND(before) == 0)
    # Of the failing filters of a document the first in the order removes it, each in an equal share of the 120 orders.
    share = lambda m: (F.lit(120) / F.greatest(F.bit_count(m), F.lit(1))).cast("long")
    shapley = F.aggregate(F.transform(F.col("n"), lambda v, m: F.when(m.bitwiseAND(own) != 0, v * share(m)).otherwise(F.lit(0))), F.lit(0).cast("long"), lambda a, v: a + v)
    return rows.select(
        "part",
        F.col("o").alias("filter_order"),
        F.col("s").alias("step"),
        total("n", lambda m: m.bitwiseAND(own.bitwiseOR(before)) == 0).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda m: (m.bitwiseAND(own) != 0) & (m.bitwiseAND(before) != 0)).alias("redundant"),
        total("n", lambda m: m == own).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        shapley.alias("shapley"),
    )
