"""Reproducible shuffle into shards by a Feistel permutation of row numbers.

Rows are numbered 0 to N - 1 in the order of (doc_id, text hash), nulls first,
by a range-partitioned sort whose partitions are counted: no task sees more
than its range. A Feistel network over pairs of residues (left modulo a, right
modulo b, a * b just above N) permutes the pairs; a result of N or more is
permuted again (cycle walking) until it lies below N. The permuted number p
gives shard p mod S and slot p div S, which anyone can compute from the row
number alone; shard sizes differ by one at most (law ``rows``).

Defined cases: null texts have size 1 and the crc of no bytes; rows that are
equal in id and text are interchangeable; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import stored

ROUNDS = 6


def _round(x: np.ndarray, key: int) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def permute(rows: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """The place of each row number among 0 to n - 1; a bijection."""
    if n <= 1:
        return np.zeros(len(rows), np.int64)
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)
    out = np.asarray(rows, np.int64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] // b, out[todo] % b
        for k in range(ROUNDS):
            key = (seed * ROUNDS + k + 1) * 0xD1342543DE82EF95 % (1 << 64)
            if k % 2:
                right = (right + (_round(left, key) % np.uint64(b)).astype(np.int64)) % b
            else:
                left = (left + (_round(right, key) % np.uint64(a)).astype(np.int64)) % a
        out[todo] = left * b + right
        todo = todo[out[todo] >= n]
    return out


def number_rows(rows: DataFrame, order: list) -> tuple[DataFrame, int]:
    """(``rows`` with row_number from 0 in the given order, number of rows)."""
    ranged = rows.withColumn("__tie", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(*order, "__tie").sortWithinPartitions(*order, "__tie")
    low = F.lit((1 << 33) - 1)
    placed = stored(ranged.drop("__tie").withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id().bitwiseAND(low)), "placed")
    sizes = {r["__part"]: r["n"] for r in placed.groupBy("__part").agg(F.count("*").alias("n")).collect()}  # a row for each task
    before, total = {}, 0
    for part in sorted(sizes):
        before[part] = total
        total += sizes[part]
    offsets = rows.sparkSession.createDataFrame([(p, o) for p, o in before.items()] or [(0, 0)], "of int, before long")
    numbered = placed.join(F.broadcast(offsets), F.col("__part") == F.col("of"))
    return numbered.withColumn("row_number", F.col("__at") + F.col("before")).drop("__part", "__at", "of", "before"), total


def _placed(batches: Iterator[pa.RecordBatch], n: int, shards: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        p = permute(batch.column(batch.num_columns - 1).to_numpy(), n, seed)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((p % shards).astype(np.int32)), pa.array(p // shards)], names=[*batch.schema.names, "shard", "slot"])


def shard(docs: DataFrame, shards: int = 16, seed: int = 0) -> DataFrame:
    """doc_id, size, text_crc32, row_number, shard, slot of every row of ``docs`` (doc_id, text)."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.xxhash64(raw).alias("__text"))
    numbered, n = number_rows(rows, ["doc_id", "__text"])
    numbered = numbered.select("doc_id", "size", "text_crc32", "row_number")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return numbered.mapInArrow(lambda it: _placed(it, n, shards, seed), f"doc_id {kind}, size long, text_crc32 long, row_number long, shard int, slot long")
