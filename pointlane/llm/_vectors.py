"""Vector columns as packed bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import hash_fraction, stored


def _packed(batches: Iterator[pa.RecordBatch], dim: int, kind: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        lists = batch.column(1)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)
        at = 0
        for size in (-1 if n is None else n for n in pa.compute.list_value_length(lists).to_pylist()):
            row = flat[at : at + max(size, 0)]
            at += max(size, 0)
            out.append(row.tobytes() if size == dim and np.isfinite(row).all() and row.any() else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["vec_id", "vec"])


def packed(table: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int, str]:
    """((vec_id, vec) of every row, dimensions, numpy type); written to the shared folder.

    vec is null for vectors that are null, zero, hold null or non-finite
    components, or have another length than most.
    """
    kind = "<f4" if isinstance(table.schema[vector].dataType.elementType, T.FloatType) else "<f8"
    sizes = table.where(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("dim")).count()
    top = sizes.orderBy(F.desc("count"), "dim").first()
    dim = max(1, int(top["dim"])) if top else 1
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("v"))
    return stored(rows.mapInArrow(lambda it: _packed(it, dim, kind), "vec_id long, vec binary"), "vectors"), dim, kind


def raw_matrix(column, kind: str, dim: int) -> np.ndarray:
    """Packed vectors, none of them null, in their own precision and without a copy."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        return np.concatenate([raw_matrix(c, kind, dim) for c in column.chunks]) if column.num_chunks else np.zeros((0, dim), kind)
    if not len(column):
        return np.zeros((0, dim), kind)
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    start = int(np.frombuffer(column.buffers()[1], wide, count=column.offset + 1)[column.offset])
    return np.frombuffer(column.buffers()[2], kind, count=len(column) * dim, offset=start).reshape(-1, dim)


def matrix(column, kind: str, dim: int) -> np.ndarray:
    return raw_matrix(column, kind, dim).astype(np.float64)


def sample(nodes: DataFrame, dim: int, kind: str, most: int, seed: int) -> tuple[np.ndarray, int]:
    """(about ``most`` of the distinct vectors ``nodes``, chosen by hash, in order of their bytes; number of all)."""
    total = nodes.count()
    drawn = nodes.select("vec") if total <= most else nodes.select("vec").where(hash_fraction("vec", seed=seed) < most / total)
    rows = drawn.toArrow().sort_by("vec")
    return matrix(rows.column("vec"), kind, dim), total
