"""Pairs within groups of any size, as bounded tiles.

A group's members are dealt by hash into chunks; a tile is a pair of chunks.
Every pair of members meets in exactly one tile, a tile holds two chunks at
most, and tiles of one group run in many tasks. A large group has larger
chunks, up to ``MOST``, so that members are copied fewer times.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import stored

LEAST, MOST, CHUNKS = 128, 4096, 16


def dealt(members: DataFrame, group: list[str], key: str, least: int = LEAST, most: int = MOST, home: str | None = None, counted: DataFrame | None = None) -> DataFrame:
    """Rows of ``members`` copied to the tiles they belong to and sorted by tile.

    Added columns: tile_i <= tile_j, and ``chunk``, the row's own chunk, which
    is one of the two. With ``home``, a boolean column, only pairs with a row
    at home are wanted: other rows (visitors) have chunks of their own, which
    never meet each other. With ``counted``, the same rows without their wide
    columns, groups are counted there and the counts written before the join:
    a hot group is then a skewed join of two plain inputs, which Spark splits.
    """
    own = F.col(home) if home else F.lit(True)
    sizes = (members if counted is None else counted).groupBy(*group).agg(F.count_if(own).alias("__homes"), F.count_if(~own).alias("__guests"))
    target = lambda n: F.least(F.greatest(F.ceil(F.col(n) / CHUNKS), F.lit(least)), F.lit(most))
    chunks = lambda n: F.ceil(F.col(n) / target(n)).cast("int").alias(f"{n}_chunks")
    sizes = sizes.where("__homes > 0").select(*[F.col(g).alias(f"__{g}") for g in group], chunks("__homes"), chunks("__guests"))
    sizes = sizes if counted is None else stored(sizes, "sizes")
    rows = members.join(sizes, [F.col(g) == F.col(f"__{g}") for g in group]).drop(*[f"__{g}" for g in group])
    place = lambda n: F.pmod(F.xxhash64(F.lit(17), F.col(key)), F.greatest(F.col(n), F.lit(1))).cast("int")
    homes, guests = F.col("__homes_chunks"), F.col("__guests_chunks")
    rows = rows.withColumn("chunk", F.when(own, place("__homes_chunks")).otherwise(homes + place("__guests_chunks")))
    rows = rows.withColumn("__other", F.explode(F.sequence(F.lit(0), F.when(own, homes + guests).otherwise(homes) - 1)))
    rows = rows.withColumn("tile_i", F.least("chunk", "__other")).withColumn("tile_j", F.greatest("chunk", "__other")).drop("__homes_chunks", "__guests_chunks", "__other")
    tile = [*group, "tile_i", "tile_j"]
    return rows.repartition(*tile).sortWithinPartitions(*tile, key)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each run of equal keys, of which each is in memory alone."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[a] for c in columns)
            if held and key != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def stretches(batches: Iterator[pa.RecordBatch], keys: list[str], least: int = 16_384) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows of whole runs of equal keys, first row of each run), of several runs at once where these are small."""

    def changes(table: pa.Table) -> np.ndarray:
        new = np.ones(table.num_rows, bool)
        new[1:] = False
        for k in keys:
            c = table.column(k).to_numpy()
            new[1:] |= c[1:] != c[:-1]
        return np.flatnonzero(new)

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= least:
            table = pa.Table.from_batches(held).combine_chunks()
            starts = changes(table)
            held, size = table.to_batches(), table.num_rows
            if len(starts) > 1:  # the last run may go on
                yield table.slice(0, int(starts[-1])), starts[:-1]
                rest = table.slice(int(starts[-1])).combine_chunks()
                held, size = rest.to_batches(), rest.num_rows
            least = max(least, 2 * size)
    if size:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, changes(table)


class Forest:
    """Union-find over positions 0 to n - 1."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = self.up[self.up[k]]
            k = self.up[k]
        return k

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b
