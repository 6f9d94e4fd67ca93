"""Near-duplicate vectors by cosine: a subspace pigeonhole join.

Unit vectors with cosine >= t are within squared distance 2 - 2t. A rotation
(principal axes of a bounded sample, dealt to blocks so that these carry like
variance) splits a vector into low-dimensional blocks, and the squared
distance is budgeted over them in proportion to their variance: a pair in
range is within budget in one block at least.

Range join within a block: its axes are cut at quantiles into cells; a vector
is at home in one cell and visits every lower-numbered cell that its budget
reaches, so every pair in block range meets in one cell. There are as many
cells as make the fewest rows, as estimated on the sample, with no bound.
Cells run as bounded tiles (``_tiles``), however many vectors they hold, and
only the block's few coordinates travel to them.

A tile gives the pairs in range in which one row has few partners; they are
bounded by the tile's rows and are verified once, by joins with the original
vectors. Rows with many partners (groups of near copies) are busy: pairs among
them are verified in tiles of their own, to which the original vectors of busy
rows alone travel, and which return sums of links by vector and a spanning
forest, never all pairs.

A link is a cosine of ``cosine`` or more in double precision on the original
vectors. A pair counts only in its first block within budget, so it counts
once. Equal vectors are one node of some weight. Components as in
``_components``.

Defined cases: unusable vectors (see ``_vectors``) and rows without an id link
with nothing (component: the own id) and are kept; repeated rows count each;
rows of one id with other vectors are one node, whose links add up; an empty
table gives no row; further columns and labels are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._components import connected_components
from ._shared import stored
from ._tiles import Forest, dealt, runs
from ._vectors import matrix, packed, raw_matrix, sample

SAMPLE, TILE_ROWS, CHUNK = 20_000, 1 << 16, 256
#: A row with more partners in a tile is busy.
BUSY = 4


@dataclass
class Blocks:
    rotation: np.ndarray  # dim x dim; columns of a block stand together, strongest first
    edges: list[int]  # block k is columns edges[k] to edges[k + 1]
    budget: np.ndarray  # squared distance allowed in each block
    cuts: list[list[np.ndarray]]  # for each block, where each of its first axes is cut


def reach(x: np.ndarray, cuts: list[np.ndarray], budget: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell) of all cells within budget that aren't numbered above the row's own, and each row's own cell."""
    row, cell, away, home = np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros(len(x)), np.zeros(len(x), np.int64)
    for k, edges in enumerate(cuts):
        low, high = np.concatenate([[-np.inf], edges]), np.concatenate([edges, [np.inf]])
        gap = np.maximum(np.maximum(low - x[:, k, None], x[:, k, None] - high), 0) ** 2
        home = home * len(low) + np.searchsorted(edges, x[:, k], side="left")
        total = away[:, None] + gap[row]
        at, to = np.nonzero((total <= budget * (1 + 1e-6)) & (cell[:, None] * len(low) + np.arange(len(low)) <= home[row][:, None]))
        row, cell, away = row[at], cell[at] * len(low) + to, total[at, to]
    return row, cell, home


def choose_cuts(x: np.ndarray, total: int, budget: float, tile_rows: int) -> list[np.ndarray]:
    """Quantiles to cut a block's axes at: the number of cells that makes the fewest rows of tiles."""
    best, fewest, some = [], float("inf"), x[:2000]
    for level in range(0, 40):
        bits = [level // x.shape[1] + (k < level % x.shape[1]) for k in range(x.shape[1])]
        cuts = [np.unique(np.quantile(x[:, k], np.arange(1, 1 << b) / (1 << b))) for k, b in enumerate(bits) if b]
        if len(some):
            visits = len(reach(some, cuts, budget)[0]) / len(some) - 1
            homes = total / 2**level
            chunks = max(1, np.ceil(homes / tile_rows))
            rows = total * (chunks + np.ceil(homes * visits / tile_rows) + visits * chunks)
            if rows < fewest:
                best, fewest = cuts, rows
            if visits > 64:
                break
        if total / 2**level <= tile_rows:
            break
    return best


def fit(vectors: np.ndarray, total: int, cosine: float, block_dim: int, tile_rows: int = TILE_ROWS) -> Blocks:
    dim = vectors.shape[1]
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True) if len(vectors) else np.zeros((0, dim))
    spread, axes = np.linalg.eigh(unit.T @ unit / max(1, len(unit)) - np.outer(m := unit.mean(0) if len(unit) else np.zeros(dim), m))
    spread, axes = np.maximum(spread[::-1], 0), axes[:, ::-1]
    n = max(1, -(-dim // block_dim))
    order = [[k for k in range(dim) if (k % n if (k // n) % 2 == 0 else n - 1 - k % n) == b] for b in range(n)]
    share = np.array([spread[o].sum() for o in order]) + 1e-9
    limit = (2 - 2 * cosine) * (1 + 1e-9) + 1e-9
    budget = limit * share / share.sum()
    rotated = unit @ axes
    cuts = [choose_cuts(rotated[:, o], total, b, tile_rows) for o, b in zip(order, budget, strict=True)]
    return Blocks(axes[:, sum(order, [])], np.cumsum([0, *map(len, order)]).tolist(), budget, cuts)


def _spread(batches: Iterator[pa.RecordBatch], shared, kind: str) -> Iterator[pa.RecordBatch]:
    """A row for each block and cell of a vector, with its coordinates in the block."""
    blocks: Blocks = shared.value
    dim = len(blocks.rotation)
    for whole in batches:
        for at in range(0, whole.num_rows, 2048):
            batch = whole.slice(at, 2048)
            v = matrix(batch.column(1), kind, dim)
            r = v / np.linalg.norm(v, axis=1, keepdims=True) @ blocks.rotation
            for b, cuts in enumerate(blocks.cuts):
                x = r[:, blocks.edges[b] : blocks.edges[b + 1]]
                row, cell, home = reach(x, cuts, blocks.budget[b])
                part = [y.tobytes() for y in x.astype("<f4")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), b, np.int32)), pa.array(cell), pa.array(cell == home[row]), batch.column(0).take(pa.array(row)), pa.array(part, pa.binary()).take(pa.array(row))],
                    ["block", "cell", "home", "node", "part"],
                )


_TILE = ["block", "cell", "tile_i", "tile_j"]


def _near(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Of each tile the pairs in block range with a row of few partners (b given), and its busy rows (b null)."""
    for tile in runs(batches, _TILE):
        key = [tile.column(k)[0].as_py() for k in _TILE]
        nodes, chunks, homes = tile.column("node"), tile.column("chunk"), tile.column("home")
        for x, y in near_pairs(tile, shared.value):
            x = pa.array(x)
            other = pa.nulls(len(x), pa.int64()) if y is None else nodes.take(pa.array(y)).combine_chunks()
            same = [pa.array([k] * len(x), t) for k, t in zip(key, (pa.int32(), pa.int64(), pa.int32(), pa.int32()), strict=True)]
            yield pa.RecordBatch.from_arrays([*same, chunks.take(x).combine_chunks(), homes.take(x).combine_chunks(), nodes.take(x).combine_chunks(), other], [*_TILE, "chunk", "home", "a", "b"])


def near_pairs(tile: pa.Table, blocks: Blocks, busy: int = BUSY) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    b = tile.column("block")[0].as_py()
    part = raw_matrix(tile.column("part"), "<f4", blocks.edges[b + 1] - blocks.edges[b])
    chunk, home = tile.column("chunk").to_numpy(), tile.column("home").to_numpy(zero_copy_only=False).astype(bool)
    i, j = tile.column("tile_i")[0].as_py(), tile.column("tile_j")[0].as_py()
    square, one = (part**2).sum(1)[:, None], np.ones((len(part), 1), np.float32)
    # The product of a row of one and a row of the other is their squared distance in the block.
    asks, holds = np.hstack([-2 * part, one, square]), np.hstack([part, square, one])
    left = np.flatnonzero(chunk == i)
    right = left if i == j else np.flatnonzero(chunk == j)
    limit = np.float32(blocks.budget[b] + 1e-5)

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, len(left), CHUNK):
            own = left[at : at + CHUNK]
            to = right[at:] if i == j else right
            flat = np.flatnonzero(asks[own] @ holds[to].T <= limit)
            for low in range(0, len(flat), 1 << 20):
                x, y = own[flat[low : low + (1 << 20)] // len(to)], to[flat[low : low + (1 << 20)] % len(to)]
                keep = home[x] | home[y]
                if i == j:
                    keep &= x < y
                yield x[keep], y[keep]

    partners, found, held = np.zeros(len(part), np.int64), [], 0
    for x, y in pairs():
        partners += np.bincount(x, minlength=len(part)) + np.bincount(y, minlength=len(part))
        held += len(x)
        if held <= 4 * busy * len(part):
            found.append((x, y))
    few = partners <= busy
    # Too many pairs to hold are found a second time.
    for x, y in found if held <= 4 * busy * len(part) else pairs():
        sel = few[x] | few[y]
        if sel.any():
            yield x[sel], y[sel]
    if not few.all():
        yield np.flatnonzero(~few), None


def first_block(p: np.ndarray, q: np.ndarray, blocks: Blocks) -> np.ndarray:
    """Of pairs of rotated unit vectors the first block within budget, or -1."""
    within = np.add.reduceat((p - q) ** 2, blocks.edges[:-1], axis=1) <= blocks.budget
    return np.where(within.any(1), within.argmax(1), -1)


def _verified(batches: Iterator[pa.RecordBatch], shared, kind: str, cosine: float) -> Iterator[pa.RecordBatch]:
    """Links among pairs that come with both vectors: (a, b, 0), and (a, a, n) for n links of a."""
    blocks: Blocks = shared.value
    dim = len(blocks.rotation)
    for whole in batches:
        for at in range(0, whole.num_rows, 4096):
            batch = whole.slice(at, 4096)
            block, a, b, a_weight, b_weight = (batch.column(k).to_numpy() for k in range(5))
            x, y = matrix(batch.column(5), kind, dim), matrix(batch.column(6), kind, dim)
            x_norm, y_norm = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
            linked = np.einsum("ij,ij->i", x, y) / (x_norm * y_norm) >= cosine
            linked &= first_block(x / x_norm[:, None] @ blocks.rotation, y / y_norm[:, None] @ blocks.rotation, blocks) == block
            a, b, a_weight, b_weight = a[linked], b[linked], a_weight[linked], b_weight[linked]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in ([a, a, b], [b, a, b], [np.zeros(len(a), np.int64), b_weight, a_weight])], ["a", "b", "n"])


def _linked(batches: Iterator[pa.RecordBatch], shared, kind: str, cosine: float) -> Iterator[pa.RecordBatch]:
    for tile in runs(batches, _TILE):
        nodes, others, links = link_tile(tile, shared.value, kind, cosine)
        if len(nodes):
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(others), pa.array(links)], ["a", "b", "n"])


def link_tile(tile: pa.Table, blocks: Blocks, kind: str, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, n): with b, a forest's link; without (b = a), n more links of a."""
    b = tile.column("block")[0].as_py()
    v = matrix(tile.column("vec"), kind, len(blocks.rotation))
    nodes, weight = tile.column("node").to_numpy(), tile.column("weight").to_numpy()
    home, chunk = tile.column("home").to_numpy(zero_copy_only=False).astype(bool), tile.column("chunk").to_numpy()
    i, j = tile.column("tile_i")[0].as_py(), tile.column("tile_j")[0].as_py()
    norm = np.linalg.norm(v, axis=1)
    r = v / norm[:, None] @ blocks.rotation
    part = r[:, blocks.edges[b] : blocks.edges[b + 1]]
    square = (part**2).sum(1)
    left = np.flatnonzero(chunk == i)
    right = left if i == j else np.flatnonzero(chunk == j)
    degree, forest, a_out, b_out = np.zeros(len(nodes), np.int64), Forest(len(nodes)), [], []
    for at in range(0, len(left), CHUNK):
        own = left[at : at + CHUNK]
        to = right[at:] if i == j else right
        flat = np.flatnonzero(square[own][:, None] + square[to] - 2 * part[own] @ part[to].T <= blocks.budget[b] + 1e-5)
        for from_ in range(0, len(flat), 1 << 16):
            x, y = own[flat[from_ : from_ + (1 << 16)] // len(to)], to[flat[from_ : from_ + (1 << 16)] % len(to)]
            keep = home[x] | home[y]
            if i == j:
                keep &= x < y
            p, q = x[keep], y[keep]
            p, q = p[sel := first_block(r[p], r[q], blocks) == b], q[sel]
            linked = np.einsum("ij,ij->i", v[p], v[q]) / (norm[p] * norm[q]) >= cosine
            p, q = p[linked], q[linked]
            np.add.at(degree, p, weight[q])
            np.add.at(degree, q, weight[p])
            for s, t in zip(p.tolist(), q.tolist(), strict=True):
                if forest.join(s, t):
                    a_out.append(nodes[s])
                    b_out.append(nodes[t])
    some = np.flatnonzero(degree)
    return (np.concatenate([np.array(a_out, np.int64), nodes[some]]), np.concatenate([np.array(b_out, np.int64), nodes[some]]), np.concatenate([np.zeros(len(a_out), np.int64), degree[some]]))


def near_duplicates(table: DataFrame, vector: str = "embedding", cosine: float = 0.95, block_dim: int = 16) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    rows, dim, kind = packed(table, vector)
    rows = rows.withColumn("key1", F.when(F.col("vec").isNotNull(), F.xxhash64(F.lit(1), "vec"))).withColumn("key2", F.when(F.col("vec").isNotNull(), F.xxhash64(F.lit(2), "vec")))
    nodes = rows.where("vec IS NOT NULL AND vec_id IS NOT NULL").groupBy("key1", "key2").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"), F.first("vec").alias("vec"))
    nodes = stored(nodes, "nodes")
    drawn, total = sample(nodes, dim, kind, SAMPLE, seed=10)
    # Two chunks a block at least, so that small tables keep several tasks busy.
    tile_rows = min(TILE_ROWS, max(1024, -(-total // 2)))
    shared = table.sparkSession.sparkContext.broadcast(fit(drawn, total, cosine, block_dim, tile_rows))
    placed = nodes.select("node", "vec").mapInArrow(lambda it: _spread(it, shared, kind), "block int, cell long, home boolean, node long, part binary")
    tiles = dealt(placed, ["block", "cell"], "node", least=tile_rows, most=tile_rows, home="home")
    near = stored(tiles.mapInArrow(lambda it: _near(it, shared), "block int, cell long, tile_i int, tile_j int, chunk int, home boolean, a long, b long"), "near")
    side = lambda c: nodes.select(F.col("node").alias(f"of_{c}"), F.col("weight").alias(f"{c}_weight"), F.col("vec").alias(f"{c}_vec"))
    pairs = near.where("b IS NOT NULL").select("block", "a", "b").join(side("a"), F.col("a") == F.col("of_a")).join(side("b"), F.col("b") == F.col("of_b"))
    sparse = pairs.select("block", "a", "b", "a_weight", "b_weight", "a_vec", "b_vec").mapInArrow(lambda it: _verified(it, shared, kind, cosine), "a long, b long, n long")
    busy = near.where("b IS NULL").join(side("a"), F.col("a") == F.col("of_a")).select(*_TILE, "chunk", "home", F.col("a").alias("node"), F.col("a_weight").alias("weight"), F.col("a_vec").alias("vec"))
    dense = busy.repartition(*_TILE).sortWithinPartitions(*_TILE, "node").mapInArrow(lambda it: _linked(it, shared, kind, cosine), "a long, b long, n long")
    found = stored(sparse.union(dense), "links")
    parts = connected_components(found.where("a != b").select("a", "b")).select(F.col("node").alias("linked"), "component")
    degrees = found.where("a = b").groupBy(F.col("a").alias("counted")).agg(F.sum("n").alias("n"))
    classes = nodes.select(F.col("key1").alias("k1"), F.col("key2").alias("k2"), "node", "weight")
    classes = classes.join(parts, F.col("node") == F.col("linked"), "left").join(degrees, F.col("node") == F.col("counted"), "left")
    classes = classes.select("k1", "k2", F.coalesce("component", "node").alias("component"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("links"))
    out = rows.join(classes, (F.col("key1") == F.col("k1")) & (F.col("key2") == F.col("k2")), "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    links = F.when(F.col("vec_id").isNotNull(), F.coalesce("links", F.lit(0))).otherwise(F.lit(0))
    return out.select("vec_id", links.cast("long").alias("n_links"), component.alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
