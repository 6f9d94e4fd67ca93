"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact verification.

A document's set holds its distinct shingles of ``width`` words (lower-cased
A-Z, split at ASCII white space; with fewer words, the whole sequence is the
only shingle; without words the set is empty and links with nothing). Two
documents link if 100 * |intersection| >= percent * |union|.

1. One pass gives each document its set's size, a 128-bit fingerprint and a
   signature of ``HASHES`` minima, cut to 16 bits each, which can only add
   agreement. Equal sets are one node from here on.
2. Bands of the signature; of buckets with the same members one is kept.
3. Pairs within a bucket are compared by signatures alone: agreement is counted
   in batches of ``BATCH`` minima. Under a uniform prior the similarity then has
   a Beta posterior, and a pair is pruned once the chance of its reaching the
   threshold is below ``miss``. First every row meets the hub (least node) of its
   bucket, which connects near copies in steps that grow with rows. Pairs that this leaves
   unconnected run as bounded tiles (``_tiles``), where the rows of a bucket's
   largest part never meet each other. A tile gives back a spanning forest of its
   survivors; documents that survivors connect form a search group, so a chain
   of loose bucket mates forms none.
4. Only members of search groups fetch their full sets. Pairs of a group that
   share a band and pass the same test on whole minima are verified exactly,
   best first, unless links found already connect them. A tile gives back a
   spanning forest of its links, never all pairs.
5. Connected components of the links.

Bands are chosen so that a pair at the threshold shares none with probability
``band_miss`` at most. No bucket, group or text is cut or capped.

Defined cases: rows without an id link with nothing (component null, kept);
rows of one id are one node; repeated rows get equal results; null and empty
texts have n_shingles 0; an empty table gives no row; further columns are not
read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._components import connected_components
from ._shared import carried, stored, unpacked
from ._text import mix64, slices, text_bytes, word_hashes
from ._tiles import dealt, runs, stretches
from ._vectors import raw_matrix

HASHES, BATCH = 128, 16
_RNG = np.random.default_rng(6)
_A = (_RNG.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_B = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)[:, None]
_STEP = 1 << 13


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Of each text, the sorted distinct 64-bit hashes of its shingles."""
    factors = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) for k in range(width)], np.uint64)
    for at, to in slices(column, 1 << 22):
        words, firsts = word_hashes(*text_bytes(column.slice(at, to - at)))
        n = max(0, len(words) - width + 1)
        full = np.zeros(n, np.uint64)
        for k in range(width):
            full += words[k : k + n] * factors[k]
        full = mix64(full)
        for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
            if b - a >= width:
                yield np.unique(full[a : b - width + 1])
            elif b > a:
                yield mix64((words[a:b] * factors[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), _STEP):
        np.minimum(low, (_A * x[None, at : at + _STEP] + _B).min(1), out=low)
    return low


def choose_bands(percent: int, band_miss: float = 1e-6) -> tuple[int, int]:
    """(bands, rows): the most rows whose chance of missing a pair at the threshold is small enough."""
    t = percent / 100
    for rows in range(16, 0, -1):
        if (1 - t**rows) ** (HASHES // rows) <= band_miss:
            return HASHES // rows, rows
    raise ValueError(f"no banding of {HASHES} minima finds {percent} % with a miss of {band_miss}")


def least_matches(percent: int, miss: float) -> list[int]:
    """For each number n of compared minima, the fewest matches at which P(similarity >= threshold) >= miss.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), whose upper
    tail at t is the chance that Binomial(n + 1, t) is at most m.
    """
    t, out = percent / 100, [0]
    for n in range(1, HASHES + 1):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def _sketch(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, key1, key2, shorts = [], [], [], []
        for s in shingle_sets(batch.column(1), width):
            sizes.append(len(s))
            key1.append(int(mix64(s).sum(dtype=np.uint64).astype(np.int64)) if len(s) else 0)
            key2.append(int(mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).astype(np.int64)) if len(s) else 0)
            shorts.append(signature(s).astype("<u2").tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(key1, pa.int64()), pa.array(key2, pa.int64()), pa.array(shorts, pa.binary())], ["doc_id", "n_shingles", "key1", "key2", "short"])


def alive(sig: np.ndarray, sizes: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(positions of the pairs (x, y) that no batch of minima prunes, their matches); also pruned: sets too unlike in size."""
    # |A| / |B| bounds the similarity of sets of these sizes.
    at = np.flatnonzero(100 * np.minimum(sizes[x], sizes[y]) >= percent * np.maximum(sizes[x], sizes[y]))
    same = np.zeros(len(at), np.int64)
    for low in range(0, HASHES, BATCH):
        same += (sig[x[at], low : low + BATCH] == sig[y[at], low : low + BATCH]).sum(1)
        keep = same >= least[low + BATCH]
        at, same = at[keep], same[keep]
    return at, same


def _near_hub(batches: Iterator[pa.RecordBatch], percent: int, least: list[int]) -> Iterator[pa.RecordBatch]:
    """The pairs (node, hub) that no batch of minima prunes."""
    for batch in batches:
        sig = np.concatenate([raw_matrix(batch.column(c), "<u2", HASHES) for c in ("short", "hub_short")])
        sizes = np.concatenate([batch.column(c).to_numpy() for c in ("n_shingles", "hub_shingles")])
        at = np.arange(batch.num_rows)
        keep = pa.array(alive(sig, sizes, at, at + batch.num_rows, percent, least)[0])
        yield pa.RecordBatch.from_arrays([batch.column("node").take(keep), batch.column("hub").take(keep)], ["a", "b"])


def stars(mates: DataFrame, nodes: DataFrame, percent: int, least: list[int]) -> DataFrame:
    """(a, b): the rows of ``mates`` (bucket, node) that survive beside the least node of their bucket, and that node."""
    # Written, as are the counts of parts and tiles below: a join of two plain inputs is one that Spark splits at a hot bucket.
    hubs = stored(mates.groupBy(F.col("bucket").alias("of")).agg(F.min("node").alias("hub")), "hubs")
    pairs = mates.join(hubs, F.col("bucket") == F.col("of")).where("node > hub").select("node", "hub").distinct()
    own = nodes.select(F.col("node").alias("own"), "n_shingles", "short")
    theirs = nodes.select(F.col("node").alias("their"), F.col("n_shingles").alias("hub_shingles"), F.col("short").alias("hub_short"))
    pairs = pairs.join(own, F.col("node") == F.col("own")).join(theirs, F.col("hub") == F.col("their"))
    return pairs.select("node", "hub", "n_shingles", "short", "hub_shingles", "hub_short").mapInArrow(lambda it: _near_hub(it, percent, least), "a long, b long")


def apart(mates: DataFrame, parts: DataFrame) -> DataFrame:
    """(bucket, node, home) of the buckets whose members ``parts`` (node, component) doesn't connect; the largest part is not at home.

    Members of one part need no comparison, nor does a bucket of two, whose only pair has met.
    """
    parts = parts.select(F.col("node").alias("in_part"), "component")
    placed = mates.join(parts, F.col("node") == F.col("in_part"), "left").select("bucket", "node", F.coalesce("component", "node").alias("part"))
    placed = stored(placed, "placed")
    by_part = placed.groupBy(F.col("bucket").alias("of"), "part").agg(F.count("*").alias("n"))
    still = by_part.groupBy("of").agg(F.sum("n").alias("n"), F.count("*").alias("parts"), F.max(F.struct("n", "part")).alias("most"))
    still = stored(still.where("parts > 1 AND n > 2").select("of", F.col("most.part").alias("most")), "still")
    return placed.join(still, F.col("bucket") == F.col("of")).select("bucket", "node", (F.col("part") != F.col("most")).alias("home"))


def _pruned(batches: Iterator[pa.RecordBatch], percent: int, least: list[int]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the surviving pairs of each tile."""
    for table, starts in stretches(batches, ["bucket", "tile_i", "tile_j"]):
        a, b = survivors_of(table, starts, percent, least)
        nodes = table.column("node").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(nodes[a]), pa.array(nodes[b])], ["a", "b"])


def survivors_of(table: pa.Table, starts: np.ndarray, percent: int, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    sig, sizes = raw_matrix(table.column("short"), "<u2", HASHES), table.column("n_shingles").to_numpy()
    chunk = table.column("chunk").to_numpy()
    lone = table.column("tile_i").to_numpy() == table.column("tile_j").to_numpy()
    ends = np.append(starts[1:], table.num_rows)
    small = ends - starts <= 32
    a_out, b_out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    # Small tiles all at once: every row with the one so many rows further on.
    end_of = np.repeat(np.where(small, ends, 0), ends - starts)
    row = np.arange(table.num_rows)
    for step in range(1, 32):
        x = row[row + step < end_of]
        if not len(x):
            break
        x = x[lone[x] | (chunk[x] != chunk[x + step])]
        for at in range(0, len(x), 1 << 16):
            part = x[at : at + (1 << 16)]
            keep, _ = alive(sig, sizes, part, part + step, percent, least)
            a_out.append(part[keep])
            b_out.append(part[keep] + step)
    for low, high in zip(starts[~small].tolist(), ends[~small].tolist(), strict=True):
        rows = np.arange(low, high)
        left = rows if lone[low] else rows[chunk[rows] == table.column("tile_i")[low].as_py()]
        right = rows if lone[low] else rows[chunk[rows] == table.column("tile_j")[low].as_py()]
        part = np.arange(high - low)  # the component of each row so far
        for x in left.tolist():
            y = right[right > x] if lone[low] else right
            y = y[part[y - low] != part[x - low]]
            keep, _ = alive(sig, sizes, np.full(len(y), x), y, percent, least)
            if len(keep):
                met, firsts = np.unique(part[y[keep] - low], return_index=True)
                a_out.append(np.full(len(met), x))
                b_out.append(y[keep][firsts])
                part[np.isin(part, met)] = part[x - low]
    return np.concatenate(a_out), np.concatenate(b_out)


def _members(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(shingle_sets(batch.column(2), width))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([signature(s).tobytes() for s in sets], pa.binary())], ["node", "grp", "shingles", "sig"])


def _linked(batches: Iterator[pa.RecordBatch], percent: int, bands: int, rows: int, least: list[int]) -> Iterator[pa.RecordBatch]:
    for tile in runs(batches, ["grp", "tile_i", "tile_j"]):
        a, b = link_tile(tile, percent, bands, rows, least)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def link_tile(tile: pa.Table, percent: int, bands: int, rows: int, least: list[int]) -> tuple[list[int], list[int]]:
    nodes = tile.column("node").to_numpy()
    sets = [np.frombuffer(x.as_py(), np.uint64) for x in tile.column("shingles")]
    sizes = np.array([len(s) for s in sets])
    sig = np.frombuffer(b"".join(x.as_py() for x in tile.column("sig")), np.uint32).reshape(-1, HASHES)
    chunk = tile.column("chunk").to_numpy()
    i, j = tile.column("tile_i")[0].as_py(), tile.column("tile_j")[0].as_py()
    left = np.flatnonzero(chunk == i)
    right = left if i == j else np.flatnonzero(chunk == j)
    band = sig[:, : bands * rows].reshape(len(sig), bands, rows)
    band = (band.astype(np.uint64) * (np.arange(1, rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1))).sum(2, dtype=np.uint64)
    part = np.unique(nodes, return_inverse=True)[1]  # the component of each row so far
    a, b = [], []
    for x in left.tolist():
        y = right[right > x] if i == j else right
        y = y[part[y] != part[x]]
        y = y[(band[y] == band[x]).any(1)]
        keep, same = alive(sig, sizes, np.full(len(y), x), y, percent, least)
        for other in y[keep][np.argsort(-same, kind="stable")].tolist():
            if part[other] == part[x]:
                continue
            common = len(np.intersect1d(sets[x], sets[other], assume_unique=True))
            if 100 * common >= percent * (len(sets[x]) + len(sets[other]) - common):
                part[part == part[other]] = part[x]
                a.append(int(nodes[x]))
                b.append(int(nodes[other]))
    return a, b


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, miss: float = 1e-5, band_miss: float = 1e-6) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = stored(texts.mapInArrow(lambda it: _sketch(it, width), "doc_id long, n_shingles long, key1 long, key2 long, short binary"), "sketch")
    bands, rows = choose_bands(percent, band_miss)
    least = least_matches(percent, miss)
    own = ["n_shingles", "key1", "key2"]
    nodes = stored(sketch.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*own).agg(F.min("doc_id").alias("node"), F.first("short").alias("short")), "nodes")
    keys = F.array(*[F.xxhash64(F.lit(k), F.substring("short", 2 * rows * k + 1, 2 * rows)) for k in range(bands)])
    buckets = nodes.select("node", F.explode(keys).alias("bucket"))
    # Buckets of the same members, of which a cluster has one in almost every band, are searched once.
    met = buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("all")).where("n > 1")
    chosen = stored(met.groupBy("n", "all").agg(F.min("bucket").alias("of")).select("of"), "buckets")
    mates = stored(buckets.join(chosen, F.col("bucket") == F.col("of")).select("bucket", "node"), "mates")
    met_hub = stored(stars(mates, nodes, percent, least), "stars")
    slim = stored(apart(mates, connected_components(met_hub)), "rest")
    rest = slim.withColumnRenamed("node", "mate").join(nodes.select("node", "n_shingles", "short"), F.col("mate") == F.col("node")).select("bucket", "home", "node", "n_shingles", "short")
    pairs = met_hub.union(dealt(rest, ["bucket"], "node", home="home", counted=slim).mapInArrow(lambda it: _pruned(it, percent, least), "a long, b long"))
    groups = stored(connected_components(pairs).select(F.col("node").alias("in_group"), F.col("component").alias("grp")), "groups")
    # The groups' ids, built into a hash table by partition; the texts are shuffled once and never sorted.
    found = texts.join(groups.hint("shuffle_hash"), F.col("doc_id") == F.col("in_group")).select(F.col("doc_id").alias("node"), "grp", "text").mapInArrow(lambda it: _members(it, width), "node long, grp long, shingles binary, sig binary")
    members = stored(found, "members")
    links = dealt(members, ["grp"], "node", counted=members.select("grp")).mapInArrow(lambda it: _linked(it, percent, bands, rows, least), "a long, b long")
    parts = connected_components(links).select(F.col("node").alias("linked"), "component")
    classes = nodes.select(*[F.col(c).alias(f"of_{c}") for c in own], "node").join(parts, F.col("node") == F.col("linked"), "left")
    classes = classes.select(*[f"of_{c}" for c in own], F.coalesce("component", "node").alias("component"))
    has = sketch.join(classes, [F.col(c) == F.col(f"of_{c}") for c in own], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return has.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _name() -> Column:
    return F.xxhash64("doc_id", "text_key", "text_key2")


def survivors(docs: DataFrame, name: Callable[[], Column] = _name, **how) -> DataFrame:
    """(doc_id, text_key, text_key2) of the texts that are kept: of each group the one of the least doc_id, then keys; all without an id.

    Each distinct (doc_id, text) is a document of its own here, so an id that repeats with other texts loses only those that are linked.
    ``name`` makes one number of a document. Documents that share it (one pair in 2^64) can't be told apart by it: they stay out of the search and are kept.
    """
    keys = ["doc_id", "text_key", "text_key2"]
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.xxhash64(F.lit(7), "text").alias("text_key2"), "text")
    texts = keyed.where(F.col("doc_id").isNotNull()).withColumn("name", name())
    names = stored(texts.select("name", *keys).distinct(), "names")
    shared = stored(names.groupBy(F.col("name").alias("shared")).agg(F.count("*").alias("n")).where("n > 1").select("shared"), "shared")
    alone = lambda rows: rows.join(shared, F.col("name") == F.col("shared"), "left_anti")
    found = near_duplicates(alone(texts.select("name", "text")).select(F.col("name").alias("doc_id"), "text"), **how).select(F.col("doc_id").alias("of"), "component_id").distinct()
    least = alone(names).join(found, F.col("name") == F.col("of")).groupBy("component_id").agg(F.min(F.struct(*keys)).alias("x"))
    kept = names.join(shared, F.col("name") == F.col("shared"), "left_semi").select(*keys)
    lone = keyed.where(F.col("doc_id").isNull()).select(*keys).distinct()
    return least.select("x.*").unionByName(kept).unionByName(lone)


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that are kept: one text of each group, and one of the rows that repeat id and text (by a hash of the other columns); all without an id."""
    names = docs.columns
    rows = carried(docs, "doc_id", "text").withColumns({"row_key": F.xxhash64("text"), "row_key2": F.xxhash64(F.lit(7), "text")})
    kept = survivors(docs.select("doc_id", "text"), **how).where(F.col("doc_id").isNotNull()).withColumnRenamed("doc_id", "kept_id")
    # Rows that repeat id and text are combined before the shuffle by these, which then serves the join too. Maps have no order, their JSON has.
    order = F.xxhash64(F.to_json("carried")) if "carried" in rows.columns else F.lit(0)
    row = F.struct("text", *(["carried"] if "carried" in rows.columns else []))
    keyed = rows.where(F.col("doc_id").isNotNull()).groupBy("doc_id", "row_key", "row_key2").agg(F.min_by(row, order).alias("row"))
    least = keyed.join(kept, (F.col("doc_id") == F.col("kept_id")) & (F.col("row_key") == F.col("text_key")) & (F.col("row_key2") == F.col("text_key2")), "left_semi")
    least = unpacked(least.select("doc_id", "row.*"), names, ("doc_id", "text"))
    return least.union(docs.where(F.col("doc_id").isNull()))
