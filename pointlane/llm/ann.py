"""Approximate nearest neighbours by additive quantisation.

A vector is coded as the sum of one word from each of ``BOOKS`` codebooks, all
of full dimension. The books are k-means of successive residuals of a bounded
sample (about ``SAMPLE`` distinct vectors). Every vector is encoded by beam
search over the residuals; the norms of the vector and of its reconstruction,
as one scale, are stored with the code.

Search: the vectors of queries, and the codes alone of the indexed vectors,
are dealt into blocks, and every pair of blocks is one task. There, a query's
products with all words make its look-up table; the sum of a code's entries
times the stored scale estimates the inner product. The ``rerank`` best
estimates of each query over all blocks are then ranked again by the exact
product of the original vectors in double precision. This budget is one of the
query, so neither block sizes nor the size of the table change it. As rows are
dealt to blocks by hash, a block need only give the share of the budget that
it may hold, by six standard deviations.

Codes can't tell apart vectors that lie closer together than the quantiser
resolves. A code that more than ``CROWD`` distinct vectors share is crowded;
these vectors travel whole and are compared exactly with every query, and the
best ``2 k`` of them are ranked beside the others.

Equal vectors are one row with their k + 1 least ids. A query is a distinct
(vec_id, vector); it passes over its own row once, so other rows of its id and
repeats of it are candidates.

Defined cases: unusable vectors (see ``_vectors``) and rows without an id take
no part; ties go to the smaller vec_id; an empty table gives no row; further
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import stored
from ._tiles import runs
from ._vectors import packed, raw_matrix, sample

BOOKS, WORDS, BEAM, SAMPLE = 24, 256, 4, 16_384
RERANK, CROWD = 256, 64
#: Rows of a block of codes, of a block of queries, and queries that are ranked again together, at most.
CODE_ROWS, QUERY_ROWS, RANK_ROWS = 1 << 16, 4096, 512


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 6) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=len(x) < k)]
    for _ in range(rounds):
        near = ((centres**2).sum(1)[None] - 2 * x @ centres.T).argmin(1)
        order = np.argsort(near, kind="stable")
        n = np.bincount(near, minlength=k)
        firsts = np.minimum(np.cumsum(n) - n, len(x) - 1)
        sums = np.add.reduceat(x[order], firsts, axis=0)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def fit(x: np.ndarray, books: int = BOOKS, words: int = WORDS, seed: int = 2) -> np.ndarray:
    """Codebooks (books, words, dim)."""
    rng, rest, found = np.random.default_rng(seed), x.astype(np.float32), []
    for _ in range(books):
        centres = _kmeans(rest, words, rng).astype(np.float32)
        found.append(centres)
        rest = rest - centres[((centres**2).sum(1)[None] - 2 * rest @ centres.T).argmin(1)]
    return np.stack(found)


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """Codes (n, books) of small squared error: beam search over the books in turn, by what is left of the vector."""
    m, k, dim = books.shape
    squares = (books**2).sum(2)
    out = np.empty((len(x), m), np.uint8)
    for low in range(0, len(x), 512):
        part = x[low : low + 512].astype(np.float32)
        n = len(part)
        rest, codes = part[:, None, :], np.zeros((n, 1, 0), np.uint8)
        error = (rest**2).sum(2)
        for b in range(m):
            width = rest.shape[1]
            gain = error[:, :, None] + squares[b] - 2 * (rest.reshape(n * width, dim) @ books[b].T).reshape(n, width, k)
            gain = gain.reshape(n, -1)
            most = min(beam, gain.shape[1])
            best = np.argpartition(gain, most - 1, axis=1)[:, :most]
            error = np.take_along_axis(gain, best, 1)
            before, word = best // k, best % k
            rest = np.take_along_axis(rest, before[:, :, None], 1) - books[b][word]
            codes = np.concatenate([np.take_along_axis(codes, before[:, :, None], 1), word[:, :, None].astype(np.uint8)], 2)
        out[low : low + 512] = codes[np.arange(n), error.argmin(1)]
    return out


def decoded(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    out = np.zeros((len(codes), books.shape[2]), np.float32)
    for m in range(len(books)):
        out += books[m][codes[:, m]]
    return out


def _encoded(batches: Iterator[pa.RecordBatch], shared, kind: str) -> Iterator[pa.RecordBatch]:
    books = shared.value
    for batch in batches:
        v = raw_matrix(batch.column(2), kind, books.shape[2])
        codes = encode(v, books)
        norms = np.linalg.norm(v.astype(np.float64), axis=1), np.linalg.norm(decoded(codes, books), axis=1)
        scale = (norms[0] / np.maximum(norms[1], 1e-12)).astype(np.float32)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(scale)], ["first", "node", "vec", "ids", "code", "scale"])


def share(rerank: int, splits: int) -> int:
    """Of a query's ``rerank`` best, how many one of so many blocks dealt by hash holds at most (but for a chance below 1e-8)."""
    mean = rerank / splits
    return min(rerank, int(np.ceil(mean + 6 * mean**0.5 + 12)))


def _best(guess: np.ndarray, width: int) -> np.ndarray:
    """Rows of the ``width`` largest of each column."""
    width = min(width, len(guess))
    return np.argpartition(-guess, width - 1, axis=0)[:width]


def _searched(batches: Iterator[pa.RecordBatch], shared, kind: str, width: int, crowd_width: int) -> Iterator[pa.RecordBatch]:
    """Of each query of a block, the best rows of a block of codes by estimate, and of its crowded vectors by product."""
    books = shared.value
    m, words, dim = books.shape
    for tile in runs(batches, ["query_block", "split"]):
        kinds = tile.column("kind").to_numpy()
        asks, coded, whole = (tile.filter(pa.array(kinds == k)) for k in (0, 1, 2))
        q = raw_matrix(asks.column("vec"), kind, dim)
        codes = raw_matrix(coded.column("code"), "u1", m)
        scale = coded.column("scale").to_numpy()
        crowd = raw_matrix(whole.column("vec"), kind, dim)
        for low in range(0, len(q), 128):
            own = q[low : low + 128]
            found = []
            if len(codes):
                tables = (books.reshape(m * words, dim) @ own.T.astype(np.float32)).reshape(m, words, len(own))
                guess = tables[0][codes[:, 0]]
                for b in range(1, m):
                    guess += tables[b][codes[:, b]]
                guess *= scale[:, None]
                found.append((coded, _best(guess, width), guess, False))
            best = score = None
            for at in range(0, len(crowd), 4096):
                product = crowd[at : at + 4096].astype(np.float64) @ own.T.astype(np.float64)
                top = _best(product, crowd_width)
                new = np.take_along_axis(product, top, 0)
                best, score = (top + at, new) if best is None else (np.concatenate([best, top + at]), np.concatenate([score, new]))
                top = _best(score, crowd_width)
                best, score = np.take_along_axis(best, top, 0), np.take_along_axis(score, top, 0)
            if best is not None:
                found.append((whole, best, None, True))
            for rows, top, values, sure in found:
                estimate = score if values is None else np.take_along_axis(values, top, 0)
                which = np.repeat(np.arange(low, low + len(own)), len(top))
                flat = top.T.ravel()
                columns = [*[asks.column(c).take(pa.array(which)).combine_chunks() for c in ("first", "node")], *[rows.column(c).take(pa.array(flat)).combine_chunks() for c in ("first", "node")]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(estimate.T.ravel().astype(np.float64)), pa.array(np.full(len(flat), sure))], ["query_id", "query_node", "first", "node", "estimate", "sure"])


def _ranked(batches: Iterator[pa.RecordBatch], kind: str, dim: int, k: int) -> Iterator[pa.RecordBatch]:
    """Exact products of the candidates of a group of queries, and each query's k nearest rows."""
    for tile in runs(batches, ["grp"]):
        asks_here = tile.column("ask").to_numpy()
        asks, held = tile.filter(pa.array(asks_here)), tile.filter(pa.array(~asks_here))
        v, copies = raw_matrix(held.column("vec"), kind, dim), held.column("ids")
        place = {key: at for at, key in enumerate(zip(held.column("first").to_pylist(), held.column("node").to_pylist(), strict=True))}
        q = raw_matrix(asks.column("vec"), kind, dim).astype(np.float64)
        out = []
        for c, (query_id, query_node, wanted) in enumerate(zip(asks.column("first").to_pylist(), asks.column("node").to_pylist(), asks.column("wanted").to_pylist(), strict=True)):
            rows = np.array([place[w["first"], w["node"]] for w in wanted], np.int64)
            exact = np.einsum("ij,j->i", v[rows].astype(np.float64), q[c])
            if len(rows) > k + 1:
                keep = exact >= np.partition(exact, len(exact) - k - 1)[len(exact) - k - 1]
                rows, exact = rows[keep], exact[keep]
            found, own = [], q[c]
            for row, score in zip(rows.tolist(), exact.tolist(), strict=True):
                ids = copies[row].as_py()
                if query_id in ids and (v[row] == own).all():
                    ids.remove(query_id)
                found += [(-score, i) for i in ids]
            out += [(query_id, query_node, rank, i, -score) for rank, (score, i) in enumerate(sorted(found)[:k], 1)]
        columns = list(zip(*out, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.float64()), strict=True)], ["query_id", "query_node", "rank", "vec_id", "score"])


def search(table: DataFrame, queries: F.Column, vector: str = "embedding", k: int = 20, rerank: int = RERANK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found, by inner product, of every row that ``queries`` (a condition on vec_id) selects."""
    rows, dim, kind = packed(table, vector)
    rows = rows.where("vec IS NOT NULL AND vec_id IS NOT NULL")
    # Of equal vectors the k + 1 least rows are all that k neighbours other than the query can need.
    least = rows.withColumn("nth", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))).where(F.col("nth") <= k + 1)
    nodes = least.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = stored(nodes.select(F.col("ids")[0].alias("first"), F.xxhash64("vec").alias("node"), "vec", "ids"), "nodes")
    drawn, total = sample(nodes, dim, kind, SAMPLE, seed=2)
    shared = table.sparkSession.sparkContext.broadcast(fit(drawn) if len(drawn) else np.zeros((BOOKS, WORDS, max(dim, 1)), np.float32))
    index = stored(nodes.mapInArrow(lambda it: _encoded(it, shared, kind), "first long, node long, vec binary, ids array<long>, code binary, scale float"), "index")
    asked = stored(rows.where(queries).select(F.col("vec_id").alias("first"), F.xxhash64("vec").alias("node"), "vec").distinct(), "asked")
    n_asked = asked.count()
    splits, blocks = max(1, -(-total // CODE_ROWS)), max(1, -(-n_asked // min(QUERY_ROWS, max(128, -(-n_asked // 12)))))
    dealt = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "first", "node"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    ask = asked.select(F.lit(0).alias("kind"), dealt(blocks, 5).alias("query_block"), every(splits).alias("split"), "first", "node", "vec", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("float").alias("scale"))
    # Codes alone travel, but for the vectors of crowded codes.
    crowded = index.groupBy(F.col("code").alias("crowded")).agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("crowded")
    held = index.join(crowded, F.col("code") == F.col("crowded"), "left").withColumn("sure", F.col("crowded").isNotNull())
    held = held.select(F.when(F.col("sure"), 2).otherwise(1).alias("kind"), dealt(splits, 6).alias("split"), "first", "node", F.when(F.col("sure"), F.col("vec")).alias("vec"), F.when(~F.col("sure"), F.col("code")).alias("code"), "scale")
    held = held.select("kind", every(blocks).alias("query_block"), "split", "first", "node", "vec", "code", "scale")
    tile = ["query_block", "split"]
    tiles = ask.unionByName(held).repartition(*tile).sortWithinPartitions(*tile, "kind", "first", "node")
    found = tiles.mapInArrow(lambda it: _searched(it, shared, kind, share(rerank, splits), 2 * k), "query_id long, query_node long, first long, node long, estimate double, sure boolean")
    place = F.row_number().over(Window.partitionBy("query_id", "query_node", "sure").orderBy(F.desc("estimate"), "first", "node"))
    budget = F.when(F.col("sure"), 2 * k).otherwise(rerank)
    groups = max(1, -(-n_asked // min(RANK_ROWS, max(64, -(-n_asked // 12)))))
    grp = F.pmod(F.xxhash64(F.lit(7), "query_id", "query_node"), F.lit(groups)).cast("int")
    pairs = stored(found.withColumn("place", place).where(F.col("place") <= budget).select(grp.alias("grp"), "query_id", "query_node", "first", "node"), "pairs")
    needed = pairs.select("grp", F.col("first").alias("f"), F.col("node").alias("n")).distinct()
    needed = needed.join(index.select("first", "node", "vec", "ids"), (F.col("f") == F.col("first")) & (F.col("n") == F.col("node")))
    needed = needed.select("grp", F.lit(False).alias("ask"), "first", "node", "vec", "ids", F.lit(None).cast("array<struct<first:long,node:long>>").alias("wanted"))
    wanted = pairs.groupBy("grp", "query_id", "query_node").agg(F.collect_list(F.struct("first", "node")).alias("wanted"))
    wanted = wanted.join(asked, (F.col("query_id") == F.col("first")) & (F.col("query_node") == F.col("node")))
    wanted = wanted.select("grp", F.lit(True).alias("ask"), "first", "node", "vec", F.lit(None).cast("array<long>").alias("ids"), "wanted")
    again = needed.unionByName(wanted).repartition("grp").sortWithinPartitions("grp", "ask", "first", "node")
    return again.mapInArrow(lambda it: _ranked(it, kind, dim, k), "query_id long, query_node long, rank int, vec_id long, score double").drop("query_node")
