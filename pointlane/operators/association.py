"""Matching of tracks to detections, and overlaps and gaps between tracks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import Keep, scratch
from .tiles import components


def cost_pairs(left: DataFrame, right: DataFrame, on: list[str], size_weight: float) -> DataFrame:
    """Every pair of rows that agree on ``on`` (a frame), with ``cost``.

    cost: distance of centers plus, for a positive weight, weight times the
    mean over axes of |difference of extents| / max(extents, 0.001). Inputs
    have cx..cz and ex..ez and an id column ``id``.
    """
    l_ = left.select(*on, F.col("id").alias("left_id"), *[F.col(c).alias(f"l_{c}") for c in ("cx", "cy", "cz", "ex", "ey", "ez")])
    r_ = right.select(*on, F.col("id").alias("right_id"), *[F.col(c).alias(f"r_{c}") for c in ("cx", "cy", "cz", "ex", "ey", "ez")])
    gap = lambda c: F.col(f"l_{c}") - F.col(f"r_{c}")
    cost = F.sqrt(gap("cx") * gap("cx") + gap("cy") * gap("cy") + gap("cz") * gap("cz"))
    if size_weight > 0:
        cost = cost + F.lit(size_weight) * sum((F.abs(gap(e)) / F.greatest(F.col(f"l_{e}"), F.col(f"r_{e}"), F.lit(0.001)) for e in ("ex", "ey", "ez")), F.lit(0.0)) / 3
    return l_.join(r_, on).select(*on, "left_id", "right_id", cost.alias("cost"))


def gated(pairs: DataFrame, gate: float) -> DataFrame:
    """Pairs whose cost, size term included, is within the gate."""
    return pairs.where(F.col("cost") <= gate)


def unmatched(rows: DataFrame, matches: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(matches, on, "left_anti")


def greedy(cost: np.ndarray, feasible: np.ndarray) -> list[tuple[int, int]]:
    """Pairs by rising (cost, row, column), each row and column once."""
    rows, cols = np.nonzero(feasible)
    order = np.lexsort((cols, rows, cost[rows, cols]))
    used_r, used_c, out = set(), set(), []
    for r, c in zip(rows[order].tolist(), cols[order].tolist(), strict=True):
        if r not in used_r and c not in used_c:
            used_r.add(r)
            used_c.add(c)
            out.append((r, c))
    return out


def hungarian(cost: np.ndarray, feasible: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of least total cost among those feasible, as many as can be.

    Rows and columns without a feasible pair are left out first; an infeasible
    pair costs more than the largest feasible one and is dropped at the end.
    Shortest augmenting paths with potentials.
    """
    rows, cols = np.flatnonzero(feasible.any(1)), np.flatnonzero(feasible.any(0))
    if not len(rows):
        return []
    sub, ok = cost[np.ix_(rows, cols)].astype(float), feasible[np.ix_(rows, cols)]
    top = sub[ok].max()
    sub = np.where(ok, sub, top + max(1.0, 10 * top))
    flip = len(rows) > len(cols)
    if flip:
        sub = sub.T
    n, m = sub.shape
    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for r in range(1, n + 1):
        match[0], at = r, 0
        slack, seen, back = np.full(m + 1, np.inf), np.zeros(m + 1, bool), np.zeros(m + 1, int)
        while True:
            seen[at] = True
            row = match[at]
            reduced = sub[row - 1] - u[row] - v[1:]
            better = ~seen[1:] & (reduced < slack[1:])
            slack[1:][better], back[1:][better] = reduced[better], at
            step = np.where(seen, np.inf, slack)
            step[0] = np.inf
            nxt = int(step.argmin())
            delta = step[nxt]
            np.add.at(u, match[seen], delta)
            v[seen] -= delta
            slack[~seen] -= delta
            at = nxt
            if match[at] == 0:
                break
        while at:
            match[at] = match[back[at]]
            at = back[at]
    pairs = [(match[c] - 1, c - 1) for c in range(1, m + 1) if match[c]]
    pairs = [(c, r) if flip else (r, c) for r, c in pairs]
    return sorted((int(rows[r]), int(cols[c])) for r, c in pairs if feasible[rows[r], cols[c]])


def assign(pairs: DataFrame, on: list[str], method: str = "hungarian", keep: Keep | None = None) -> DataFrame:
    """(*on, left_id, right_id, cost): one-to-one matches among gated ``pairs`` (*on, left_id, right_id, cost) of each group.

    Pairs fall into connected components that share no row; each is solved
    alone (``greedy`` by rising cost, or ``hungarian``: least total cost), so a
    group may hold any number of rows as long as its gate keeps components
    small. Ids are whole and not negative.
    """
    solve = {"greedy": greedy, "hungarian": hungarian}[method]
    keep = keep or scratch(pairs.sparkSession)
    rows = keep("pairs", pairs.select(*on, F.col("left_id").cast("bigint").alias("left_id"), F.col("right_id").cast("bigint").alias("right_id"), F.col("cost").cast("double").alias("cost")))
    # Rows of the two sides are nodes of one graph.
    edges = rows.select(*on, (2 * F.col("left_id")).alias("a"), (2 * F.col("right_id") + 1).alias("b"))
    part = components(edges, on, keep).select(*[F.col(c).alias(f"of_{c}") for c in on], "node", "component")
    joined = rows.join(part, [F.col(c) == F.col(f"of_{c}") for c in on] + [2 * F.col("left_id") == F.col("node")])
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        left, r = np.unique(own.left_id, return_inverse=True)
        right, c = np.unique(own.right_id, return_inverse=True)
        cost, feasible = np.zeros((len(left), len(right))), np.zeros((len(left), len(right)), bool)
        cost[r, c], feasible[r, c] = own.cost, True
        found = solve(cost, feasible)
        out = pd.DataFrame({"left_id": [left[i] for i, _ in found], "right_id": [right[j] for _, j in found], "cost": [cost[p] for p in found]})
        for name, value in zip(on, key, strict=False):
            out[name] = value
        return out[[*on, "left_id", "right_id", "cost"]]

    schema = ", ".join(f"{c} {kinds[c]}" for c in [*on, "left_id", "right_id", "cost"])
    return joined.select(*on, "component", "left_id", "right_id", "cost").groupBy(*on, "component").applyInPandas(run, schema)


def frame_overlap(observations: DataFrame) -> DataFrame:
    """(seq_id, a, b, overlap, ratio): pairs of tracks that share frames; ratio to the shorter track."""
    o = observations.select("seq_id", "track_id", "frame_id")
    both = o.select("seq_id", F.col("track_id").alias("a"), "frame_id").join(o.select("seq_id", F.col("track_id").alias("b"), "frame_id"), ["seq_id", "frame_id"]).where("a < b")
    n = o.groupBy("seq_id", "track_id").agg(F.count("*").alias("n"))
    pairs = both.groupBy("seq_id", "a", "b").agg(F.count("*").alias("overlap"))
    pairs = pairs.join(n.withColumnsRenamed({"track_id": "a", "n": "na"}), ["seq_id", "a"]).join(n.withColumnsRenamed({"track_id": "b", "n": "nb"}), ["seq_id", "b"])
    return pairs.select("seq_id", "a", "b", "overlap", (F.col("overlap") / F.least("na", "nb")).alias("ratio"))


def gap_pairs(observations: DataFrame, max_gap: int, max_distance: float) -> DataFrame:
    """(seq_id, a, b): b begins 1 to ``max_gap`` frames after a ends, within the distance of a's last center.

    An equi-join on the frame at which b may begin, not a join of all pairs.
    """
    c = F.struct("cx", "cy", "cz")
    ends = observations.groupBy("seq_id", "track_id").agg(F.min("frame_id").alias("first"), F.max("frame_id").alias("last"), F.min_by(c, "frame_id").alias("head"), F.max_by(c, "frame_id").alias("tail"))
    a = ends.select("seq_id", F.col("track_id").alias("a"), "tail", F.explode(F.sequence(F.col("last") + 1, F.col("last") + max_gap)).alias("first"))
    b = ends.select("seq_id", F.col("track_id").alias("b"), "head", "first")
    d = lambda n: F.col(f"tail.{n}") - F.col(f"head.{n}")
    near = d("cx") * d("cx") + d("cy") * d("cy") + d("cz") * d("cz") <= max_distance * max_distance
    return a.join(b, ["seq_id", "first"]).where(near & (F.col("a") != F.col("b"))).select("seq_id", "a", "b")
