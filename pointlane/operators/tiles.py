"""Neighbourhoods without a frame or cloud a task: spatial tiles, connected components, nearest neighbours.

Points belong to groups (a frame, a track), are dealt into cubes and copied to
the cubes they lie near. A task sees one cube with its surroundings, so its
size follows the density of points, not the size of a frame. What crosses
borders is a graph of few local clusters, joined by DataFrame operations.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import Keep, scratch

TILE = ["tx", "ty", "tz"]
#: Side of a tile in units of the radius.
SIDE = 32
#: Edges (16 MB of them) up to which a graph is solved without rounds.
SMALL = 1 << 18
#: Pairs of points that are compared at once.
PAIRS = 1 << 20


def components(edges: DataFrame, group: list[str], keep: Keep | None = None, small: int = SMALL) -> DataFrame:
    """(*group, node, component): of each node with an edge (a, b) to another the least node reachable within its group.

    Rounds of two steps, each a minimum by node and a join on it: larger
    neighbours move to a node's smallest neighbour, then a node and its smaller
    ones do. Tables are written between, so a lost executor costs a re-read.
    Up to ``small`` edges in all, a group's edges are solved in one task.
    """
    keep = keep or scratch(edges.sparkSession)
    now = keep("edges", edges.where("a <> b").select(*group, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None

    def least(rows: DataFrame) -> DataFrame:
        names = {c: f"of_{c}" for c in group}
        return keep("least", rows.groupBy(*group, "a").agg(F.min("b").alias("m")).withColumnsRenamed(names | {"a": "of"}))

    def met(rows: DataFrame, least_: DataFrame) -> DataFrame:
        on = [F.col(c) == F.col(f"of_{c}") for c in group] + [F.col("a") == F.col("of")]
        return rows.join(least_, on)

    kinds = {f.name: f.dataType.simpleString() for f in now.schema}

    def solved(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        names, place = np.unique(own[["a", "b"]].to_numpy(np.int64), return_inverse=True)
        place = place.reshape(-1, 2)
        frame = pd.DataFrame({"node": names, "component": names[_joined(len(names), place[:, 0], place[:, 1])]})
        for c, v in zip(group, key, strict=True):
            frame[c] = v
        return frame[[*group, "node", "component"]]

    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64(*group, "a", "b").cast("decimal(38,0)"))).first()
        if before is None and state[0] <= small:
            return now.groupBy(*group).applyInPandas(solved, ", ".join(f"{c} {kinds[c]}" for c in group) + ", node bigint, component bigint")
        if state == before or not state[0]:
            break
        before = state
        both = now.select(*group, "a", "b").union(now.select(*group, "b", "a"))
        low = least(both)
        large = keep("large", met(both.where("b > a"), low).select(*group, F.col("b").alias("a"), F.least("of", "m").alias("b")).distinct())
        low = least(large)
        small = met(large, low).where("b <> m").select(*group, F.col("b").alias("a"), F.col("m").alias("b"))
        now = keep("edges", small.union(low.select(*[F.col(f"of_{c}") for c in group], "of", "m")).distinct())
    return now.select(*group, F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(*group, "b", "b").distinct())


class Cells:
    """Points sorted into cubes so small that two points of one are within ``eps``."""

    def __init__(self, p: np.ndarray, eps: float):
        self.p, self.eps = p, eps
        side = eps / np.sqrt(3.0) * (1 - 1e-9)
        cell = np.floor(p / side).astype(np.int64)
        cell -= cell.min(0) - 2
        self.wide = cell.max(0) + 3
        key = (cell[:, 0] * self.wide[1] + cell[:, 1]) * self.wide[2] + cell[:, 2]
        self.order = np.argsort(key, kind="stable")
        self.keys, self.start, self.count = np.unique(key[self.order], return_index=True, return_counts=True)
        self.of = np.repeat(np.arange(len(self.keys)), self.count)
        # Neighbouring cells that may hold a point within eps.
        near = [d for d in product(range(-2, 3), repeat=3) if sum(max(abs(x) - 1, 0) ** 2 for x in d) < 3.0]
        self.shifts = [(d, (d[0] * self.wide[1] + d[1]) * self.wide[2] + d[2]) for d in near]

    def neighbour(self, shift: int) -> np.ndarray:
        """Index of each cell's neighbour, -1 without one."""
        at = np.minimum(np.searchsorted(self.keys, self.keys + shift), len(self.keys) - 1)
        return np.where(self.keys[at] == self.keys + shift, at, -1)

    def pairs(self, rows: np.ndarray, cells: np.ndarray):
        """Blocks (k, j): place k in ``rows`` beside every sorted point j of that row's cell in ``cells``."""
        count = self.count[cells]
        done, low = np.cumsum(count), 0
        while low < len(rows):
            high = max(low + 1, int(np.searchsorted(done, (done[low - 1] if low else 0) + PAIRS, side="right")))
            n = count[low:high]
            k = np.repeat(np.arange(low, high), n)
            yield k, self.start[cells[k]] + np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
            low = high

    def close(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return ((self.p[self.order[i]] - self.p[self.order[j]]) ** 2).sum(1) <= self.eps * self.eps


def _joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of n nodes reachable over edges a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def density_clusters(p: np.ndarray, eps: float, min_points: int, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(core, owner) of each point: whether it has ``min_points`` within ``eps``; the least core point of its cluster, -1 for noise.

    A point counts as ``weight`` points of its place (1, if left out).

    A border point follows its least core neighbour. Points of a full cell are
    core without a distance, points of a cell are joined without one, and two
    cells are compared point by point only if nothing simpler decides: work
    grows with points and cells, not with pairs.
    """
    n = len(p)
    if not n:
        return np.zeros(0, bool), np.zeros(0, np.int64)
    c = Cells(p, eps)
    heavy = np.ones(n, np.int64) if weight is None else weight[c.order].astype(np.int64)
    held = np.add.reduceat(heavy, c.start)
    dense = held >= min_points
    core = dense[c.of]  # by sorted point
    open_ = np.flatnonzero(~core)
    near = held[c.of[open_]].copy()
    for d, shift in c.shifts:
        if d == (0, 0, 0) or not len(open_):
            continue
        to = c.neighbour(shift)[c.of[open_]]
        rows = np.flatnonzero((to >= 0) & (near < min_points))
        for k, j in c.pairs(open_[rows], to[rows]):
            met = c.close(open_[rows[k]], j)
            near += np.bincount(rows[k[met]], heavy[j[met]], minlength=len(near)).astype(np.int64)
    core[open_[near >= min_points]] = True
    # Clusters of cells that hold core points.
    has = np.bincount(c.of, core, len(c.keys)) > 0
    box_low, box_high = (f.reduceat(np.where(core[:, None], p[c.order], fill), c.start) for f, fill in ((np.minimum, np.inf), (np.maximum, -np.inf)))
    centre = (np.where(has[:, None], box_low, 0) + np.where(has[:, None], box_high, 0)) / 2
    one = np.flatnonzero(core)
    # The core point of each cell nearest to the middle of its core points stands for it.
    far = ((p[c.order[one]] - centre[c.of[one]]) ** 2).sum(1)
    pick = one[np.lexsort((far, c.of[one]))]
    first = np.ones(len(pick), bool)
    first[1:] = c.of[pick][1:] != c.of[pick][:-1]
    mid = np.full(len(c.keys), -1)
    mid[c.of[pick[first]]] = pick[first]
    sure_a, sure_b, ask_a, ask_b = [], [], [], []
    for d, shift in c.shifts:
        if d <= (0, 0, 0):
            continue
        to = c.neighbour(shift)
        a = np.flatnonzero((to >= 0) & has & has[to])
        b = to[a]
        gap = np.maximum(0, np.maximum(box_low[a] - box_high[b], box_low[b] - box_high[a]))
        may = (gap**2).sum(1) <= eps * eps * (1 + 1e-9)
        a, b = a[may], b[may]
        sure = c.close(mid[a], mid[b])
        sure_a.append(a[sure]), sure_b.append(b[sure]), ask_a.append(a[~sure]), ask_b.append(b[~sure])
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    part = _joined(len(c.keys), join(sure_a), join(sure_b))
    a, b = join(ask_a), join(ask_b)
    apart = part[a] != part[b]
    a, b = a[apart], b[apart]
    linked = np.zeros(len(a), bool)
    rows = np.repeat(np.arange(len(a)), c.count[a])
    left = c.start[a[rows]] + np.arange(len(rows)) - np.repeat(np.cumsum(c.count[a]) - c.count[a], c.count[a])
    rows, left = rows[core[left]], left[core[left]]
    for k, j in c.pairs(left, b[rows]):
        live = core[j] & ~linked[rows[k]]
        k, j = k[live], j[live]
        linked[rows[k[c.close(left[k], j)]]] = True
    part = _joined(len(c.keys), np.concatenate([join(sure_a), a[linked]]), np.concatenate([join(sure_b), b[linked]]))
    # Names: the least core point of a cluster.
    least = np.full(len(c.keys), n)
    np.minimum.at(least, part[c.of[one]], c.order[one])
    owner = np.full(n, -1)
    owner[c.order[one]] = least[part[c.of[one]]]
    flags = np.zeros(n, bool)
    flags[c.order[one]] = True
    rest = np.flatnonzero(~core)
    best = np.full(len(rest), n)
    for _, shift in c.shifts:
        to = c.neighbour(shift)[c.of[rest]]
        some = np.flatnonzero(to >= 0)
        for k, j in c.pairs(rest[some], to[some]):
            ok = core[j]
            ok[ok] = c.close(rest[some[k[ok]]], j[ok])
            np.minimum.at(best, some[k[ok]], c.order[j[ok]])
    border = best < n
    owner[c.order[rest[border]]] = owner[best[border]]
    return flags, owner


def _range(c: str, halo: float, side: float):
    return F.explode(F.sequence(F.floor((F.col(c) - halo) / side), F.floor((F.col(c) + halo) / side)))


def spread(points: DataFrame, group: list[str], halo: float, side: float) -> DataFrame:
    """(*group, node, x, y, z, tx, ty, tz): every point, with its weight if it has one, in each tile that it lies in or within ``halo`` of."""
    weight = ["weight"] if "weight" in points.columns else []
    rows = points.select(*group, "node", *[F.col(a).cast("double").alias(a) for a in "xyz"], *weight)
    for a in "xyz":
        rows = rows.select("*", _range(a, halo, side).alias(f"t{a}"))
    return rows


def density_components(points: DataFrame, group: list[str], eps: float, min_points: int, keep: Keep | None = None, side: int = SIDE) -> DataFrame:
    """(*group, node, core, cluster) of points (*group, node, x, y, z): the least core node of the cluster, null for noise.

    A tile sees what lies within 2 eps, so it knows which points within eps of
    it are core. Local clusters that share a core point are one. With a column
    ``weight``, a row stands for so many points of its place.
    """
    keep = keep or scratch(points.sparkSession)
    wide = side * eps
    kinds = {f.name: f.dataType.simpleString() for f in points.schema}
    out = ", ".join(f"{c} {kinds[c]}" for c in group) + ", node bigint, own boolean, shared boolean, core boolean, root bigint"

    def run(key: tuple, tile: pd.DataFrame) -> pd.DataFrame:
        tile = tile.sort_values("node", kind="stable")
        p, node = tile[["x", "y", "z"]].to_numpy(float), tile["node"].to_numpy()
        low = np.array(key[-3:], float) * wide
        own = (np.floor(p / wide) == np.array(key[-3:], float)).all(1)
        inner = ((p >= low - eps) & (p <= low + wide + eps)).all(1)
        # Only points whose surroundings are seen whole may join clusters here.
        core, owner = _within(p, inner, eps, min_points, tile["weight"].to_numpy() if "weight" in tile else None)
        edge = ((p - low < eps) | (low + wide - p <= eps)).any(1)
        shared = core & (~own | edge)
        stay = own | shared
        frame = pd.DataFrame({"node": node, "own": own, "shared": shared, "core": core, "root": pd.array(np.where(owner >= 0, node[np.maximum(owner, 0)], 0), "Int64")})[stay]
        frame.loc[owner[stay] < 0, "root"] = pd.NA
        for c, v in zip(group, key[:-3], strict=True):
            frame[c] = v
        return frame[[*group, "node", "own", "shared", "core", "root"]]

    local = keep("tiles", spread(points, group, 2 * eps, wide).groupBy(*group, *TILE).applyInPandas(run, out))
    met = local.where("shared").groupBy(*group, "node").agg(F.array_sort(F.collect_set("root")).alias("roots")).where(F.size("roots") > 1)
    edges = met.select(*group, F.col("roots")[0].alias("a"), F.explode(F.slice("roots", 2, 8)).alias("b"))
    whole = keep("joined", components(edges, group, keep).withColumnsRenamed({c: f"of_{c}" for c in group} | {"node": "of"}))
    rows = local.where("own").join(whole, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in group] + [F.col("root") == F.col("of")], "left")
    return rows.select(*group, "node", "core", F.coalesce("component", "root").alias("cluster"))


def _within(p: np.ndarray, inner: np.ndarray, eps: float, min_points: int, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """As ``density_clusters``, with points outside ``inner`` counted as neighbours but never core."""
    if inner.all():
        return density_clusters(p, eps, min_points, weight)
    # Which are core is seen with all points; clusters are made of inner ones.
    core, _ = density_clusters(p, eps, min_points, weight)
    core &= inner
    at = np.flatnonzero(core)
    _, among = density_clusters(p[at], eps, 1)
    owner = np.full(len(p), -1)
    owner[at] = at[among]
    rest = np.flatnonzero(~core & inner)
    if len(rest) and len(at):
        both = np.concatenate([at, rest])
        c = Cells(p[both], eps)
        is_core = np.arange(len(both)) < len(at)
        sorted_of = np.argsort(c.order)
        best = np.full(len(rest), len(p))
        mine = sorted_of[len(at) :]
        for _, shift in c.shifts:
            to = c.neighbour(shift)[c.of[mine]]
            some = np.flatnonzero(to >= 0)
            for k, j in c.pairs(mine[some], to[some]):
                ok = is_core[c.order[j]]
                ok[ok] = c.close(mine[some[k[ok]]], j[ok])
                np.minimum.at(best, some[k[ok]], both[c.order[j[ok]]])
        border = best < len(p)
        owner[rest[border]] = owner[best[border]]
    return core, owner


def mean_neighbour_distance(points: DataFrame, group: list[str], k: int, keep: Keep | None = None) -> DataFrame:
    """(*group, node, distance): the mean distance of each point to its ``k`` nearest others of the group (all, if fewer).

    A k-nearest join on tiles whose rings grow: a point is done once its k-th
    neighbour is nearer than what its tile doesn't see; the radius doubles for
    the others, and only tiles with open points are visited again.
    """
    keep = keep or scratch(points.sparkSession)
    plain = keep("cloud", points.select(*group, "node", *[F.col(a).cast("double").alias(a) for a in "xyz"]))
    spans = [(F.max(a) - F.min(a)) for a in "xyz"]
    size = plain.groupBy(*group).agg(F.count("*").alias("n"), F.greatest(*spans).alias("long"), *[s.alias(f"s{a}") for a, s in zip("xyz", spans, strict=True)])
    # About 2 k points within the first radius, were the box filled evenly; flat boxes count as a tenth as thick as long.
    volume = 1.0
    for a in "xyz":
        volume = volume * F.greatest(F.col(f"s{a}"), F.col("long") / 10, F.lit(1e-6))
    radius = 0.8 * F.pow(volume * k / F.col("n"), F.lit(1 / 3))
    size = keep("sizes", size.select(*[F.col(c).alias(f"of_{c}") for c in group], "n", "long", radius.alias("radius")))
    on = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in group]
    kinds = {f.name: f.dataType.simpleString() for f in plain.schema}
    out = ", ".join(f"{c} {kinds[c]}" for c in group) + ", node bigint, distance double, done boolean"

    def run(key: tuple, tile: pd.DataFrame) -> pd.DataFrame:
        p, asks = tile[["x", "y", "z"]].to_numpy(float), np.flatnonzero(tile["asks"].to_numpy(bool))
        r, n = float(tile["r"].iloc[0]), int(tile["n"].iloc[0])
        need = min(k, n - 1)
        mean, done = np.zeros(len(asks)), np.zeros(len(asks), bool)
        block = max(1, PAIRS // max(len(p), 1))
        for at in range(0, len(asks), block):
            q = asks[at : at + block]
            d = ((p[q, None] - p[None]) ** 2).sum(2)
            d[np.arange(len(q)), q] = np.inf
            have = min(need, len(p) - 1)
            near = np.sqrt(np.sort(np.partition(d, have - 1, 1)[:, :have], 1)) if have else np.zeros((len(q), 0))
            done[at : at + block] = (have == need) & ((near[:, -1] <= r) if have else True) | (len(p) == n)
            mean[at : at + block] = near.mean(1) if have else 0.0
        frame = pd.DataFrame({"node": tile["node"].to_numpy()[asks], "distance": mean, "done": done})
        for c, v in zip(group, key[:-3], strict=True):
            frame[c] = v
        return frame[[*group, "node", "distance", "done"]]

    names = [*group, *TILE]
    found, rows, factor = None, plain.withColumn("open", F.lit(True)), 1.0
    while True:
        dealt = rows.join(size, on).withColumns({"r": F.col("radius") * factor, "side": F.col("radius") * (4 * factor)})
        mine = F.col("open")
        for a in "xyz":
            near = F.sequence(F.floor((F.col(a) - F.col("r")) / F.col("side")), F.floor((F.col(a) + F.col("r")) / F.col("side")))
            dealt = dealt.select("*", F.explode(near).alias(f"t{a}"))
            mine = mine & (F.col(f"t{a}") == F.floor(F.col(a) / F.col("side")))
        dealt = dealt.select(*names, "node", "x", "y", "z", "r", "n", mine.alias("asks"))
        if found is not None:  # only tiles in which a point is still open
            dealt = dealt.join(keep("asked", dealt.where("asks").select(*names).distinct()), names, "left_semi")
        got = keep("rings", dealt.groupBy(*names).applyInPandas(run, out))
        ready = got.where("done").select(*group, "node", "distance")
        found = ready if found is None else found.unionByName(ready)
        left = got.where(~F.col("done")).select(*[F.col(c).alias(f"of_{c}") for c in group], F.col("node").alias("of_node"))
        if left.isEmpty():
            return found
        match = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in group] + [F.col("node") == F.col("of_node")]
        rows = plain.join(left, match, "left").select(*plain.columns, F.col("of_node").isNotNull().alias("open"))
        factor *= 2
