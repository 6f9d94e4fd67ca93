"""Clustering of a frame's points, and detections.

Distances are resolved on spatial tiles (``tiles``), voxels and planes by
groupings, so a frame of any size is many tasks; only the density hierarchy
(HDBSCAN) and the components of sensor cells see a frame's places or cells in
one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import finite, voxels
from ..sources.scratch import Keep, scratch
from .tiles import PAIRS, density_components

FRAME = ["seq_id", "frame_index"]
VOXEL = ["vx", "vy", "vz"]


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member reachable, for n nodes and edges a-b: pointer jumping over numpy arrays."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def ranked(label: np.ndarray) -> np.ndarray:
    """Labels 0, 1, ... in the order of their roots."""
    return np.unique(label, return_inverse=True)[1]


def _cores(p: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """Squared distance from each place to the point of rank ``k`` from it (itself is 0), of ``weight`` points a place.

    Places are compared with a window of the longest axis, which grows until nothing outside can be nearer.
    """
    axis = int(np.argmax(p.max(0) - p.min(0)))
    order = np.argsort(p[:, axis], kind="stable")
    q, w, n = p[order], weight[order], len(p)
    along, out = q[:, axis], np.empty(n)
    low = 0
    while low < n:
        high, pad = min(n, low + 256), 256
        while True:
            a, b = max(0, low - pad), min(n, high + pad)
            for i in range(low, high, step := max(1, PAIRS // (b - a))):
                j = min(high, i + step)
                square = sum((q[i:j, c, None] - q[None, a:b, c]) ** 2 for c in range(3))
                near = np.argpartition(square, k, 1)[:, : k + 1] if b - a > k + 1 else np.broadcast_to(np.arange(b - a), square.shape)
                square = np.take_along_axis(square, near, 1)
                by = np.argsort(square, 1)
                enough = np.cumsum(w[a:b][np.take_along_axis(near, by, 1)], 1) > k
                rank = np.where(enough.any(1), enough.argmax(1), -1)
                found = np.take_along_axis(np.take_along_axis(square, by, 1), rank[:, None], 1)[:, 0]
                out[i:j] = np.where(rank < 0, np.inf, found)
            unseen = np.minimum(along[low:high] - along[a - 1] if a else np.inf, along[b] - along[low:high] if b < n else np.inf)
            if (out[low:high] <= unseen**2).all():
                break
            pad *= 4
        low = high
    back = np.empty(n)
    back[order] = out
    return back


def _spanning(p: np.ndarray, core: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, squared reach, place it was reached from) in the order of Prim's algorithm from place 0; of equals the first place."""
    n = len(p)
    x, y, z = (np.ascontiguousarray(p[:, c]) for c in range(3))
    name, limit, best, source = np.arange(n), core.copy(), np.full(n, np.inf), np.zeros(n, int)
    order, length, origin = np.zeros(n, int), np.full(n, np.inf), np.zeros(n, int)
    at, left = 0, n
    for step in range(n):
        here = name[at]
        order[step], length[step], origin[step] = here, best[at], source[at]
        reach = (x - x[at]) ** 2
        reach += (y - y[at]) ** 2
        reach += (z - z[at]) ** 2
        np.maximum(reach, limit, out=reach)
        np.maximum(reach, core[here], out=reach)
        # A place that is done has no finite limit, so nothing is closer to it.
        best[at] = limit[at] = reach[at] = np.inf
        closer = reach < best
        best[closer], source[closer] = reach[closer], here
        left -= 1
        if left < 0.75 * len(name):
            open_ = np.flatnonzero(np.isfinite(limit))
            x, y, z, name, limit, best, source = (v[open_] for v in (x, y, z, name, limit, best, source))
        if left:
            at = int(best.argmin())
    return order, length, origin


def hdbscan(p: np.ndarray, min_cluster_size: int, min_samples: int, weight: np.ndarray | None = None) -> np.ndarray:
    """Clusters of largest excess of mass in the density hierarchy (Campello et al. 2013); noise -1.

    A row stands for ``weight`` points of its place (1, if left out). Points of
    a place that holds more than ``min_samples`` of them join without a
    distance, so one row stands for all of these. Memory grows with rows, time
    with the square of distinct places.
    """
    weight = np.ones(len(p), np.int64) if weight is None else np.asarray(weight, np.int64)
    total, label = int(weight.sum()), np.full(len(p), -1)
    if total < max(2, min_cluster_size):
        return label
    _, first, of = np.unique(p, axis=0, return_index=True, return_inverse=True)
    by = np.argsort(first)
    rank = np.empty(len(by), int)
    rank[by] = np.arange(len(by))
    first, of = first[by], rank[of.reshape(-1)]
    size = np.bincount(of, weight).astype(np.int64)
    core = _cores(p[first], size, min(min_samples, total - 1))
    order, length, origin = _spanning(p[first], core)
    # Rows that are nodes of the hierarchy: one of a place whose points join at once, else all.
    whole = (core == 0) & (min_cluster_size > 1)
    more = np.flatnonzero(first[of] != np.arange(len(p)))
    more = more[~whole[of[more]]]
    when = np.empty(len(order), int)
    when[order] = np.arange(len(order))
    # Further rows of a place are reached from its first one, or from where that was, if this is as near.
    own = core[of[more]] < length[when[of[more]]]
    far = np.sqrt(np.concatenate([length[1:], core[of[more]]]))
    left = np.concatenate([first[origin[1:]], np.where(own, first[of[more]], first[origin[when[of[more]]]])])
    right = np.concatenate([first[order[1:]], more])
    sort = np.lexsort((right, left, far))
    far, left, right = far[sort].tolist(), left[sort].tolist(), right[sort].tolist()
    n = len(p)
    up, node = list(range(n)), list(range(n))
    count = weight.copy()
    count[first[whole]] = size[whole]
    count = count.tolist()
    children: list[tuple[int, int]] = []

    def find(k: int) -> int:
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return k

    for k, (a, b) in enumerate(zip(left, right, strict=True)):
        a, b = find(a), find(b)
        children.append((node[a], node[b]))
        count.append(count[node[a]] + count[node[b]])
        up[b], node[a] = a, n + k

    def under(top: int) -> list[int]:
        out, todo = [], [top]
        while todo:
            k = todo.pop()
            if k < n:
                out.append(k)
            else:
                todo += children[k - n]
        return out

    # Condense: a split counts only if both sides are large enough.
    clusters: list[dict] = [{"birth": 0.0, "mass": 0.0, "kids": []}]
    todo = [(n + len(children) - 1, 0)] if children else []
    while todo:
        top, c = todo.pop()
        if top < n:  # one place, whose points part at no distance
            clusters[c]["mass"] += count[top] * (1e12 - clusters[c]["birth"]) if count[top] > 1 else 0.0
            continue
        a, b = children[top - n]
        level = 1 / max(far[top - n], 1e-12)
        big = [k for k in (a, b) if count[k] >= min_cluster_size]
        if len(big) == 2:
            clusters[c]["mass"] += count[top] * (level - clusters[c]["birth"])
            for k in big:
                clusters.append({"birth": level, "mass": 0.0, "kids": [], "top": k})
                clusters[c]["kids"].append(len(clusters) - 1)
                todo.append((k, len(clusters) - 1))
        else:
            lost = sum(count[k] for k in (a, b) if k not in big)
            clusters[c]["mass"] += lost * (level - clusters[c]["birth"])
            todo += [(k, c) for k in big]
    value = [0.0] * len(clusters)
    heavier = [False] * len(clusters)
    for c in range(len(clusters) - 1, 0, -1):
        below = sum(value[k] for k in clusters[c]["kids"])
        heavier[c] = clusters[c]["mass"] >= below
        value[c] = max(clusters[c]["mass"], below)
    chosen, todo = [], list(clusters[0]["kids"])
    while todo:
        c = todo.pop()
        if heavier[c]:
            chosen.append(under(clusters[c]["top"]))
        else:
            todo += clusters[c]["kids"]
    for k, own in enumerate(sorted(chosen, key=min)):
        label[own] = k
    return np.where(whole[of], label[first[of]], label)


def _numbered(points: DataFrame, found: DataFrame, first: Column) -> DataFrame:
    """``points`` with ``label``: the clusters of a frame counted from 0 by ``first``, -1 for noise.

    ``found``: (seq_id, frame_index, x, y, z, cluster) of each place, and what ``first`` needs.
    """
    names = found.where("cluster IS NOT NULL").groupBy(*FRAME, "cluster").agg(first.alias("first"))
    label = F.row_number().over(Window.partitionBy(*FRAME).orderBy("first")) - 1
    names = names.select(*[F.col(c).alias(f"of_{c}") for c in (*FRAME, "cluster")], label.cast("int").alias("label"))
    on = [F.col(c) == F.col(f"of_{c}") for c in (*FRAME, "cluster")]
    own = found.select(*FRAME, *"xyz", "cluster").join(names, on, "left").select(*[F.col(c).alias(f"at_{c}") for c in (*FRAME, *"xyz")], F.coalesce("label", F.lit(-1)).alias("label"))
    return points.join(own, [F.col(c) == F.col(f"at_{c}") for c in (*FRAME, *"xyz")]).select(*points.columns, "label")


def cluster_dbscan(points: DataFrame, eps: float, min_points: int, keep: Keep | None = None) -> DataFrame:
    """``points`` with a label: clusters by their least core point_id from 0, noise -1.

    Tiles of the frame are the tasks (``tiles.density_components``); they hold a
    row for each distinct place, under its least point_id, with the number of
    its points. A border point goes to the cluster of its least core neighbour.
    """
    keep = keep or scratch(points.sparkSession)
    places = keep("places", points.groupBy(*FRAME, *"xyz").agg(F.min("point_id").cast("bigint").alias("node"), F.count("*").alias("weight")))
    found = density_components(places, FRAME, eps, min_points, keep)
    return _numbered(points, keep("clusters", places.drop("weight").join(found, [*FRAME, "node"])), F.min("cluster"))


def cluster_euclidean(points: DataFrame, eps: float, keep: Keep | None = None) -> DataFrame:
    return cluster_dbscan(points, eps, 1, keep)


def cluster_voxels(points: DataFrame, size: float, keep: Keep | None = None) -> DataFrame:
    """Components of occupied voxels that touch by a face, edge or corner, by their least voxel; only voxels are compared."""
    keep = keep or scratch(points.sparkSession)
    keyed = points.select("*", *voxels(size, single=True))
    cells = keep("voxels", keyed.select(*FRAME, *VOXEL).distinct().withColumn("node", F.monotonically_increasing_id()))
    # Centers of touching voxels are within sqrt(3), others at least 2 apart.
    found = density_components(cells.select(*FRAME, "node", *[(F.col(v) + 0.5).alias(a) for v, a in zip(VOXEL, "xyz", strict=True)]), FRAME, 1.8, 1, keep)
    found = cells.join(found, [*FRAME, "node"])
    first = found.groupBy(*FRAME, "cluster").agg(F.min(F.struct(*VOXEL)).alias("first"))
    label = (F.row_number().over(Window.partitionBy(*FRAME).orderBy("first")) - 1).cast("int").alias("label")
    labels = found.join(first.select(*FRAME, "cluster", label), [*FRAME, "cluster"]).select(*FRAME, *VOXEL, "label")
    return keyed.join(keep("clusters", labels), [*FRAME, *VOXEL]).select(*points.columns, "label")


def cluster_hdbscan(points: DataFrame, min_cluster_size: int, min_samples: int) -> DataFrame:
    """``points`` with a label from the density hierarchy of their frame, noise -1; points without a finite place are noise.

    A task has the distinct places of a frame, with up to ``min_samples`` rows
    each: of more points at one place, one stands for all, by their number.
    """
    place = Window.partitionBy(*FRAME, *"xyz")
    located = points.withColumn("at_node", F.row_number().over(place.orderBy("point_id"))).withColumn("at_size", F.count("*").over(place))
    many = (F.col("at_size") > min_samples) & F.lit(min_cluster_size > 1)
    nodes = located.where((~many | (F.col("at_node") == 1)) & finite(*"xyz")).select(*FRAME, "point_id", *"xyz", "at_node", F.when(many, F.col("at_size")).otherwise(1).alias("weight"))
    kinds = {f.name: f.dataType for f in nodes.schema}
    out = T.StructType([T.StructField(f"of_{c}", kinds[c]) for c in (*FRAME, *"xyz", "at_node")] + [T.StructField("label", T.IntegerType())])

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["point_id", *"xyz", "at_node"], kind="stable")
        labels = hdbscan(frame[[*"xyz"]].to_numpy(float), min_cluster_size, min_samples, frame["weight"].to_numpy())
        return frame[[*FRAME, *"xyz", "at_node"]].add_prefix("of_").assign(label=labels.astype("int32"))

    found = nodes.groupBy(*FRAME).applyInPandas(run, out)
    own = located.withColumn("at_node", F.when(many, 1).otherwise(F.col("at_node")))
    on = [F.col(c) == F.col(f"of_{c}") for c in (*FRAME, *"xyz", "at_node")]
    return own.join(found, on, "left").select(*points.columns, F.coalesce("label", F.lit(-1)).alias("label"))


def ground_planes(points: DataFrame, distance: float = 0.12, samples: int = 120, seed: int = 0, keep: Keep | None = None) -> DataFrame:
    """(seq_id, frame_index, nx, ny, nz, qx, qy, qz, inliers): the plane through three of a frame's points that most points are within ``distance`` of.

    ``samples`` planes a frame, through points drawn by a hash of their ids;
    their inliers are counted in one aggregation. Of equal planes the earlier.
    """
    keep = keep or scratch(points.sparkSession)
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), "seq_id", "frame_index", "point_id"))
    most = 3 * samples
    rows = points.select(*FRAME, "point_id", *[F.col(a).cast("double").alias(a) for a in "xyz"]).withColumn("draw", draw)
    # The least draws by part of a frame, then of these: no task orders a whole frame.
    part = F.pmod(F.xxhash64("point_id"), F.lit(64))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy(*FRAME, part).orderBy("draw", "point_id"))).where(F.col("place") <= most)
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy(*FRAME).orderBy("draw", "point_id"))).where(F.col("place") <= most)
    pool = rows.groupBy(*FRAME).agg(F.sort_array(F.collect_list(F.struct("place", "x", "y", "z"))).alias("pool"))
    planes = pool.select(*FRAME, "pool", F.size("pool").alias("m"), F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("s")).where("m >= 3")
    turn = F.expr("(3 * s) div m")
    corner = {j: F.element_at("pool", ((3 * F.col("s") + j + j * turn) % F.col("m") + 1).cast("int")).alias(f"c{j}") for j in range(3)}
    planes = planes.select(*FRAME, "s", *corner.values())
    u, v = ({a: F.col(f"c{j}")[a] - F.col("c0")[a] for a in "xyz"} for j in (1, 2))
    planes = planes.select(
        *FRAME, "s", *[F.col("c0")[a].alias(f"q{a}") for a in "xyz"],
        (u["y"] * v["z"] - u["z"] * v["y"]).alias("ux"), (u["z"] * v["x"] - u["x"] * v["z"]).alias("uy"), (u["x"] * v["y"] - u["y"] * v["x"]).alias("uz"),
    ).withColumn("norm", F.sqrt(F.col("ux") * F.col("ux") + F.col("uy") * F.col("uy") + F.col("uz") * F.col("uz"))).where("norm >= 1e-9")
    planes = keep("planes", planes.select(*FRAME, "s", "qx", "qy", "qz", *[(F.col(f"u{a}") / F.col("norm")).alias(f"n{a}") for a in "xyz"]))
    near = points.select(*FRAME, *[F.col(a).cast("double").alias(a) for a in "xyz"]).join(planes, FRAME).where(F.abs(plane_distance()) <= distance)
    counted = near.groupBy(*FRAME, "s").agg(F.count("*").alias("inliers"))
    plane = F.struct("nx", "ny", "nz", "qx", "qy", "qz", "inliers")
    return planes.join(counted, [*FRAME, "s"]).groupBy(*FRAME).agg(F.max_by(plane, F.struct("inliers", -F.col("s"))).alias("plane")).select(*FRAME, "plane.*")


def plane_distance() -> Column:
    """Signed distance of (x, y, z) from the plane through q with unit normal n."""
    return (F.col("x") - F.col("qx")) * F.col("nx") + (F.col("y") - F.col("qy")) * F.col("ny") + (F.col("z") - F.col("qz")) * F.col("nz")


def without_ground(points: DataFrame, planes: DataFrame, distance: float, normal_z_min: float = 0.75) -> DataFrame:
    """``points`` with ``ground``: within ``distance`` of their frame's plane, if that is level enough."""
    own = planes.select(*[F.col(c).alias(f"of_{c}") for c in FRAME], *[f"{k}{a}" for k in "nq" for a in "xyz"])
    rows = points.join(own, [F.col(c) == F.col(f"of_{c}") for c in FRAME], "left")
    ground = F.coalesce((F.abs("nz") >= normal_z_min) & (F.abs(plane_distance()) <= distance), F.lit(False))
    return rows.select(*points.columns, ground.alias("ground"))


def cluster_ground_removed(points: DataFrame, eps: float, min_points: int, distance: float = 0.12, samples: int = 120, normal_z_min: float = 0.75, seed: int = 0, keep: Keep | None = None) -> DataFrame:
    """DBSCAN after removal of a plane that is level enough; ground points have label -2."""
    keep = keep or scratch(points.sparkSession)
    planes = keep("ground", ground_planes(points, distance, samples, seed, keep))
    rows = keep("ground_points", without_ground(points, planes, distance, normal_z_min))
    above = cluster_dbscan(rows.where("NOT ground").drop("ground"), eps, min_points, keep)
    return above.unionByName(rows.where("ground").drop("ground").withColumn("label", F.lit(-2)))


def ground_metrics(labelled: DataFrame, planes: DataFrame, normal_z_min: float = 0.75) -> DataFrame:
    """(seq_id, frame_index, ground_removed_count, ground_model): points removed, and a, b, c, d of the plane that removed them (null: none did)."""
    removed = labelled.groupBy(*FRAME).agg(F.count_if(F.col("label") == -2).alias("ground_removed_count"))
    d = -(F.col("nx") * F.col("qx") + F.col("ny") * F.col("qy") + F.col("nz") * F.col("qz"))
    model = F.when(F.abs("nz") >= normal_z_min, F.array("nx", "ny", "nz", d))
    return removed.join(planes.select(*FRAME, model.alias("ground_model")), FRAME, "left")


def sensor_cells(points: DataFrame) -> DataFrame:
    """One row for each (frame, sensor, row, column) with points: their number, mean center and mean range."""
    mean = lambda c, name: F.avg(F.col(c).cast("double")).alias(name)
    return points.groupBy(*FRAME, "sensor_name", "row_index", "col_index").agg(F.count("*").alias("point_count"), mean("x", "cx"), mean("y", "cy"), mean("z", "cz"), mean("range", "mean_range"))


#: Rules by which neighbouring cells join: factor on the range limit, and whether centers must be within eps too.
CELL_RULES = {"range_image_connected_components": (1.5, False), "range_image_depth_jump": (1.0, False), "beam_neighbor_region_growing": (1.5, True)}


def cell_links(cells: DataFrame, rule: str, jump_abs: float, jump_ratio: float, eps: float = 1.15, rows: int = 1, cols: int = 1) -> DataFrame:
    """(frame, sensor, a, b): neighbouring cells of one sensor that join, a < b; columns do not wrap round.

    Neighbours are found by an equi-join on shifted cell coordinates.
    """
    factor, by_center = CELL_RULES[rule]
    cells = cells.withColumn("cell", F.struct("row_index", "col_index"))
    shifts = [(r, c) for r in range(-rows, rows + 1) for c in range(-cols, cols + 1) if (r, c) > (0, 0)]
    shift = F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in shifts]))
    key = [*FRAME, "sensor_name"]
    left = cells.withColumn("shift", shift).select(*key, F.col("cell").alias("a"), (F.col("row_index") + F.col("shift.r")).alias("row_index"), (F.col("col_index") + F.col("shift.c")).alias("col_index"), *[F.col(c).alias(f"a_{c}") for c in ("cx", "cy", "cz", "mean_range")])
    both = left.join(cells.select(*key, "row_index", "col_index", F.col("cell").alias("b"), "cx", "cy", "cz", "mean_range"), [*key, "row_index", "col_index"])
    limit = F.greatest(F.lit(jump_abs * factor), F.least("a_mean_range", "mean_range") * jump_ratio * factor)
    near = F.abs(F.col("a_mean_range") - F.col("mean_range")) <= limit
    if by_center:
        near &= sum(((F.col(f"a_{c}") - F.col(c)) * (F.col(f"a_{c}") - F.col(c)) for c in ("cx", "cy", "cz")), F.lit(0.0)) <= eps * eps
    return both.where(near).select(*key, "a", "b")


def cell_components(cells: DataFrame, links: DataFrame, least_points: int) -> DataFrame:
    """Cells with ``component`` (the least cell reachable within frame and sensor), of components with enough points."""
    key = [*FRAME, "sensor_name"]

    def run(k, cell: pd.DataFrame, link: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values(["row_index", "col_index"], kind="stable").reset_index(drop=True)
        place = {rc: n for n, rc in enumerate(zip(cell.row_index, cell.col_index, strict=True))}
        a = np.array([place[r, c] for r, c in zip(link.a_row, link.a_col, strict=True)], int)
        b = np.array([place[r, c] for r, c in zip(link.b_row, link.b_col, strict=True)], int)
        return cell.assign(component=ranked(components(len(cell), a, b)).astype("int32"))

    # The other side's keys have names of their own: both sides come from the same cells.
    flat = links.select(*[F.col(k).alias(f"link_{k}") for k in key], F.col("a.row_index").alias("a_row"), F.col("a.col_index").alias("a_col"), F.col("b.row_index").alias("b_row"), F.col("b.col_index").alias("b_col"))
    out = T.StructType([*cells.schema.fields, T.StructField("component", T.IntegerType())])
    found = cells.groupBy(*key).cogroup(flat.groupBy(*[f"link_{k}" for k in key])).applyInPandas(run, out)
    total = F.sum("point_count").over(Window.partitionBy(*key, "component"))
    return found.withColumn("component_points", total).where(F.col("component_points") >= least_points)


def label_points(points: DataFrame, cells: DataFrame) -> DataFrame:
    """Points of the cells' components; ``label`` numbers a frame's components over its sensors."""
    key = [*FRAME, "sensor_name", "row_index", "col_index"]
    label = F.dense_rank().over(Window.partitionBy(*FRAME).orderBy("sensor_name", "component")) - 1
    return points.join(cells.select(*key, "component").withColumn("label", label.cast("int")).drop("component"), key)


def detections(labelled: DataFrame, least: int, most: int) -> DataFrame:
    """One row for each label >= 0 with least to most points: mean center, bounds; ids 1.. over accepted ones by label."""
    aggs = [F.avg(F.col(a).cast("double")).alias(f"c{a}") for a in "xyz"] + [f(a).alias(f"{n}_{a}") for a in "xyz" for f, n in ((F.min, "min"), (F.max, "max"))]
    rows = labelled.where("label >= 0").groupBy(*FRAME, "label").agg(F.count("*").alias("point_count"), F.min("frame_timestamp_ns").alias("frame_timestamp_ns"), *aggs)
    accepted = rows.where(F.col("point_count").between(least, most))
    return accepted.withColumn("detection_id", F.row_number().over(Window.partitionBy(*FRAME).orderBy("label")))


def cluster_metrics(labelled: DataFrame, least: int, most: int) -> DataFrame:
    """Per frame: clusters found, accepted, and rejected as too small or too large."""
    sizes = labelled.where("label >= 0").groupBy(*FRAME, "label").agg(F.count("*").alias("n"))
    return sizes.groupBy(*FRAME).agg(
        F.count("*").alias("raw_clusters"), F.count_if(F.col("n").between(least, most)).alias("accepted"), F.count_if(F.col("n") < least).alias("rejected_small"), F.count_if(F.col("n") > most).alias("rejected_large")
    )
