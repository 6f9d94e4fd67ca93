"""Fusion of a track's selected chunks into one cloud.

``chunk_points``: seq_id, track_id, frame_id, x, y, z, intensity. Fusion is two
chained groupings on (track, frame, voxel) and (track, voxel); what needs
neighbours (outlier removal, components) runs on spatial tiles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import AXES, other_axes, voxels
from ..sources.scratch import Keep, scratch
from .tiles import density_components, mean_neighbour_distance

TRACK = ["seq_id", "track_id"]
VOXEL = ["vx", "vy", "vz"]


def voxel_mean(points: DataFrame, group: list[str], size: float, single: bool = False) -> DataFrame:
    """Mean position and intensity (null unless every point has one) by voxel; size <= 0 changes nothing."""
    if size <= 0:
        return points
    mean = [F.avg(F.col(a).cast("double")).alias(a) for a in AXES]
    all_lit = F.when(F.count("intensity") == F.count("*"), F.avg("intensity")).alias("intensity")
    return points.groupBy(*group, *voxels(size, single)).agg(F.count("*").alias("n"), *mean, all_lit)


def chunk_weights(observations: DataFrame, mode: str = "uniform", quality: DataFrame | None = None) -> DataFrame:
    """(seq_id, track_id, frame_id, weight): 1, the number of points, or the number scaled by the track's quality."""
    if mode == "uniform":
        weight: Column = F.lit(1.0)
    elif mode == "point_count":
        weight = F.col("n_points").cast("double")
    elif mode == "quality" and quality is not None:
        observations = observations.join(quality.select(*TRACK, "quality_score"), TRACK)
        weight = F.col("n_points") * F.greatest("quality_score", F.lit(0.05))
    else:
        raise ValueError(f"unknown weight mode {mode!r}")
    return observations.select(*TRACK, "frame_id", weight.alias("weight"))


def fuse(chunk_points: DataFrame, size: float, weights: DataFrame | None = None, least_chunks: int = 1, consensus: float | None = None, confidence: str = "uniform", single: bool = False) -> DataFrame:
    """Mean by chunk and voxel, then weighted mean over chunks, of voxels that enough chunks hit.

    ``consensus``: share of the track's chunks that must hit (occupancy
    consensus). Intensity stays only if all chunks of the track have it.
    ``confidence`` is the sum of the chunks' weights, or of 1 each.
    """
    by_chunk = voxel_mean(chunk_points, [*TRACK, "frame_id"], size, single)
    track = Window.partitionBy(*TRACK)
    lit = F.bool_and(F.col("intensity").isNotNull()).over(track)
    by_chunk = by_chunk.withColumn("intensity", F.when(lit, F.col("intensity")))
    if consensus is not None:
        by_chunk = by_chunk.withColumn("chunks", F.size(F.collect_set("frame_id").over(track)))
    if weights is not None:
        by_chunk = by_chunk.join(weights, [*TRACK, "frame_id"])
    else:
        by_chunk = by_chunk.withColumn("weight", F.lit(1.0))
    mean = lambda c: (F.sum(F.col("weight") * F.col(c)) / F.sum("weight")).alias(c)
    trust = F.sum("weight") if confidence == "weight" else F.count("*").cast("double")
    need = [F.max("chunks").alias("chunks")] if consensus is not None else []
    out = by_chunk.groupBy(*TRACK, *VOXEL).agg(F.count("*").alias("hits"), *[mean(a) for a in AXES], mean("intensity"), trust.alias("confidence"), *need)
    if consensus is not None:
        return out.where(F.col("hits") >= F.greatest(F.lit(least_chunks), F.ceil(F.lit(consensus) * F.col("chunks")))).drop("chunks")
    return out.where(F.col("hits") >= least_chunks)


def revoxelise(cloud: DataFrame, size: float, single: bool = False) -> DataFrame:
    """Mean position and intensity and summed confidence by voxel."""
    base = cloud.drop(*VOXEL)
    mean = [F.avg(a).alias(a) for a in AXES]
    lit = F.when(F.count("intensity") == F.count("*"), F.avg("intensity")).alias("intensity")
    return base.groupBy(*TRACK, *voxels(size, single)).agg(*mean, lit, F.sum("confidence").alias("confidence"))


def _numbered(cloud: DataFrame, keep: Keep) -> DataFrame:
    """The cloud with a number a point, written so that the numbers stay."""
    return keep("numbered", cloud.withColumn("node", F.monotonically_increasing_id()))


def remove_outliers(cloud: DataFrame, neighbours: int, ratio: float, keep: Keep | None = None, least: int | None = None) -> DataFrame:
    """Statistical outlier removal: points whose mean distance to their nearest neighbours is within mean + ratio * deviation.

    Tracks of fewer than ``least`` (max(8, neighbours)) points stay as they are. The point
    itself is not among its neighbours. Neighbours are found on tiles, so a
    cloud of any size is many tasks.
    """
    keep = keep or scratch(cloud.sparkSession)
    points = _numbered(cloud, keep)
    few = points.groupBy(*TRACK).agg(F.count("*").alias("n")).where(F.col("n") < (least or max(8, neighbours))).select(*TRACK)
    far = keep("distances", mean_neighbour_distance(points.join(few, TRACK, "left_anti"), TRACK, neighbours, keep))
    # Equal distances have a mean that may be less than them by the last bit.
    limit = far.groupBy(*TRACK).agg(((F.avg("distance") + ratio * F.stddev_pop("distance")) * (1 + 1e-12)).alias("limit"))
    near = far.join(limit, TRACK).where("distance <= limit").select(*TRACK, "node")
    return points.join(near, [*TRACK, "node"], "left_semi").unionByName(points.join(few, TRACK, "left_semi")).drop("node")


def cloud_components(cloud: DataFrame, eps: float, keep: Keep | None = None) -> DataFrame:
    """Adds ``component`` by eps-connection within each track."""
    keep = keep or scratch(cloud.sparkSession)
    points = _numbered(cloud, keep)
    found = density_components(points, TRACK, eps, 1, keep).select(*TRACK, "node", F.col("cluster").alias("component"))
    return points.join(found, [*TRACK, "node"]).drop("node")


def tail_bridge(parts: DataFrame, gap: float, lateral: float, vertical: float, step: float, axis: str = "y") -> DataFrame:
    """Points interpolated between neighbouring components along the axis whose gap and offsets are within limits."""
    side, up = other_axes(axis)
    by = parts.groupBy(*TRACK, "component").agg(F.min(axis).alias("low"), F.max(axis).alias("high"), F.avg(side).alias("side"), F.avg(up).alias("up"), F.avg("intensity").alias("intensity"), F.avg("confidence").alias("confidence"))
    order = Window.partitionBy(*TRACK).orderBy("low", "component")
    nxt = {f"next_{c}": F.lead(c).over(order) for c in ("low", "side", "up")}
    rows = by.withColumns(nxt).withColumn("gap", F.col("next_low") - F.col("high"))
    rows = rows.where((F.col("gap") > 0) & (F.col("gap") <= gap) & (F.abs(F.col("next_side") - F.col("side")) <= lateral) & (F.abs(F.col("next_up") - F.col("up")) <= vertical))
    n = F.ceil(F.col("gap") / step).cast("int")
    rows = rows.withColumn("n", n).where("n > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1)))
    t = F.col("k") / F.col("n")
    place = {axis: F.col("high") + t * F.col("gap"), side: F.col("side") + t * (F.col("next_side") - F.col("side")), up: F.col("up") + t * (F.col("next_up") - F.col("up"))}
    return rows.select(*TRACK, *[place[a].alias(a) for a in AXES], "intensity", "confidence")


def confidence_cap(cloud: DataFrame, most: int, bins: int, axis: str = "y") -> DataFrame:
    """At most ``most`` points a track: an equal whole budget (none, with more bins than points) for each occupied bin along the axis by confidence, then the best of the rest.

    Ties go by voxel where the cloud has voxels, else by coordinates.
    """
    track = Window.partitionBy(*TRACK)
    low, high = F.min(axis).over(track), F.max(axis).over(track)
    rows = cloud.withColumn("bin", F.least(F.floor((F.col(axis) - low) / F.greatest(high - low, F.lit(1e-9)) * bins), F.lit(bins - 1)))
    order = [F.desc("confidence"), *[c for c in ("vx", "vy", "vz") if c in cloud.columns], *AXES]
    rows = rows.withColumn("in_bin", F.row_number().over(Window.partitionBy(*TRACK, "bin").orderBy(*order))).withColumn("n", F.count("*").over(track)).withColumn("used", F.size(F.collect_set("bin").over(track)))
    first = F.col("in_bin") <= F.floor(F.lit(most) / F.col("used"))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy(*TRACK).orderBy(F.when(first, 0).otherwise(1), *order)))
    return rows.where((F.col("n") <= most) | (F.col("place") <= most)).drop("bin", "in_bin", "n", "used", "place")


def symmetry_plane(cloud: DataFrame, axis: str = "y", size: float = 0.06) -> DataFrame:
    """Per track the lateral plane (median, or the midpoint of the 5 and 95 % marks if that is half a voxel off) and the kept side.

    The side with more points; of equals the one further from the plane on average; else the positive.
    """
    side, _ = other_axes(axis)
    marks = cloud.groupBy(*TRACK).agg(*[F.percentile(side, F.lit(q)).alias(n) for q, n in ((0.05, "p05"), (0.5, "p50"), (0.95, "p95"))])
    mid = (F.col("p05") + F.col("p95")) / 2
    marks = marks.select(*TRACK, F.when(F.abs(mid - F.col("p50")) >= size / 2, mid).otherwise(F.col("p50")).alias("plane"))
    off = F.col(side) - F.col("plane")
    sides = cloud.join(marks, TRACK).groupBy(*TRACK, "plane").agg(
        F.count_if(off >= 0).alias("plus"), F.count_if(off < 0).alias("minus"), F.coalesce(F.avg(F.when(off >= 0, off)), F.lit(0.0)).alias("plus_far"), F.coalesce(F.avg(F.when(off < 0, -off)), F.lit(0.0)).alias("minus_far")
    )
    keep_plus = (F.col("plus") > F.col("minus")) | ((F.col("plus") == F.col("minus")) & (F.col("plus_far") >= F.col("minus_far")))
    return sides.select(*TRACK, "plane", "plus", "minus", F.when(keep_plus, 1).otherwise(-1).alias("side"))


def complete_symmetry(cloud: DataFrame, size: float, axis: str = "y") -> DataFrame:
    """The kept side and its mirror image, voxelised again."""
    side, _ = other_axes(axis)
    kept = cloud.join(symmetry_plane(cloud, axis, size), TRACK).where((F.col(side) - F.col("plane")) * F.col("side") >= 0)
    mirrored = kept.withColumn(side, 2 * F.col("plane") - F.col(side))
    return revoxelise(kept.unionByName(mirrored).drop("plane", "plus", "minus", "side"), size)


def symmetry_slices(cloud: DataFrame, size: float, axis: str = "y") -> DataFrame:
    """Per track and side the number of distinct (axis bin, vertical bin)."""
    side, up = other_axes(axis)
    rows = cloud.join(symmetry_plane(cloud, axis, size).select(*TRACK, "plane"), TRACK)
    half = F.when(F.col(side) >= F.col("plane"), 1).otherwise(-1)
    return rows.groupBy(*TRACK, half.alias("half")).agg(F.countDistinct(F.floor(F.col(axis) / size), F.floor(F.col(up) / size)).alias("slices"))


def dimensions(cloud: DataFrame, axis: str = "y") -> DataFrame:
    """Length, width and height of each cloud."""
    side, up = other_axes(axis)
    return cloud.groupBy(*TRACK).agg(F.count("*").alias("n_points"), *[(F.max(a) - F.min(a)).alias(n) for a, n in ((axis, "length"), (side, "width"), (up, "height"))])


def deskew(chunk_points: DataFrame, observations: DataFrame, axis: str = "y", least_speed: float = 1.0) -> DataFrame:
    """Points moved along the axis to where they were at their chunk's median time.

    Speed: central difference of centers over real seconds. Chunks below
    ``least_speed`` a second, or whose points lack a time, stay.
    """
    order = Window.partitionBy(*TRACK).orderBy("frame_id")
    either = lambda c: (F.coalesce(F.lead(c).over(order), F.col(c)) - F.coalesce(F.lag(c).over(order), F.col(c)))
    speed = either(f"c{axis}") / F.nullif(either("ts_ns") / 1e9, F.lit(0.0))
    rows = chunk_points.join(observations.withColumn("speed", speed).select(*TRACK, "frame_id", "speed"), [*TRACK, "frame_id"])
    mid = F.percentile("point_ns", F.lit(0.5)).over(Window.partitionBy(*TRACK, "frame_id"))
    rows = rows.withColumn("mid", mid)
    moved = F.col(axis) - F.col("speed") * (F.col("point_ns") - F.col("mid")) / 1e9
    use = F.col("speed").isNotNull() & (F.abs("speed") >= least_speed) & F.col("point_ns").isNotNull()
    return rows.withColumn("applied", use).withColumn(axis, F.when(use, moved).otherwise(F.col(axis).cast("double"))).drop("speed", "mid")


def decide(tracks: DataFrame, clouds: DataFrame, least_hits: int, least_points: int, least_quality: float | Column, require_exit: bool) -> DataFrame:
    """``status`` of each track, gates in order: hits, exit, no cloud, points, quality (a threshold a track, if a column); else saved; with its stage and a summary."""
    rows = tracks.join(clouds.select(*TRACK, "n_points"), TRACK, "left")
    gates = [
        (F.col("hit_count") < least_hits, "skipped_min_hits", "gate"), (F.lit(require_exit) & ~F.col("exited"), "skipped_track_exit", "gate"), (F.col("n_points").isNull(), "empty_selection", "fusion"),
        (F.col("n_points") < least_points, "skipped_min_saved_points", "save"), (F.col("quality_score") < least_quality, "skipped_quality_threshold", "save"),
    ]
    status, stage = F.lit("saved"), F.lit("save")
    for test, name, at in reversed(gates):
        status, stage = F.when(test, name).otherwise(status), F.when(test, at).otherwise(stage)
    text = F.format_string("track %04d: %s (%s), %d hits, %d points", F.col("track_id"), "status", "stage", "hit_count", F.coalesce("n_points", F.lit(0)))
    return rows.withColumn("status", status).withColumn("stage", stage).withColumn("summary", text)


def exited(observations: DataFrame, tracks: DataFrame, lane_end: float, margin: float, axis: str = "y") -> DataFrame:
    """``tracks`` with exited: the last center is past the line and the track was missed since."""
    last = observations.groupBy(*TRACK).agg(F.max_by(f"c{axis}", "frame_id").alias("last_at"))
    gone = (F.col("last_at") <= lane_end + margin) & (F.col("ended_by_missed") | (F.col("missed") > 0))
    return tracks.join(last, TRACK, "left").withColumn("exited", F.coalesce(gone, F.lit(False))).drop("last_at")


def front_anchor(cloud: DataFrame, direction: DataFrame, axis: str = "y") -> DataFrame:
    """Leading edge along the axis, medians across it."""
    rows = cloud.join(direction.select(*TRACK, "direction"), TRACK)
    edge = F.max(F.col(axis) * F.col("direction")) * F.first("direction")
    return rows.groupBy(*TRACK).agg(edge.alias(f"anchor_{axis}"), *[F.percentile(a, F.lit(0.5)).alias(f"anchor_{a}") for a in other_axes(axis)])


def candidate_world(cloud: DataFrame, observations: DataFrame) -> DataFrame:
    """A local cloud moved to the median of its track's selected centers."""
    anchor = observations.groupBy(*TRACK).agg(*[F.percentile(f"c{a}", F.lit(0.5)).alias(f"anchor_{a}") for a in AXES])
    rows = cloud.join(anchor, TRACK)
    return rows.withColumns({a: F.col(a) + F.col(f"anchor_{a}") for a in AXES}).drop(*[f"anchor_{a}" for a in AXES])
