"""Selection of a track's frames ("chunks") for fusion, over ``observations``.

Selections by rank, prefix or window are window functions; the greedy covers,
where each pick depends on those before, run as a grouped map per track on one
row per frame.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import AXES

TRACK = ["seq_id", "track_id"]


def _order():
    return Window.partitionBy(*TRACK).orderBy("frame_id")


def _all():
    return Window.partitionBy(*TRACK)


def touch_index(observations: DataFrame, line: float, margin: float, axis: str = "y") -> DataFrame:
    """Adds obs_index (from 0) and touch_index: the first chunk whose span meets the line, else the first center there, else null."""
    margin = abs(margin)
    rows = observations.withColumn("obs_index", F.row_number().over(_order()) - 1)
    span = (F.col(f"min_{axis}") - margin <= line) & (F.col(f"max_{axis}") + margin >= line)
    center = F.abs(F.col(f"c{axis}") - line) <= margin
    first = lambda c: F.min(F.when(c, F.col("obs_index"))).over(_all())
    return rows.withColumn("touch_index", F.coalesce(first(span), first(center)))


def line_touch_last_k(observations: DataFrame, line: float, margin: float, k: int, axis: str = "y") -> DataFrame:
    """The last k chunks up to the first that touches the line; without a touch, the last k of all."""
    rows = touch_index(observations, line, margin, axis).where(F.col("touch_index").isNull() | (F.col("obs_index") <= F.col("touch_index")))
    last = F.row_number().over(Window.partitionBy(*TRACK).orderBy(F.desc("frame_id")))
    return rows.withColumn("__last", last).where(F.col("__last") <= max(1, k)).drop("__last")


def truncate_at_lane_end(observations: DataFrame, lane_end: float, margin: float, axis: str = "y") -> DataFrame:
    """The prefix up to the first chunk that touches the lane's low end; whole tracks without a touch."""
    return touch_index(observations, lane_end, margin, axis).where(F.col("touch_index").isNull() | (F.col("obs_index") <= F.col("touch_index")))


def keyframe_motion(observations: DataFrame, keep: int) -> DataFrame:
    """Endpoints, then frames by falling motion (distance to both neighbours), until ``keep``.

    The count is tested after each frame added to the endpoints, so at least
    one frame beyond them comes in; of equal motion the later frame goes first.
    """
    keep = max(1, keep)
    gap = lambda other: F.sqrt(sum(((F.col(f"c{a}") - other(f"c{a}").over(_order())) * (F.col(f"c{a}") - other(f"c{a}").over(_order())) for a in AXES), F.lit(0.0)))
    rows = observations.withColumn("obs_index", F.row_number().over(_order()) - 1).withColumn("n", F.count("*").over(_all()))
    rows = rows.withColumn("motion", F.coalesce(gap(F.lag), F.lit(0.0)) + F.coalesce(gap(F.lead), F.lit(0.0)))
    end = (F.col("obs_index") == 0) | (F.col("obs_index") == F.col("n") - 1)
    rank = Window.partitionBy(*TRACK).orderBy(F.desc("motion"), F.desc("obs_index"))
    # How many frames are chosen once this rank is taken, and once the rank before was.
    chosen = 2 + F.sum(F.when(end, 0).otherwise(1)).over(rank.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("rank", F.row_number().over(rank)).withColumn("before", F.coalesce(chosen, F.lit(2)))
    take = (F.col("n") <= keep) | end | (F.col("before") < keep) | (F.col("rank") == 1)
    return rows.where(take).drop("n", "motion", "rank", "before")


def tail_candidates(observations: DataFrame, axis: str = "y") -> DataFrame:
    """Per track the two chunks that reach furthest behind their center against the direction of motion."""
    direction = F.when(F.max_by(f"c{axis}", "frame_id").over(_all()) - F.min_by(f"c{axis}", "frame_id").over(_all()) < -1e-6, -1).otherwise(1)
    rows = observations.withColumn("direction", direction)
    rear = F.when(F.col("direction") > 0, F.col(f"c{axis}") - F.col(f"min_{axis}")).otherwise(F.col(f"max_{axis}") - F.col(f"c{axis}"))
    ratio = rear / F.greatest(F.col(f"max_{axis}") - F.col(f"min_{axis}"), F.lit(1e-6))
    rows = rows.withColumn("rear_ratio", ratio)
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*TRACK).orderBy(F.desc("rear_ratio"), "frame_id"))).where("rank <= 2")


def coverage_bins(observations: DataFrame, bins: int = 3, axis: str = "y") -> DataFrame:
    """The densest chunk of each of ``bins`` even bins over the range of the track's centers."""
    low, high = F.min(f"c{axis}").over(_all()), F.max(f"c{axis}").over(_all())
    share = (F.col(f"c{axis}") - low) / F.greatest(high - low, F.lit(1e-6))
    rows = observations.withColumn("bin", F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int"))
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*TRACK, "bin").orderBy(F.desc("n_points"), "frame_id"))).where("rank = 1").drop("rank")


def shape_consistent(observations: DataFrame, ratio: float) -> DataFrame:
    """Chunks whose extent norm is within median / ratio and median * ratio; else the largest one alone."""
    norm = F.sqrt(sum(((F.col(f"max_{a}") - F.col(f"min_{a}")).cast("double") * (F.col(f"max_{a}") - F.col(f"min_{a}")) for a in AXES), F.lit(0.0)))
    rows = observations.withColumn("norm", norm)
    rows = rows.withColumn("median", F.percentile("norm", F.lit(0.5)).over(_all()))
    ok = (F.col("median") <= 1e-6) | F.col("norm").between(F.col("median") / ratio, F.col("median") * ratio)
    rows = rows.withColumn("ok", ok).withColumn("any_ok", F.bool_or("ok").over(_all())).withColumn("first_top", F.row_number().over(Window.partitionBy(*TRACK).orderBy(F.desc("norm"), "frame_id")))
    return rows.where("ok OR (NOT any_ok AND first_top = 1)").drop("ok", "any_ok", "first_top", "median")


def quality_window(observations: DataFrame, points_ratio: float = 0.4, extent_ratio: float = 0.35, least: int = 4) -> DataFrame:
    """The run of good chunks that holds the best one; too short or none: ``least`` chunks around the best.

    Good: points and extent reach a share of the track's peaks. Score: 0.6 of
    points plus 0.4 of extent, relative to the peaks; of runs with the peak
    score the longest, then by mean points, then the earlier.
    """
    norm = F.sqrt(sum(((F.col(f"max_{a}") - F.col(f"min_{a}")).cast("double") * (F.col(f"max_{a}") - F.col(f"min_{a}")) for a in AXES), F.lit(0.0)))
    rows = observations.withColumns({"norm": norm, "obs_index": F.row_number().over(_order()) - 1, "n": F.count("*").over(_all())})
    rows = rows.withColumns({"p": F.col("n_points") / F.greatest(F.max("n_points").over(_all()), F.lit(1)), "e": F.col("norm") / F.greatest(F.max("norm").over(_all()), F.lit(1e-6))})
    rows = rows.withColumns({"good": (F.col("p") >= points_ratio) & (F.col("e") >= extent_ratio), "score": 0.6 * F.col("p") + 0.4 * F.col("e")})
    rows = rows.withColumn("run", F.sum(F.when(F.col("good") == F.lag("good").over(_order()), 0).otherwise(1)).over(_order()))
    run = Window.partitionBy(*TRACK, "run")
    rows = rows.withColumns({"run_top": F.max("score").over(run), "run_n": F.count("*").over(run), "run_points": F.avg("n_points").over(run), "run_start": F.min("obs_index").over(run)})
    key = F.struct("run_top", "run_n", "run_points", (-F.col("run_start")).alias("early"), "run")
    rows = rows.withColumn("best", F.max(F.when(F.col("good"), key)).over(_all()))
    rows = rows.withColumn("peak", F.max(F.struct("score", (-F.col("obs_index")).alias("early"))).over(_all()))
    size = F.least(F.col("n"), F.lit(least))
    start = F.greatest(F.lit(0), F.least(-F.col("peak.early") - F.floor(size / 2), F.col("n") - size))
    usable = F.col("best").isNotNull() & (F.col("best.run_n") >= least)
    take = F.when(usable, F.col("good") & (F.col("run") == F.col("best.run"))).otherwise(F.col("obs_index").between(start, start + size - 1))
    return rows.where(take).drop("norm", "n", "p", "e", "good", "score", "run", "run_top", "run_n", "run_points", "run_start", "best", "peak")


#: Shares of a track's peaks in points and extent that let a tail candidate stay beside the window.
TAIL_POINTS, TAIL_EXTENT = 0.25, 0.2


def with_tails(window: DataFrame, observations: DataFrame, tails: DataFrame, points_ratio: float = 0.4, extent_ratio: float = 0.35) -> DataFrame:
    """``window`` and, of ``observations``, the tail candidates that reach lesser shares of their track's peaks; ``tails``: (seq_id, track_id, frame_id)."""
    norm = F.sqrt(sum(((F.col(f"max_{a}") - F.col(f"min_{a}")).cast("double") * (F.col(f"max_{a}") - F.col(f"min_{a}")) for a in AXES), F.lit(0.0)))
    rows = observations.withColumn("norm", norm)
    enough = (F.col("n_points") >= min(points_ratio, TAIL_POINTS) * F.greatest(F.max("n_points").over(_all()), F.lit(1))) & (F.col("norm") >= min(extent_ratio, TAIL_EXTENT) * F.greatest(F.max("norm").over(_all()), F.lit(1e-6)))
    kept = rows.withColumn("enough", enough).where("enough").join(tails, [*TRACK, "frame_id"], "left_semi")
    keys = window.select(*TRACK, "frame_id").union(kept.select(*TRACK, "frame_id")).distinct()
    return observations.join(keys, [*TRACK, "frame_id"], "left_semi")


def with_coverage(chosen: DataFrame, observations: DataFrame, long: DataFrame, tails: DataFrame, bins: int = 3, axis: str = "y") -> DataFrame:
    """``chosen`` and, for the tracks of ``long`` (seq_id, track_id), the densest chunk of each of ``bins`` stretches of their way and their tail candidates among ``observations``."""
    own = observations.join(long, TRACK, "left_semi")
    moves = own.groupBy(*TRACK).agg((F.max(f"c{axis}") - F.min(f"c{axis}")).alias("way")).where("way > 1e-6")
    dense = coverage_bins(own.join(moves, TRACK, "left_semi"), bins, axis)
    frame = [*TRACK, "frame_id"]
    keys = chosen.select(*frame).union(dense.select(*frame)).union(tails.join(long, TRACK, "left_semi").select(*frame)).distinct()
    return observations.join(keys, frame, "left_semi")


# Greedy covers: arrays of one track in, chosen positions out.


def covered(low: np.ndarray, high: np.ndarray, bins: int) -> np.ndarray:
    """Which even bins over the joint range each closed interval meets."""
    if high.max() - low.min() <= 1e-6:
        return np.zeros((len(low), max(2, bins)), bool)
    edges = np.linspace(low.min(), high.max(), max(2, bins) + 1)
    return (high[:, None] >= edges[None, :-1]) & (low[:, None] <= edges[None, 1:])


def _cover(cells: np.ndarray, low: np.ndarray, high: np.ndarray, keep: int, rank: list[tuple], stop_at_zero: bool) -> list[int]:
    chosen = [int(low.argmin())]
    if int(high.argmax()) not in chosen:
        chosen.append(int(high.argmax()))
    done = cells[chosen].any(0)
    while len(chosen) < keep:
        rest = [k for k in range(len(low)) if k not in chosen]
        if not rest:
            break
        gain = {k: int((cells[k] & ~done).sum()) for k in rest}
        best = max(rest, key=lambda k: (gain[k], rank[k]))
        if stop_at_zero and gain[best] <= 0:
            break
        chosen.append(best)
        done |= cells[best]
    for k in sorted((k for k in range(len(low)) if k not in chosen), key=lambda k: rank[k], reverse=True):
        if len(chosen) >= keep:
            break
        chosen.append(k)
    return sorted(chosen)


def length_coverage(low: np.ndarray, high: np.ndarray, keep: int, bins: int) -> list[int]:
    if len(low) <= keep:
        return list(range(len(low)))
    if high.max() - low.min() <= 1e-6:
        return sorted(np.argsort(high - low, kind="stable")[::-1][:keep].tolist())
    # Of equal gain and span the earlier chunk.
    return _cover(covered(low, high, bins), low, high, keep, [(h - l_, -k) for k, (l_, h) in enumerate(zip(low, high, strict=True))], False)


def quality_coverage(points: np.ndarray, low: np.ndarray, high: np.ndarray, norm: np.ndarray, keep: int, bins: int) -> list[int]:
    if len(low) <= keep:
        return list(range(len(low)))
    return _cover(covered(low, high, bins), low, high, keep, [(p, h - l_, n, k) for k, (p, l_, h, n) in enumerate(zip(points, low, high, norm, strict=True))], True)


def center_diversity(centers: np.ndarray, points: np.ndarray, span: np.ndarray, keep: int) -> list[int]:
    """Endpoints, then always the frame furthest from all chosen."""
    n = len(centers)
    if n <= keep:
        return list(range(n))
    chosen = [0, n - 1]
    near = np.minimum(*(np.linalg.norm(centers - centers[k], axis=1) for k in chosen))
    while len(chosen) < keep:
        best = max((k for k in range(n) if k not in chosen), key=lambda k: (near[k], points[k], span[k], k))
        chosen.append(best)
        near = np.minimum(near, np.linalg.norm(centers - centers[best], axis=1))
    return sorted(chosen)


METHODS = ("auto", "all_track_frames", "line_touch_last_k", "keyframe_motion", "length_coverage", "quality_coverage", "tail_coverage", "center_diversity", "max_extent")


def select(observations: DataFrame, method: str = "auto", use_all_frames: bool = True, top_k: int = 10, keep: int = 8, bins: int = 10, line: float = 0.0, margin: float = 0.12, axis: str = "y") -> DataFrame:
    """The frames to fuse. ``max_extent`` and unknown names mean line_touch_last_k; ``auto`` means all frames if ``use_all_frames``, else line touch."""
    if method == "auto":
        method = "all_track_frames" if use_all_frames else "line_touch_last_k"
    if method == "all_track_frames":
        return observations
    if method == "keyframe_motion":
        return keyframe_motion(observations, keep)
    if method not in ("length_coverage", "quality_coverage", "tail_coverage", "center_diversity"):
        return line_touch_last_k(observations, line, margin, top_k, axis)
    keep, bins, top_k = max(1, keep), max(2, bins), max(1, top_k)

    def run(track: pd.DataFrame) -> pd.DataFrame:
        track = track.sort_values("frame_id")
        part = track.iloc[max(0, len(track) - top_k) :] if method == "tail_coverage" else track
        low, high, points = part[f"min_{axis}"].to_numpy(float), part[f"max_{axis}"].to_numpy(float), part["n_points"].to_numpy(float)
        if method == "length_coverage":
            chosen = length_coverage(low, high, keep, bins)
        elif method == "center_diversity":
            chosen = center_diversity(part[["cx", "cy", "cz"]].to_numpy(float), points, high - low, keep)
        else:
            norm = np.sqrt(sum((part[f"max_{a}"] - part[f"min_{a}"]).to_numpy(float) ** 2 for a in AXES))
            chosen = quality_coverage(points, low, high, norm, keep, bins)
        return part.iloc[chosen]

    return observations.groupBy(*TRACK).applyInPandas(run, observations.schema)


def long_vehicle_method(method: str, use_all_frames: bool) -> str:
    """What selection a long vehicle gets instead."""
    return "length_coverage" if method == "keyframe_motion" or (method == "auto" and not use_all_frames) else method
