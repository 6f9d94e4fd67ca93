"""Track post-processing over ``observations``, one row per track and frame.

Columns used: seq_id, track_id, frame_id, n_points, cx..cz, min_x..max_z. What
compares tracks is a join on the frame and a grouping; only the order-bound
resolution of merges runs as one grouped map per sequence, on a few rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import AXES, other_axes

TRACK = ["seq_id", "track_id"]


def extents(observations: DataFrame) -> DataFrame:
    return observations.withColumns({f"e{a}": F.col(f"max_{a}") - F.col(f"min_{a}") for a in AXES})


def variation(c: Column) -> Column:
    """Population deviation over the mean, which counts as 1 at least."""
    return F.stddev_pop(c) / F.greatest(F.avg(c), F.lit(1.0))


def quality(observations: DataFrame, tracks: DataFrame, axis: str = "y", long_threshold: float = 4.5) -> DataFrame:
    """Per track the quality score and its parts; ``tracks`` has age."""
    lateral, vertical = other_axes(axis)
    parts = extents(observations).groupBy(*TRACK).agg(
        F.count("*").alias("observation_count"), variation(F.col("n_points")).alias("point_count_cv"), variation(F.col(f"e{axis}")).alias("length_cv"),
        variation(F.col(f"e{lateral}")).alias("width_cv"), variation(F.col(f"e{vertical}")).alias("height_cv"), F.percentile(f"e{axis}", F.lit(0.75)).alias("longitudinal_extent_p75"),
    )
    unit = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    rows = parts.join(tracks.select(*TRACK, "age"), TRACK)
    rows = rows.withColumn("continuity", unit(F.col("observation_count") / F.greatest("age", F.lit(1)))).withColumn("longevity", unit(F.col("observation_count") / 20.0))
    rows = rows.withColumn("cross_section_cv", 0.5 * (F.col("width_cv") + F.col("height_cv")))
    cross, length = unit(1 / (1 + F.col("point_count_cv") + F.col("cross_section_cv"))), unit(1 / (1 + F.col("length_cv")))
    rows = rows.withColumn("quality_score", 0.4 * F.col("continuity") + 0.3 * F.col("longevity") + 0.2 * cross + 0.1 * length)
    return rows.withColumn("is_long_vehicle", F.col("longitudinal_extent_p75") >= long_threshold)


def smooth(observations: DataFrame, window: int) -> DataFrame:
    """Centers replaced by the mean over window // 2 neighbours on each side; tracks of up to two stay."""
    if window <= 1:
        return observations
    half = window // 2
    near = Window.partitionBy(*TRACK).orderBy("frame_id").rowsBetween(-half, half)
    n = F.count("*").over(Window.partitionBy(*TRACK))
    return observations.withColumns({f"c{a}": F.when(n > 2, F.avg(f"c{a}").over(near)).otherwise(F.col(f"c{a}")) for a in AXES})


def shared_frames(observations: DataFrame) -> DataFrame:
    """A row for each pair of tracks a < b and each frame both were seen in, with columns a_* and b_*."""
    cols = [c for c in observations.columns if c not in ("seq_id", "frame_id")]
    a = observations.select("seq_id", "frame_id", *[F.col(c).alias(f"a_{c}") for c in cols])
    b = observations.select("seq_id", "frame_id", *[F.col(c).alias(f"b_{c}") for c in cols])
    return a.join(b, ["seq_id", "frame_id"]).where("a_track_id < b_track_id").withColumnsRenamed({"a_track_id": "a", "b_track_id": "b"})


def _steps(who: str) -> list[Column]:
    """Aggregates: a track's displacement over the shared frames by axis."""
    return [(F.max_by(f"{who}_c{x}", "frame_id") - F.min_by(f"{who}_c{x}", "frame_id")).alias(f"{who}_d{x}") for x in AXES]


def _norm(who: str) -> Column:
    return F.sqrt(sum(F.col(f"{who}_d{x}") ** 2 for x in AXES))


def _cosine(scale: float) -> Column:
    return sum(F.col(f"a_d{x}") * F.col(f"b_d{x}") for x in AXES) / F.greatest(_norm("a") * _norm("b"), F.lit(1e-6 * scale * scale))


def co_moving_metrics(observations: DataFrame, axis: str = "y") -> DataFrame:
    """(seq_id, a, b): overlap, mean lateral and vertical offset, largest, deviation and median of the longitudinal one, displacements."""
    lateral, vertical = other_axes(axis)
    gap = lambda x: F.col(f"b_c{x}") - F.col(f"a_c{x}")
    return shared_frames(observations).groupBy("seq_id", "a", "b").agg(
        F.count("*").alias("overlap"), F.avg(F.abs(gap(lateral))).alias("lateral_mean"), F.max(F.abs(gap(axis))).alias("longitudinal_max"),
        F.stddev_pop(F.abs(gap(axis))).alias("longitudinal_std"), F.avg(F.abs(gap(vertical))).alias("vertical_mean"), F.percentile(gap(axis), F.lit(0.5)).alias("longitudinal_median"), *_steps("a"), *_steps("b"),
    )


def co_moving_pairs(observations: DataFrame, max_lateral: float, max_longitudinal: float, min_overlap: int, min_ratio: float, axis: str = "y", scale: float = 1.0) -> DataFrame:
    """Pairs that may merge: they overlap enough, keep close and steady offsets and move alike. ``scale``: units a metre."""
    n = observations.groupBy(*TRACK).agg(F.count("*").alias("n"))
    rows = co_moving_metrics(observations, axis).join(n.withColumnsRenamed({"track_id": "a", "n": "na"}), ["seq_id", "a"]).join(n.withColumnsRenamed({"track_id": "b", "n": "nb"}), ["seq_id", "b"])
    ok = (F.col("overlap") >= min_overlap) & (F.col("overlap") / F.least("na", "nb") >= min_ratio) & (F.col("lateral_mean") <= max_lateral) & (F.col("longitudinal_max") <= max_longitudinal)
    ok &= (F.col("longitudinal_std") <= max(0.5 * scale, 0.25 * max_longitudinal)) & (F.col("vertical_mean") <= max(0.6 * scale, max_lateral))
    still = lambda who: _norm(who) <= 1e-6 * scale
    speed = F.abs(F.col(f"a_d{axis}") - F.col(f"b_d{axis}")) / F.greatest(F.col("overlap") - 1, F.lit(1))
    alike = (_cosine(scale) >= 0.85) & (speed <= max(0.5 * scale, 0.2 * max_longitudinal))
    ok &= (F.col("overlap") < 2) | (still("a") & still("b")) | (~still("a") & ~still("b") & alike)
    return rows.where(ok).select("seq_id", "a", "b", "overlap")


def co_moving_merges(observations: DataFrame, max_lateral: float, max_longitudinal: float, min_overlap: int, min_ratio: float, axis: str = "y", scale: float = 1.0) -> DataFrame:
    """(seq_id, track_id, new_id): tracks merged until none is left that may.

    In order of first frame and id, a track takes every free later one that may
    merge with what it has become; passes repeat until one merges nothing. A
    merged frame's center is the mean over the points of both. One sequence's
    observations, a row for a track and frame, are one group; tracks that can't
    meet in any frame are never compared.
    """
    lateral, vertical = (AXES.index(x) for x in other_axes(axis))
    along = AXES.index(axis)

    def may(one: dict[int, np.ndarray], two: dict[int, np.ndarray]) -> bool:
        frames = sorted(one.keys() & two.keys())
        if len(frames) < max(min_overlap, 1) or len(frames) / min(len(one), len(two)) < min_ratio:
            return False
        a, b = (np.array([t[f][:3] / t[f][3] for f in frames]) for t in (one, two))
        gap = np.abs(b - a)
        if gap[:, lateral].mean() > max_lateral or gap[:, along].max() > max_longitudinal or gap[:, along].std() > max(0.5 * scale, 0.25 * max_longitudinal) or gap[:, vertical].mean() > max(0.6 * scale, max_lateral):
            return False
        da, db = a[-1] - a[0], b[-1] - b[0]
        na, nb = np.linalg.norm(da), np.linalg.norm(db)
        if len(frames) < 2 or max(na, nb) <= 1e-6 * scale:
            return True
        if min(na, nb) <= 1e-6 * scale or da @ db / (na * nb) < 0.85:
            return False
        return abs(da[along] - db[along]) / (len(frames) - 1) <= max(0.5 * scale, 0.2 * max_longitudinal)

    def run(key, seq: pd.DataFrame) -> pd.DataFrame:
        weighted = seq[["cx", "cy", "cz"]].to_numpy(float) * seq.n_points.to_numpy(float)[:, None]
        held: dict[int, dict[int, np.ndarray]] = {}
        for t, f, w, n in zip(seq.track_id, seq.frame_id, weighted, seq.n_points, strict=True):
            held.setdefault(t, {})[f] = np.append(w, float(n))
        order = sorted(held, key=lambda t: (min(held[t]), t))
        parts, changed = {t: [t] for t in order}, True
        while changed:
            changed, left = False, []
            free = dict.fromkeys(order)
            for t in order:
                if t not in free:
                    continue
                del free[t]
                for other in list(free):
                    if may(held[t], held[other]):
                        for f, w in held.pop(other).items():
                            held[t][f] = held[t].get(f, 0.0) + w
                        parts[t] += parts.pop(other)
                        del free[other]
                        changed = True
                left.append(t)
            order = left
        rows = [(key[0], t, new) for new, all_ in parts.items() for t in all_]
        return pd.DataFrame(rows, columns=["seq_id", "track_id", "new_id"])

    rows = observations.select(*TRACK, "frame_id", *[F.col(f"c{x}").cast("double").alias(f"c{x}") for x in AXES], "n_points")
    return rows.groupBy("seq_id").applyInPandas(run, "seq_id string, track_id int, new_id int")


def motion(observations: DataFrame, axis: str = "y", last: int | None = None) -> DataFrame:
    """Per track: direction of motion, displacement, and slope of the rear edge against the frame over its ``last`` frames."""
    order = Window.partitionBy(*TRACK).orderBy("frame_id")
    rows = observations.withColumn("step", F.col(f"c{axis}") - F.lag(f"c{axis}").over(order)).withColumn("back", F.row_number().over(Window.partitionBy(*TRACK).orderBy(F.desc("frame_id"))))
    direction = F.when(F.sum("step") < 0, -1).otherwise(1)
    tail = F.lit(True) if last is None else F.col("back") <= last
    edge = lambda c: F.regr_slope(F.when(tail, F.col(c)), F.when(tail, F.col("frame_id")))
    return rows.groupBy(*TRACK).agg(direction.alias("direction"), (F.max_by(f"c{axis}", "frame_id") - F.min_by(f"c{axis}", "frame_id")).alias("displacement"), edge(f"min_{axis}").alias("min_slope"), edge(f"max_{axis}").alias("max_slope")).withColumn(
        "rear_slope", F.when(F.col("direction") > 0, F.col("min_slope")).otherwise(F.col("max_slope"))
    ).drop("min_slope", "max_slope")


def articulated_metrics(observations: DataFrame, window: int = 5, axis: str = "y", scale: float = 1.0) -> DataFrame:
    """(seq_id, a, b) of tracks with common frames: what the tests of ``articulated_decision`` need.

    direction (of both together, or of the one that moves; 0: neither does),
    offsets, cosine and norms of the displacements, speeds of the rear edges
    over the last ``window`` common frames and of the centers over all, a's
    lead over b along the direction, and the gap from the leader's rear to the
    follower's front: over all frames (full_*) and the last (tail_*).
    """
    lateral, vertical = other_axes(axis)
    pair = Window.partitionBy("seq_id", "a", "b")
    ordered = pair.orderBy("frame_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    moved = lambda t: F.last(f"{t}_c{axis}").over(ordered) - F.first(f"{t}_c{axis}").over(ordered)
    least = F.lit(1e-6 * scale)
    heading = F.when(F.abs(F.col("ma") + F.col("mb")) > least, F.col("ma") + F.col("mb")).when(F.abs("ma") > least, F.col("ma")).otherwise(F.col("mb"))
    rows = shared_frames(observations).withColumns({"ma": moved("a"), "mb": moved("b"), "back": F.row_number().over(pair.orderBy(F.desc("frame_id")))})
    rows = rows.withColumn("direction", F.when(F.abs(heading) <= least, 0).when(heading > 0, 1).otherwise(-1))
    for t in "ab":
        low, high = F.col(f"{t}_min_{axis}"), F.col(f"{t}_max_{axis}")
        rows = rows.withColumns({f"{t}_rear": F.when(F.col("direction") < 0, -high).otherwise(low).cast("double"), f"{t}_front": F.when(F.col("direction") < 0, -low).otherwise(high).cast("double")})
    rows = rows.withColumns({
        "ahead": (F.col(f"a_c{axis}") - F.col(f"b_c{axis}")) * F.col("direction"), "gap_ab": F.col("a_rear") - F.col("b_front"), "gap_ba": F.col("b_rear") - F.col("a_front"),
        "joint": F.greatest("a_front", "b_front") - F.least("a_rear", "b_rear"), "late": F.col("back") <= window,
    })
    late = lambda c: F.when(F.col("late"), F.col(c))
    gaps = [f(c).alias(f"{n}_{g}") for g in ("gap_ab", "gap_ba") for n, f, c in (("full_mean", F.avg, g), ("full_std", F.stddev_pop, g), ("least", F.min, g), ("tail_mean", F.avg, late(g)), ("tail_std", F.stddev_pop, late(g)))]
    missing = F.greatest(*[F.max(F.col(f"{t}_{e}_{axis}").isNull().cast("int")) for t in "ab" for e in ("min", "max")]) == 1
    late_missing = F.max((F.col("late") & (F.col("a_rear").isNull() | F.col("b_rear").isNull())).cast("int")) == 1
    out = rows.groupBy("seq_id", "a", "b", "direction").agg(
        F.count("*").alias("overlap"), F.min("frame_id").alias("overlap_start"), F.max("frame_id").alias("overlap_end"), F.count_if("late").alias("tail_count"),
        F.avg(F.abs(F.col(f"a_c{lateral}") - F.col(f"b_c{lateral}"))).alias("lateral_mean"), F.avg(F.abs(F.col(f"a_c{vertical}") - F.col(f"b_c{vertical}"))).alias("vertical_mean"),
        F.percentile("ahead", F.lit(0.5)).alias("ahead_median"), F.avg((F.col("ahead") > 0).cast("double")).alias("ahead_share"), F.avg((F.col("ahead") < 0).cast("double")).alias("behind_share"),
        F.percentile("joint", F.lit(0.75)).alias("combined_length"), missing.alias("missing"), late_missing.alias("late_missing"), *_steps("a"), *_steps("b"), *gaps,
        *[F.regr_slope(late(f"{t}_rear"), F.when(F.col("late"), F.col("frame_id"))).alias(f"{t}_slope") for t in "ab"],
        *[F.percentile(F.col(f"{t}_max_{axis}") - F.col(f"{t}_min_{axis}"), F.lit(0.75)).alias(f"{t}_length") for t in "ab"],
    )
    of_lead = lambda n: F.when(F.col("ahead_median") > 0, F.col(f"{n}_gap_ab")).otherwise(F.col(f"{n}_gap_ba"))
    gaps = {"full_gap_mean": of_lead("full_mean"), "full_gap_std": of_lead("full_std"), "tail_gap_mean": of_lead("tail_mean"), "tail_gap_std": of_lead("tail_std"), "gap_min": of_lead("least")}
    out = out.withColumns(gaps).withColumns({f"{t}_speed": F.col(f"{t}_d{axis}") / F.greatest(F.col("overlap") - 1, F.lit(1)) for t in "ab"})
    short = F.col("tail_count") < 3
    out = out.withColumns({"cosine": _cosine(scale), "a_moved": _norm("a"), "b_moved": _norm("b"), "gap_mean": F.when(short, F.col("full_gap_mean")).otherwise(F.col("tail_gap_mean")), "gap_std": F.when(short, F.col("full_gap_std")).otherwise(F.col("tail_gap_std"))})
    return out.drop(*[f"{n}_{g}" for g in ("gap_ab", "gap_ba") for n in ("full_mean", "full_std", "least", "tail_mean", "tail_std")])


def motion_accepted(max_speed_delta: float, scale: float = 1.0) -> Column:
    """Whether two tracks of ``articulated_metrics`` move alike: both still, or like headings and like speeds of the rear edges (of the centers where an edge is missing)."""
    still = lambda t: F.col(f"{t}_moved") <= 1e-6 * scale
    edges = F.abs(F.coalesce("a_slope", F.lit(0.0)) - F.coalesce("b_slope", F.lit(0.0))) <= max_speed_delta
    centers = F.abs(F.col("a_speed") - F.col("b_speed")) <= max_speed_delta
    like = (F.col("cosine") >= 0.85) & ((F.col("tail_count") < 2) | F.when(F.col("late_missing"), centers).otherwise(edges))
    return (F.col("overlap") < 2) | (still("a") & still("b")) | (~still("a") & ~still("b") & like)


def articulated_decision(metrics: DataFrame, lengths: DataFrame, min_overlap: int = 4, min_ratio: float = 0.5, max_lateral: float = 0.9, max_vertical: float = 0.6, max_gap: float = 2.5, max_gap_std: float = 0.6, min_length: float = 6.5, max_speed_delta: float = 0.5, scale: float = 1.0) -> DataFrame:
    """``reason`` of each pair: the first test that fails, else where the accepted gap comes from; and ``linked``.

    ``lengths``: (seq_id, track_id, n). ``scale``: units a metre, which all lengths are given in but for those fixed here.
    """
    rows = metrics.join(lengths.withColumnsRenamed({"track_id": "a", "n": "na"}), ["seq_id", "a"]).join(lengths.withColumnsRenamed({"track_id": "b", "n": "nb"}), ["seq_id", "b"])
    ratio = F.col("overlap") / F.greatest(F.least("na", "nb"), F.lit(1))
    steady = F.when(F.col("ahead_median") > 0, F.col("ahead_share")).otherwise(F.col("behind_share"))
    full = F.col("tail_count") < 3
    # Names of reasons are fixed values.
    tests = [
        (F.col("overlap") < min_overlap, "overlap_frames"), (ratio < min_ratio, "overlap_ratio"), (F.col("lateral_mean") > max_lateral, "lateral_offset"), (F.col("vertical_mean") > max_vertical, "vertical_offset"),
        (F.col("direction") == 0, "direction"), (~motion_accepted(max_speed_delta, scale), "motion"), ((F.abs("ahead_median") < 0.5 * scale) | (steady < 0.9), "ordering"), (F.col("missing"), "missing_points"),
        (full & (F.col("gap_mean") > max_gap), "gap_full"), (F.col("gap_mean") > max_gap, "gap_tail"), (full & (F.col("gap_std") > max_gap_std), "gap_full_std"), (F.col("gap_std") > max_gap_std, "gap_tail_std"),
        (F.col("gap_min") < -0.75 * scale, "gap_negative"), (F.col("combined_length") < min_length, "combined_length"), (full, "full_gap_fallback"),
    ]
    reason = F.lit("tail_gap")
    for test, name in reversed(tests):
        reason = F.when(test, F.lit(name)).otherwise(reason)
    return rows.withColumn("ratio", ratio).withColumn("reason", reason).withColumn("linked", F.col("reason").isin("tail_gap", "full_gap_fallback"))


def best_partners(decided: DataFrame, observations: DataFrame) -> DataFrame:
    """(seq_id, lead, rear, gap_mean): in order of first frame and id, a free track takes its best free later partner, by overlap, ratio, steadiness and closeness of the gap."""
    first = observations.groupBy(*TRACK).agg(F.min("frame_id").alias("first"))
    side = lambda t: first.select("seq_id", F.col("track_id").alias(t), F.col("first").alias(f"{t}_first"))
    rows = decided.where("linked").select("seq_id", "a", "b", "overlap", "ratio", "gap_std", "gap_mean", "ahead_median").join(side("a"), ["seq_id", "a"]).join(side("b"), ["seq_id", "b"])

    def run(key, pairs: pd.DataFrame) -> pd.DataFrame:
        later: dict[tuple, list[tuple]] = {}
        for p in pairs.itertuples():
            one, two = sorted([(p.a_first, p.a), (p.b_first, p.b)])
            link = (p.a, p.b, p.gap_mean) if p.ahead_median > 0 else (p.b, p.a, p.gap_mean)
            later.setdefault(one, []).append(((p.overlap, p.ratio, -p.gap_std, -abs(p.gap_mean)), two, link))
        used, out = set(), []
        for one in sorted(later):
            # Of equal partners the first in order.
            free = sorted((x for x in later[one] if x[1] not in used), key=lambda x: x[1])
            if one not in used and free:
                _, two, link = max(free, key=lambda x: x[0])
                used |= {one, two}
                out.append((key[0], *link))
        return pd.DataFrame(out, columns=["seq_id", "lead", "rear", "gap_mean"])

    return rows.groupBy("seq_id").applyInPandas(run, "seq_id string, lead int, rear int, gap_mean double")


def link_states(links: DataFrame, kind: str) -> DataFrame:
    """(seq_id, track_id, group_id, group_kind, role, partner_id, gap_mean, component_track_ids): the state that a link (lead, rear) gives both tracks.

    ``kind`` is ``articulated`` or ``fragment``; the group has the leader's id.
    """
    follower = "rear" if kind == "articulated" else "fragment"
    both = F.array(F.struct(F.col("lead").alias("track_id"), F.lit("lead").alias("role"), F.col("rear").alias("partner_id")), F.struct(F.col("rear").alias("track_id"), F.lit(follower).alias("role"), F.col("lead").alias("partner_id")))
    gap = F.col("gap_mean") if "gap_mean" in links.columns else F.lit(None).cast("double")
    rows = links.select("seq_id", F.col("lead").alias("group_id"), gap.alias("gap_mean"), F.array("lead", "rear").alias("component_track_ids"), F.explode(both).alias("s"))
    return rows.select("seq_id", "s.track_id", "group_id", F.lit(kind).alias("group_kind"), "s.role", "s.partner_id", "gap_mean", "component_track_ids")


def long_candidates(observations: DataFrame, threshold: float, axis: str = "y") -> DataFrame:
    """Pairs of overlapping tracks that may be parts of one long vehicle."""
    p75 = F.percentile(F.col(f"max_{axis}") - F.col(f"min_{axis}"), F.lit(0.75))
    long = observations.groupBy(*TRACK).agg(p75.alias("length"), F.max_by(f"c{axis}", "frame_id").alias("now"))
    both = shared_frames(observations).select("seq_id", "a", "b").distinct()
    side = lambda t: long.select("seq_id", F.col("track_id").alias(t), F.col("length").alias(f"l{t}"), F.col("now").alias(f"now_{t}"))
    rows = both.join(side("a"), ["seq_id", "a"]).join(side("b"), ["seq_id", "b"])
    # Each track's current center is its last one, in whatever frame.
    joint = F.col("la") + F.col("lb") + F.abs(F.col("now_b") - F.col("now_a"))
    return rows.where((F.greatest("la", "lb") >= 0.85 * threshold) | (joint >= threshold)).select("seq_id", "a", "b")


def fragment_links(observations: DataFrame, pairs: DataFrame, axis: str = "y") -> DataFrame:
    """(seq_id, a, b): fragments of one long vehicle, each track in one link.

    ``pairs`` may move together and be long. In order of first frame and id, a
    free track takes its best free later partner: by joint extent, joint
    points, the smaller number of hits, then the nearer id.
    """
    own = observations.groupBy(*TRACK).agg(F.min("frame_id").alias("first"), F.percentile(F.col(f"max_{axis}") - F.col(f"min_{axis}"), F.lit(0.75)).alias("length"), F.sum("n_points").alias("points"), F.count("*").alias("hits"))
    side = lambda t: own.select("seq_id", F.col("track_id").alias(t), *[F.col(c).alias(f"{t}_{c}") for c in ("first", "length", "points", "hits")])
    rows = pairs.select("seq_id", "a", "b").join(side("a"), ["seq_id", "a"]).join(side("b"), ["seq_id", "b"])
    rows = rows.select("seq_id", "a", "b", "a_first", "b_first", (F.col("a_length") + F.col("b_length")).alias("length"), (F.col("a_points") + F.col("b_points")).alias("points"), F.least("a_hits", "b_hits").alias("hits"))

    def run(key, pair: pd.DataFrame) -> pd.DataFrame:
        later: dict[tuple, list[tuple]] = {}
        for p in pair.itertuples():
            one, two = sorted([(p.a_first, p.a), (p.b_first, p.b)])
            later.setdefault(one, []).append((p.length, p.points, p.hits, -abs(p.a - p.b), two))
        used, out = set(), []
        for one in sorted(later):
            free = [x for x in later[one] if x[-1] not in used]
            if one not in used and free:
                two = max(free)[-1]
                used |= {one, two}
                out.append((key[0], one[1], two[1]))
        return pd.DataFrame(out, columns=["seq_id", "a", "b"])

    return rows.groupBy("seq_id").applyInPandas(run, "seq_id string, a int, b int")


def stitch(observations: DataFrame, pairs: DataFrame) -> DataFrame:
    """(seq_id, track_id, new_id) of tracklets stitched end to start.

    ``pairs`` (seq_id, a, b): b may continue a. In order of first frame and id,
    a tracklet takes every free later one that may continue its end, which then
    is its end; passes repeat until one takes nothing. What is one sequence's
    is one group: a row for a track and the pairs.
    """
    spans = observations.groupBy(*TRACK).agg(F.min("frame_id").alias("first_frame")).select(F.col("seq_id").alias("span_seq"), "track_id", "first_frame")

    def run(key, pair: pd.DataFrame, span: pd.DataFrame) -> pd.DataFrame:
        chains = [[t] for t in span.sort_values(["first_frame", "track_id"]).track_id.tolist()]
        after: dict[int, list[int]] = {}
        for a, b in zip(pair.a, pair.b, strict=True):
            after.setdefault(a, []).append(b)
        changed = True
        while changed:
            changed, taken = False, set()
            place = {chain[0]: k for k, chain in enumerate(chains)}
            for k, chain in enumerate(chains):
                at = k
                while k not in taken and (later := [p for b in after.get(chain[-1], []) if (p := place.get(b, -1)) > at and p not in taken]):
                    at = min(later)
                    chain += chains[at]
                    taken.add(at)
                    changed = True
            chains = [c for k, c in enumerate(chains) if k not in taken]
        return pd.DataFrame([(key[0], t, chain[0]) for chain in chains for t in chain], columns=["seq_id", "track_id", "new_id"])

    return pairs.groupBy("seq_id").cogroup(spans.groupBy("span_seq")).applyInPandas(run, "seq_id string, track_id int, new_id int")


def merge_by_frame(observations: DataFrame, mapping: DataFrame) -> DataFrame:
    """Observations under their new ids; those of one frame become one: weighted mean center, joint bounds."""
    rows = observations.join(mapping, TRACK)
    mean = lambda a: (F.sum(F.col(f"c{a}") * F.col("n_points")) / F.sum("n_points")).alias(f"c{a}")
    bounds = [f(f"{n}_{a}").alias(f"{n}_{a}") for a in AXES for f, n in ((F.min, "min"), (F.max, "max"))]
    return rows.groupBy("seq_id", F.col("new_id").alias("track_id"), "frame_id").agg(F.sum("n_points").alias("n_points"), *[mean(a) for a in AXES], *bounds, F.array_sort(F.collect_set(rows["track_id"])).alias("source_track_ids"))


def lead_choice(observations: DataFrame, axis: str = "y", ahead_by: float = 0.25) -> DataFrame:
    """(seq_id, a, b, lead): the one ahead in the direction of motion, else the longer, the denser, the lower id."""
    rows = articulated_metrics(observations, axis=axis)
    dense = observations.groupBy(*TRACK).agg(F.sum("n_points").alias("points"))
    rows = rows.join(dense.withColumnsRenamed({"track_id": "a", "points": "pa"}), ["seq_id", "a"]).join(dense.withColumnsRenamed({"track_id": "b", "points": "pb"}), ["seq_id", "b"])
    lead = F.when(F.col("ahead_median") > ahead_by, F.col("a")).when(F.col("ahead_median") < -ahead_by, F.col("b")).when(F.col("a_length") > F.col("b_length"), F.col("a")).when(F.col("a_length") < F.col("b_length"), F.col("b"))
    return rows.select("seq_id", "a", "b", lead.when(F.col("pa") > F.col("pb"), F.col("a")).when(F.col("pa") < F.col("pb"), F.col("b")).otherwise(F.least("a", "b")).alias("lead"))
