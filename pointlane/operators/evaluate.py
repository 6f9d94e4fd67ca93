"""Classification, ground-truth matching and class statistics over saved tracks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .association import hungarian

TRACK = ["seq_id", "track_id"]


def last_timestamp(observations: DataFrame) -> DataFrame:
    """Per track its last frame's timestamp, or without one its last frame id."""
    return observations.groupBy(*TRACK).agg(F.max("frame_id").alias("last_frame"), F.max_by("ts_ns", "frame_id").alias("ts")).withColumn("last_ns", F.coalesce("ts", F.col("last_frame").cast("long"))).drop("ts")


def candidate_costs(tracks: DataFrame, labels: DataFrame) -> DataFrame:
    """Time difference in ns and difference of frames of every saved track and label of a sequence.

    Both sides are one row per object of a sequence. The differences are whole
    numbers, so nothing is lost at the size of epoch nanoseconds.
    """
    t = tracks.select("seq_id", "track_id", "last_ns", "last_frame")
    g = labels.select("seq_id", "object_id", F.col("timestamp_ns"), F.col("frame_index"))
    return t.join(g, "seq_id").select("seq_id", "track_id", "object_id", F.abs(F.col("last_ns") - F.col("timestamp_ns")).alias("delta_ns"), F.abs(F.col("last_frame") - F.col("frame_index")).alias("delta_frame"))


def match_ground_truth(tracks: DataFrame, labels: DataFrame) -> DataFrame:
    """One-to-one matches of least total time difference; ties by frames, then lower id to lower id; unmatched rows of both sides follow."""
    out = "seq_id string, track_id int, object_id int, delta_ns long, status string"
    rows = candidate_costs(tracks, labels)
    rows = rows.withColumn("t", F.dense_rank().over(Window.partitionBy("seq_id").orderBy("track_id")) - 1).withColumn("g", F.dense_rank().over(Window.partitionBy("seq_id").orderBy("object_id")) - 1)

    def run(key, pairs: pd.DataFrame) -> pd.DataFrame:
        n, m = int(pairs.t.max()) + 1, int(pairs.g.max()) + 1
        cost = np.zeros((n, m))
        # Time in steps of its own greatest common divisor; frames and ranks count only where times tie.
        step = max(1, int(np.gcd.reduce(pairs.delta_ns.to_numpy())))
        top = float(pairs.delta_frame.max()) + 1
        worth = pairs.delta_ns / step + (pairs.delta_frame + (pairs.t - pairs.g).abs() / (n + m)) / (top * 4 * (n + m))
        cost[pairs.t, pairs.g] = worth
        by = {(a, b): (t, g, d) for a, b, t, g, d in zip(pairs.t, pairs.g, pairs.track_id, pairs.object_id, pairs.delta_ns, strict=True)}
        return pd.DataFrame([(key[0], *by[p], "matched") for p in hungarian(cost, np.ones((n, m), bool))], columns=["seq_id", "track_id", "object_id", "delta_ns", "status"])

    matched = rows.groupBy("seq_id").applyInPandas(run, out)
    lone_t = tracks.join(matched, TRACK, "left_anti").select("seq_id", F.col("track_id").cast("int").alias("track_id"), F.lit(None).cast("int").alias("object_id"), F.lit(None).cast("long").alias("delta_ns"), F.lit("unmatched_track").alias("status"))
    lone_g = labels.join(matched, ["seq_id", "object_id"], "left_anti").select("seq_id", F.lit(None).cast("int").alias("track_id"), F.col("object_id").cast("int").alias("object_id"), F.lit(None).cast("long").alias("delta_ns"), F.lit("unmatched_gt").alias("status"))
    return matched.unionByName(lone_t).unionByName(lone_g)


def match_summary(matches: DataFrame) -> DataFrame:
    return matches.groupBy("seq_id").agg(
        F.count_if(F.col("status") == "matched").alias("matched"), F.count_if(F.col("status") == "unmatched_track").alias("unmatched_tracks"), F.count_if(F.col("status") == "unmatched_gt").alias("unmatched_gt"),
        F.avg("delta_ns").alias("mean_delta_ns"), F.max("delta_ns").alias("max_delta_ns"),
    )


def normalise_class(name: Column, aliases: dict[str, str]) -> Column:
    """Trimmed; known aliases, case folded, take their class; others stay."""
    bare = F.trim(name)
    if not aliases:
        return bare
    table = F.create_map(*[F.lit(x) for k, v in aliases.items() for x in (k.strip().lower(), v)])
    return F.coalesce(F.element_at(table, F.lower(bare)), bare)


def class_statistics(rows: DataFrame, total: str = "TOTAL") -> DataFrame:
    """Per class, and in a TOTAL row: predictions, ground truth, matched pairs, and agreement.

    ``rows``: predicted, actual (either may be null), matched. Two groupings
    joined outer; the total comes from a rollup.
    """
    said = rows.where("predicted IS NOT NULL").rollup("predicted").agg(F.count("*").alias("predicted_count"), F.count_if("matched").alias("matched_count"), F.count_if(F.col("matched") & (F.col("predicted") == F.col("actual"))).alias("agree"))
    true = rows.where("actual IS NOT NULL").rollup("actual").agg(F.count("*").alias("gt_count"))
    said, true = said.select(F.coalesce("predicted", F.lit(total)).alias("class"), "predicted_count", "matched_count", "agree"), true.select(F.coalesce("actual", F.lit(total)).alias("class"), "gt_count")
    both = said.join(true, "class", "full_outer").na.fill(0)
    return both.withColumn("mismatch", F.col("matched_count") - F.col("agree"))


def farthest_points(p: np.ndarray, n: int) -> np.ndarray:
    """Positions of n points, each furthest from those before; the first furthest from the centroid. Fewer points repeat."""
    if len(p) <= n:
        return np.resize(np.arange(len(p)), n)
    at = int(((p - p.mean(0)) ** 2).sum(1).argmax())
    chosen, far = [at], np.full(len(p), np.inf)
    for _ in range(n - 1):
        far = np.minimum(far, ((p - p[chosen[-1]]) ** 2).sum(1))
        chosen.append(int(far.argmax()))
    return np.array(chosen)


def stratified_points(p: np.ndarray, n: int, bins: int = 8) -> np.ndarray:
    """Farthest points within even bins of the longest axis, an even quota each, the rest over all."""
    if len(p) <= n:
        return farthest_points(p, n)
    axis = int(np.ptp(p, 0).argmax())
    span = max(np.ptp(p[:, axis]), 1e-9)
    bin_ = np.minimum(((p[:, axis] - p[:, axis].min()) / span * bins).astype(int), bins - 1)
    chosen: list[int] = []
    for b in range(bins):
        own = np.flatnonzero(bin_ == b)
        if len(own):
            chosen += own[farthest_points(p[own], min(len(own), n // bins))].tolist() if n // bins else []
    rest = np.setdiff1d(np.arange(len(p)), chosen)
    if len(chosen) < n:
        chosen += rest[farthest_points(p[rest], n - len(chosen))].tolist()
    return np.array(chosen[:n])


def prepare_cloud(p: np.ndarray, n: int = 1024) -> np.ndarray:
    """Centered on the centroid and resampled to n points."""
    centred = p - p.mean(0)
    return centred[stratified_points(centred, n)]


#: A classifier takes a prepared cloud and gives (class, score).
Classifier = Callable[[np.ndarray], tuple[str, float]]


def by_size(p: np.ndarray, scale: float = 1.0) -> tuple[str, float]:
    """A geometric stand-in for a trained network: classes by length of the cloud in metres."""
    length = float(np.ptp(p, 0).max()) / scale
    name = "truck" if length >= 6.5 else "car" if length >= 2.5 else "bicycle"
    return name, float(1 / (1 + np.exp(-abs(length - (6.5 if length >= 4.5 else 2.5)))))


def classify(cloud: DataFrame, classifier: Classifier = by_size, points: int = 1024) -> DataFrame:
    """(seq_id, track_id, class, score) by a model applied to each track's cloud."""

    def run(key, track: pd.DataFrame) -> pd.DataFrame:
        name, score = classifier(prepare_cloud(track[["x", "y", "z"]].to_numpy(float), points))
        return pd.DataFrame([(*key, name, score)], columns=["seq_id", "track_id", "class", "score"])

    return cloud.groupBy(*TRACK).applyInPandas(run, "seq_id string, track_id int, class string, score double")


#: Keys of annotated metrics: fixed values, as readers of the results look for them.
GT_KEYS = ("gt_match_mode", "gt_match_assignment", "gt_matched", "gt_object_id", "gt_timestamp_ns", "gt_timestamp_delta_ns", "gt_frame_index", "gt_obj_class", "gt_obj_class_score", "gt_unmatched_reason")
PREDICTION_KEYS = ("predicted_class_id", "predicted_class_name", "predicted_class_score", "classification_backend", "classification_point_source", "classification_input_point_count")
MERGED = "merged_into_long_vehicle_group"


def merged_metrics(values: dict[str, Column], stale: tuple[str, ...] = ()) -> Column:
    """The map ``metrics`` with ``values`` written over it; keys of null values that are in ``stale`` go, others stay as they were."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in values.items()])
    new = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    old = F.coalesce("metrics", F.create_map().cast("map<string,string>"))
    away = F.array(*[F.lit(k) for k in stale]) if stale else F.array().cast("array<string>")
    kept = F.map_filter(old, lambda k, _: ~F.array_contains(away, k) & ~F.map_contains_key(new, k))
    return F.map_concat(kept, new)


def annotate_ground_truth(results: DataFrame, matches: DataFrame, labels: DataFrame) -> DataFrame:
    """``results`` with ground truth in the map ``metrics`` of saved tracks.

    ``matches``: as ``match_ground_truth`` gives them; ``labels``: seq_id,
    object_id, timestamp_ns, frame_index, and obj_class, obj_class_score, which
    may be null. A matched track loses the reason it had for being unmatched,
    an unmatched one the class it had; a track without a row in ``matches``
    stays as it is.
    """
    own = matches.where("track_id IS NOT NULL").select("seq_id", "track_id", F.col("object_id").alias("gt_id"), "delta_ns", (F.col("status") == "matched").alias("hit"))
    truth = labels.select("seq_id", F.col("object_id").alias("gt_id"), F.col("timestamp_ns").alias("gt_ns"), F.col("frame_index").alias("gt_frame"), F.nullif("obj_class", F.lit("")).alias("gt_class"), F.col("obj_class_score").alias("gt_score"))
    rows = results.join(own.join(truth, ["seq_id", "gt_id"], "left"), TRACK, "left")
    hit = F.coalesce("hit", F.lit(False))
    only = lambda c: F.when(hit, F.col(c))
    values = {
        "gt_match_mode": F.lit("timestamp_only"), "gt_match_assignment": F.lit("one_to_one"), "gt_matched": hit, "gt_object_id": only("gt_id"), "gt_timestamp_ns": only("gt_ns"), "gt_timestamp_delta_ns": only("delta_ns"),
        "gt_frame_index": only("gt_frame"), "gt_obj_class": only("gt_class"), "gt_obj_class_score": only("gt_score"), "gt_unmatched_reason": F.when(~hit, "unmatched_no_gt_available"),
    }
    annotated = merged_metrics(values, ("gt_obj_class", "gt_obj_class_score", "gt_unmatched_reason"))
    use = (F.col("status") == "saved") & F.col("hit").isNotNull()
    return rows.select(*[F.when(use, annotated).otherwise(F.col("metrics")).alias(c) if c == "metrics" else results[c] for c in results.columns])


def classification_points(clouds: DataFrame, candidates: DataFrame, results: DataFrame) -> DataFrame:
    """(seq_id, track_id, x, y, z, point_source) of tracks that aren't merged into another: the saved cloud's points, else the candidate's."""
    open_ = results.where(F.col("status") != MERGED).select(*TRACK, (F.col("status") == "saved").alias("saved"))
    own = clouds.join(open_.where("saved").select(*TRACK), TRACK, "left_semi").select(*TRACK, "x", "y", "z", F.lit("result_points").alias("point_source"))
    has = own.select(*TRACK).distinct()
    rest = candidates.join(open_.select(*TRACK), TRACK, "left_semi").join(has, TRACK, "left_anti")
    return own.unionByName(rest.select(*TRACK, "x", "y", "z", F.lit("candidate_points_world").alias("point_source")))


def write_predictions(results: DataFrame, predictions: DataFrame, backend: str, aliases: dict[str, str] | None = None) -> DataFrame:
    """``results`` with predictions in the map ``metrics``; members of merged vehicles get their target's.

    ``predictions``: seq_id, track_id, class, and class_id, score (may be null),
    point_source and n_points. A null class id or score takes the old one away.
    """
    said = predictions.select("seq_id", F.col("track_id").alias("of"), F.col("class_id").cast("long").alias("p_id"), normalise_class(F.col("class"), aliases or {}).alias("p_class"), F.col("score").alias("p_score"), F.col("point_source").alias("p_source"), F.col("n_points").alias("p_points"))
    merged = (F.col("status") == MERGED) & F.col("merged_target_track_id").isNotNull()
    rows = results.withColumn("of", F.when(merged, F.col("merged_target_track_id")).otherwise(F.col("track_id"))).join(said, ["seq_id", "of"], "left")
    values = {
        "predicted_class_id": F.col("p_id"), "predicted_class_name": F.col("p_class"), "predicted_class_score": F.col("p_score"), "classification_backend": F.lit(backend),
        "classification_point_source": F.when(merged, "merged_target_track").otherwise(F.col("p_source")), "classification_input_point_count": F.col("p_points"),
    }
    written = merged_metrics(values, ("predicted_class_id", "predicted_class_score"))
    return rows.select(*[F.when(F.col("p_class").isNotNull(), written).otherwise(F.col("metrics")).alias(c) if c == "metrics" else results[c] for c in results.columns])


def track_outcomes(tracks: DataFrame, results: DataFrame, last: DataFrame) -> DataFrame:
    """A row per track with its result and last active state; without a result, status ``missing_result``."""
    rows = tracks.join(results, TRACK, "left").join(last, TRACK, "left")
    return rows.withColumn("status", F.coalesce("status", F.lit("missing_result")))
