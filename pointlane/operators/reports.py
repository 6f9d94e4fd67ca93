"""Exports, replay event tables and benchmark reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stem(kind: str, id_: str) -> Column:
    """Zero-padded file stem, such as track_0007."""
    return F.format_string(f"{kind}_%04d", F.col(id_))


def debug_rows(states: DataFrame) -> DataFrame:
    """One JSON text per frame with its track states in order."""
    row = F.struct("track_id", "status", "age", "missed")
    return states.groupBy("seq_id", "frame_id").agg(F.to_json(F.struct(F.col("frame_id"), F.array_sort(F.collect_list(row)).alias("tracks"))).alias("json")).select("seq_id", "frame_id", "json")


def json_rows(rows: DataFrame, key: list[str]) -> DataFrame:
    """(key, json) of each row, columns in order of name, nulls left out."""
    return rows.select(*key, F.to_json(F.struct(*sorted(rows.columns))).alias("json"))


def outcome_windows(outcomes: DataFrame, frames: int = 20) -> DataFrame:
    """Each outcome's event on the ``frames`` playback indices from its last active one."""
    return outcomes.withColumn("playback", F.explode(F.sequence(F.col("last_index"), F.col("last_index") + frames - 1)))


def save_windows(saved: DataFrame, last_playback: int, frames: int = 20) -> DataFrame:
    """Windows of saved tracks, cut at the last playback frame."""
    return saved.withColumn("playback", F.explode(F.sequence(F.col("last_index"), F.least(F.col("last_index") + frames - 1, F.lit(last_playback)))))


def link_windows(links: DataFrame, frames: int = 20) -> DataFrame:
    """A link of two tracks is shown from its first to its last shared frame, its outcome for ``frames`` more; by (lead, rear).

    ``links``: seq_id, lead, rear, start, end (frames).
    """
    both = F.sequence(F.col("start"), F.col("end") + frames - 1)
    rows = links.withColumn("playback", F.explode(both))
    return rows.withColumn("kind", F.when(F.col("playback") < F.col("end"), "active").otherwise("outcome"))


def visible(states: DataFrame, saved: DataFrame) -> DataFrame:
    """Active states of saved tracks."""
    return states.where(F.col("status").isin("spawned", "matched", "missed")).join(saved, ["seq_id", "track_id"], "left_semi")


def trajectory_tail(states: DataFrame, at: int, most: int) -> DataFrame:
    """Per track the last ``most`` centers of the unbroken run of frames that ends at ``at``; repeats within 1e-6 left out."""
    track = Window.partitionBy("seq_id", "track_id").orderBy("frame_id")
    rows = states.where((F.col("frame_id") <= at) & F.col("status").isin("spawned", "matched", "missed"))
    rows = rows.withColumn("island", F.col("frame_id") - F.row_number().over(track))
    rows = rows.withColumn("current", F.max("island").over(Window.partitionBy("seq_id", "track_id"))).withColumn("end", F.max("frame_id").over(Window.partitionBy("seq_id", "track_id")))
    rows = rows.where((F.col("island") == F.col("current")) & (F.col("end") == at))
    move = sum((F.abs(F.col(c) - F.lag(c).over(track)) for c in ("cx", "cy", "cz")), F.lit(0.0))
    rows = rows.withColumn("move", move).where("move IS NULL OR move > 1e-6")
    back = F.row_number().over(Window.partitionBy("seq_id", "track_id").orderBy(F.desc("frame_id")))
    return rows.withColumn("back", back).where(F.col("back") <= most).drop("island", "current", "end", "move", "back")


def visual_subsample(points: DataFrame, most: int, seed: int = 42) -> DataFrame:
    """``most`` points of each frame by a seeded hash of the id."""
    order = Window.partitionBy("seq_id", "frame_index").orderBy(F.xxhash64(F.lit(seed), "point_id"), "point_id")
    return points.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= most).drop("__n")


def grayscale(points: DataFrame, group: list[str]) -> DataFrame:
    """``gray`` in 0..1: log of intensity stretched between its 5 and 95 % marks."""
    rows = points.withColumn("__log", F.log1p(F.greatest("intensity", F.lit(0.0))))
    marks = rows.groupBy(*group).agg(F.percentile("__log", F.lit(0.05)).alias("__low"), F.percentile("__log", F.lit(0.95)).alias("__high"))
    share = (F.col("__log") - F.col("__low")) / F.greatest(F.col("__high") - F.col("__low"), F.lit(1e-9))
    return rows.join(marks, group).withColumn("gray", F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))).drop("__log", "__low", "__high")


def hud(metrics: DataFrame) -> DataFrame:
    """A line of text per frame."""
    return metrics.withColumn("line", F.format_string("frame %d: matched %d, missed %d, spawned %d", "frame_id", "matched", "missed", "spawned"))


#: The gate of each status, as readers of the results look for it.
REASONS = {"saved": "saved", "skipped_min_hits": "min_hits", "skipped_track_exit": "track_exit", "empty_selection": "empty_selection", "skipped_min_saved_points": "min_saved_points", "skipped_quality_threshold": "quality_threshold"}


def reason(status: Column) -> Column:
    """The code of a decision; a status without one is its own."""
    table = F.create_map(*[F.lit(x) for pair in REASONS.items() for x in pair])
    return F.coalesce(F.element_at(table, status), status)


def track_rows(tracks: DataFrame, observations: DataFrame, quality: DataFrame, results: DataFrame, chosen: DataFrame, links: DataFrame) -> DataFrame:
    """A wide row for each track: its frames and last center, quality and its parts, what was decided and why, the frames fused, and its role in a long vehicle.

    Columns of steps that a track never reached are null; ``results``' map of metrics, if it has one, is ``aggregation_metrics``.
    """
    key = ["seq_id", "track_id"]
    seen = observations.groupBy(*key).agg(F.sort_array(F.collect_set("frame_id")).alias("frame_ids"), F.max_by(F.array("cx", "cy", "cz"), "frame_id").alias("last_center"))
    parts = [c for c in quality.columns if c not in (*key, "quality_score")]
    scored = quality.select(*key, "quality_score", F.struct(*parts).alias("quality_metrics"))
    said = results.select(*key, F.col("status").alias("aggregate_status"), F.col("stage").alias("decision_stage"), reason(F.col("status")).alias("decision_reason_code"), F.col("summary").alias("decision_summary"), F.col("n_points").alias("aggregate_points"), *[F.col("metrics").alias("aggregation_metrics")] * ("metrics" in results.columns))
    used = chosen.groupBy(*key).agg(F.sort_array(F.collect_set("frame_id")).alias("selected_frame_ids"))
    linked = links.groupBy(*key).agg(F.first("group_kind").alias("object_kind"), F.max("component_track_ids").alias("articulated_component_track_ids"), F.array_sort(F.collect_set("role")).alias("long_vehicle_component_roles"))
    own = tracks.select(*key, "hit_count", "age", "missed", "ended_by_missed", F.col("last_frame").alias("last_frame_id"), F.struct("spawned_count", "matched_count", "missed_count").alias("tracker_debug_summary"))
    rows = own
    for more in (seen, scored, said, used, linked):
        rows = rows.join(more, key, "left")
    return rows.withColumn("status", F.coalesce("aggregate_status", F.lit("missing_result")))


def merge_events(links: DataFrame, observations: DataFrame) -> DataFrame:
    """One row a linked pair (seq_id, lead, rear, group_kind, gap_mean, start, end): the frames both were seen in, null where none."""
    pairs = links.where("role = 'lead'").select("seq_id", F.col("track_id").alias("lead"), F.col("partner_id").alias("rear"), "group_kind", "gap_mean")
    frames = lambda name: observations.select("seq_id", F.col("track_id").alias(name), "frame_id")
    both = pairs.join(frames("lead"), ["seq_id", "lead"]).join(frames("rear"), ["seq_id", "rear", "frame_id"])
    met = both.groupBy("seq_id", "lead", "rear").agg(F.min("frame_id").alias("start"), F.max("frame_id").alias("end"))
    return pairs.join(met, ["seq_id", "lead", "rear"], "left")


# Benchmarks: a row per run with context columns and measures.

#: Orders of leaderboards, each a list of measures with a minus where most comes first.
ORDERS = {
    "overall": ("-saved", "-quality_mean", "-registration_accept_rate", "total_wall_seconds"),
    "long_vehicles": ("-mean_length_saved", "mean_component_count_saved", "-saved", "total_wall_seconds"),
    "fastest": ("total_wall_seconds",),
    "most_compute": ("-compute_wall_seconds", "-total_cpu_seconds"),
    "most_memory": ("-peak_rss_mb",),
}


def order(name: str, context: list[str]) -> list[Column]:
    """Sort keys of a leaderboard; a missing measure counts as 0, ties go by context."""
    keys = [(m.lstrip("-"), m.startswith("-")) for m in ORDERS[name]]
    value = lambda m: F.coalesce(F.col(m).cast("double"), F.lit(0.0))
    return [*[-value(m) if down else value(m) for m, down in keys], *[F.col(c) for c in context]]


def median_rows(runs: DataFrame, context: list[str]) -> DataFrame:
    """Per context the median of every measure and the largest memory."""
    measures = [c for c, t in runs.dtypes if c not in (*context, "run_index", "peak_rss_mb") and t in ("int", "bigint", "double", "float")]
    return runs.groupBy(*context).agg(*[F.percentile(c, F.lit(0.5)).alias(c) for c in measures], F.max("peak_rss_mb").alias("peak_rss_mb"), F.count("*").alias("runs"))


def run_aggregates(runs: DataFrame, context: list[str], measure: str) -> DataFrame:
    """Median, least and most of a measure per context, and the representative run: nearest to the median, then the first."""
    mid = runs.groupBy(*context).agg(F.percentile(measure, F.lit(0.5)).alias("median"), F.min(measure).alias("least"), F.max(measure).alias("most"), F.avg(measure).alias("mean"), F.percentile(measure, F.lit(0.9)).alias("p90"), F.count("*").alias("runs"))
    rows = runs.join(mid, context)
    return rows.groupBy(*context, "median", "least", "most", "mean", "p90", "runs").agg(F.min_by("run_index", F.struct(F.abs(F.col(measure) - F.col("median")), "run_index")).alias("representative"))


def leaderboard(rows: DataFrame, by: list[Column]) -> DataFrame:
    """``place`` from 1 in the given order; the rows are contexts, few by nature."""
    return rows.withColumn("place", F.row_number().over(Window.orderBy(*by)))


def component_medians(rows: DataFrame, component: str, measure: str) -> DataFrame:
    return rows.groupBy(F.lit(component).alias("component"), F.col(component).alias("value")).agg(F.percentile(measure, F.lit(0.5)).alias("median"), F.count("*").alias("n"))


def matched_comparisons(rows: DataFrame, component: str, context: list[str], measure: str) -> DataFrame:
    """Contexts that differ in ``component`` alone: its values' medians where it has two values at least."""
    rest = [c for c in context if c != component]
    several = rows.groupBy(*rest).agg(F.countDistinct(component).alias("n")).where("n >= 2").drop("n")
    return rows.join(several, rest, "left_semi").groupBy(*rest, component).agg(F.percentile(measure, F.lit(0.5)).alias("median"))
