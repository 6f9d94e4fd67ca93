"""Runs that write artifacts, replay tables, and benchmarks over presets; with stage timings.

    python -m pointlane.plans.runner run -c preset.yaml -i frames/ -o runs/
    python -m pointlane.plans.runner replay -c preset.yaml -i frames/ -o runs/
    python -m pointlane.plans.runner benchmark -c manifest.yaml -o benchmarks/
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime
import json
import logging
import os
import resource
import subprocess
import sys
import tempfile
import time
from collections import Counter
from contextlib import contextmanager
from typing import Protocol

import yaml

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import crop, evaluate, fusion, reports, tracking
from ..sources import frames, objects, sinks
from . import config, pipeline, published

log = logging.getLogger("pointlane")


class PointReader(Protocol):
    """Anything that gives the flat ``points`` table."""

    def __call__(self, spark: SparkSession, paths: list[str]) -> DataFrame: ...


#: Readers by format name; a closed set, like the other components in ``config``.
READERS: dict[str, PointReader] = {"frames": frames.read_points, "parquet": lambda spark, paths: spark.read.parquet(*paths)}


class Profile:
    """Wall and CPU seconds of the driver by stage, and the process's largest memory."""

    def __init__(self) -> None:
        self.stages: dict[str, tuple[float, float]] = {}

    @contextmanager
    def stage(self, name: str):
        wall, cpu = time.perf_counter(), time.process_time()
        yield
        before = self.stages.get(name, (0.0, 0.0))
        self.stages[name] = (before[0] + time.perf_counter() - wall, before[1] + time.process_time() - cpu)

    def summary(self, n_frames: int) -> dict:
        total = sum(w for w, _ in self.stages.values())
        out = {f"{k}_wall_seconds": round(w, 6) for k, (w, _) in self.stages.items()} | {f"{k}_cpu_seconds": round(c, 6) for k, (_, c) in self.stages.items()}
        cpu, rest = sum(c for _, c in self.stages.values()), sum(w for k, (w, _) in self.stages.items() if k != "write")
        out |= {"total_cpu_seconds": round(cpu, 6), "compute_wall_seconds": round(rest, 6)}
        return out | {"total_wall_seconds": round(total, 6), "frames_per_second": round(n_frames / total, 6) if total > 0 else 0.0, "peak_rss_mb": resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024}


def read(spark: SparkSession, kind: str, paths: list[str]) -> DataFrame:
    if kind not in READERS:
        raise config.ConfigError(f"unknown input format {kind!r}; known: {', '.join(READERS)}")
    return READERS[kind](spark, paths)


def plain(value):
    """Dataclasses as maps and tuples as lists, which YAML holds."""
    if dataclasses.is_dataclass(value):
        return {f.name: plain(getattr(value, f.name)) for f in dataclasses.fields(value)}
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    return [plain(v) for v in value] if isinstance(value, (tuple, list)) else value


def run(
    spark: SparkSession, spec: config.Spec, points: DataFrame, out: str, classifier: evaluate.Classifier = evaluate.by_size, frames: DataFrame | None = None,
    labels: DataFrame | None = None, aliases: dict[str, str] | None = None, intensity: bool = True,
) -> dict:
    """Write a run's tables and artifacts under ``out``; every table is written once, and each is built from those before it as they were written. Gives the summary row.

    ``labels``: labelled objects (seq_id, object_id, timestamp_ns, frame_index,
    obj_class, obj_class_score, point_count, points, row_id, ...). With them
    come the object list, the matches and the annotated metrics.
    """
    profile, used = Profile(), Counter()
    track = ["seq_id", "track_id"]

    def keep(name: str, rows: DataFrame) -> DataFrame:
        # Steps inside an operator come as often as their rounds do.
        used[name] += 1
        path = f"{out}/{name}.parquet" if used[name] == 1 else f"{out}/rounds/{name}-{used[name]}.parquet"
        with profile.stage(name):
            rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    spark.createDataFrame([(yaml.safe_dump(plain(spec), sort_keys=False),)], "value string").write.text(f"{out}/config_snapshot")
    done = pipeline.run(points, spec, frames, keep=keep)
    chosen = spark.read.parquet(f"{out}/chosen.parquet")
    results = done["results"].withColumn("metrics", F.create_map().cast("map<string,string>"))
    results = results if "merged_target_track_id" in results.columns else results.withColumn("merged_target_track_id", F.lit(None).cast("int"))
    saved = results.where("status = 'saved'").select(*track)
    clouds = done["clouds"].join(saved, track, "left_semi")
    with profile.stage("classify"):
        classes = evaluate.classify(clouds, classifier)
        classes.write.parquet(f"{out}/classes.parquet")
        classes = spark.read.schema(classes.schema).parquet(f"{out}/classes.parquet")
    said = classes.select(*track, "class", F.lit(None).cast("long").alias("class_id"), "score", F.lit("result_points").alias("point_source")).join(clouds.groupBy(*track).agg(F.count("*").alias("n_points")), track)
    results = evaluate.write_predictions(results, said, getattr(classifier, "__name__", "classifier"), aliases)
    with profile.stage("write"):
        if labels is not None:
            results = write_ground_truth(labels, results, done["observations"], saved, f"{out}", aliases)
        results = keep("annotated", results)
        sinks.write_clouds(clouds, f"{out}/clouds", intensity=intensity)
        objects.write_clouds(clouds, results, chosen, f"{out}/aggregates")
        sinks.write_json_lines(reports.track_rows(done["tracks"], done["observations"], done["quality"], results, chosen, done["links"]), f"{out}/tracks")
        sinks.write_json_lines(evaluate.track_outcomes(done["tracks"], results.select(*track, "status", "stage", "summary", "n_points"), tracking.last_active(done["states"])), f"{out}/track_outcomes")
        sinks.write_json_lines(reports.debug_rows(done["states"]), f"{out}/tracker_debug")
        sinks.write_json_lines(reports.merge_events(done["links"], done["observations"]), f"{out}/merge_events")
        known = F.col("metrics")
        kinds = results.where("status = 'saved'").select(known["predicted_class_name"].alias("predicted"), evaluate.normalise_class(known["gt_obj_class"], aliases or {}).alias("actual"), F.coalesce(known["gt_matched"].cast("boolean"), F.lit(False)).alias("matched"))
        sinks.write_json_lines(evaluate.class_statistics(kinds), f"{out}/class_stats")
    n = points.select("seq_id", "frame_index").distinct().count()
    counts = results.agg(F.count("*").alias("tracks"), F.count_if(F.col("status") == "saved").alias("saved"), F.avg(F.when(F.col("status") == "saved", F.col("quality_score"))).alias("quality")).first()
    size = fusion.dimensions(clouds, spec.axis).agg(F.avg("length").alias("length")).first()["length"]
    parts = done["links"].select("seq_id", "group_id", F.size("component_track_ids").alias("n")).distinct().agg(F.avg("n").alias("n")).first()["n"]
    tried = accepted = 0
    if spec.accumulator == "registration_voxel_fusion":
        tried = chosen.select(*track, "frame_id").distinct().count()
        accepted = spark.read.parquet(f"{out}/registered.parquet").select(*track, "frame_id").distinct().count()
    row = {"frames": n, "tracks": counts["tracks"], "saved": counts["saved"], "save_rate": counts["saved"] / counts["tracks"] if counts["tracks"] else 0.0}
    row |= {"quality_mean": float(counts["quality"] or 0.0), "mean_length_saved": float(size or 0.0), "mean_component_count_saved": float(parts or 0.0), "registration_accept_rate": accepted / tried if tried else 0.0}
    row |= profile.summary(n)
    spark.createDataFrame([row]).write.json(f"{out}/summary")
    return row


def write_ground_truth(labels: DataFrame, results: DataFrame, observations: DataFrame, saved: DataFrame, out: str, aliases: dict[str, str] | None = None) -> DataFrame:
    """The object list, matches, what stays unmatched on both sides, and their summary; gives ``results`` with its metrics annotated."""
    latest = crop.latest_labels(labels)
    objects.write_labels(latest, f"{out}/object_list")
    matches = evaluate.match_ground_truth(evaluate.last_timestamp(observations).join(saved, ["seq_id", "track_id"], "left_semi"), latest)
    matches.write.parquet(f"{out}/gt_matching/all.parquet")
    matches = observations.sparkSession.read.schema(matches.schema).parquet(f"{out}/gt_matching/all.parquet")
    for status, name in (("matched", "matches"), ("unmatched_track", "unmatched_saved_tracks"), ("unmatched_gt", "unmatched_gt_objects")):
        sinks.write_json_lines(matches.where(F.col("status") == status), f"{out}/gt_matching/{name}")
    sinks.write_json_lines(evaluate.match_summary(matches), f"{out}/gt_matching/summary")
    named = latest.withColumn("obj_class", evaluate.normalise_class(F.col("obj_class"), aliases or {}))
    return evaluate.annotate_ground_truth(results, matches, named)


def replay(points: DataFrame, spec: config.Spec, out: str) -> None:
    """The event tables that a viewer would show: active states, outcome windows, merge events and their windows, trajectory tails, HUD lines."""
    tables = pipeline.run(points, spec)
    states, observations = tables["states"], tables["observations"]
    last = tracking.last_active(states).withColumnRenamed("frame_id", "last_index")
    merges = reports.merge_events(tables["links"], observations)
    end = observations.agg(F.max("frame_id")).first()[0] or 0
    for name, rows in {
        "active": reports.visible(states, tables["results"].where("status = 'saved'").select("seq_id", "track_id")), "outcomes": reports.outcome_windows(tables["results"].join(last.select("seq_id", "track_id", "last_index"), ["seq_id", "track_id"])),
        "merge_events": merges, "merge_windows": reports.link_windows(merges.where("start IS NOT NULL")), "tails": reports.trajectory_tail(states, end, 20), "hud": reports.hud(tracking.frame_metrics(states)),
    }.items():
        rows.write.parquet(f"{out}/{name}.parquet")


def benchmark(spark: SparkSession, sequences: dict[str, DataFrame], presets: dict[str, config.Spec], out: str, warmup: int = 1, measure: int = 1) -> DataFrame:
    """Rows of measured runs of every sequence and preset, and reports beside them."""
    rows = []
    for sequence, points in sequences.items():
        for preset, spec in presets.items():
            for k in range(warmup + measure):
                row = run(spark, spec, points, f"{out}/{sequence}/{preset}/{k}")
                if k >= warmup:
                    rows.append(described(sequence, preset, spec, k - warmup) | row)
    return report(spark, rows, out)


def described(sequence: str, preset: str, spec: config.Spec, index: int) -> dict:
    return {"sequence": sequence, "preset": preset, "clusterer": spec.clusterer, "tracker": spec.tracker.algorithm, "accumulator": spec.accumulator, "run_index": index}


def benchmark_apart(plan: published.Manifest, form: str, out: str) -> list[dict]:
    """Rows of measured runs, each in a process and session of its own, so that none finds another's caches or compiled plans."""
    rows = []
    for sequence, source in plan.sequences.items():
        for preset, path in plan.presets.items():
            for k in range(plan.warmup + plan.measure):
                into = f"{out}/{sequence}/{preset}/{f'warmup_{k + 1:02d}' if k < plan.warmup else f'measure_{k - plan.warmup + 1:02d}'}"
                summary = os.path.join(tempfile.mkdtemp(prefix="pointlane-run-"), "summary.json")
                command = [sys.executable, "-m", "pointlane.plans.runner", "run", "-c", path, "-i", source, "-f", form, "--into", into, "--summary", summary]
                done = subprocess.run(command, cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), capture_output=True, text=True, check=False)
                if done.returncode:
                    raise RuntimeError(f"{preset} on {sequence}, run {k}: {done.stderr[-2000:]}")
                with open(summary, encoding="utf-8") as file:
                    row = json.load(file)
                if k >= plan.warmup:
                    rows.append(described(sequence, preset, load_preset(path).spec, k - plan.warmup) | row | {"run_dir": into})
    return rows


def report(spark: SparkSession, rows: list[dict], out: str) -> DataFrame:
    """The measured runs as a table, with leaderboards and medians by component beside it; gives the aggregates of total time."""
    runs = spark.createDataFrame(rows)
    sinks.write_csv(runs, f"{out}/runs")
    summary = reports.run_aggregates(runs, ["sequence", "preset"], "total_wall_seconds")
    context = ["sequence", "preset"]
    sinks.write_csv(reports.leaderboard(summary, [F.col("median"), F.col("preset")]), f"{out}/leaderboard")
    medians = reports.median_rows(runs, context)
    for name in reports.ORDERS:
        sinks.write_csv(reports.leaderboard(medians, reports.order(name, context)), f"{out}/leaderboard_{name}")
    for component in ("clusterer", "tracker", "accumulator"):
        sinks.write_csv(reports.component_medians(runs, component, "total_wall_seconds"), f"{out}/by_{component}")
    return summary


def load_preset(path: str) -> published.Preset:
    """A preset by its published names or by the fields of ``Spec``."""
    raw = config.load(path)
    return published.bind(raw, os.path.dirname(os.path.abspath(path))) if published.is_published(raw) else published.Preset(config.spec(raw), intensity=True)


def support_path(name: str, config_path: str) -> str:
    """A file named in a configuration: beside it, in the folder above, or in the working folder; the first that is there."""
    here = os.path.dirname(os.path.abspath(config_path))
    for folder in (here, os.path.dirname(here), os.getcwd()):
        if os.path.exists(os.path.join(folder, name)):
            return os.path.join(folder, name)
    raise config.ConfigError(f"{name} is in none of the folders of {config_path}")


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("command", choices=("run", "replay", "benchmark"))
    parser.add_argument("-c", "--config", required=True)
    parser.add_argument("-i", "--input", nargs="*", default=[])
    parser.add_argument("-f", "--format", default="frames")
    parser.add_argument("--into", help="the very folder of one run")
    parser.add_argument("--summary", help="a local file for the summary of one run")
    parser.add_argument("-o", "--output", help="left out: the folder that the configuration names")
    given = parser.parse_args(args)
    logging.basicConfig(level=logging.INFO)
    session = SparkSession.builder.appName("pointlane").getOrCreate
    folder, stamp = os.path.dirname(os.path.abspath(given.config)), f"{datetime.datetime.now():%Y%m%d_%H%M%S}"
    if given.command == "benchmark":
        raw = config.read(given.config)
        if isinstance(raw.get("sequences"), dict):
            spark, out = session(), f"{given.output}/{stamp}"
            inputs = {k: read(spark, given.format, [support_path(p, given.config) for p in v]) for k, v in raw["sequences"].items()}
            presets = {p: load_preset(support_path(p, given.config)).spec for p in raw["presets"]}
            benchmark(spark, inputs, presets, out, raw.get("warmup_runs", 1), raw.get("measure_runs", 1))
        else:
            plan = published.manifest(raw, folder)
            published.present(tuple(plan.sequences.values()))
            out = f"{given.output or published.beside(plan.root, folder)}/{stamp}_{plan.name}"
            # No session here while runs have theirs.
            rows = benchmark_apart(plan, given.format, out)
            report(session(), rows, out)
    else:
        spark, preset = session(), load_preset(given.config)
        spec, paths = preset.spec, list(published.present(tuple(given.input) or preset.paths))
        out = given.into or f"{given.output or published.beside(preset.root, folder)}/{stamp}_{spec.tracker.algorithm}_{spec.accumulator}"
        points = read(spark, given.format, paths)
        if given.command == "run":
            labels = frames.read_sequence_labels(spark, paths) if given.format == "frames" else None
            row = run(spark, spec, points, out, labels=labels, aliases=preset.aliases, intensity=preset.intensity)
            log.info("%s", row)
            if given.summary:
                with open(given.summary, "w", encoding="utf-8") as file:
                    json.dump(row, file)
        else:
            replay(points, spec, out)
    log.info("written to %s", out)


if __name__ == "__main__":
    main()
