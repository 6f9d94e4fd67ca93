"""Published presets and manifests, the object list, and the artifacts of a run."""

import json
import math
import os

import numpy as np
import pytest
import yaml
from pyspark.sql import Row

from pointlane.functions.geometry import Box
from pointlane.operators import reports, selection
from pointlane.plans import config, published, runner
from pointlane.sources import objects

BASE = """
input: {paths: [../data/a.pb], format: a42_pb}
preprocessing: {lane_box: [2.0, -2.0, 4.0, 35.0, 0.1, 4.8], bootstrap_frames: 3}
clustering: {algorithm: dbscan, eps: 0.9, min_points: 8, sensor_range_max: 120.0}
tracking: {algorithm: kalman_nn, max_dist: 7.5, min_track_hits: 6, fragment_child_max_age: 6}
aggregation: {enable_post_filter_stat_outlier_removal: false, registration_backend: icp_point_to_plane, fusion_weight_mode: quality}
class_normalization: {enabled: true, aliases: {PKW: CAR}}
output: {root_dir: runs, track_exit_edge_margin: 5}
visualization: {enabled: true, max_points: 10}
"""
LONG = """
clustering: {algorithm: range_image_connected_components, sensor_neighbor_cols: 3, sensor_ground_row_ignore: 2}
aggregation: {algorithm: weighted_voxel_fusion, long_vehicle_mode: true, shape_consistency_filter: true, enable_confidence_point_cap: true, frame_selection_method: length_coverage}
postprocessing: {enable_trajectory_smoothing: true, enable_articulated_vehicle_merge: true, enable_co_moving_track_merge: true, parallel_merge_max_lateral_offset: 0.9}
stray_key: 1
"""


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "configs").mkdir(), (tmp_path / "data").mkdir()
    (tmp_path / "configs" / "base.yaml").write_text(BASE)
    (tmp_path / "configs" / "long.yaml").write_text(LONG)
    (tmp_path / "configs" / "bench.yaml").write_text("name: two\nsequences: [../data/a.pb]\npresets: [base.yaml, long.yaml]\nmeasure_runs: 3\n")
    return tmp_path


def test_preset_binds_over_its_base(folder):
    got = published.preset(str(folder / "configs" / "long.yaml"))
    spec = got.spec
    assert spec.box.bounds("x") == (-2.0, 2.0) and spec.box.bounds("z") == (0.1, 4.8)
    assert (spec.clusterer, spec.eps, spec.neighbour_cols, spec.ground_rows, spec.range_max) == ("range_image_connected_components", 0.9, 3, 2, 120.0)
    assert (spec.tracker.algorithm, spec.tracker.max_dist, spec.tracker.max_missed, spec.min_track_hits) == ("kalman_nn", 7.5, 12, 6)
    assert spec.post == ("articulated_vehicle_merge", "co_moving_track_merge", "trajectory_smoothing") and spec.merge_lateral == 0.9 and spec.smoothing_window == 3
    assert (spec.accumulator, spec.weights, spec.shape_ratio, spec.cap_points, spec.outlier_neighbours, spec.long_vehicles) == ("weighted_voxel_fusion", "quality", 2.0, 2048, 0, True)
    assert spec.quality_window and spec.tail_bridge and spec.exit_margin == 5 and spec.registration.backend == "icp_point_to_plane"
    assert got.paths == (str(folder / "data" / "a.pb"),) and got.aliases == {"PKW": "CAR"} and got.root == "runs"


def test_silent_preset_takes_published_defaults():
    spec = published.bind({"preprocessing": {"lane_box": [0, 1, 0, 1, 0, 1]}}).spec
    assert (spec.eps, spec.min_track_hits, spec.min_saved_points, spec.shape_ratio, spec.cap_points, spec.outlier_neighbours) == (1.15, 4, 180, 0.0, 0, 12)
    assert (spec.quality_window, spec.tail_bridge, spec.smoothing_window, spec.registration.backend, spec.post) == (True, True, 3, "small_gicp", ())


@pytest.mark.parametrize(
    ("section", "key", "value"),
    [
        ("preprocessing", "lane_box", [1, 2]), ("preprocessing", "bootstrap_frames", -1), ("clustering", "algorithm", "nope"), ("clustering", "nope", 1), ("clustering", "sensor_range_max", -1.0),
        ("clustering", "plane_ransac_n", 4), ("tracking", "algorithm", "nope"), ("tracking", "min_track_hits", 0), ("aggregation", "algorithm", "nope"), ("aggregation", "frame_selection_method", "nope"),
        ("aggregation", "registration_backend", "nope"), ("aggregation", "fusion_weight_mode", "nope"), ("aggregation", "top_k_frames", 0), ("aggregation", "symmetry_completion", 1), ("aggregation", "long_vehicle_length_threshold", 0),
        ("aggregation", "chunk_min_points_ratio_to_peak", 1.5), ("aggregation", "length_coverage_bins", 1), ("aggregation", "top_k_frames", "ten"), ("postprocessing", "smoothing_window", 0), ("postprocessing", "articulated_min_overlap_ratio", -0.1),
        ("classification", "enabled", True), ("classification", "backend", "nope"), ("class_normalization", "aliases", {" ": "x"}), ("class_normalization", "aliases", ["x"]), ("input", "format", "nope"), ("visualization", "show_tracker_debug", "yes"),
    ],
)
def test_bad_values_are_errors(section, key, value):
    raw = {"preprocessing": {"lane_box": [0, 1, 0, 1, 0, 1]}}
    raw[section] = raw.get(section, {}) | {key: value}
    with pytest.raises(config.ConfigError):
        published.bind(raw)


def test_manifest(folder):
    path = folder / "configs" / "bench.yaml"
    got = published.manifest(yaml.safe_load(path.read_text()), str(folder / "configs"))
    assert got.sequences == {"a": str(folder / "data" / "a.pb")} and list(got.presets) == ["base", "long"] and (got.name, got.warmup, got.measure) == ("two", 1, 3)
    for bad in ({"presets": ["a.yaml"]}, {"sequences": ["a.pb"]}, {"sequences": ["a.pb"], "presets": ["a.yaml"], "measure_runs": 0}, {"sequences": ["a.pb", "x/a.pb"], "presets": ["a.yaml"]}, {"nope": 1}):
        with pytest.raises(config.ConfigError):
            published.manifest(bad)
    with pytest.raises(config.ConfigError):
        published.present(got.sequences.values())
    (folder / "data" / "a.pb").write_bytes(b"")
    assert published.present(tuple(got.sequences.values()))


def listed(spark, path):
    return sorted((json.loads(r["value"]) for r in spark.read.text(f"{path}/manifest").collect()), key=lambda r: r["pcd_path"])


def test_object_list(spark, tmp_path):
    rows = [Row(seq_id="s", stem=f"object_{k:04d}", points=[(float(k), 0.0, float(j)) for j in range(k)], object_id=k, obj_class=None if k == 2 else "car") for k in range(5)]
    schema = "seq_id string, stem string, points array<struct<x:double,y:double,z:double>>, object_id int, obj_class string"
    out = str(tmp_path / "list")
    objects.write_objects(spark.createDataFrame(rows, schema).repartition(3), out)
    got = listed(spark, out)
    assert [(r["object_id"], r["pcd_path"], r["point_count"]) for r in got] == [(k, f"s/object_{k:04d}.pcd", k) for k in range(5)]
    for r in got:
        assert f"POINTS {r['point_count']}\n" in open(f"{out}/{r['pcd_path']}").read()
    assert os.listdir(f"{out}/_pending") == []
    empty = str(tmp_path / "none")
    objects.write_objects(spark.createDataFrame([], schema), empty)
    assert os.listdir(f"{empty}/manifest") == []


def test_a_failed_task_leaves_no_row(spark, tmp_path):
    from pyspark.sql import functions as F

    out = str(tmp_path / "list")
    rows = spark.range(8).repartition(4).select(F.format_string("object_%04d", "id").alias("stem"), F.array(F.struct(F.lit(1.0).alias("x"), F.lit(1.0).alias("y"), F.lit(1.0).alias("z"))).alias("points"), F.when(F.col("id") == 5, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("id").cast("int")).alias("object_id"))
    with pytest.raises(Exception, match="lost"):
        objects.write_objects(rows, out)
    # Tasks that outlive the job may write pending parts after it: they never become rows.
    assert not os.path.exists(f"{out}/manifest")
    whole = spark.range(3).select(F.format_string("object_%04d", "id").alias("stem"), F.array(F.struct(F.lit(1.0).alias("x"), F.lit(1.0).alias("y"), F.lit(1.0).alias("z"))).alias("points"), F.col("id").cast("int").alias("object_id"))
    objects.write_objects(whole, out)
    assert [r["object_id"] for r in listed(spark, out)] == [0, 1, 2]


def test_coverage_adds_bins_and_tails(spark):
    rows = [("s", t, f, 10 + (f == 4), 0.0, float(2 * f), 0.0, -1.0, 2.0 * f - 1 - (f == 7), 0.0, 1.0, 2.0 * f + 1, 1.0) for t in (1, 2) for f in range(9)]
    seen = spark.createDataFrame(rows, "seq_id string, track_id int, frame_id int, n_points int, cx double, cy double, cz double, min_x double, min_y double, min_z double, max_x double, max_y double, max_z double")
    tails = selection.tail_candidates(seen).select("seq_id", "track_id", "frame_id")
    long = seen.where("track_id = 1").select("seq_id", "track_id").distinct()
    got = selection.with_coverage(seen.where("frame_id = 8"), seen, long, tails).collect()
    # First of each third (4 has the most points), the furthest rear (7) and its runner-up (0).
    assert sorted(r["frame_id"] for r in got if r["track_id"] == 1) == [0, 4, 6, 7, 8]
    assert [r["frame_id"] for r in got if r["track_id"] == 2] == [8]
    assert set(got[0].asDict()) == set(seen.columns)


def test_orders_of_leaderboards(spark):
    rows = spark.createDataFrame([("a", 3, 0.5, 0.9, 5.0, 1.0, 7.0), ("b", 3, 0.5, 0.9, 4.0, 2.0, 9.0), ("c", 4, 0.1, None, 9.0, 3.0, 8.0), ("d", 3, 0.6, 0.0, 1.0, 2.0, 1.0)], "preset string, saved int, quality_mean double, registration_accept_rate double, total_wall_seconds double, mean_length_saved double, peak_rss_mb double")
    rows = rows.selectExpr("*", "0.0 mean_component_count_saved", "total_wall_seconds compute_wall_seconds", "1.0 total_cpu_seconds")
    first = lambda name: [r["preset"] for r in reports.leaderboard(rows, reports.order(name, ["preset"])).orderBy("place").collect()]
    assert first("overall") == ["c", "d", "b", "a"] and first("long_vehicles") == ["c", "d", "b", "a"]
    assert first("fastest") == ["d", "b", "a", "c"] and first("most_compute") == ["c", "a", "b", "d"] and first("most_memory") == ["b", "c", "a", "d"]


def test_merge_events(spark):
    links = spark.createDataFrame([("s", 1, 1, "articulated", "lead", 2, 0.5, [1, 2]), ("s", 2, 1, "articulated", "rear", 1, 0.5, [1, 2]), ("s", 3, 3, "fragment", "lead", 4, None, [3, 4]), ("s", 4, 3, "fragment", "fragment", 3, None, [3, 4])], "seq_id string, track_id int, group_id int, group_kind string, role string, partner_id int, gap_mean double, component_track_ids array<int>")
    seen = spark.createDataFrame([("s", t, f) for t, frames in ((1, range(5)), (2, range(2, 9)), (3, range(3)), (4, range(3, 6))) for f in frames], "seq_id string, track_id int, frame_id int")
    got = {(r["lead"], r["rear"]): (r["start"], r["end"]) for r in reports.merge_events(links, seen).collect()}
    assert got == {(1, 2): (2, 4), (3, 4): (None, None)}


def test_run_with_labels_writes_every_artifact(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [("s", f, f * 10**8, "a", f * 100 + k, *map(float, (rng.uniform(0, 1.8), 30 - f + rng.uniform(0, 4), rng.uniform(0, 1.5))), 1.0, 0, 0, 1.0) for f in range(6) for k in range(60)]
    points = spark.createDataFrame(rows, "seq_id string, frame_index int, frame_timestamp_ns long, sensor_name string, point_id long, x double, y double, z double, intensity double, row_index int, col_index int, range double")
    spec = config.Spec(box=Box((-5, 5), (0, 45), (0, 5)), min_points=3, vehicle_min_points=5, eps=1.5, require_exit=False, min_saved_points=10, outlier_ratio=9.0, long_vehicles=True, long_length=2.0, quality_window=True)
    label = lambda k, ts, n: ("s", k, ts, ts // 10**8, "roof", "PKW", 0.5, n, "a.pb", k, [(1.0, 2.0, 3.0)] * n)
    labels = spark.createDataFrame([label(7, 5 * 10**8, 2), label(8, 10**8, 1), label(9, 10**8, 0)], "seq_id string, object_id int, timestamp_ns long, frame_index long, sensor_name string, obj_class string, obj_class_score double, point_count int, source_path string, row_id long, points array<struct<x:double,y:double,z:double>>")
    out = str(tmp_path / "run")
    row = runner.run(spark, spec, points, out, labels=labels, aliases={"pkw": "CAR"})
    assert row["saved"] == 1 and row["quality_mean"] > 0 and row["mean_length_saved"] > 3
    snapshot = "\n".join(r["value"] for r in spark.read.option("wholetext", "true").text(f"{out}/config_snapshot").collect())
    again = config.spec(yaml.safe_load(snapshot))
    assert again == spec and math.isinf(again.range_max)
    assert [(r["object_id"], r["pcd_path"], r["point_count"]) for r in listed(spark, f"{out}/object_list")] == [(7, "s/object_0007.pcd", 2), (8, "s/object_0008.pcd", 1)]
    (cloud,) = listed(spark, f"{out}/aggregates")
    assert cloud["status"] == "saved" and cloud["selected_frame_ids"] and cloud["point_count"] > 10
    first = lambda name: json.loads(spark.read.text(f"{out}/{name}").first()["value"])
    assert (first("gt_matching/matches")["object_id"], first("gt_matching/unmatched_gt_objects")["object_id"]) == (7, 8)
    track = first("tracks")
    assert track["frame_ids"] == list(range(6)) and track["decision_reason_code"] == "saved" and track["selected_frame_ids"] == cloud["selected_frame_ids"] and track["quality_metrics"]["observation_count"] == 6
    assert track["aggregation_metrics"]["gt_obj_class"] == "CAR" and track["aggregation_metrics"]["gt_object_id"] == "7" and "predicted_class_name" in track["aggregation_metrics"]
    stats = {json.loads(r["value"])["class"]: json.loads(r["value"]) for r in spark.read.text(f"{out}/class_stats").collect()}
    assert stats["TOTAL"]["predicted_count"] == 1 and stats["CAR"]["gt_count"] == 1


def test_manifest_runs_each_preset_in_a_process_of_its_own(spark, folder):
    rng = np.random.default_rng(6)
    rows = [("s", f, f * 10**8, "a", f * 100 + k, *map(float, (rng.uniform(0, 1.8), 25 - f + rng.uniform(0, 4), rng.uniform(0.2, 1.5))), 1.0, 0, 0, 20.0) for f in range(6) for k in range(60)]
    spark.createDataFrame(rows, "seq_id string, frame_index int, frame_timestamp_ns long, sensor_name string, point_id long, x double, y double, z double, intensity double, row_index int, col_index int, range double").write.parquet(str(folder / "data" / "a.pb"))
    plan = published.Manifest({"a": str(folder / "data" / "a.pb")}, {"base": str(folder / "configs" / "base.yaml")}, warmup=0, measure=1)
    rows = runner.benchmark_apart(plan, "parquet", str(folder / "out"))
    assert len(rows) == 1 and rows[0]["frames"] == 6 and rows[0]["clusterer"] == "dbscan" and rows[0]["run_dir"].endswith("a/base/measure_01")
    assert spark.read.json(f"{rows[0]['run_dir']}/summary").first()["frames"] == 6
    runner.report(spark, rows, str(folder / "report"))
    assert spark.read.option("header", "true").csv(str(folder / "report" / "leaderboard_overall")).first()["place"] == "1"
