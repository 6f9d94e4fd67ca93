"""Assignment by components and the write-back of matches and predictions."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from pointlane.operators import association, evaluate


def best_total(cost, feasible):
    """(most pairs, least cost) over all one-to-one matchings, by trying them."""
    n, m = cost.shape
    best = (0, 0.0)
    for k in range(1, min(n, m) + 1):
        for rows in itertools.combinations(range(n), k):
            for cols in itertools.permutations(range(m), k):
                if all(feasible[r, c] for r, c in zip(rows, cols, strict=True)):
                    total = sum(cost[r, c] for r, c in zip(rows, cols, strict=True))
                    if k > best[0] or total < best[1]:
                        best = (k, total)
    return best


def test_assignment_by_components(spark):
    rng = np.random.default_rng(0)
    rows, want = [], {}
    for frame in range(12):
        n, m = rng.integers(1, 6, 2)
        cost, feasible = np.round(rng.uniform(1, 2, (n, m)), 3), rng.random((n, m)) < 0.5
        rows += [(frame, int(r), int(c), float(cost[r, c])) for r, c in zip(*np.nonzero(feasible), strict=True)]
        want[frame] = (best_total(cost, feasible), association.greedy(cost, feasible))
    pairs = spark.createDataFrame(rows, "frame int, left_id int, right_id int, cost double")
    for method in ("hungarian", "greedy"):
        got = association.assign(pairs, ["frame"], method).toPandas()
        for frame, (best, greedy) in want.items():
            own = got[got.frame == frame]
            assert own.left_id.is_unique and own.right_id.is_unique
            if method == "greedy":
                assert sorted(zip(own.left_id, own.right_id, strict=True)) == sorted(greedy)
            else:
                assert len(own) == best[0] and abs(own.cost.sum() - best[1]) < 1e-9


def test_assignment_of_many_rows_with_a_gate(spark):
    """30,000 by 30,000 rows in one group: a dense matrix would hold 7 GB; by components every row finds its own."""
    left = spark.range(30_000).select(F.lit(1).alias("frame"), F.col("id").alias("left_id"), F.explode(F.sequence(F.lit(0), (F.col("id") % 3 < 2).cast("int"))).alias("k"))
    pairs = left.select("frame", "left_id", (F.col("left_id") + F.col("k")).alias("right_id"), (F.col("k") + 0.5).alias("cost"))
    got = association.assign(pairs, ["frame"])
    assert got.count() == 30_000 and got.where("left_id <> right_id").count() == 0
    assert association.assign(pairs.limit(0), ["frame"]).count() == 0


RESULT = "seq_id string, track_id int, status string, merged_target_track_id int, metrics map<string,string>"


def test_annotation_clears_stale_keys(spark):
    results = spark.createDataFrame([("s", 1, "saved", None, {"gt_unmatched_reason": "x", "a": "1"}), ("s", 2, "saved", None, {"gt_obj_class": "bus", "gt_obj_class_score": "1.0"}), ("s", 3, "skipped_min_hits", None, None), ("s", 4, "saved", None, {"b": "2"})], RESULT)
    matches = spark.createDataFrame([("s", 1, 7, 5, "matched"), ("s", 2, None, None, "unmatched_track"), ("s", None, 9, None, "unmatched_gt"), ("s", 3, 8, 0, "matched")], "seq_id string, track_id int, object_id int, delta_ns long, status string")
    labels = spark.createDataFrame([("s", 7, 100, 3, "", None), ("s", 8, 1, 1, "car", 0.5), ("s", 9, 1, 1, "car", 0.5)], "seq_id string, object_id int, timestamp_ns long, frame_index int, obj_class string, obj_class_score double")
    got = {r.track_id: r.metrics for r in evaluate.annotate_ground_truth(results, matches, labels).collect()}
    fixed = {"gt_match_mode": "timestamp_only", "gt_match_assignment": "one_to_one"}
    assert got[1] == fixed | {"a": "1", "gt_matched": "true", "gt_object_id": "7", "gt_timestamp_ns": "100", "gt_timestamp_delta_ns": "5", "gt_frame_index": "3"}
    assert got[2] == fixed | {"gt_matched": "false", "gt_unmatched_reason": "unmatched_no_gt_available"}
    assert got[3] is None and got[4] == {"b": "2"}


def test_predictions_reach_merged_members(spark):
    results = spark.createDataFrame([("s", 1, "saved", None, {"predicted_class_score": "0.1", "a": "1"}), ("s", 2, evaluate.MERGED, 1, None), ("s", 3, evaluate.MERGED, 8, None), ("s", 4, "skipped_track_exit", None, None)], RESULT)
    cloud = "seq_id string, track_id int, x double, y double, z double"
    clouds = spark.createDataFrame([("s", 1, 0.0, 0.0, 0.0), ("s", 2, 0.0, 0.0, 0.0), ("s", 4, 0.0, 0.0, 0.0)], cloud)
    candidates = spark.createDataFrame([("s", t, 5.0, 0.0, 0.0) for t in (1, 2, 4, 4)], cloud)
    sources = sorted((r.track_id, r.point_source, r.x) for r in evaluate.classification_points(clouds, candidates, results).collect())
    assert sources == [(1, "result_points", 0.0), (4, "candidate_points_world", 5.0), (4, "candidate_points_world", 5.0)]
    said = spark.createDataFrame([("s", 1, " Auto", None, None, "result_points", 9)], "seq_id string, track_id int, class string, class_id int, score double, point_source string, n_points long")
    got = {r.track_id: r.metrics for r in evaluate.write_predictions(results, said, "m", {"auto": "car"}).collect()}
    own = {"predicted_class_name": "car", "classification_backend": "m", "classification_input_point_count": "9"}
    assert got == {1: own | {"a": "1", "classification_point_source": "result_points"}, 2: own | {"classification_point_source": "merged_target_track"}, 3: None, 4: None}
