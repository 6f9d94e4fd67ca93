"""Operators on small clouds with known results, and properties."""

import itertools
import json
import struct
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pointlane.functions.geometry import Box, axis_name, other_axes
from pointlane.operators import association, clustering, crop, evaluate, fusion, postprocess, registration, selection, tiles, tracking
from pointlane.plans import config
from pointlane.plans.pipeline import run
from pointlane.sources import frames, sinks

OBS = "seq_id string, track_id int, frame_id int, ts_ns long, n_points long, cx double, cy double, cz double, min_x double, min_y double, min_z double, max_x double, max_y double, max_z double"


def observations(spark, rows):
    """rows: (track, frame, center, half extents, points)."""
    out = []
    for t, f, c, h, n in rows:
        low, high = [a - b for a, b in zip(c, h, strict=True)], [a + b for a, b in zip(c, h, strict=True)]
        out.append(("s", t, f, f * 100_000_000, n, *map(float, c), *map(float, low), *map(float, high)))
    return spark.createDataFrame(out, OBS)


def cloud(rng, center, n, spread):
    return rng.normal(center, spread, (n, 3))


def picked(df):
    return sorted(r["frame_id"] for r in df.collect())


def test_box_and_axes(spark):
    points = spark.createDataFrame([(0.0, 0.0, 1.0), (2.0, 0.0, 1.0), (0.0, 1.0, -1.0), (1.0, 2.0, 2.0)], "x double, y double, z double")
    assert [tuple(r) for r in crop.lane_crop(points, Box((1, -1), (-2, 2), (0, 2))).collect()] == [(0, 0, 1), (1, 2, 2)]
    assert axis_name("Q") == "y" and axis_name(7) == "z" and other_axes("y") == ("x", "z")


def frame_of(spark, p):
    return spark.createDataFrame([("s", 0, i, *map(float, x)) for i, x in enumerate(p)], "seq_id string, frame_index int, point_id long, x double, y double, z double")


def labels_of(rows):
    return np.array([r.label for r in rows.orderBy("point_id").collect()])


def local_labels(p, eps, least):
    """Clusters by their least core point, noise -1."""
    owner = tiles.density_clusters(p, eps, least)[1]
    return np.where(owner < 0, -1, np.searchsorted(np.unique(owner[owner >= 0]), owner))


def test_clusterers_find_two_objects_and_the_ground(spark):
    rng = np.random.default_rng(4)
    two = np.vstack([cloud(rng, (0, 0, 1), 30, 0.03), cloud(rng, (1.5, 1.5, 1.1), 30, 0.03)])
    frame = frame_of(spark, two)
    for labels in (local_labels(two, 0.5, 5), local_labels(two, 0.5, 1), labels_of(clustering.cluster_dbscan(frame, 0.5, 5)), labels_of(clustering.cluster_euclidean(frame, 0.5)), labels_of(clustering.cluster_voxels(frame, 0.25)), clustering.hdbscan(two, 10, 5)):
        assert set(labels[:30]) == {0} and set(labels[30:]) == {1}
    noise = local_labels(np.vstack([two, [[9, 9, 9]]]), 0.5, 5)
    assert noise[-1] == -1
    x, y = np.meshgrid(np.linspace(-1, 1, 12), np.linspace(0, 3, 12))
    flat = np.vstack([np.column_stack([x.ravel(), y.ravel(), np.zeros(144)]), cloud(rng, (0.2, 1.5, 1), 40, 0.03)])
    planes = clustering.ground_planes(frame_of(spark, flat), 0.1, 60)
    plane = planes.first()
    inside = np.array([r.ground for r in clustering.without_ground(frame_of(spark, flat), planes, 0.1).orderBy("point_id").collect()])
    assert abs(plane.nz) > 0.9 and inside[:144].all() and not inside[144:].any()


def test_hierarchy_in_memory_of_the_places(spark):
    rng = np.random.default_rng(5)
    p = np.vstack([cloud(rng, (4 * k, 0, 0), 1000, 0.3) for k in range(5)])
    tracemalloc.start()
    labels = clustering.hdbscan(p, 300, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6  # a matrix of their distances has 200 MB
    assert set(labels) - {-1} == set(range(5))
    assert all(set(labels[1000 * k : 1000 * (k + 1)]) <= {-1, k} for k in range(5))
    # Points of one place: a row stands for as many as there are; the few of a place stay rows.
    p = rng.integers(0, 6, (60, 3)).astype(float)
    p = np.vstack([p, np.repeat(p[:12], 9, 0), p[12:20]])[rng.permutation(176)]
    assert (labels_of(clustering.cluster_hdbscan(frame_of(spark, p), 8, 4)) == clustering.hdbscan(p, 8, 4)).all()
    found = clustering.cluster_hdbscan(frame_of(spark, np.vstack([p, [[float("nan"), 0, 0]]])), 8, 4)
    assert labels_of(found)[-1] == -1 and found.count() == 177


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 60))
def test_euclidean_clusters_are_the_components(seed, n):
    p = np.random.default_rng(seed).uniform(0, 3, (n, 3))
    near = ((p[:, None] - p[None]) ** 2).sum(2) <= 0.6**2
    label = np.arange(n)
    for _ in range(n):
        label = np.where(near, label[None], n).min(1)
    assert (local_labels(p, 0.6, 1) == np.unique(label, return_inverse=True)[1]).all()


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 5), st.integers(1, 5))
def test_hungarian_is_optimal_and_never_worse_than_greedy(seed, n, m):
    rng = np.random.default_rng(seed)
    cost = rng.uniform(0, 10, (n, m))
    full = np.ones((n, m), bool)
    total = lambda pairs: sum(cost[p] for p in pairs)
    best = min(sum(cost[r, c] for r, c in zip(rows, cols, strict=True)) for rows in itertools.combinations(range(n), min(n, m)) for cols in itertools.permutations(range(m), min(n, m)))
    assert abs(total(association.hungarian(cost, full)) - best) < 1e-9 and best <= total(association.greedy(cost, full)) + 1e-9
    gate = cost <= 4
    assert all(gate[p] for p in association.hungarian(cost, gate)) and len(association.hungarian(cost, gate)) >= len(association.greedy(cost, gate))


def test_greedy_and_hungarian_differ_where_known():
    cost = np.array([[1.9, 3, 6], [0.1, 1, 4], [3.1, 2, 1]])
    ok = cost <= 3.4
    assert sum(cost[p] for p in association.hungarian(cost, ok)) <= sum(cost[p] for p in association.greedy(cost, ok))


def test_scalar_kalman_equals_the_matrix_filter(spark):
    rng = np.random.default_rng(3)
    z = np.cumsum(rng.normal(1, 0.3, 30))
    frames_ = [k for k in range(30) if k not in (7, 8, 19)]
    rows = observations(spark, [(1, k, (0, z[k], 0), (1, 1, 1), 5) for k in frames_])
    got = tracking.kalman_fold(rows, 5.0, 0.08, 0.6).first()
    f, q, h = np.array([[1.0, 1], [0, 1]]), 0.08 * np.eye(2), np.array([[1.0, 0]])
    x, p = np.array([z[0], 0]), 5.0 * np.eye(2)
    for k in range(1, 30):
        x, p = f @ x, f @ p @ f.T + q
        if k in frames_:
            g = p @ h.T / (h @ p @ h.T + 0.6)
            x, p = x + (g * (z[k] - x[0])).ravel(), (np.eye(2) - g @ h) @ p
    assert abs(got["x"] - x[0]) < 1e-9 and abs(got["v"] - x[1]) < 1e-9


def test_tracker_misses_ends_and_respawns():
    tracker = tracking.Tracker(tracking.TrackerConfig("kalman_nn", max_missed=2))
    one = np.array([[0.0, 0, 0]])
    states = []
    for k, centers in enumerate([one, one + 1, np.zeros((0, 3)), np.zeros((0, 3)), np.zeros((0, 3)), one + 5]):
        rows, _ = tracker.step(k, centers, np.ones((len(centers), 3)))
        states.append([(r[0], r[2]) for r in rows])
    assert states == [[(1, "spawned")], [(1, "matched")], [(1, "missed")], [(1, "missed")], [(1, "ended")], [(2, "spawned")]]
    rows, _ = tracker.step(6, one + 50, np.ones((1, 3)), np.array([True]))
    assert rows[-1][2] == "suppressed" and tracker.finish()[0][0] == 2
    with pytest.raises(ValueError):
        tracking.TrackerConfig("none")


def test_streaming_tracker_equals_batch(spark, tmp_path):
    from pointlane.streaming.tracker import track_stream

    rng = np.random.default_rng(1)
    rows = [("s", f, d + 1, *map(float, (3 * d + rng.normal(0, 0.05), 0.5 * f, 0)), 1.0, 1.0, 1.0) for f in range(12) for d in range(3) if (f + d) % 5]
    schema = "seq_id string, frame_index int, detection_id int, cx double, cy double, cz double, ex double, ey double, ez double"
    for k in range(3):
        spark.createDataFrame([r for r in rows if r[1] // 4 == k], schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        stream = track_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in")), tracking.TrackerConfig())
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).toPandas()
    batch = spark.createDataFrame(rows, schema).withColumns({f"{n}_{a}": F.lit(0.0 if n == "min" else 1.0) for n in ("min", "max") for a in "xyz"})
    want = tracking.track(batch, tracking.TrackerConfig()).drop("detection_id").toPandas()[got.columns]
    key = ["frame_id", "track_id"]
    pd.testing.assert_frame_equal(got.sort_values(key).reset_index(drop=True), want.sort_values(key).reset_index(drop=True), check_dtype=False)


def test_selection_vectors(spark):
    h = (0.1, 0.1, 0.1)
    line = observations(spark, [(1, 10 + k, (0, y, 0), h, 8) for k, y in enumerate((1, 2, 3, 4))])
    assert picked(selection.line_touch_last_k(line, 4.0, 0.05, 2)) == [12, 13]
    motion = observations(spark, [(1, 10 + k, (0, y, 0), h, 8) for k, y in enumerate((1, 2, 5, 6, 10))])
    chosen = picked(selection.keyframe_motion(motion, 3))
    assert len(chosen) == 3 and {10, 14} <= set(chosen)
    spans = [(1, 2), (2, 4), (6, 9.5), (10, 14)]
    cover = observations(spark, [(1, 20 + k, (0, (a + b) / 2, 0), (0.1, (b - a) / 2, 0.1), 8) for k, (a, b) in enumerate(spans)])
    assert picked(selection.select(cover, "length_coverage", keep=3)) == [20, 22, 23]
    dense = observations(spark, [(1, 40 + k, (x, 0, 0), h, 8) for k, x in enumerate((0, 1, 10, 11, 20))])
    assert picked(selection.select(dense, "center_diversity", keep=3)) in ([40, 42, 44], [40, 43, 44])
    assert picked(selection.select(dense, "tail_coverage", keep=2, top_k=3))[0] >= 42
    assert picked(selection.select(dense, "auto")) == [40, 41, 42, 43, 44]
    shape = observations(spark, [(1, k, (0, 0, 0), (e / 2, 0, 0), 8) for k, e in ((1, 0.35), (2, 0.38), (3, 6.9))])
    assert picked(selection.shape_consistent(shape, 1.5)) == [1, 2]
    assert picked(selection.truncate_at_lane_end(line, 2.0, 0.15)) == [10, 11]


def test_fusion_vectors(spark):
    rows = [(0, 1.02, 0.0, 10.0, 0.4), (1, 0.02, 0.0, 1.0, 0.5), (2, 1.04, 0.02, 30.0, 0.6), (3, 0.06, 0.01, 3.0, 0.7)]
    frame = spark.createDataFrame([("s", 1, x, y, 0.0, i, c) for _, x, y, i, c in rows], "seq_id string, track_id int, x double, y double, z double, intensity double, confidence double")
    got = sorted((round(r["x"], 6), round(r["y"], 6), round(r["intensity"], 6), round(r["confidence"], 6)) for r in fusion.revoxelise(frame, 0.10).collect())
    assert got == [(0.04, 0.005, 2.0, 1.2), (1.03, 0.01, 20.0, 1.0)]
    chunk = "seq_id string, track_id int, frame_id int, x double, y double, z double, intensity double"
    points = [("s", 1, 0, 0.01, 0.0, 0.0, 1.0), ("s", 1, 0, 0.03, 0.0, 0.0, 3.0), ("s", 1, 1, 0.06, 0.0, 0.0, 8.0), ("s", 1, 1, 1.01, 0.0, 0.0, None)]
    fused = fusion.fuse(spark.createDataFrame(points, chunk), 0.1).orderBy("x").collect()
    assert [round(r["x"], 6) for r in fused] == [0.04, 1.01] and fused[0]["hits"] == 2 and fused[0]["intensity"] is None
    assert fusion.fuse(spark.createDataFrame(points, chunk), 0.1, least_chunks=2).count() == 1
    line = spark.createDataFrame([("s", 1, 0.0, 0.01 * k, 0.0, 1.0, 1.0) for k in range(40)] + [("s", 1, 5.0, 5.0, 5.0, 1.0, 1.0)], frame.schema)
    assert fusion.remove_outliers(line, 6, 2.0).count() == 40
    assert fusion.confidence_cap(line, 10, 4).count() == 10
    few = spark.createDataFrame([("s", 1, 0.0, float(k), 0.0, 1.0, c) for k, c in enumerate((9.0, 8.0, 1.0, 7.0))], frame.schema)
    assert sorted(r["confidence"] for r in fusion.confidence_cap(few, 2, 4).collect()) == [8.0, 9.0]


def test_exit_and_smoothing_and_merge(spark):
    tracks = spark.createDataFrame([("s", 1, False, 1), ("s", 2, False, 0), ("s", 3, True, 0)], "seq_id string, track_id int, ended_by_missed boolean, missed int")
    rows = observations(spark, [(1, 0, (0, 0.05, 0), (0, 0, 0), 5), (2, 0, (0, 0.05, 0), (0, 0, 0), 5), (3, 0, (0, 0.25, 0), (0, 0, 0), 5)])
    assert {r["track_id"]: r["exited"] for r in fusion.exited(rows, tracks, 0.0, 0.1).collect()} == {1: True, 2: False, 3: False}
    path = observations(spark, [(1, k, (0, y, 0), (0, 0, 0), 5) for k, y in enumerate((0, 3, 6, 3))])
    assert [r["cy"] for r in postprocess.smooth(path, 3).orderBy("frame_id").collect()] == [1.5, 3, 4, 4.5]
    near = observations(spark, [(t, k, (0.4 * t, k + 0.7 * t, 0), (0.1, 0.1, 0.1), 5) for t in (0, 1) for k in range(6)])
    assert postprocess.co_moving_pairs(near, 0.8, 4.0, 5, 0.6).count() == 1
    assert postprocess.co_moving_pairs(near.withColumn("cx", F.col("cx") * 4), 0.8, 4.0, 5, 0.6).count() == 0
    truck = observations(spark, [(21, k, (0, 10 + k, 0), (1, 1.7, 1), 9) for k in range(4)] + [(22, k, (0, 6.2 + k, 0), (1, 1.7, 1), 9) for k in range(4)])
    n = truck.groupBy("seq_id", "track_id").agg(F.count("*").alias("n"))
    decided = postprocess.articulated_decision(postprocess.articulated_metrics(truck), n)
    assert [tuple(r)[:3] for r in postprocess.best_partners(decided, truck).collect()] == [("s", 21, 22)]
    states = {r["track_id"]: r for r in postprocess.link_states(postprocess.best_partners(decided, truck), "articulated").collect()}
    assert states[22]["role"] == "rear" and states[22]["group_id"] == 21 and states[21]["component_track_ids"] == [21, 22]
    # Faster at the rear edge: the motion test rejects before the gap's.
    n_of = lambda rows: rows.groupBy("seq_id", "track_id").agg(F.count("*").alias("n"))
    reason = lambda rows: [r["reason"] for r in postprocess.articulated_decision(postprocess.articulated_metrics(rows), n_of(rows)).collect()]
    assert reason(truck) == ["tail_gap"]
    fast = observations(spark, [(21, k, (0, 10 + k, 0), (1, 1.7, 1), 9) for k in range(4)] + [(22, k, (0, 3 + 1.9 * k, 0), (1, 1.7, 1), 9) for k in range(4)])
    assert reason(fast) == ["motion"]
    still = observations(spark, [(21, k, (0, 10, 0), (1, 1.7, 1), 9) for k in range(4)] + [(22, k, (0, 6.2, 0), (1, 1.7, 1), 9) for k in range(4)])
    assert reason(still) == ["direction"]
    # Merges go on with what a track has become: 3 is near 2, not near 1.
    three = observations(spark, [(t, k, (0.5 * t, k, 0), (0.1, 0.1, 0.1), 5) for t in (1, 2, 3) for k in range(6)])
    got = dict(tuple(r)[1:] for r in postprocess.co_moving_merges(three, 0.8, 4.0, 5, 0.6).collect())
    assert got == {1: 1, 2: 1, 3: 1}
    far = observations(spark, [(t, k, (0.5 * t, k, 0), (0.1, 0.1, 0.1), 5) for t in (1, 3) for k in range(6)])
    assert dict(tuple(r)[1:] for r in postprocess.co_moving_merges(far, 0.8, 4.0, 5, 0.6).collect()) == {1: 1, 3: 3}


def test_contested_stitches(spark):
    """Each tracklet takes all that may go on from its end; against the definition in plain Python."""
    ends = {1: (0, 1, 0.0), 2: (0, 1, 0.1), 3: (2, 3, 0.0), 4: (2, 5, 0.1), 5: (4, 6, 0.05), 6: (6, 8, 0.1), 7: (7, 9, 5.0), 8: (9, 9, 0.1)}
    rows = observations(spark, [(t, f, (x, 0, 0), (1, 1, 1), 5) for t, (a, b, x) in ends.items() for f in (a, b)]).distinct()
    for near in ({(1, 3), (2, 3), (2, 4)}, {(a, b) for a in ends for b in ends if 0 < ends[b][0] - ends[a][1] <= 2 and abs(ends[a][2] - ends[b][2]) <= 1}):
        chains, changed = [[t] for t in sorted(ends, key=lambda t: (ends[t][0], t))], True
        while changed:
            changed, out, skip = False, [], set()
            for k, chain in enumerate(chains):
                if k in skip:
                    continue
                for later in range(k + 1, len(chains)):
                    if later not in skip and (chain[-1], chains[later][0]) in near:
                        chain = chain + chains[later]
                        skip.add(later)
                        changed = True
                out.append(chain)
            chains = out
        pairs = spark.createDataFrame([("s", a, b) for a, b in near], "seq_id string, a int, b int")
        got = {r["track_id"]: r["new_id"] for r in postprocess.stitch(rows, pairs).collect()}
        assert got == {t: chain[0] for chain in chains for t in chain}


def test_registration_recovers_a_known_motion():
    rng = np.random.default_rng(2)
    p = np.vstack([np.column_stack([rng.uniform(0, 4, 200), rng.uniform(0, 2, 200), np.zeros(200)]), np.column_stack([rng.uniform(0, 4, 200), np.zeros(200), rng.uniform(0, 1.5, 200)]), np.column_stack([np.zeros(150), rng.uniform(0, 2, 150), rng.uniform(0, 1.5, 150)])])
    motion = registration.exponential(np.array([0.02, -0.03, 0.05, 0.1, -0.08, 0.05]))
    moved = registration.apply(motion, p)
    for generalised in (False, True):
        m, fitness = registration.icp(p, moved, 0.6, 40, generalised=generalised)
        assert fitness > 0.95 and np.abs(registration.apply(m, p) - moved).max() < 0.05
    assert np.allclose(registration.rigid(p, moved), motion, atol=1e-9)
    bad = np.eye(4)
    bad[0, 3] = 10
    assert not registration.valid_transform(bad, 3) and registration.valid_transform(np.eye(4), 3)
    kept = registration.align_chunks([p, moved, p[:3]], registration.RegistrationConfig(voxel=0.05))
    assert [k for k, *_ in kept] == [0, 1]
    assert {s for *_, s in registration.align_chunks([p, moved], registration.RegistrationConfig("small_gicp"))} == {"registration_skipped"}


def test_ground_truth_vectors(spark):
    tracks = spark.createDataFrame([("s", 1, 10, 100), ("s", 2, 20, 300)], "seq_id string, track_id int, last_frame int, last_ns long")
    labels = spark.createDataFrame([("s", 7, 98, 10), ("s", 8, 305, 20), ("s", 9, 900, 30)], "seq_id string, object_id int, timestamp_ns long, frame_index int")
    got = sorted(map(str, (tuple(r)[1:] for r in evaluate.match_ground_truth(tracks, labels).collect())))
    assert got == sorted(map(str, [(1, 7, 2, "matched"), (2, 8, 5, "matched"), (None, 9, None, "unmatched_gt")]))
    same = labels.where("object_id < 9").withColumn("timestamp_ns", F.lit(5).cast("long")).withColumn("frame_index", F.lit(1))
    ties = evaluate.match_ground_truth(tracks.withColumn("last_ns", F.lit(5).cast("long")).withColumn("last_frame", F.lit(1)), same)
    assert sorted((r["track_id"], r["object_id"]) for r in ties.collect()) == [(1, 7), (2, 8)]
    p = np.random.default_rng(0).normal(0, 1, (300, 3))
    assert len(set(evaluate.stratified_points(p, 64).tolist())) == 64 and evaluate.prepare_cloud(p[:10], 64).shape == (64, 3)


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def field(number, value):
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def frame_bytes(stamp, points, intensity=b"", object_id=None):
    cloud_ = field(1, np.array(points, "<f4").tobytes()) + (field(2, intensity) if intensity else b"") + field(6, np.arange(len(points), dtype="<u8").tobytes())
    scan = field(1, 3) + field(2, stamp) + field(3, cloud_) + field(4, field(1, b"roof") + field(5, 4) + field(6, 32) + field(8, np.array([-0.1, 0, 0.1], "<f4").tobytes()))
    if object_id is not None:
        scan += field(5, field(1, object_id) + field(2, stamp) + field(7, field(1, np.array(points, "<f4").tobytes())) + field(8, b"car") + varint(9 << 3 | 5) + struct.pack("<f", 0.5))
    body = field(1, stamp) + field(2, scan)
    return struct.pack("<I", len(body)) + body


def test_frame_files(spark, tmp_path):
    nan = float("nan")
    (tmp_path / "02.pb").write_bytes(frame_bytes(10**18 + 7, [(3, 4, 0), (nan, 0, 0), (0, 1, 0)], bytes([255, 1, 51]), 7))
    (tmp_path / "01.pb").write_bytes(frame_bytes(5, [(1, 0, 0)]) + frame_bytes(6, [(nan, nan, nan)]) + frame_bytes(7, [(0, 2, 0.2)]))
    (tmp_path / "ignore.txt").write_text("x")
    rows = frames.read_points(spark, [str(tmp_path)]).orderBy("frame_index", "point_id").collect()
    assert [(r["frame_index"], r["source_index"], r["frame_timestamp_ns"]) for r in rows] == [(0, 0, 5), (2, 0, 7), (3, 1, 10**18 + 7), (3, 1, 10**18 + 7)]
    assert rows[2]["intensity"] == pytest.approx(25.0) and rows[3]["intensity"] == pytest.approx(0.2) and rows[0]["intensity"] is None
    assert [r["point_timestamp_ns"] for r in rows[2:]] == [10**18 + 7, 10**18 + 9] and rows[0]["sensor_name"] == "roof"
    assert (rows[0]["row_index"], rows[1]["row_index"]) == (1, 2) and rows[0]["col_index"] == 16
    label = frames.read_labels(spark, [str(tmp_path)]).collect()
    assert [(r["object_id"], r["point_count"], r["obj_class"], r["obj_class_score"]) for r in label] == [(7, 2, "car", 0.5)]
    with pytest.raises(ValueError):
        frames.resolve([str(tmp_path / "none")] if (tmp_path / "none").mkdir() is None else [])


def test_sinks(spark, tmp_path):
    clouds = spark.createDataFrame([("s", 7, 1.0, 2.0, 3.0, 0.5), ("s", 7, 4.0, 5.0, 6.0, 0.25)], "seq_id string, track_id int, x double, y double, z double, intensity double")
    sinks.write_clouds(clouds, str(tmp_path / "pcd"), intensity=True)
    text = "\n".join(r["value"] for r in spark.read.text(str(tmp_path / "pcd" / "seq_id=s" / "stem=track_0007")).collect())
    assert "POINTS 2" in text and "1 2 3 0.5" in text
    sinks.write_json_lines(spark.createDataFrame([(1, None)], "b int, a string"), str(tmp_path / "j"))
    assert json.loads(spark.read.text(str(tmp_path / "j")).first()["value"]) == {"b": 1}
    assert sinks.markdown(iter([{"a": 1}]), ["a"]).splitlines()[2] == "| 1 |"


def test_config(tmp_path):
    (tmp_path / "base.yaml").write_text("box: {x: [0, 1], y: [0, 1], z: [0, 1]}\neps: 2.0\ntracker: {max_dist: 3.0, max_missed: 4}\n")
    (tmp_path / "a.yaml").write_text("tracker: {max_missed: 9}\nclusterer: hdbscan\n")
    got = config.spec(config.load(str(tmp_path / "a.yaml")))
    assert (got.eps, got.tracker.max_dist, got.tracker.max_missed, got.clusterer) == (2.0, 3.0, 9, "hdbscan")
    for bad in ({"eps": 1.0}, {"box": {"x": [0, 1], "y": [0, 1], "z": [0, 1]}, "nope": 1}, {"box": {"x": [0, 1], "y": [0, 1], "z": [0, 1]}, "clusterer": "nope"}, {"box": {"x": [0, 1], "y": [0, 1], "z": [0, 1]}, "eps": 0}):
        with pytest.raises(config.ConfigError):
            config.spec(bad)


def test_whole_run_with_registration(spark):
    rng = np.random.default_rng(8)
    shape = np.vstack([np.column_stack([rng.uniform(0, 1.8, 60), rng.uniform(0, 4, 60), np.ones(60)]), np.column_stack([np.zeros(60), rng.uniform(0, 4, 60), rng.uniform(0.2, 1, 60)])])
    rows = [("s", f, f * 10**8, "a", f * 1000 + k, *map(float, p + [0, 30 - 1.5 * f, 0]), 1.0, 0, 0, 1.0) for f in range(12) for k, p in enumerate(shape)]
    points = spark.createDataFrame(rows, "seq_id string, frame_index int, frame_timestamp_ns long, sensor_name string, point_id long, x double, y double, z double, intensity double, row_index int, col_index int, range double")
    spec = config.Spec(box=Box((-5, 5), (0, 45), (0, 5)), accumulator="registration_voxel_fusion", selection="keyframe_motion", keep=4, min_points=5, eps=1.2, require_exit=False, min_saved_points=50, registration=registration.RegistrationConfig(max_iter=10))
    out = run(points, spec)
    result = out["results"].collect()
    assert len(result) == 1 and result[0]["status"] == "saved" and result[0]["hit_count"] == 12
    size = fusion.dimensions(out["clouds"]).first()
    assert 3.5 < size["length"] < 4.5


def test_runner_writes_artifacts_and_reports(spark, tmp_path):
    from pointlane.plans import runner

    rng = np.random.default_rng(5)
    rows = [("s", f, f * 10**8, "a", f * 100 + k, *map(float, (rng.uniform(0, 1.8), 30 - f + rng.uniform(0, 4), rng.uniform(0, 1.5))), 1.0, 0, 0, 1.0) for f in range(6) for k in range(60)]
    points = spark.createDataFrame(rows, "seq_id string, frame_index int, frame_timestamp_ns long, sensor_name string, point_id long, x double, y double, z double, intensity double, row_index int, col_index int, range double")
    spec = config.Spec(box=Box((-5, 5), (0, 45), (0, 5)), min_points=3, vehicle_min_points=5, eps=1.5, require_exit=False, min_saved_points=10, outlier_ratio=9.0)
    out = runner.benchmark(spark, {"one": points}, {"a": spec}, str(tmp_path / "b"), warmup=0, measure=2).collect()
    assert len(out) == 1 and out[0]["runs"] == 2
    row = json.loads(spark.read.text(str(tmp_path / "b/one/a/0/summary")).first()["value"])
    assert row["frames"] == 6 and row["saved"] == 1 and row["frames_per_second"] > 0
    assert spark.read.json(str(tmp_path / "b/one/a/0/tracks")).first()["status"] == "saved"
    runner.replay(points, spec, str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r/hud.parquet")).count() == 6
    with pytest.raises(config.ConfigError):
        runner.read(spark, "nope", [])
    (tmp_path / "x.yaml").write_text("")
    assert runner.support_path("x.yaml", str(tmp_path / "sub" / "c.yaml")) == str(tmp_path / "x.yaml")
