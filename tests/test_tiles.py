"""Tiled neighbourhoods against brute force: clusters over many borders, components, nearest neighbours, planes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pointlane.operators import clustering, fusion, tiles


def brute_clusters(p, eps, least):
    """(core, owner): all pairs within eps; a border point follows its least core neighbour."""
    n = len(p)
    near = ((p[:, None] - p[None]) ** 2).sum(2) <= eps * eps
    core = near.sum(1) >= least
    label = np.arange(n)
    while True:
        new = np.array([label[near[i] & core].min() if core[i] else label[i] for i in range(n)])
        if (new == label).all():
            break
        label = new
    owner = np.where(core, label, -1)
    for i in np.flatnonzero(~core):
        by = np.flatnonzero(near[i] & core)
        owner[i] = label[by[0]] if len(by) else -1
    return core, owner


def test_local_clusters_equal_brute_force():
    rng = np.random.default_rng(0)
    for case in range(150):
        n = int(rng.integers(0, 160))
        p = rng.normal(0, rng.choice([0.3, 1.0, 3.0]), (n, 3))
        if case % 3 == 0:
            p = np.round(p, 1)
        eps, least = float(rng.choice([0.2, 0.5, 1.0])), int(rng.choice([1, 2, 3, 5, 8]))
        core, owner = tiles.density_clusters(p, eps, least)
        want_core, want = brute_clusters(p, eps, least)
        assert (core == want_core).all() and (owner == want).all()


def test_dense_clouds_need_no_pairs():
    """Two lumps of 200,000 points each within a few radii: all pairs would be 10^10."""
    rng = np.random.default_rng(1)
    p = np.concatenate([rng.normal(0, 0.3, (200_000, 3)), rng.normal(20, 0.3, (200_000, 3))])
    core, owner = tiles.density_clusters(p, 1.0, 20)
    assert core.mean() > 0.999 and set(np.unique(owner[owner >= 0])) == {0, 200_000}


@pytest.mark.parametrize("least", [1, 4])
def test_tiled_clusters_equal_brute_force(spark, least):
    rng = np.random.default_rng(least)
    rows, clouds = [], {}
    for frame in range(3):
        # Chains along x pass many tiles; scattered points make border points and noise.
        chain = np.stack([np.arange(0, 40, 0.3), rng.normal(0, 0.2, 134), rng.normal(0, 0.2, 134)], 1)
        p = np.round(np.concatenate([chain, rng.uniform(-6, 40, (150, 3)) * [1, 0.2, 0.2], chain + [0, 9, 0]]), 3)
        clouds[frame] = p
        order = rng.permutation(len(p))
        rows += [("s", frame, int(i), *map(float, p[i])) for i in order]
    points = spark.createDataFrame(rows, "seq_id string, frame_index int, node long, x double, y double, z double").repartition(4)
    for side in (7, 32) if least > 1 else (8,):
        got = tiles.density_components(points, ["seq_id", "frame_index"], 0.7, least, side=side).toPandas()
        for frame, p in clouds.items():
            own = got[got.frame_index == frame].sort_values("node")
            core, owner = brute_clusters(p, 0.7, least)
            assert own.node.tolist() == list(range(len(p))) and own.core.tolist() == core.tolist()
            assert own.cluster.fillna(-1).astype(int).tolist() == owner.tolist()


def test_points_of_one_place_are_one_row_of_a_tile(spark, monkeypatch):
    rng = np.random.default_rng(9)
    for case in range(60):
        p = np.round(rng.normal(0, rng.choice([0.3, 1.0, 3.0]), (int(rng.integers(1, 60)), 3)), 1)
        places, first, of, n = np.unique(np.repeat(p, rng.integers(1, 5, len(p)), 0), axis=0, return_index=True, return_inverse=True, return_counts=True)
        least = int(rng.choice([1, 2, 3, 5, 8]))
        core, owner = tiles.density_clusters(places, 0.5, least, n)
        want_core, want = brute_clusters(places[of.reshape(-1)], 0.5, least)
        assert (core[of.reshape(-1)] == want_core).all()
        assert ((owner < 0)[of.reshape(-1)] == (want < 0)).all()
    rows = [("s", 0, i, float(i % 40) * 0.3, 0.0, float(i % 3 == 0)) for i in range(4_000)] + [("s", 0, 4_000 + i, 90.0, 0.0, 0.0) for i in range(3)]
    points = spark.createDataFrame(rows, "seq_id string, frame_index int, point_id long, x double, y double, z double")
    tiled = []
    inner = clustering.density_components
    monkeypatch.setattr(clustering, "density_components", lambda rows, *how: tiled.append(rows.count()) or inner(rows, *how))
    got = clustering.cluster_dbscan(points, 0.5, 4).orderBy("point_id").collect()
    assert tiled == [81]  # of 4,003 points
    # Two rows of places a unit apart, each in steps of 0.3; three points are too few.
    assert [r.label for r in got] == [int(r[5] == 0) for r in rows[:4_000]] + [-1] * 3


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(g, int(a), int(b)) for g in "ab" for a, b in rng.integers(0, 300, (250, 2))] + [("a", i, i + 1) for i in range(1000, 1040)] + [("b", 7, 7)]
    frame = spark.createDataFrame(edges, "g string, a long, b long")
    got, small = ({(r.g, r.node): r.component for r in tiles.components(frame, ["g"], small=n).collect()} for n in (0, 10_000))
    want = {}
    for g in "ab":
        label = {}
        links = [(a, b) for h, a, b in edges if h == g and a != b]
        for a, b in links:
            label[a], label[b] = a, b
        changed = True
        while changed:
            changed = False
            for a, b in links:
                low = min(label[a], label[b])
                if label[a] != low or label[b] != low:
                    label[a] = label[b] = low
                    changed = True
        want |= {(g, k): v for k, v in label.items()}
    assert got == want == small
    assert tiles.components(spark.createDataFrame([], "g string, a long, b long"), ["g"]).count() == 0


def brute_distance(p, k):
    d = np.sqrt(((p[:, None] - p[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    return np.sort(d, 1)[:, : min(k, len(p) - 1)].mean(1)


def test_neighbour_distances_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    clouds = {
        0: rng.normal(0, 1, (500, 3)), 1: np.concatenate([rng.normal(0, 0.1, (300, 3)), [[900.0, 0, 0], [-4000.0, 7, 7]]]), 2: rng.uniform(0, 1, (400, 3)) * [50, 1, 0],
        3: np.zeros((20, 3)), 4: rng.normal(0, 1, (5, 3)), 5: np.stack([np.arange(300.0)] * 3, 1),
    }
    rows = [("s", t, i, *map(float, x)) for t, p in clouds.items() for i, x in enumerate(p)]
    frame = spark.createDataFrame(rows, "seq_id string, track_id int, node long, x double, y double, z double").repartition(4)
    got = tiles.mean_neighbour_distance(frame, ["seq_id", "track_id"], 8).toPandas()
    for t, p in clouds.items():
        own = got[got.track_id == t].sort_values("node")
        assert own.node.tolist() == list(range(len(p))) and np.allclose(own.distance, brute_distance(p, 8))


def test_outliers_of_small_and_large_tracks(spark):
    rng = np.random.default_rng(3)
    rows = [("s", 1, *map(float, x), None, 1.0) for x in np.concatenate([rng.normal(0, 1, (3000, 3)), [[50.0, 50, 50]]])] + [("s", 2, float(i * i * 9), 0.0, 0.0, None, 1.0) for i in range(7)]
    cloud = spark.createDataFrame(rows, "seq_id string, track_id int, x double, y double, z double, intensity double, confidence double")
    kept = fusion.remove_outliers(cloud, 8, 3.0)
    assert kept.columns == cloud.columns and kept.where("track_id = 2").count() == 7 and kept.where("track_id = 1 AND x > 40").count() == 0 and kept.where("track_id = 1").count() > 2900


def test_components_of_a_cloud(spark):
    rows = [("s", 1, 0.1 * i, 0.0, 0.0) for i in range(50)] + [("s", 1, 0.1 * i, 3.0, 0.0) for i in range(50)] + [("s", 2, 0.1 * i, 0.0, 0.0) for i in range(50)]
    got = fusion.cloud_components(spark.createDataFrame(rows, "seq_id string, track_id int, x double, y double, z double"), 0.15)
    assert sorted(r.n for r in got.groupBy("track_id", "component").agg(F.count("*").alias("n")).collect()) == [50, 50, 50]


def test_ground_plane_and_its_metrics(spark):
    rng = np.random.default_rng(6)
    grid = [(x / 6 - 1, y / 4, 0.0) for x in range(12) for y in range(12)]
    rows = [("s", 0, i, *map(float, p)) for i, p in enumerate(grid + list(rng.normal((0.2, 1.5, 1), 0.03, (40, 3))))]
    rows += [("s", 1, i, 0.0, *map(float, p)) for i, p in enumerate(rng.uniform(0, 3, (60, 2)))] + [("s", 2, 0, 1.0, 1.0, 1.0), ("s", 2, 1, 2.0, 2.0, 2.0)]
    points = spark.createDataFrame(rows, "seq_id string, frame_index int, point_id long, x double, y double, z double")
    planes = clustering.ground_planes(points, 0.05, 60)
    found = {r.frame_index: r for r in planes.collect()}
    assert set(found) == {0, 1} and abs(abs(found[0].nz) - 1) < 1e-9 and found[0].inliers == 144 and abs(found[1].nz) < 1e-9
    labelled = clustering.cluster_ground_removed(points, 0.5, 5, 0.05, 60)
    metrics = {r.frame_index: r for r in clustering.ground_metrics(labelled, planes).collect()}
    assert metrics[0].ground_removed_count == 144 and abs(metrics[0].ground_model[2]) > 0.99 and metrics[1].ground_removed_count == 0 and metrics[1].ground_model is None and metrics[2].ground_model is None
    assert {(r.frame_index, r.label): r["count"] for r in labelled.groupBy("frame_index", "label").count().collect()}[0, 0] == 40
