"""Long-vehicle groups against plain Python, and in a whole run."""

from pyspark.sql import functions as F

from pointlane.operators import fusion, groups, postprocess
from pointlane.sources.scratch import scratch

CLOUD = "seq_id string, track_id int, x double, y double, z double, intensity double, confidence double"
LINK = "seq_id string, lead int, rear int, gap_mean double"


def line(track, low, high, n=41, x=0.0):
    return [("s", track, x, low + (high - low) * k / (n - 1), 0.0, 1.0, 1.0) for k in range(n)]


def moving(track, start, step, frames, n=10):
    return [("s", track, f, n, 0.0, start + step * f, 0.0, -1.0, start + step * f - 2, -1.0, 1.0, start + step * f + 2, 1.0, f * 100) for f in frames]


OBS = "seq_id string, track_id int, frame_id int, n_points int, cx double, cy double, cz double, min_x double, min_y double, min_z double, max_x double, max_y double, max_z double, ts_ns long"


def test_groups_join_links_of_any_length(spark):
    keep = scratch(spark)
    links = postprocess.link_states(spark.createDataFrame([("s", 1, 2, 0.5), ("s", 2, 3, None), ("s", 9, 8, 0.1), ("t", 1, 2, 0.2)], LINK), "articulated")
    links = links.unionByName(postprocess.link_states(spark.createDataFrame([("s", 9, 7, None)], LINK), "fragment"))
    got = sorted((r.seq_id, r.group_id, r.track_id, r.role, r.gap_mean) for r in groups.link_groups(links, keep).collect())
    assert got == [("s", 1, 1, "lead", None), ("s", 1, 2, "rear", 0.5), ("s", 1, 3, "rear", None), ("s", 9, 7, "fragment", None), ("s", 9, 8, "rear", 0.1), ("s", 9, 9, "lead", None), ("t", 1, 1, "lead", None), ("t", 1, 2, "rear", 0.2)]


def placed(parts, direction, clearance):
    """(track, shift) by walking a group from its lead backwards; parts: (track, role, gap, low, high), lead first."""
    front = lambda p: p[4] if direction > 0 else -p[3]
    back = lambda p: p[3] if direction > 0 else -p[4]
    edge, out = back(parts[0]), {parts[0][0]: 0.0}
    for p in sorted(parts[1:], key=lambda p: (-front(p), p[0])):
        out[p[0]] = 0.0
        if p[1] == "rear":
            move = min(0.0, edge - max(p[2] or 0.0, 0.0) - clearance - front(p))
            edge, out[p[0]] = min(edge, back(p) + move), move * direction
    return out


def test_shifts_equal_a_walk_from_the_lead(spark):
    cases = {
        1: [(10, "lead", None, 10, 20), (11, "rear", 0.5, 4, 12), (12, "rear", None, -3, 5), (13, "fragment", None, 15, 22)],
        2: [(20, "lead", None, 0, 5), (21, "rear", -2.0, -9, -1)],
        3: [(30, "lead", None, 0, 5), (31, "rear", 0.25, 2, 8), (32, "rear", 0.0, 7, 9), (33, "rear", 1.0, 30, 33)],
    }
    cloud = spark.createDataFrame([r for ps in cases.values() for p in ps for r in line(p[0], float(p[3]), float(p[4]))] + line(99, 0.0, 1.0), CLOUD)
    rows = [("s", p[0], ps[0][0], p[1], p[2]) for ps in cases.values() for p in ps] + [("s", 99, 98, "rear", None), ("s", 98, 98, "lead", None)]
    group = spark.createDataFrame(rows, "seq_id string, track_id int, group_id int, role string, gap_mean double")
    for direction in (1, -1):
        heading = spark.createDataFrame([("s", t, direction) for t in (10, 20, 30, 98)], "seq_id string, track_id int, direction int")
        got = {r.track_id: r.shift for r in groups.shifts(cloud, group, heading, 0.1).collect()}
        want = {}
        for ps in cases.values():
            want |= placed(ps, direction, 0.1)
        assert got.keys() == want.keys()  # 99's lead has no cloud
        assert all(abs(got[t] - want[t]) < 1e-9 for t in want)


def test_group_is_decided_again(spark):
    keep = scratch(spark)
    observations = spark.createDataFrame(moving(1, 20, -1.0, range(12)) + moving(2, 25, -1.0, range(2, 16)) + moving(3, 50, -1.0, range(5)), OBS)
    tracks = spark.createDataFrame([("s", 1, 12, 12, 2, False), ("s", 2, 14, 15, 0, False), ("s", 3, 5, 5, 0, False)], "seq_id string, track_id int, hit_count long, age int, missed int, ended_by_missed boolean")
    quality = spark.createDataFrame([("s", 1, 0.4), ("s", 2, 0.9), ("s", 3, 0.9)], "seq_id string, track_id int, quality_score double")
    clouds = spark.createDataFrame(line(1, -2.0, 2.0) + line(2, -2.0, 2.0) + line(3, 0.0, 1.0), CLOUD)
    links = postprocess.link_states(spark.createDataFrame([("s", 1, 2, 0.5)], LINK), "articulated")
    gone = fusion.exited(observations, tracks, 0.0, 30.0).join(quality, ["seq_id", "track_id"])
    results = fusion.decide(gone, fusion.dimensions(clouds), 4, 50, 0.5, False)
    assert {r.track_id: r.status for r in results.collect()} == {1: "skipped_min_saved_points", 2: "skipped_min_saved_points", 3: "skipped_min_saved_points"}
    how = dict(clearance=0.1, neighbours=0, ratio=2.0, voxel=0.05, lane_end=0.0, margin=30.0, least_quality=0.5)
    merged, decided = groups.merge_long_vehicles(clouds, observations, tracks, quality, links, results, keep, least_points=50, require_exit=False, **how)
    rows = {r.track_id: r for r in decided.collect()}
    # 41 points each: together they pass the gate of 50; the best quality counts.
    assert rows[1].status == "saved" and rows[1].n_points == 82 and rows[1].quality_score == 0.9 and rows[1].hit_count == 16
    assert rows[2].status == groups.MERGED and rows[2].merged_target_track_id == 1 and rows[2].n_points == 0
    assert rows[3].status == "skipped_min_saved_points" and rows[3].merged_target_track_id is None
    extent = {r.track_id: (r.low, r.high) for r in merged.groupBy("track_id").agg(F.min("y").alias("low"), F.max("y").alias("high")).collect()}
    # Moving to -y, the lead's front is its least y, the origin of the merged cloud.
    assert extent.keys() == {1, 3} and abs(extent[1][0]) < 1e-9 and extent[1][1] >= 8.5
    # The group is last seen with the rear, which has missed nothing by then.
    _, strict = groups.merge_long_vehicles(clouds, observations, tracks, quality, links, results, keep, least_points=50, require_exit=True, **how)
    assert {r.track_id: r.status for r in strict.collect()}[1] == "skipped_track_exit"
    _, few = groups.merge_long_vehicles(clouds, observations, tracks, quality, links, results, keep, least_points=83, require_exit=False, **how)
    assert {r.track_id: r.status for r in few.collect()}[1] == "skipped_min_saved_points"


def test_merge_filter_drops_far_points(spark):
    keep = scratch(spark)
    cloud = spark.createDataFrame(line(1, 0.0, 4.0) + line(2, 4.2, 8.0) + [("s", 2, 300.0, 6.0, 0.0, 1.0, 1.0)], CLOUD)
    moves = spark.createDataFrame([("s", 1, 1, "lead", 0.0), ("s", 2, 1, "rear", 0.0)], "seq_id string, track_id int, group_id int, role string, shift double")
    assert groups.merged_clouds(cloud, moves, 12, 2.3, 0.04, keep).where("x > 100").count() == 0
    assert groups.merged_clouds(cloud, moves, 0, 2.3, 0.04, keep).where("x > 100").count() == 1
