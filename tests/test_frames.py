"""The frame index and the reader by frames: empty frames, many files and sequences, filters, parts."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from pointlane.operators import tracking
from pointlane.sources import frames


def number(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def field(k, value):
    return number(k << 3) + number(value) if isinstance(value, int) else number(k << 3 | 2) + number(len(value)) + value


def scan(points):
    return field(2, field(2, 5) + field(3, field(1, np.array(points, "<f4").tobytes())) + field(4, field(1, b"roof")))


def frame(stamp, *scans, late=False):
    body = b"".join(scans) + field(1, stamp) if late else field(1, stamp) + b"".join(scans)
    return struct.pack("<I", len(body)) + body


@pytest.fixture()
def folder(tmp_path):
    """Two folders; files that end, begin or consist of empty frames."""
    a, b = tmp_path / "a", tmp_path / "b"
    a.mkdir(), b.mkdir()
    (a / "1.pb").write_bytes(frame(10, scan([[1, 2, 3], [4, 5, 6]])) + frame(11) + frame(12, scan([[float("nan"), 0, 0]])))
    (a / "2.pb").write_bytes(frame(20))
    (a / "3.pb").write_bytes(frame(30) + frame(31, scan([[7, 8, 9]]), scan([[1, 1, 1], [2, 2, 2]]), late=True))
    (a / "ignore.txt").write_bytes(b"no frames")
    (b / "1.pb").write_bytes(b"")
    (b / "2.pb").write_bytes(frame(40, scan([[0, 0, 1]])))
    return tmp_path


def test_index_counts_empty_frames(spark, folder):
    rows = frames.read_index(spark, [str(folder / "a"), str(folder / "b")]).orderBy("frame_index").collect()
    assert [(r.frame_index, r.frame_timestamp_ns, r.source_index, r.source_frame_index) for r in rows] == [(0, 10, 0, 0), (1, 11, 0, 1), (2, 12, 0, 2), (3, 20, 1, 0), (4, 30, 2, 0), (5, 31, 2, 1), (6, 40, 4, 0)]
    points = frames.read_points(spark, [str(folder / "a"), str(folder / "b")])
    got = sorted((r.frame_index, r.point_id - (r.frame_index << 32), r.scan_index, r.x, r.frame_timestamp_ns) for r in points.collect())
    assert got == [(0, 0, 0, 1.0, 10), (0, 1, 0, 4.0, 10), (5, 0, 0, 7.0, 31), (5, 1, 1, 1.0, 31), (5, 2, 1, 2.0, 31), (6, 0, 0, 0.0, 40)]
    assert points.select("seq_id").distinct().collect()[0][0] == "s0"


def test_sequences_by_folder_and_file(spark, folder):
    paths = [str(folder / "a"), str(folder / "b")]
    by_folder = frames.read_index(spark, paths, "folder").orderBy("seq_id", "frame_index").collect()
    assert [(r.seq_id, r.frame_index) for r in by_folder] == [("a", k) for k in range(6)] + [("b", 0)]
    by_file = frames.read_index(spark, [str(folder / "a")], "file").orderBy("seq_id", "frame_index").collect()
    assert [(r.seq_id, r.frame_index) for r in by_file] == [("1.pb", 0), ("1.pb", 1), ("1.pb", 2), ("2.pb", 0), ("3.pb", 0), ("3.pb", 1)]
    with pytest.raises(ValueError):
        frames.read_index(spark, paths, "day")


def test_filters_read_chosen_frames_in_many_parts(spark, tmp_path):
    rng = np.random.default_rng(0)
    clouds = [rng.normal(size=(50, 3)).astype("<f4") for _ in range(40)]
    (tmp_path / "long.pb").write_bytes(b"".join(frame(100 + k, scan(c)) for k, c in enumerate(clouds)))
    index = frames.read_index(spark, [str(tmp_path / "long.pb")])
    whole = frames.decode(index, part_bytes=2000)
    assert whole.rdd.getNumPartitions() > 4 and whole.count() == 2000
    some = frames.decode(index.where("frame_timestamp_ns BETWEEN 110 AND 112 OR frame_index = 39")).orderBy("point_id").collect()
    assert np.allclose([[r.x, r.y, r.z] for r in some], np.concatenate([clouds[k] for k in (10, 11, 12, 39)]))
    address = frames.read_points(spark, [f"file://{tmp_path}/long.pb"])
    assert address.count() == 2000


def test_broken_files_are_errors(spark, tmp_path):
    (tmp_path / "cut.pb").write_bytes(frame(1, scan([[1, 2, 3]]))[:-3])
    with pytest.raises(Exception, match="ends within a frame"):
        frames.read_points(spark, [str(tmp_path / "cut.pb")]).count()


def test_trackers_step_on_frames_without_detections(spark, folder):
    """An object seen in frames 0 and 5 only was missed by the four between."""
    index = frames.read_index(spark, [str(folder / "a")])
    points = frames.read_points(spark, [str(folder / "a")])
    found = points.groupBy("seq_id", "frame_index").agg(F.lit(1).alias("detection_id"), *[F.lit(0.0).alias(f"c{a}") for a in "xyz"], *[f.alias(f"{n}_{a}") for a in "xyz" for n, f in (("min", F.lit(0.0)), ("max", F.lit(1.0)))])
    states = tracking.track(found, tracking.TrackerConfig("kalman_nn"), index)
    assert [(r.frame_id, r.status) for r in states.orderBy("frame_id").collect()] == [(0, "spawned"), (1, "missed"), (2, "missed"), (3, "missed"), (4, "missed"), (5, "matched")]
    # In each missed frame the track's last points stand at the predicted center.
    labelled = points.withColumn("label", F.lit(0))
    shown = tracking.predicted_tracks(states, found.withColumn("label", F.lit(0)), labelled)
    assert sorted((r.frame_id, r.status, r.x, r.y) for r in shown.collect()) == sorted((f, "predicted", x, y) for f in (1, 2, 3, 4) for x, y in ((1.0, 2.0), (4.0, 5.0)))
