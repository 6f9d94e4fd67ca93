"""The tracker on a stream whose sequences end: frames without detections, silence, and what is left to finish."""

import datetime

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from pointlane.operators import tracking
from pointlane.streaming import tracker

SCHEMA = "seq_id string, frame_index int, time timestamp, detection_id int, cx double, cy double, cz double, ex double, ey double, ez double"


def rows_of(name, frames, start, rng, skip=()):
    """Two objects; frames in ``skip`` have none, and the second object is gone from frame 5 on."""
    out = []
    for f in frames:
        at = datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=start + f)
        found = [] if f in skip else [d for d in range(2) if d == 0 or f < 5]
        out += [(name, f, at, d + 1, *map(float, (4 * d + rng.normal(0, 0.05), 0.4 * f, 0)), 1.0, 1.0, 1.0) for d in found]
        if not found:
            out.append((name, f, at, *[None] * 7))
    return out


def test_silent_sequences_finish_and_equal_the_batch(spark, tmp_path):
    rng, config = np.random.default_rng(2), tracking.TrackerConfig(max_missed=3)
    a, b = rows_of("a", range(8), 0, rng, skip=(3,)), rows_of("b", range(30), 0, rng, skip=(7, 8))
    parts = [[r for r in a + b if lo <= r[1] < lo + 6] for lo in range(0, 30, 6)]
    for k, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in")).withWatermark("time", "1 second")
        states = tracker.track_stream(stream, config, silent_seconds=5)
        # Every batch is a run of its own: the state outlives them.
        states.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert {(r["seq_id"], r["frame_id"]) for r in got.where("status = 'finished'").collect()} == {("a", 7)}, "b goes on"

    found = spark.createDataFrame(a + b, SCHEMA)
    frames = found.select("seq_id", "frame_index").distinct()
    batch = tracking.track(found.where("detection_id IS NOT NULL").withColumns({f"{n}_{x}": F.lit(0.0 if n == "min" else 1.0) for n in ("min", "max") for x in "xyz"}), config, frames)
    key = ["seq_id", "track_id", "frame_id"]
    stepped = got.where("status <> 'finished'").toPandas().sort_values(key).reset_index(drop=True)
    pd.testing.assert_frame_equal(stepped, batch.drop("detection_id").toPandas()[stepped.columns].sort_values(key).reset_index(drop=True), check_dtype=False)

    columns = ["seq_id", "track_id", "hit_count", "age", "missed", "ended_by_missed", "first_frame", "last_frame"]
    want = tracking.tracks(batch).where("seq_id = 'a' OR ended_by_missed").select(*columns)
    assert sorted(map(tuple, tracker.tracks(got).select(*columns).collect())) == sorted(map(tuple, want.collect()))
