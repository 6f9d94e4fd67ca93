"""The tracker on a stream of detections: keyed state per sequence.

Frames of a sequence must come in order over micro-batches, as the reader
delivers files; within a micro-batch they are sorted. The state is the
tracker's active tracks and next id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.tracking import Tracker, TrackerConfig, _Track, step_frames

OUT = "seq_id string, frame_id int, track_id int, status string, cx double, cy double, cz double, age int, missed int"
STATE = "next_id int, last_frame int, tracks array<struct<id:int,x:array<double>,v:array<double>,p:array<double>,extent:array<double>,last_frame:int,missed:int,age:int,hits:int>>"
#: Status of a track that is still active when its sequence ends.
FINISHED = "finished"


def dump(tracker: Tracker, last_frame: int) -> tuple:
    tracks = [(t.id, t.x.tolist(), t.v.tolist(), [float(p) for p in t.p], t.extent.tolist(), int(t.last_frame), t.missed, t.age, t.hits) for t in tracker.active]
    return tracker.next_id, last_frame, tracks


def restore(state: tuple, config: TrackerConfig) -> Tracker:
    next_id, _, tracks = state
    active = [_Track(i, np.array(x), np.array(v), tuple(p), np.array(e), f, m, a, h) for i, x, v, p, e, f, m, a, h in tracks]
    return Tracker(config, active, next_id)


def track_stream(detections: DataFrame, config: TrackerConfig, silent_seconds: float | None = None) -> DataFrame:
    """States of tracks as ``operators.tracking.track`` gives them, appended batch by batch.

    ``detections``: a streaming frame of seq_id, frame_index, detection_id,
    cx..cz, ex..ez; a row with a null detection_id is a frame without
    detections. With ``silent_seconds`` there is ``time`` too, under a
    watermark: a sequence ends once the watermark is that far past its last
    frame. Then each active track gives a row of status ``finished`` at that
    frame, and the state goes. A sequence that goes on later begins anew, with
    ids from 1: give it a name of its own.
    """

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tracker, out = restore(state.get, config) if state.exists else Tracker(config), []
        if state.hasTimedOut:
            last, by = state.get[1], {t.id: t for t in tracker.active}
            out = [(last, t, FINISHED, *map(float, by[t].x), age, missed) for t, age, missed, _, _ in tracker.finish()]
            state.remove()
        else:
            rows = pd.concat(list(parts)).sort_values(["frame_index", "detection_id"])
            tracker, out = step_frames(config, tracker, (part for _, part in rows.groupby("frame_index", sort=True)))
            state.update(dump(tracker, int(rows["frame_index"].max())))
            if silent_seconds is not None:
                end = int(rows["millis"].max() + silent_seconds * 1000)
                state.setTimeoutTimestamp(max(end, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame([(key[0], *r) for r in out], columns=[c.split(" ")[0] for c in OUT.split(", ")])

    timeout = GroupStateTimeout.NoTimeout
    if silent_seconds is not None:
        detections, timeout = detections.withColumn("millis", F.unix_millis("time")), GroupStateTimeout.EventTimeTimeout
    return detections.groupBy("seq_id").applyInPandasWithState(run, OUT, STATE, "append", timeout)


def tracks(states: DataFrame) -> DataFrame:
    """A row per track that has ended or finished, from the rows of ``track_stream``: hit_count, age, missed, ended_by_missed, first_frame, last_frame."""
    seen = F.col("status").isin("spawned", "matched")
    rows = states.where("track_id >= 0").groupBy("seq_id", "track_id").agg(
        F.count_if(seen).cast("int").alias("hit_count"), F.max("age").alias("age"), F.max_by("missed", F.struct("frame_id", "age")).alias("missed"), F.bool_or(F.col("status") == "ended").alias("ended_by_missed"),
        F.min("frame_id").alias("first_frame"), F.max(F.when(seen, F.col("frame_id"))).alias("last_frame"), F.bool_or(F.col("status").isin("ended", FINISHED)).alias("over"),
    )
    return rows.where("over").drop("over")
