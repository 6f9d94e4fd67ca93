"""Multi-object tracking over detections, one ordered pass per sequence.

Detections travel without their points (tens of rows a frame). The Kalman
filter's axes do not interact and its noise is the same on each, so position
and velocity of an axis share one 2 x 2 covariance per track: four numbers
instead of matrices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .association import greedy, hungarian


@dataclass(frozen=True)
class TrackerConfig:
    algorithm: str = "kalman_nn"
    max_dist: float = 3.4
    max_missed: int = 12
    sticky_extra_dist_per_missed: float = 0.55
    sticky_max_dist: float = 6.2
    kf_init_var: float = 5.0
    kf_process_var: float = 0.08
    kf_meas_var: float = 0.6
    association_size_weight: float = 0.15

    def __post_init__(self) -> None:
        if self.algorithm not in ("euclidean_nn", "kalman_nn", "hungarian_kalman"):
            raise ValueError(f"unknown tracker {self.algorithm!r}")


@dataclass
class _Track:
    id: int
    x: np.ndarray
    v: np.ndarray
    p: tuple[float, float, float]  # variance of position, covariance, variance of velocity
    extent: np.ndarray
    last_frame: int
    missed: int = 0
    age: int = 1
    hits: int = 1


@dataclass
class Tracker:
    """State of one sequence; ``step`` takes a frame's detections and returns observation rows."""

    config: TrackerConfig
    active: list[_Track] = field(default_factory=list)
    next_id: int = 1

    def step(self, frame: int, centers: np.ndarray, extents: np.ndarray, suppressed: np.ndarray | None = None) -> tuple[list[tuple], list[tuple]]:
        """(observations, ended): (track_id, detection row, status, center, age, missed) and (track_id, age, missed, hits, ended_by_missed)."""
        c, rows, ended = self.config, [], []
        filtered = c.algorithm != "euclidean_nn"
        if filtered:
            for t in self.active:
                a, b, d = t.p
                t.x = t.x + t.v
                t.p = (a + 2 * b + d + c.kf_process_var, b + d, d + c.kf_process_var)
        pairs: list[tuple[int, int]] = []
        if self.active and len(centers):
            at, size = np.stack([t.x for t in self.active]), np.stack([t.extent for t in self.active])
            cost = np.linalg.norm(at[:, None] - centers[None], axis=2)
            if c.association_size_weight > 0:
                gap = np.abs(size[:, None] - extents[None]) / np.maximum(np.maximum(size[:, None], extents[None]), 1e-3)
                cost = cost + c.association_size_weight * gap.mean(2)
            missed = np.array([t.missed for t in self.active])
            gate = np.minimum(c.sticky_max_dist, c.max_dist + c.sticky_extra_dist_per_missed * missed) if filtered else np.full(len(missed), c.max_dist)
            feasible = cost <= gate[:, None]
            pairs = (hungarian if c.algorithm == "hungarian_kalman" else greedy)(cost, feasible)
        met = dict(pairs)
        kept = []
        for k, t in enumerate(self.active):
            t.age += 1
            if k in met:
                z = centers[met[k]]
                if filtered:
                    a, b, d = t.p
                    s = a + c.kf_meas_var
                    y = z - t.x
                    t.x, t.v = t.x + a / s * y, t.v + b / s * y
                    t.p = ((1 - a / s) * a, (1 - a / s) * b, d - b * b / s)
                else:
                    t.x = z.copy()
                t.extent, t.missed, t.last_frame = extents[met[k]], 0, frame
                t.hits += 1
                rows.append((t.id, met[k], "matched", t.x, t.age, 0))
            else:
                t.missed += 1
                if t.missed > c.max_missed:
                    ended.append((t.id, t.age, t.missed, t.hits, True))
                    rows.append((t.id, -1, "ended", t.x, t.age, t.missed))
                    continue
                rows.append((t.id, -1, "missed", t.x, t.age, t.missed))
            kept.append(t)
        self.active = kept
        taken = set(met.values())
        for k in range(len(centers)):
            if k in taken:
                continue
            if suppressed is not None and suppressed[k]:
                rows.append((-1, k, "suppressed", centers[k], 0, 0))
                continue
            self.active.append(_Track(self.next_id, centers[k].copy(), np.zeros(3), (c.kf_init_var, 0.0, c.kf_init_var), extents[k], frame))
            rows.append((self.next_id, k, "spawned", centers[k], 1, 0))
            self.next_id += 1
        return rows, ended

    def finish(self) -> list[tuple]:
        return [(t.id, t.age, t.missed, t.hits, False) for t in sorted(self.active, key=lambda t: t.id)]


STATES = "seq_id string, frame_id int, track_id int, detection_id int, status string, cx double, cy double, cz double, age int, missed int"


def track(detections: DataFrame, config: TrackerConfig, frames: DataFrame | None = None) -> DataFrame:
    """A row for each track and frame (status spawned, matched, missed or ended) and each suppressed detection.

    ``frames`` (seq_id, frame_index) adds frames without detections; every
    sequence is one task, and detections arrive in order of frame. A detection
    whose ``spawn_suppressed`` (if there is such a column) is true begins no track.
    """
    rows = detections.select("seq_id", "frame_index", "detection_id", "cx", "cy", "cz", *[(F.col(f"max_{a}") - F.col(f"min_{a}")).cast("double").alias(f"e{a}") for a in "xyz"], (F.coalesce("spawn_suppressed", F.lit(False)) if "spawn_suppressed" in detections.columns else F.lit(False)).alias("suppressed"))
    if frames is not None:
        rows = rows.unionByName(frames.select("seq_id", "frame_index").distinct(), allowMissingColumns=True)

    def run(key, seq: pd.DataFrame) -> pd.DataFrame:
        tracker, out = Tracker(config), []
        for frame, part in seq.sort_values(["frame_index", "detection_id"]).groupby("frame_index", sort=True):
            part = part[part.detection_id.notna()]
            states, _ = tracker.step(int(frame), part[["cx", "cy", "cz"]].to_numpy(float), part[["ex", "ey", "ez"]].to_numpy(float), part["suppressed"].to_numpy(bool))
            ids = part.detection_id.to_numpy()
            out += [(key[0], int(frame), t, int(ids[d]) if d >= 0 else None, s, *map(float, x), age, missed) for t, d, s, x, age, missed in states]
        return pd.DataFrame(out, columns=[c.split(" ")[0] for c in STATES.split(", ")])

    return rows.groupBy("seq_id").applyInPandas(run, STATES)


def tracks(states: DataFrame) -> DataFrame:
    """One row per track: hit_count, age, missed, ended_by_missed, first and last frame seen, and counts by status."""
    seen = F.col("status").isin("spawned", "matched")
    count = lambda s: F.count_if(F.col("status") == s)
    return states.where("track_id > 0").groupBy("seq_id", "track_id").agg(
        F.count_if(seen).alias("hit_count"), F.max_by("age", "frame_id").alias("age"), F.max_by("missed", "frame_id").alias("missed"), F.bool_or(F.col("status") == "ended").alias("ended_by_missed"),
        F.min(F.when(seen, F.col("frame_id"))).alias("first_frame"), F.max(F.when(seen, F.col("frame_id"))).alias("last_frame"),
        count("spawned").alias("spawned_count"), count("matched").alias("matched_count"), (count("missed") + count("ended")).alias("missed_count"),
    )


def frame_metrics(states: DataFrame, detections: DataFrame | None = None, algorithm: str | None = None) -> DataFrame:
    """Per frame the numbers of matched, missed, spawned and suppressed; with ``detections`` also of those with ``tracking_halo_only``, with ``algorithm`` its assignment method."""
    count = lambda *s: F.count_if(F.col("status").isin(*s))
    rows = states.groupBy("seq_id", "frame_id").agg(count("matched").alias("matched"), count("missed", "ended").alias("missed"), count("spawned").alias("spawned"), count("suppressed").alias("suppressed"))
    if detections is not None:
        halo = F.count_if("tracking_halo_only") if "tracking_halo_only" in detections.columns else F.lit(0).cast("long")
        halos = detections.groupBy("seq_id", F.col("frame_index").alias("frame_id")).agg(halo.alias("halo"))
        rows = rows.join(halos, ["seq_id", "frame_id"], "left").withColumn("halo", F.coalesce("halo", F.lit(0).cast("long")))
    return rows if algorithm is None else rows.withColumn("assignment_method", F.lit("hungarian" if algorithm == "hungarian_kalman" else "greedy"))


def predicted_tracks(states: DataFrame, found: DataFrame, labelled: DataFrame) -> DataFrame:
    """(seq_id, frame_id, track_id, status, cx..cz, x, y, z, intensity): the points of a filtered track in each frame that missed it.

    These are the points of the last frame that saw it, moved with the track
    from its center there to the predicted one. ``found`` are detections with
    their label, ``labelled`` the points. The last sight is an as-of lookup in
    the track's own rows; points are joined by frame and label only for them.
    """
    before = Window.partitionBy("seq_id", "track_id").orderBy("frame_id").rowsBetween(Window.unboundedPreceding, -1)
    sight = F.when(F.col("status").isin("spawned", "matched"), F.struct("frame_id", "detection_id", "cx", "cy", "cz"))
    missed = states.where("track_id > 0").withColumn("sight", F.last(sight, ignorenulls=True).over(before)).where("status = 'missed' AND sight IS NOT NULL")
    missed = missed.select("seq_id", "frame_id", "track_id", "cx", "cy", "cz", F.col("sight.frame_id").alias("frame_index"), F.col("sight.detection_id").alias("detection_id"), *[(F.col(f"c{a}") - F.col(f"sight.c{a}")).alias(f"d{a}") for a in "xyz"])
    rows = missed.join(found.select("seq_id", "frame_index", "detection_id", "label"), ["seq_id", "frame_index", "detection_id"])
    points = labelled.select("seq_id", "frame_index", "label", "x", "y", "z", "intensity")
    rows = rows.join(points, ["seq_id", "frame_index", "label"])
    return rows.select("seq_id", "frame_id", "track_id", F.lit("predicted").alias("status"), "cx", "cy", "cz", *[(F.col(a) + F.col(f"d{a}")).alias(a) for a in "xyz"], "intensity")


def last_active(states: DataFrame) -> DataFrame:
    """Per track its last frame seen and its center there."""
    seen = states.where(F.col("status").isin("spawned", "matched"))
    return seen.groupBy("seq_id", "track_id").agg(F.max_by(F.struct("frame_id", "cx", "cy", "cz"), "frame_id").alias("s")).select("seq_id", "track_id", "s.*")


def kalman_fold(observations: DataFrame, init_var: float, process_var: float, meas_var: float) -> DataFrame:
    """(seq_id, track_id, x, v): the filter over each track's centers along y, a known association, as one SQL fold.

    A gap of frames is that many predictions without update.
    """
    rows = observations.groupBy("seq_id", "track_id").agg(F.sort_array(F.collect_list(F.struct("frame_id", F.col("cy").cast("double").alias("z")))).alias("o"))
    first = F.col("o")[0]
    d = lambda v: F.lit(v).cast("double")
    zero = F.struct(first["frame_id"].alias("f"), first["z"].alias("x"), d(0.0).alias("v"), d(init_var).alias("a"), d(0.0).alias("b"), d(init_var).alias("c"))

    def predict(s: Column) -> Column:
        return F.struct(s["f"].alias("f"), (s["x"] + s["v"]).alias("x"), s["v"].alias("v"), (s["a"] + 2 * s["b"] + s["c"] + process_var).alias("a"), (s["b"] + s["c"]).alias("b"), (s["c"] + process_var).alias("c"))

    def step(s: Column, o: Column) -> Column:
        p = F.aggregate(F.sequence(F.lit(1), o["frame_id"] - s["f"]), s, lambda acc, _: predict(acc))
        return F.aggregate(F.array(p), p, lambda q, _: F.struct(
            o["frame_id"].alias("f"), (q["x"] + q["a"] / (q["a"] + meas_var) * (o["z"] - q["x"])).alias("x"), (q["v"] + q["b"] / (q["a"] + meas_var) * (o["z"] - q["x"])).alias("v"),
            ((1 - q["a"] / (q["a"] + meas_var)) * q["a"]).alias("a"), ((1 - q["a"] / (q["a"] + meas_var)) * q["b"]).alias("b"), (q["c"] - q["b"] * q["b"] / (q["a"] + meas_var)).alias("c"),
        ))

    state = F.aggregate(F.slice("o", 2, F.greatest(F.size("o") - 1, F.lit(0))), zero, step)
    return rows.select("seq_id", "track_id", state.alias("s")).select("seq_id", "track_id", F.col("s.x").alias("x"), F.col("s.v").alias("v"))


def step_frames(config: TrackerConfig, tracker: Tracker | None, frames: Iterator[pd.DataFrame]) -> tuple[Tracker, list[tuple]]:
    """Run a tracker over frames of detections (columns as in ``track``), for streaming."""
    tracker, out = tracker or Tracker(config), []
    for part in frames:
        frame = int(part.frame_index.iloc[0])
        # A frame without detections is one row without an id.
        part = part[part.detection_id.notna()].sort_values("detection_id")
        suppressed = part["suppressed"].fillna(False).to_numpy(bool) if "suppressed" in part else None
        states, _ = tracker.step(frame, part[["cx", "cy", "cz"]].to_numpy(float), part[["ex", "ey", "ez"]].to_numpy(float), suppressed)
        out += [(frame, t, s, *map(float, x), age, missed) for t, _, s, x, age, missed in states]
    return tracker, out
