"""Crops and gates over the flat ``points`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import Box, finite

FRAME = ["seq_id", "frame_index"]


def lane_crop(points: DataFrame, box: Box) -> DataFrame:
    """Points inside the box, bounds included; optional columns go with their row."""
    return points.where(box.holds())


def sensor_crop(points: DataFrame, box: Box, range_min: float = 0.0, range_max: float = 120.0, ignore_rows: int = 0) -> DataFrame:
    """Lane crop, range band, and no rows below ``ignore_rows``."""
    rows = points.where(box.holds() & F.col("range").between(range_min, range_max))
    return rows.where(F.col("row_index") >= ignore_rows) if ignore_rows > 0 else rows


def finite_points(points: DataFrame) -> DataFrame:
    return points.where(finite("x", "y", "z"))


def all_or_none(points: DataFrame, column: str, group: list[str]) -> DataFrame:
    """A column stays only in groups where every row has it."""
    has = F.bool_and(F.col(column).isNotNull()).over(Window.partitionBy(*group))
    return points.withColumn(column, F.when(has, F.col(column)))


def frames_with_enough(points: DataFrame, least: int) -> DataFrame:
    """Points of frames that hold at least ``least``; smaller frames yield no detections."""
    return points.withColumn("frame_points", F.count("*").over(Window.partitionBy(*FRAME))).where(F.col("frame_points") >= least)


def backwards_frames(frames: DataFrame) -> DataFrame:
    """Frames whose timestamp is before that of the frame before them; only a warning, order stays."""
    before = F.lag("frame_timestamp_ns").over(Window.partitionBy("seq_id").orderBy("frame_index"))
    return frames.withColumn("previous_ns", before).where(F.col("frame_timestamp_ns") < F.col("previous_ns"))


def latest_labels(labels: DataFrame) -> DataFrame:
    """Per sequence and object_id the newest label with points: by timestamp, then frame; of equals the earlier row (``row_id``)."""
    order = Window.partitionBy("seq_id", "object_id").orderBy(F.desc("timestamp_ns"), F.desc("frame_index"), "row_id")
    return labels.where("point_count > 0").withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn")
