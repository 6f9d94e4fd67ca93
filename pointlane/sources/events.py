"""The point cloud that the driver's ``events`` table stands for.

Ten objects on lanes of their own move by 1.2 m a day along y towards the lane
end; a day is a frame, an event a point. Coordinates are whole millimetres, so
sums of them are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import Box

LANE = Box(x=(-500, 28_500), y=(4_000, 41_000), z=(120, 4_800))
SENSORS = ("click", "error", "purchase", "signup", "view")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq_id, frame_index, frame_timestamp_ns, sensor_name, point_id, object_id, x, y, z, intensity, row_index, col_index, range."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("int")
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    # A generator of one row: filters on what is derived from k stay above it, so the text is parsed once a row.
    rows = events.select("event_id", "ts", "user_id", "event_type", "value", F.explode(F.array(k)).alias("k"), day.alias("day"))
    object_id = (F.col("user_id") % 10).cast("int")
    rows = rows.select(
        F.lit("s0").alias("seq_id"), F.col("day").cast("int").alias("frame_index"), (F.col("day").cast("long") * 86_400_000_000_000).alias("frame_timestamp_ns"), F.col("event_type").alias("sensor_name"),
        F.col("event_id").alias("point_id"), object_id.alias("object_id"),
        (object_id * 3000 + (F.col("k") % 10) * 40).cast("long").alias("x"), (40_000 - 1200 * F.col("day") + F.floor(F.col("k") / 10) * 40).cast("long").alias("y"),
        (500 + (F.round(F.col("value") * 100).cast("long") % 100) * 3).cast("long").alias("z"), F.col("value").alias("intensity"),
    )
    r = F.sqrt(F.col("x").cast("double") * F.col("x") + F.col("y").cast("double") * F.col("y") + F.col("z").cast("double") * F.col("z"))
    return rows.withColumn("row_index", F.floor(F.col("z") / 60).cast("int")).withColumn("col_index", F.floor(F.col("x") / 250).cast("int")).withColumn("range", r)


#: The same table for the oracles.
POINTS_SQL = """
k0 AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day FROM events),
points AS (SELECT 's0' AS seq_id, CAST(day AS INTEGER) AS frame_index, CAST(day AS BIGINT) * 86400000000000 AS frame_timestamp_ns, event_type AS sensor_name, event_id AS point_id, CAST(user_id % 10 AS INTEGER) AS object_id,
  CAST((user_id % 10) * 3000 + (k % 10) * 40 AS BIGINT) AS x, CAST(40000 - 1200 * day + (k // 10) * 40 AS BIGINT) AS y, CAST(500 + (CAST(round(value * 100) AS BIGINT) % 100) * 3 AS BIGINT) AS z, value AS intensity FROM k0),
cells0 AS (SELECT *, CAST(floor(z / 60) AS INTEGER) AS row_index, CAST(floor(x / 250) AS INTEGER) AS col_index, sqrt(x::DOUBLE * x + y::DOUBLE * y + z::DOUBLE * z) AS range FROM points),
lane AS (SELECT * FROM cells0 WHERE x BETWEEN -500 AND 28500 AND y BETWEEN 4000 AND 41000 AND z BETWEEN 120 AND 4800)
"""
