"""Every query of the engine over the driver's tables, and its oracle in DuckDB's SQL.

Objects of the events cloud (``object_id``) stand for tracks where a query
starts from known tracks. Compared numbers are whole: results of floating
steps are given in thousandths.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import milli, range_corrected, row_index
from ..operators import association, clustering, crop, evaluate, fusion, groups, postprocess, reports, selection, tracking
from ..sources.events import LANE, POINTS_SQL, points
from ..sources.scratch import scratch
from . import pipeline
from .config import Spec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

OBS_SQL = """, obs AS (SELECT seq_id, object_id AS track_id, frame_index AS frame_id, min(frame_timestamp_ns) AS ts_ns, count(*) AS n_points,
  avg(x) AS cx, avg(y) AS cy, avg(z) AS cz, min(x) AS min_x, min(y) AS min_y, min(z) AS min_z, max(x) AS max_x, max(y) AS max_y, max(z) AS max_z FROM lane GROUP BY ALL),
obs2 AS (SELECT * FROM obs WHERE (frame_id * 7 + track_id * 3) % 5 <> 0)"""


def m(sql: str) -> str:
    """Thousandths in the oracle."""
    return f"CAST(floor(({sql}) * 1000 + 0.500001) AS BIGINT)"


def query(oracle: str | None = None, ctes: str = ""):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            recursive = "RECURSIVE " if "UNION" in ctes else ""
            ORACLES[f.__name__] = f"WITH {recursive}{POINTS_SQL}{OBS_SQL}{', ' + ctes if ctes else ''} {oracle}"
        return f

    return add


def lane(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crop.lane_crop(points(spark, sf_dir), LANE)


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations of the objects in the lane."""
    bounds = [f(a).alias(f"{n}_{a}") for n, f in (("min", F.min), ("max", F.max)) for a in "xyz"]
    rows = lane(spark, sf_dir).groupBy("seq_id", F.col("object_id").alias("track_id"), F.col("frame_index").alias("frame_id"))
    return rows.agg(F.min("frame_timestamp_ns").alias("ts_ns"), F.count("*").alias("n_points"), *[F.avg(F.col(a).cast("double")).alias(f"c{a}") for a in "xyz"], *bounds)


def obs2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with gaps."""
    return obs(spark, sf_dir).where((F.col("frame_id") * 7 + F.col("track_id") * 3) % 5 != 0)


def ages(rows: DataFrame) -> DataFrame:
    return rows.groupBy("seq_id", "track_id").agg((F.max("frame_id") - F.min("frame_id") + 1).alias("age"), F.count("*").alias("hit_count"), (29 - F.max("frame_id")).alias("missed"), (F.max("frame_id") < 27).alias("ended_by_missed"))


def as_long(*names: str) -> list:
    return [F.col(n).cast("long").alias(n) for n in names]


# --- points ---------------------------------------------------------------


@query(f"SELECT frame_index, CAST(floor(x / 250) AS BIGINT) AS vx, CAST(floor(y / 250) AS BIGINT) AS vy, CAST(floor(z / 250) AS BIGINT) AS vz, count(*) AS n, {m('avg(x)')} AS x, {m('avg(y)')} AS y, {m('avg(z)')} AS z FROM lane GROUP BY 1, 2, 3, 4")
def lane_voxel_mean(spark, sf_dir):
    rows = fusion.voxel_mean(lane(spark, sf_dir), ["frame_index"], 250)
    return rows.select("frame_index", *as_long("vx", "vy", "vz"), "n", *[milli(F.col(a)).alias(a) for a in "xyz"])


@query("SELECT frame_index, sensor_name, count(*) AS n, CAST(sum(x) AS BIGINT) AS sx, CAST(sum(y) AS BIGINT) AS sy, CAST(sum(z) AS BIGINT) AS sz FROM lane GROUP BY 1, 2")
def lane_crop(spark, sf_dir):
    return lane(spark, sf_dir).groupBy("frame_index", "sensor_name").agg(F.count("*").alias("n"), *[F.sum(a).alias(f"s{a}") for a in "xyz"])


@query("SELECT frame_index, count(*) AS n, CAST(sum(point_id) AS BIGINT) AS ids FROM lane WHERE range BETWEEN 5000 AND 30000 AND row_index >= 9 GROUP BY 1")
def sensor_crop(spark, sf_dir):
    return crop.sensor_crop(points(spark, sf_dir), LANE, 5000, 30_000, 9).groupBy("frame_index").agg(F.count("*").alias("n"), F.sum("point_id").alias("ids"))


@query("SELECT frame_index, count(*) AS n, count(DISTINCT sensor_name) AS sensors FROM (SELECT *, count(*) OVER (PARTITION BY frame_index) AS c FROM lane) WHERE c >= 330 GROUP BY 1")
def frame_gate(spark, sf_dir):
    return crop.frames_with_enough(lane(spark, sf_dir), 330).groupBy("frame_index").agg(F.count("*").alias("n"), F.countDistinct("sensor_name").alias("sensors"))


@query("SELECT object_id, frame_index, count(*) AS n, count(v) FILTER (ok) AS lit FROM (SELECT *, bool_and(v IS NOT NULL) OVER (PARTITION BY object_id, frame_index) AS ok FROM (SELECT *, CASE WHEN point_id % 97 <> 0 THEN intensity END AS v FROM lane)) GROUP BY 1, 2")
def optional_column_all_or_none(spark, sf_dir):
    rows = lane(spark, sf_dir).withColumn("intensity", F.when(F.col("point_id") % 97 != 0, F.col("intensity")))
    return crop.all_or_none(rows, "intensity", ["object_id", "frame_index"]).groupBy("object_id", "frame_index").agg(F.count("*").alias("n"), F.count("intensity").alias("lit"))


@query("SELECT frame_index, frame_timestamp_ns, previous_ns FROM (SELECT *, lag(frame_timestamp_ns) OVER (ORDER BY frame_index) AS previous_ns FROM (SELECT DISTINCT frame_index, frame_timestamp_ns - CASE WHEN frame_index % 7 = 3 THEN 200000000000000 ELSE 0 END AS frame_timestamp_ns FROM points)) WHERE frame_timestamp_ns < previous_ns")
def backwards_frames(spark, sf_dir):
    late = F.when(F.col("frame_index") % 7 == 3, 200_000_000_000_000).otherwise(0)
    frames = points(spark, sf_dir).select("seq_id", "frame_index", (F.col("frame_timestamp_ns") - late).alias("frame_timestamp_ns")).distinct()
    return crop.backwards_frames(frames).drop("seq_id")


LABELS = "labels0 AS (SELECT CASE WHEN frame_index < 11 THEN 's0' ELSE 's1' END AS seq_id, object_id, frame_timestamp_ns AS timestamp_ns, frame_index, point_id AS row_id, point_id % 3 AS point_count FROM points WHERE (frame_index + object_id) % 3 <> 0), latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seq_id, object_id ORDER BY timestamp_ns DESC, frame_index DESC, row_id) AS rn FROM labels0 WHERE point_count > 0) WHERE rn = 1)"


def label_rows(spark, sf_dir):
    return points(spark, sf_dir).where((F.col("frame_index") + F.col("object_id")) % 3 != 0).select("seq_id", "object_id", F.col("frame_timestamp_ns").alias("timestamp_ns"), "frame_index", F.col("point_id").alias("row_id"), (F.col("point_id") % 3).alias("point_count"))


@query("SELECT seq_id, object_id, timestamp_ns, frame_index, row_id FROM latest", LABELS)
def latest_object_labels(spark, sf_dir):
    rows = label_rows(spark, sf_dir).withColumn("seq_id", F.when(F.col("frame_index") < 11, "s0").otherwise("s1"))
    return crop.latest_labels(rows).select("seq_id", "object_id", "timestamp_ns", "frame_index", "row_id")


@query("SELECT frame_index, row_index, col_index, count(*) AS n FROM (SELECT frame_index, CAST(list_position(g, list_min(g)) - 1 AS INTEGER) AS row_index, CAST(floor((atan2(y, x) + 3.141592653589793) / (2 * 3.141592653589793) * 64) % 64 AS INTEGER) AS col_index FROM (SELECT *, [abs(asin(z / range) - b) for b in [0.0::DOUBLE, 0.02, 0.04, 0.08, 0.16]] AS g FROM lane)) GROUP BY 1, 2, 3")
def sensor_rows_and_columns(spark, sf_dir):
    from ..functions.geometry import column_index

    rows = lane(spark, sf_dir).withColumn("row_index", row_index([0.0, 0.02, 0.04, 0.08, 0.16])).withColumn("col_index", column_index(F.lit(64)))
    return rows.groupBy("frame_index", "row_index", "col_index").agg(F.count("*").alias("n"))


@query(f"SELECT sensor_name, object_id, {m('max(intensity * range * range / 1e6)')} AS top, {m('min(intensity * range * range / 1e6)')} AS low FROM lane GROUP BY 1, 2")
def range_corrected_intensity(spark, sf_dir):
    v = range_corrected(F.col("intensity"), F.col("range")) / 1e6
    return lane(spark, sf_dir).groupBy("sensor_name", "object_id").agg(milli(F.max(v)).alias("top"), milli(F.min(v)).alias("low"))


@query()
def visual_subsample(spark, sf_dir):
    return reports.visual_subsample(lane(spark, sf_dir), 50).select("frame_index", "point_id")


@query(f"SELECT sensor_name, point_id, {m('greatest(0.0, least(1.0, (lg - low) / greatest(high - low, 1e-9)))')} AS gray FROM (SELECT *, ln(1 + greatest(intensity, 0)) AS lg FROM lane) JOIN (SELECT sensor_name, quantile_cont(ln(1 + greatest(intensity, 0)), 0.05) AS low, quantile_cont(ln(1 + greatest(intensity, 0)), 0.95) AS high FROM lane GROUP BY 1) USING (sensor_name)")
def intensity_grayscale(spark, sf_dir):
    return reports.grayscale(lane(spark, sf_dir), ["sensor_name"]).select("sensor_name", "point_id", milli(F.col("gray")).alias("gray"))


# --- clusters -------------------------------------------------------------

VOXEL_CC = """vox AS (SELECT DISTINCT frame_index AS f, CAST(floor(x / 250) AS BIGINT) AS a, CAST(floor(y / 250) AS BIGINT) AS b, CAST(floor(z / 250) AS BIGINT) AS c FROM lane),
adj AS (SELECT v.f, v.a, v.b, v.c, w.a AS a2, w.b AS b2, w.c AS c2 FROM vox v JOIN vox w ON v.f = w.f AND abs(v.a - w.a) <= 1 AND abs(v.b - w.b) <= 1 AND abs(v.c - w.c) <= 1),
reach AS (SELECT f, a, b, c, a AS a2, b AS b2, c AS c2 FROM vox UNION SELECT r.f, r.a, r.b, r.c, j.a2, j.b2, j.c2 FROM reach r JOIN adj j ON r.f = j.f AND r.a2 = j.a AND r.b2 = j.b AND r.c2 = j.c),
root AS (SELECT f, a, b, c, min((a2, b2, c2)) AS root FROM reach GROUP BY ALL)"""


@query("SELECT frame_index, count(*) AS n, min(point_id) AS least_id, max(point_id) AS most_id FROM lane JOIN root ON f = frame_index AND a = floor(x / 250) AND b = floor(y / 250) AND c = floor(z / 250) GROUP BY frame_index, root.root", VOXEL_CC)
def voxel_components(spark, sf_dir):
    rows = clustering.cluster_voxels(lane(spark, sf_dir), 250)
    return rows.groupBy("frame_index", "label").agg(F.count("*").alias("n"), F.min("point_id").alias("least_id"), F.max("point_id").alias("most_id")).drop("label")


def density_sql(source: str, eps: int, least: int) -> str:
    """Every point of ``source`` with the least core point of its cluster (null: noise), by the definition: pairs, degrees, reachability."""
    return f"""near AS (SELECT p.frame_index AS f, p.point_id AS a, q.point_id AS b FROM {source} p JOIN {source} q ON p.frame_index = q.frame_index AND (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) + (p.z - q.z) * (p.z - q.z) <= {eps * eps}),
core AS (SELECT f, a FROM near GROUP BY 1, 2 HAVING count(*) >= {least}),
hop AS (SELECT near.f, near.a, near.b FROM near JOIN core x ON x.f = near.f AND x.a = near.a JOIN core y ON y.f = near.f AND y.a = near.b),
dreach AS (SELECT f, a, a AS b FROM core UNION SELECT r.f, r.a, h.b FROM dreach r JOIN hop h ON h.f = r.f AND h.a = r.b),
droot AS (SELECT f, a, min(b) AS root FROM dreach GROUP BY 1, 2),
owner AS (SELECT near.f, near.a, coalesce(max(CASE WHEN near.a = near.b THEN r.root END), arg_min(r.root, near.b)) AS root FROM near JOIN droot r ON r.f = near.f AND r.a = near.b GROUP BY 1, 2),
found AS (SELECT s.frame_index, s.point_id, o.root, CASE WHEN o.root IS NOT NULL THEN dense_rank() OVER (PARTITION BY s.frame_index ORDER BY o.root NULLS LAST) - 1 ELSE -1 END AS label FROM {source} s LEFT JOIN owner o ON o.f = s.frame_index AND o.a = s.point_id)"""


CLUSTERS_OUT = "SELECT frame_index, CAST(label AS INTEGER) AS label, count(*) AS n, min(point_id) AS least_id, CAST(sum(point_id) AS BIGINT) AS ids FROM found GROUP BY 1, 2"


def cluster_sums(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("frame_index", "label").agg(F.count("*").alias("n"), F.min("point_id").alias("least_id"), F.sum("point_id").alias("ids"))


@query(CLUSTERS_OUT, density_sql("lane", 700, 3))
def dbscan_clusters(spark, sf_dir):
    return cluster_sums(clustering.cluster_dbscan(lane(spark, sf_dir), 700, 3))


@query(CLUSTERS_OUT, density_sql("lane", 700, 1))
def euclidean_clusters(spark, sf_dir):
    return cluster_sums(clustering.cluster_euclidean(lane(spark, sf_dir), 700))


#: Planes through points drawn by a hash, 40 a frame; the best one removes its points if it is level.
GROUND = """pool AS (SELECT * FROM (SELECT frame_index, x::DOUBLE AS x, y::DOUBLE AS y, z::DOUBLE AS z, row_number() OVER (PARTITION BY frame_index ORDER BY md5('0|s0|' || frame_index || '|' || point_id), point_id) - 1 AS place FROM lane) WHERE place < 120),
pm AS (SELECT frame_index, count(*) AS m FROM pool GROUP BY 1 HAVING count(*) >= 3),
hyp AS (SELECT frame_index, m, s, (3 * s) // m AS turn FROM pm, range(0, 40) r(s)),
tri AS (SELECT h.frame_index, h.s, a.x AS qx, a.y AS qy, a.z AS qz, b.x - a.x AS bx, b.y - a.y AS by_, b.z - a.z AS bz, c.x - a.x AS cx, c.y - a.y AS cy, c.z - a.z AS cz FROM hyp h
  JOIN pool a ON a.frame_index = h.frame_index AND a.place = (3 * s) % m JOIN pool b ON b.frame_index = h.frame_index AND b.place = (3 * s + 1 + turn) % m JOIN pool c ON c.frame_index = h.frame_index AND c.place = (3 * s + 2 + 2 * turn) % m),
nrm AS (SELECT *, by_ * cz - bz * cy AS ux, bz * cx - bx * cz AS uy, bx * cy - by_ * cx AS uz FROM tri),
pln AS (SELECT frame_index, s, qx, qy, qz, ux / norm AS nx, uy / norm AS ny, uz / norm AS nz FROM (SELECT *, sqrt(ux * ux + uy * uy + uz * uz) AS norm FROM nrm) WHERE norm >= 1e-9),
cnt AS (SELECT p.frame_index, p.s, count(*) AS inliers FROM pln p JOIN lane l ON l.frame_index = p.frame_index AND abs((l.x - qx) * nx + (l.y - qy) * ny + (l.z - qz) * nz) <= 60 GROUP BY 1, 2),
best AS (SELECT frame_index, s FROM (SELECT *, row_number() OVER (PARTITION BY frame_index ORDER BY inliers DESC, s) AS rn FROM cnt) WHERE rn = 1),
grd AS (SELECT p.* FROM pln p JOIN best USING (frame_index, s)),
above AS (SELECT l.* FROM lane l LEFT JOIN grd g ON g.frame_index = l.frame_index WHERE NOT coalesce(abs(nz) >= 0.05 AND abs((l.x - qx) * nx + (l.y - qy) * ny + (l.z - qz) * nz) <= 60, false))"""


@query(CLUSTERS_OUT + " UNION ALL SELECT frame_index, -2 AS label, count(*), min(point_id), CAST(sum(point_id) AS BIGINT) FROM lane WHERE (frame_index, point_id) NOT IN (SELECT (frame_index, point_id) FROM above) GROUP BY 1", GROUND + ", " + density_sql("above", 700, 3))
def ground_removed_clusters(spark, sf_dir):
    return cluster_sums(clustering.cluster_ground_removed(lane(spark, sf_dir), 700, 3, distance=60, samples=40, normal_z_min=0.05))


@query(f"SELECT l.frame_index, count(*) FILTER (a.point_id IS NULL) AS ground_removed_count, {m('any_value(CASE WHEN abs(nz) >= 0.05 THEN nz END)')} AS model_nz FROM lane l LEFT JOIN above a ON a.frame_index = l.frame_index AND a.point_id = l.point_id LEFT JOIN grd g ON g.frame_index = l.frame_index GROUP BY 1", GROUND)
def ground_plane_metrics(spark, sf_dir):
    rows = lane(spark, sf_dir)
    planes = clustering.ground_planes(rows, 60, 40)
    labelled = clustering.without_ground(rows, planes, 60, 0.05).withColumn("label", F.when(F.col("ground"), -2).otherwise(0))
    return clustering.ground_metrics(labelled, planes, 0.05).select("frame_index", "ground_removed_count", milli(F.col("ground_model")[2]).alias("model_nz"))


@query()
def hdbscan_clusters(spark, sf_dir):
    return clustering.cluster_hdbscan(lane(spark, sf_dir), 8, 4).groupBy("frame_index", "label").agg(F.count("*").alias("n"))


def by_object(spark, sf_dir):
    return lane(spark, sf_dir).withColumn("label", F.col("object_id"))


DET = "det AS (SELECT *, row_number() OVER (PARTITION BY frame_index ORDER BY label) AS detection_id FROM (SELECT frame_index, object_id AS label, count(*) AS point_count, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y FROM lane GROUP BY 1, 2) WHERE point_count BETWEEN 25 AND 45)"


@query(f"SELECT frame_index, CAST(detection_id AS INTEGER) AS detection_id, point_count, {m('cx')} AS cx, {m('cy')} AS cy, {m('cz')} AS cz, min_x, max_y FROM det", DET)
def detections(spark, sf_dir):
    rows = clustering.detections(by_object(spark, sf_dir), 25, 45)
    return rows.select("frame_index", "detection_id", "point_count", *[milli(F.col(f"c{a}")).alias(f"c{a}") for a in "xyz"], "min_x", "max_y")


@query("SELECT frame_index, count(*) AS raw_clusters, count(*) FILTER (n BETWEEN 30 AND 40) AS accepted, count(*) FILTER (n < 30) AS rejected_small, count(*) FILTER (n > 40) AS rejected_large FROM (SELECT frame_index, object_id, count(*) AS n FROM lane GROUP BY 1, 2) GROUP BY 1")
def cluster_size_gate(spark, sf_dir):
    return clustering.cluster_metrics(by_object(spark, sf_dir), 30, 40).drop("seq_id")


CELLS = "cells AS (SELECT frame_index, sensor_name, row_index, col_index, count(*) AS point_count, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz, avg(range) AS mean_range FROM lane GROUP BY 1, 2, 3, 4)"


@query(f"SELECT frame_index, sensor_name, row_index, col_index, point_count, {m('cx')} AS cx, {m('cy')} AS cy, {m('cz')} AS cz FROM cells", CELLS)
def sensor_cells(spark, sf_dir):
    return clustering.sensor_cells(lane(spark, sf_dir)).select("frame_index", "sensor_name", "row_index", "col_index", "point_count", *[milli(F.col(c)).alias(c) for c in ("cx", "cy", "cz")])


def cell_link_sql(factor: float, center: bool) -> str:
    near = " AND (a.cx - b.cx) * (a.cx - b.cx) + (a.cy - b.cy) * (a.cy - b.cy) + (a.cz - b.cz) * (a.cz - b.cz) <= 300.0 * 300.0" if center else ""
    return f"""{CELLS}, links AS (SELECT a.frame_index, a.sensor_name, a.row_index AS r1, a.col_index AS c1, b.row_index AS r2, b.col_index AS c2 FROM cells a JOIN cells b ON a.frame_index = b.frame_index AND a.sensor_name = b.sensor_name
      AND abs(a.row_index - b.row_index) <= 1 AND abs(a.col_index - b.col_index) <= 1 AND (a.row_index, a.col_index) < (b.row_index, b.col_index)
      AND abs(a.mean_range - b.mean_range) <= greatest(90.0 * {factor}, least(a.mean_range, b.mean_range) * 0.004 * {factor}){near})"""


def links_of(spark, sf_dir, rule):
    cells = clustering.sensor_cells(lane(spark, sf_dir))
    return cells, clustering.cell_links(cells, rule, 90.0, 0.004, 300.0)


LINK_OUT = "SELECT frame_index, sensor_name, count(*) AS links, CAST(sum(r1 * 100 + c1) AS BIGINT) AS firsts, CAST(sum(r2 * 100 + c2) AS BIGINT) AS seconds FROM links GROUP BY 1, 2"


def link_sums(links):
    code = lambda c: F.sum(F.col(f"{c}.row_index") * 100 + F.col(f"{c}.col_index"))
    return links.groupBy("frame_index", "sensor_name").agg(F.count("*").alias("links"), code("a").alias("firsts"), code("b").alias("seconds"))


@query(LINK_OUT, cell_link_sql(1.5, False))
def range_image_connected_links(spark, sf_dir):
    return link_sums(links_of(spark, sf_dir, "range_image_connected_components")[1])


@query(LINK_OUT, cell_link_sql(1.0, False))
def range_image_depth_jump_links(spark, sf_dir):
    return link_sums(links_of(spark, sf_dir, "range_image_depth_jump")[1])


@query(LINK_OUT, cell_link_sql(1.5, True))
def beam_neighbor_links(spark, sf_dir):
    return link_sums(links_of(spark, sf_dir, "beam_neighbor_region_growing")[1])


@query(
    "SELECT frame_index, sensor_name, CAST(sum(point_count) AS BIGINT) AS n, count(*) AS cells, min(row_index * 100 + col_index) AS least_cell FROM cells JOIN croot USING (frame_index, sensor_name, row_index, col_index) GROUP BY frame_index, sensor_name, root HAVING sum(point_count) >= 3",
    cell_link_sql(1.0, False) + """, both_ways AS (SELECT * FROM links UNION ALL SELECT frame_index, sensor_name, r2, c2, r1, c1 FROM links),
    creach AS (SELECT frame_index, sensor_name, row_index, col_index, row_index AS r, col_index AS c FROM cells UNION SELECT q.frame_index, q.sensor_name, q.row_index, q.col_index, l.r2, l.c2 FROM creach q JOIN both_ways l ON q.frame_index = l.frame_index AND q.sensor_name = l.sensor_name AND q.r = l.r1 AND q.c = l.c1),
    croot AS (SELECT frame_index, sensor_name, row_index, col_index, min(r * 100 + c) AS root FROM creach GROUP BY 1, 2, 3, 4)""",
)
def sensor_cell_components(spark, sf_dir):
    cells, links = links_of(spark, sf_dir, "range_image_depth_jump")
    found = clustering.cell_components(cells, links, 3)
    return found.groupBy("frame_index", "sensor_name", "component").agg(F.sum("point_count").alias("n"), F.count("*").alias("cells"), F.min(F.col("row_index") * 100 + F.col("col_index")).alias("least_cell")).drop("component")


# --- association and tracking ---------------------------------------------


def steps(spark, sf_dir):
    rows = obs(spark, sf_dir).select(F.col("frame_id").alias("frame"), F.col("track_id").alias("id"), "cx", "cy", "cz", *[(F.col(f"max_{a}") - F.col(f"min_{a}")).cast("double").alias(f"e{a}") for a in "xyz"])
    return rows, rows.withColumn("frame", F.col("frame") - 1)


COST = """e AS (SELECT frame_id AS frame, track_id AS id, cx, cy, cz, max_x - min_x AS ex, max_y - min_y AS ey, max_z - min_z AS ez FROM obs),
cost AS (SELECT a.frame, a.id AS left_id, b.id AS right_id, sqrt((a.cx - b.cx) * (a.cx - b.cx) + (a.cy - b.cy) * (a.cy - b.cy) + (a.cz - b.cz) * (a.cz - b.cz))
  + 150.0 * (abs(a.ex - b.ex) / greatest(a.ex, b.ex, 0.001) + abs(a.ey - b.ey) / greatest(a.ey, b.ey, 0.001) + abs(a.ez - b.ez) / greatest(a.ez, b.ez, 0.001)) / 3 AS cost FROM e a JOIN e b ON a.frame = b.frame - 1)"""


@query("SELECT frame, left_id, right_id, CAST(floor(cost + 0.5) AS BIGINT) AS cost FROM cost", COST)
def cost_matrix(spark, sf_dir):
    return association.cost_pairs(*steps(spark, sf_dir), ["frame"], 150.0).withColumn("cost", F.floor(F.col("cost") + 0.5))


@query("SELECT frame, count(*) AS pairs, count(*) FILTER (left_id = right_id) AS own FROM cost WHERE cost <= 3400 GROUP BY 1", COST)
def gated_pairs(spark, sf_dir):
    rows = association.gated(association.cost_pairs(*steps(spark, sf_dir), ["frame"], 150.0), 3400.0)
    return rows.groupBy("frame").agg(F.count("*").alias("pairs"), F.count_if(F.col("left_id") == F.col("right_id")).alias("own"))


@query("SELECT frame, left_id, right_id, CAST(floor(cost + 0.5) AS BIGINT) AS cost FROM cost WHERE left_id = right_id AND cost <= 3400", COST)
def gated_assignment(spark, sf_dir):
    """Neighbouring lanes contend within the gate; the least total keeps each object with itself."""
    pairs = association.gated(association.cost_pairs(*steps(spark, sf_dir), ["frame"], 150.0), 3400.0)
    return association.assign(pairs, ["frame"]).select("frame", "left_id", "right_id", F.floor(F.col("cost") + 0.5).alias("cost"))


@query("SELECT track_id, frame_id FROM obs o WHERE NOT EXISTS (SELECT 1 FROM obs2 p WHERE p.track_id = o.track_id AND p.frame_id = o.frame_id)")
def unmatched_observations(spark, sf_dir):
    return association.unmatched(obs(spark, sf_dir), obs2(spark, sf_dir), ["track_id", "frame_id"]).select("track_id", "frame_id")


@query(f"SELECT a.track_id AS a, b.track_id AS b, count(*) AS overlap, {m('count(*) / least(any_value(na.n), any_value(nb.n))')} AS ratio FROM obs2 a JOIN obs2 b ON a.frame_id = b.frame_id AND a.track_id < b.track_id JOIN (SELECT track_id, count(*) AS n FROM obs2 GROUP BY 1) na ON na.track_id = a.track_id JOIN (SELECT track_id, count(*) AS n FROM obs2 GROUP BY 1) nb ON nb.track_id = b.track_id GROUP BY 1, 2")
def frame_overlap(spark, sf_dir):
    return association.frame_overlap(obs2(spark, sf_dir)).select("a", "b", "overlap", milli(F.col("ratio")).alias("ratio"))


def tracklets(spark, sf_dir):
    rows = obs(spark, sf_dir).where("frame_id % 6 < 4")
    return rows.withColumn("track_id", (F.col("track_id") * 10 + F.floor(F.col("frame_id") / 6)).cast("int"))


TRACKLETS = "tl AS (SELECT *, track_id * 10 + frame_id // 6 AS t FROM obs WHERE frame_id % 6 < 4), ends AS (SELECT t, min(frame_id) AS first, max(frame_id) AS last, arg_min([cx, cy, cz], frame_id) AS head, arg_max([cx, cy, cz], frame_id) AS tail FROM tl GROUP BY 1)"


@query("SELECT CAST(a.t AS INTEGER) AS a, CAST(b.t AS INTEGER) AS b FROM ends a JOIN ends b ON b.first - a.last BETWEEN 1 AND 3 AND list_distance(a.tail, b.head) <= 4300", TRACKLETS)
def gap_pairs(spark, sf_dir):
    return association.gap_pairs(tracklets(spark, sf_dir), 3, 4300).select("a", "b")


@query("SELECT CAST(t AS INTEGER) AS track_id, CAST(t // 10 * 10 AS INTEGER) AS new_id FROM ends", TRACKLETS)
def tracklet_stitching(spark, sf_dir):
    rows = tracklets(spark, sf_dir)
    return postprocess.stitch(rows, association.gap_pairs(rows, 3, 4300)).select("track_id", "new_id")


MM = {"max_dist": 3400.0, "sticky_extra_dist_per_missed": 550.0, "sticky_max_dist": 6200.0, "kf_init_var": 5e6, "kf_process_var": 8e4, "kf_meas_var": 6e5, "association_size_weight": 150.0}


#: Objects with gaps of two frames, in five sequences of two objects each.
SEEN = "seen AS (SELECT *, 's' || (track_id % 5) AS seq FROM obs WHERE NOT (track_id % 2 = 0 AND frame_id % 10 IN (6, 7)))"
#: Runs of frames that a gate of 3.4 m without prediction doesn't break.
ISLANDS = SEEN + ", isl0 AS (SELECT *, CASE WHEN frame_id - lag(frame_id) OVER (PARTITION BY track_id ORDER BY frame_id) >= 3 THEN 1 ELSE 0 END AS cut FROM seen), isl AS (SELECT *, sum(cut) OVER (PARTITION BY track_id ORDER BY frame_id) AS part FROM isl0)"


def tracked(spark, sf_dir, algorithm):
    rows = by_object(spark, sf_dir).where(~((F.col("label") % 2 == 0) & (F.col("frame_index") % 10).isin(6, 7)))
    found = clustering.detections(rows.withColumn("seq_id", F.concat(F.lit("s"), F.col("label") % 5)), 1, 100_000)
    return found, tracking.track(found, tracking.TrackerConfig(algorithm, **MM))


def members(spark, sf_dir, algorithm):
    """Tracks and the one object each follows."""
    found, states = tracked(spark, sf_dir, algorithm)
    seen = states.where("detection_id IS NOT NULL").join(found.select("seq_id", F.col("frame_index").alias("frame_id"), "detection_id", "label"), ["seq_id", "frame_id", "detection_id"])
    rows = seen.groupBy("seq_id", "track_id").agg(F.min("label").alias("object_id"), F.countDistinct("label").alias("objects"), F.count("*").alias("hits"), F.min("frame_id").alias("first_frame"), F.max("frame_id").alias("last_frame"))
    return rows.drop("track_id")


MEMBERS = "SELECT seq AS seq_id, track_id AS object_id, 1::BIGINT AS objects, count(*) AS hits, min(frame_id) AS first_frame, max(frame_id) AS last_frame"


@query(MEMBERS + " FROM seen GROUP BY 1, 2", SEEN)
def tracker_kalman_nn(spark, sf_dir):
    return members(spark, sf_dir, "kalman_nn")


@query(MEMBERS + " FROM seen GROUP BY 1, 2", SEEN)
def tracker_hungarian_kalman(spark, sf_dir):
    return members(spark, sf_dir, "hungarian_kalman")


@query(MEMBERS + " FROM isl GROUP BY 1, 2, part", ISLANDS)
def tracker_euclidean_nn(spark, sf_dir):
    return members(spark, sf_dir, "euclidean_nn")


@query("SELECT f.seq AS seq_id, f.frame_id, count(*) FILTER (s.frame_id IS NOT NULL AND f.frame_id > first) AS matched, count(*) FILTER (s.frame_id IS NULL AND f.frame_id > first) AS missed, count(*) FILTER (f.frame_id = first) AS spawned, 0::BIGINT AS suppressed FROM fr f JOIN life l ON l.seq = f.seq LEFT JOIN seen s ON s.track_id = l.track_id AND s.frame_id = f.frame_id WHERE f.frame_id >= first GROUP BY 1, 2", SEEN + ", fr AS (SELECT DISTINCT seq, frame_id FROM seen), life AS (SELECT seq, track_id, min(frame_id) AS first FROM seen GROUP BY 1, 2)")
def frame_tracker_metrics(spark, sf_dir):
    return tracking.frame_metrics(tracked(spark, sf_dir, "kalman_nn")[1])


@query(
    "SELECT g.seq AS seq_id, g.frame_id, s.n_points AS n, s.max_x - s.min_x AS ex, s.max_y - s.min_y AS ey, s.max_z - s.min_z AS ez FROM gap g JOIN seen s ON s.track_id = g.track_id AND s.frame_id = g.last",
    SEEN + ", gap AS (SELECT f.seq, f.frame_id, l.track_id, (SELECT max(p.frame_id) FROM seen p WHERE p.track_id = l.track_id AND p.frame_id < f.frame_id) AS last FROM (SELECT DISTINCT seq, frame_id FROM seen) f JOIN (SELECT seq, track_id, min(frame_id) AS first FROM seen GROUP BY 1, 2) l ON l.seq = f.seq WHERE f.frame_id > l.first AND NOT EXISTS (SELECT 1 FROM seen s WHERE s.track_id = l.track_id AND s.frame_id = f.frame_id))",
)
def predicted_active_tracks(spark, sf_dir):
    """Points of tracks in the frames that missed them: as many and as wide as when last seen."""
    found, states = tracked(spark, sf_dir, "kalman_nn")
    rows = by_object(spark, sf_dir).withColumn("seq_id", F.concat(F.lit("s"), F.col("label") % 5))
    out = tracking.predicted_tracks(states, found, rows).groupBy("seq_id", "frame_id", "track_id")
    return out.agg(F.count("*").alias("n"), *[F.round(F.max(a) - F.min(a)).cast("long").alias(f"e{a}") for a in "xyz"]).drop("track_id")


@query(
    "SELECT seq AS seq_id, frame_id, count(*) FILTER (track_id % 2 = 1 AND frame_id < 4) AS suppressed, count(*) FILTER (NOT (track_id % 2 = 1 AND frame_id < 4) AND frame_id = first) AS spawned, count(*) FILTER (track_id % 3 = 0) AS halo, 'greedy' AS assignment_method FROM (SELECT *, min(CASE WHEN NOT (track_id % 2 = 1 AND frame_id < 4) THEN frame_id END) OVER (PARTITION BY track_id) AS first FROM seen) GROUP BY 1, 2",
    SEEN,
)
def spawn_suppression(spark, sf_dir):
    """Objects of odd number begin no track in the first four frames; a third of all detections is marked as halo."""
    found, _ = tracked(spark, sf_dir, "kalman_nn")
    found = found.withColumns({"spawn_suppressed": (F.col("label") % 2 == 1) & (F.col("frame_index") < 4), "tracking_halo_only": F.col("label") % 3 == 0})
    states = tracking.track(found, tracking.TrackerConfig("kalman_nn", **MM))
    return tracking.frame_metrics(states, found, "kalman_nn").select("seq_id", "frame_id", "suppressed", "spawned", "halo", "assignment_method")


@query(f"SELECT seq AS seq_id, frame_id, {m('cx')} AS cx, {m('cy')} AS cy, {m('cz')} AS cz FROM (SELECT *, max(frame_id) OVER (PARTITION BY track_id, part) AS last FROM isl) WHERE frame_id = last", ISLANDS)
def last_active_state(spark, sf_dir):
    return tracking.last_active(tracked(spark, sf_dir, "euclidean_nn")[1]).select("seq_id", "frame_id", *[milli(F.col(c)).alias(c) for c in ("cx", "cy", "cz")])


@query("SELECT seq AS seq_id, count(*) AS hit_count, max(frame_id) - min(frame_id) + 1 AS age, 0 AS missed, 1::BIGINT AS spawned_count, count(*) - 1 AS matched_count, max(frame_id) - min(frame_id) + 1 - count(*) AS missed_count, max(frame_id) AS last_frame FROM seen GROUP BY seq, track_id", SEEN)
def track_summary(spark, sf_dir):
    rows = tracking.tracks(tracked(spark, sf_dir, "kalman_nn")[1])
    return rows.select("seq_id", "hit_count", F.col("age").cast("long").alias("age"), "missed", "spawned_count", "matched_count", "missed_count", "last_frame")


@query(
    "SELECT track_id, CAST(floor(x + 0.5) AS BIGINT) AS x, CAST(floor(v + 0.5) AS BIGINT) AS v FROM kf WHERE (track_id, k) IN (SELECT track_id, max(k) FROM seqd GROUP BY 1)",
    """seqd AS (SELECT track_id, frame_id, cy AS z, row_number() OVER (PARTITION BY track_id ORDER BY frame_id) AS k FROM obs),
kf AS (SELECT track_id, k, z AS x, 0.0::DOUBLE AS v, 5e6::DOUBLE AS a, 0.0::DOUBLE AS b, 5e6::DOUBLE AS c FROM seqd WHERE k = 1
 UNION ALL SELECT s.track_id, s.k, p.px + p.pa / (p.pa + 6e5) * (s.z - p.px), p.v + p.pb / (p.pa + 6e5) * (s.z - p.px), (1 - p.pa / (p.pa + 6e5)) * p.pa, (1 - p.pa / (p.pa + 6e5)) * p.pb, p.pc - p.pb * p.pb / (p.pa + 6e5)
 FROM (SELECT track_id, k, x + v AS px, v, a + 2 * b + c + 8e4 AS pa, b + c AS pb, c + 8e4 AS pc FROM kf) p JOIN seqd s ON s.track_id = p.track_id AND s.k = p.k + 1)""",
)
def kalman_fold(spark, sf_dir):
    rows = tracking.kalman_fold(obs(spark, sf_dir), 5e6, 8e4, 6e5)
    return rows.select("track_id", F.floor(F.col("x") + 0.5).alias("x"), F.floor(F.col("v") + 0.5).alias("v"))


# --- tracks ---------------------------------------------------------------

CV = lambda c: f"stddev_pop({c}) / greatest(avg({c}), 1.0)"
QUALITY = f"""age AS (SELECT track_id, max(frame_id) - min(frame_id) + 1 AS age FROM obs2 GROUP BY 1),
q0 AS (SELECT track_id, count(*) AS n, {CV('n_points')} AS pcv, {CV('max_y - min_y')} AS lcv, {CV('max_x - min_x')} AS wcv, {CV('max_z - min_z')} AS hcv, quantile_cont((max_y - min_y)::DOUBLE, 0.75) AS p75 FROM obs2 GROUP BY 1),
qual AS (SELECT track_id, n, p75, 0.4 * least(1.0, n / greatest(age, 1)) + 0.3 * least(1.0, n / 20.0) + 0.2 * (1 / (1 + pcv + 0.5 * (wcv + hcv))) + 0.1 * (1 / (1 + lcv)) AS score FROM q0 JOIN age USING (track_id))"""


@query(f"SELECT track_id, n AS observation_count, {m('score')} AS quality_score, {m('p75')} AS extent_p75, p75 >= 360 AS is_long_vehicle FROM qual", QUALITY)
def track_quality_scoring(spark, sf_dir):
    rows = obs2(spark, sf_dir)
    out = postprocess.quality(rows, ages(rows), long_threshold=360)
    return out.select("track_id", "observation_count", milli(F.col("quality_score")).alias("quality_score"), milli(F.col("longitudinal_extent_p75")).alias("extent_p75"), "is_long_vehicle")


@query(f"SELECT track_id, frame_id, {m('avg(cx) OVER w')} AS cx, {m('avg(cy) OVER w')} AS cy, {m('avg(cz) OVER w')} AS cz FROM obs2 WINDOW w AS (PARTITION BY track_id ORDER BY frame_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)")
def trajectory_smoothing(spark, sf_dir):
    return postprocess.smooth(obs2(spark, sf_dir), 5).select("track_id", "frame_id", *[milli(F.col(c)).alias(c) for c in ("cx", "cy", "cz")])


SHARED = "sh AS (SELECT a.track_id AS a, b.track_id AS b, a.frame_id, a.cx AS acx, a.cy AS acy, a.cz AS acz, b.cx AS bcx, b.cy AS bcy, b.cz AS bcz, a.min_y AS aminy, a.max_y AS amaxy, b.min_y AS bminy, b.max_y AS bmaxy FROM obs2 a JOIN obs2 b ON a.frame_id = b.frame_id AND a.track_id < b.track_id), cm AS (SELECT a, b, count(*) AS overlap, avg(abs(bcx - acx)) AS lat, max(abs(bcy - acy)) AS lmax, stddev_pop(abs(bcy - acy)) AS lstd, avg(abs(bcz - acz)) AS vert, quantile_cont(bcy - acy, 0.5) AS lmed, arg_max(acx, frame_id) - arg_min(acx, frame_id) AS adx, arg_max(acy, frame_id) - arg_min(acy, frame_id) AS ady, arg_max(acz, frame_id) - arg_min(acz, frame_id) AS adz, arg_max(bcx, frame_id) - arg_min(bcx, frame_id) AS bdx, arg_max(bcy, frame_id) - arg_min(bcy, frame_id) AS bdy, arg_max(bcz, frame_id) - arg_min(bcz, frame_id) AS bdz FROM sh GROUP BY 1, 2)"


@query(f"SELECT a, b, overlap, {m('lat')} AS lateral_mean, {m('lmax')} AS longitudinal_max, {m('lstd')} AS longitudinal_std, {m('vert')} AS vertical_mean, {m('lmed')} AS longitudinal_median FROM cm", SHARED)
def co_moving_metrics(spark, sf_dir):
    names = ("lateral_mean", "longitudinal_max", "longitudinal_std", "vertical_mean", "longitudinal_median")
    return postprocess.co_moving_metrics(obs2(spark, sf_dir)).select("a", "b", "overlap", *[milli(F.col(c)).alias(c) for c in names])


COUNTS = ", na AS (SELECT track_id, count(*) AS n FROM obs2 GROUP BY 1)"


@query("SELECT a, b, overlap FROM cm JOIN na x ON x.track_id = a JOIN na y ON y.track_id = b WHERE overlap >= 5 AND overlap / least(x.n, y.n) >= 0.6 AND lat <= 6100 AND lmax <= 400 AND lstd <= 500 AND vert <= 6100 AND (adx * bdx + ady * bdy + adz * bdz) / (sqrt(adx * adx + ady * ady + adz * adz) * sqrt(bdx * bdx + bdy * bdy + bdz * bdz)) >= 0.85 AND abs(ady - bdy) / (overlap - 1) <= 500", SHARED + COUNTS)
def co_moving_pairs(spark, sf_dir):
    return postprocess.co_moving_pairs(obs2(spark, sf_dir), 6100, 400, 5, 0.6, scale=1000).select("a", "b", "overlap")


MOTION = "mo AS (SELECT track_id, CASE WHEN sum(step) < 0 THEN -1 ELSE 1 END AS direction, arg_max(cy, frame_id) - arg_min(cy, frame_id) AS displacement, regr_slope(min_y, frame_id) FILTER (back <= 8) AS s1, regr_slope(max_y, frame_id) FILTER (back <= 8) AS s2 FROM (SELECT *, cy - lag(cy) OVER (PARTITION BY track_id ORDER BY frame_id) AS step, row_number() OVER (PARTITION BY track_id ORDER BY frame_id DESC) AS back FROM obs2) GROUP BY 1)"


@query(f"SELECT track_id, direction, {m('displacement')} AS displacement, {m('CASE WHEN direction > 0 THEN s1 ELSE s2 END')} AS rear_slope FROM mo", MOTION)
def motion_similarity(spark, sf_dir):
    return postprocess.motion(obs2(spark, sf_dir), last=8).select("track_id", "direction", milli(F.col("displacement")).alias("displacement"), milli(F.col("rear_slope")).alias("rear_slope"))


ART = SHARED + """, dr AS (SELECT a, b, CASE WHEN abs(ady + bdy) > 0.001 THEN sign(ady + bdy) WHEN abs(ady) > 0.001 THEN sign(ady) WHEN abs(bdy) > 0.001 THEN sign(bdy) ELSE 0 END AS direction FROM cm),
gp AS (SELECT sh.*, direction, (acy - bcy) * direction AS ahead, row_number() OVER (PARTITION BY a, b ORDER BY frame_id DESC) AS back,
  CASE WHEN direction < 0 THEN -amaxy ELSE aminy END AS arear, CASE WHEN direction < 0 THEN -aminy ELSE amaxy END AS afront, CASE WHEN direction < 0 THEN -bmaxy ELSE bminy END AS brear, CASE WHEN direction < 0 THEN -bminy ELSE bmaxy END AS bfront FROM sh JOIN dr USING (a, b)),
md AS (SELECT a, b, quantile_cont(ahead, 0.5) AS ahead_median FROM gp GROUP BY 1, 2),
gq AS (SELECT gp.*, ahead_median, CASE WHEN ahead_median > 0 THEN arear - bfront ELSE brear - afront END AS gap FROM gp JOIN md USING (a, b)),
ar0 AS (SELECT a, b, any_value(direction) AS direction, count(*) AS overlap, count(*) FILTER (back <= 5) AS tail_count, avg(abs(acx - bcx)) AS lateral_mean, avg(abs(acz - bcz)) AS vertical_mean, any_value(ahead_median) AS ahead_median, avg((ahead > 0)::INT) AS ahead_share, avg((ahead < 0)::INT) AS behind_share,
  avg(gap) AS full_mean, stddev_pop(gap) AS full_std, avg(gap) FILTER (back <= 5) AS tail_mean, stddev_pop(gap) FILTER (back <= 5) AS tail_std, min(gap) AS gap_min, quantile_cont((greatest(afront, bfront) - least(arear, brear))::DOUBLE, 0.75) AS combined_length,
  regr_slope(arear, frame_id) FILTER (back <= 5) AS a_slope, regr_slope(brear, frame_id) FILTER (back <= 5) AS b_slope, quantile_cont((amaxy - aminy)::DOUBLE, 0.75) AS a_length, quantile_cont((bmaxy - bminy)::DOUBLE, 0.75) AS b_length FROM gq GROUP BY 1, 2),
art AS (SELECT *, CASE WHEN tail_count < 3 THEN full_mean ELSE tail_mean END AS gap_mean, CASE WHEN tail_count < 3 THEN full_std ELSE tail_std END AS gap_std FROM ar0)""" + COUNTS


@query(f"SELECT a, b, overlap, CAST(direction AS INTEGER) AS direction, {m('ahead_median')} AS ahead_median, {m('ahead_share')} AS ahead_share, {m('gap_mean')} AS gap_mean, {m('gap_std')} AS gap_std, {m('full_mean')} AS full_gap_mean, gap_min, {m('combined_length')} AS combined_length, {m('a_slope')} AS a_slope FROM art", ART)
def articulated_metrics(spark, sf_dir):
    names = ("ahead_median", "ahead_share", "gap_mean", "gap_std", "full_gap_mean", "combined_length", "a_slope")
    return postprocess.articulated_metrics(obs2(spark, sf_dir), scale=1000).select("a", "b", "overlap", "direction", *[milli(F.col(c)).alias(c) for c in names], F.col("gap_min").cast("long").alias("gap_min"))


@query(
    """SELECT a, b, CASE WHEN overlap < 8 THEN 'overlap_frames' WHEN overlap / least(x.n, y.n) < 0.7 THEN 'overlap_ratio' WHEN lateral_mean > 13000 THEN 'lateral_offset' WHEN vertical_mean > 20 THEN 'vertical_offset' WHEN direction = 0 THEN 'direction'
WHEN (adx * bdx + ady * bdy + adz * bdz) / (sqrt(adx * adx + ady * ady + adz * adz) * sqrt(bdx * bdx + bdy * bdy + bdz * bdz)) < 0.85 OR abs(a_slope - b_slope) > 25 THEN 'motion'
WHEN abs(ahead_median) < 500 OR CASE WHEN ahead_median > 0 THEN ahead_share ELSE behind_share END < 0.9 THEN 'ordering' ELSE CASE WHEN gap_mean > 2500 THEN 'gap_tail' WHEN gap_std > 60 THEN 'gap_tail_std' WHEN gap_min < -750 THEN 'gap_negative' WHEN combined_length < 700 THEN 'combined_length' ELSE 'tail_gap' END END AS reason
FROM art JOIN cm USING (a, b) JOIN na x ON x.track_id = a JOIN na y ON y.track_id = b""".replace("lateral_mean", "art.lateral_mean").replace("CASE WHEN overlap < 8", "CASE WHEN art.overlap < 8").replace("overlap / least", "art.overlap / least"),
    ART.replace("obs2", "shifted").replace("sh AS", "shifted AS (SELECT seq_id, track_id, frame_id, cx, cz, n_points, min_x, max_x, min_z, max_z, cy + 1500 * (track_id % 3) AS cy, min_y + 1500 * (track_id % 3) AS min_y, max_y + 1500 * (track_id % 3) AS max_y FROM obs2), sh AS", 1),
)
def articulated_decision(spark, sf_dir):
    shift = 1500 * (F.col("track_id") % 3)
    rows = obs2(spark, sf_dir).withColumns({c: F.col(c) + shift for c in ("cy", "min_y", "max_y")})
    n = rows.groupBy("seq_id", "track_id").agg(F.count("*").alias("n"))
    out = postprocess.articulated_decision(postprocess.articulated_metrics(rows, scale=1000), n, 8, 0.7, 13_000, 20, 2500, 60, 700, 25, scale=1000)
    return out.select("a", "b", "reason")


@query("SELECT a, b, CASE WHEN ahead_median > 0.25 THEN a WHEN ahead_median < -0.25 THEN b WHEN a_length > b_length THEN a WHEN a_length < b_length THEN b WHEN p.n > q.n THEN a WHEN p.n < q.n THEN b ELSE least(a, b) END AS lead FROM art JOIN (SELECT track_id, sum(n_points) AS n FROM obs2 GROUP BY 1) p ON p.track_id = a JOIN (SELECT track_id, sum(n_points) AS n FROM obs2 GROUP BY 1) q ON q.track_id = b", ART)
def lead_choice(spark, sf_dir):
    return postprocess.lead_choice(obs2(spark, sf_dir)).select("a", "b", "lead")


@query("SELECT a, b FROM cm JOIN lo x ON x.track_id = a JOIN lo y ON y.track_id = b WHERE greatest(x.l, y.l) >= 0.85 * 760 OR x.l + y.l + abs(x.now - y.now) >= 760", SHARED + ", lo AS (SELECT track_id, quantile_cont((max_y - min_y)::DOUBLE, 0.75) AS l, arg_max(cy, frame_id) AS now FROM obs2 GROUP BY 1)")
def long_vehicle_candidates(spark, sf_dir):
    return postprocess.long_candidates(obs2(spark, sf_dir), 760).select("a", "b")


@query(f"SELECT track_id // 2 AS track_id, frame_id, CAST(sum(n_points) AS BIGINT) AS n_points, {m('sum(cy * n_points) / sum(n_points)')} AS cy, min(min_x) AS min_x, max(max_x) AS max_x, list_sort(list(track_id))::VARCHAR AS sources FROM obs2 GROUP BY 1, 2")
def merge_tracks_by_frame(spark, sf_dir):
    rows = obs2(spark, sf_dir)
    mapping = rows.select("seq_id", "track_id").distinct().withColumn("new_id", F.floor(F.col("track_id") / 2).cast("int"))
    out = postprocess.merge_by_frame(rows, mapping)
    return out.select("track_id", "frame_id", "n_points", milli(F.col("cy")).alias("cy"), "min_x", "max_x", F.concat(F.lit("["), F.array_join("source_track_ids", ", "), F.lit("]")).alias("sources"))


# --- selection ------------------------------------------------------------

IDX = "ix AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY frame_id) - 1 AS i, count(*) OVER (PARTITION BY track_id) AS n FROM obs2)"


def touch_sql(line: int) -> str:
    return f"{IDX}, tc AS (SELECT *, coalesce(min(i) FILTER (min_y - 120 <= {line} AND max_y + 120 >= {line}) OVER (PARTITION BY track_id), min(i) FILTER (abs(cy - {line}) <= 120) OVER (PARTITION BY track_id)) AS touch FROM ix)"


@query("SELECT track_id, frame_id FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY frame_id DESC) AS back FROM tc WHERE touch IS NULL OR i <= touch) WHERE back <= 5", touch_sql(20000))
def line_touch_last_k(spark, sf_dir):
    return selection.line_touch_last_k(obs2(spark, sf_dir), 20_000, 120, 5).select("track_id", "frame_id")


@query("SELECT track_id, count(*) AS kept, max(frame_id) AS last_frame FROM tc WHERE touch IS NULL OR i <= touch GROUP BY 1", touch_sql(15000))
def lane_end_truncation(spark, sf_dir):
    return selection.truncate_at_lane_end(obs2(spark, sf_dir), 15_000, 120).groupBy("track_id").agg(F.count("*").alias("kept"), F.max("frame_id").alias("last_frame"))


@query(
    "SELECT track_id, frame_id FROM r2 WHERE n <= 8 OR i = 0 OR i = n - 1 OR before < 8 OR rank = 1",
    IDX + """, d AS (SELECT *, sqrt((cx - lag(cx) OVER w) * (cx - lag(cx) OVER w) + (cy - lag(cy) OVER w) * (cy - lag(cy) OVER w) + (cz - lag(cz) OVER w) * (cz - lag(cz) OVER w)) AS d1, sqrt((cx - lead(cx) OVER w) * (cx - lead(cx) OVER w) + (cy - lead(cy) OVER w) * (cy - lead(cy) OVER w) + (cz - lead(cz) OVER w) * (cz - lead(cz) OVER w)) AS d2 FROM ix WINDOW w AS (PARTITION BY track_id ORDER BY frame_id)),
r2 AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY coalesce(d1, 0) + coalesce(d2, 0) DESC, i DESC) AS rank, 2 + coalesce(sum(CASE WHEN i = 0 OR i = n - 1 THEN 0 ELSE 1 END) OVER (PARTITION BY track_id ORDER BY coalesce(d1, 0) + coalesce(d2, 0) DESC, i DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d)""",
)
def keyframe_motion(spark, sf_dir):
    return selection.keyframe_motion(obs2(spark, sf_dir), 8).select("track_id", "frame_id")


@query(f"SELECT track_id, frame_id, {m('rr')} AS rear_ratio FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY rr DESC, frame_id) AS rank FROM (SELECT o.*, CASE WHEN d > 0 THEN cy - min_y ELSE max_y - cy END / greatest(max_y - min_y, 1e-6) AS rr FROM obs2 o JOIN (SELECT track_id, CASE WHEN arg_max(cy, frame_id) - arg_min(cy, frame_id) < -1e-6 THEN -1 ELSE 1 END AS d FROM obs2 GROUP BY 1) USING (track_id))) WHERE rank <= 2")
def tail_candidates(spark, sf_dir):
    return selection.tail_candidates(obs2(spark, sf_dir)).select("track_id", "frame_id", milli(F.col("rear_ratio")).alias("rear_ratio"))


@query("SELECT track_id, bin, frame_id FROM (SELECT *, row_number() OVER (PARTITION BY track_id, bin ORDER BY n_points DESC, frame_id) AS rank FROM (SELECT *, CAST(least(floor((cy - lo) / greatest(hi - lo, 1e-6) * 3), 2) AS INTEGER) AS bin FROM (SELECT *, min(cy) OVER (PARTITION BY track_id) AS lo, max(cy) OVER (PARTITION BY track_id) AS hi FROM obs2))) WHERE rank = 1")
def coverage_bins(spark, sf_dir):
    return selection.coverage_bins(obs2(spark, sf_dir)).select("track_id", "bin", "frame_id")


@query(
    """SELECT track_id, frame_id FROM tl WHERE frame_id % 4 = 1 OR (rank <= 2 AND n_points >= 0.25 * top_p AND norm >= 0.2 * top_e)
UNION SELECT track_id, frame_id FROM (SELECT *, row_number() OVER (PARTITION BY track_id, bin ORDER BY n_points DESC, frame_id) AS best FROM (SELECT *, CAST(least(floor((cy - lo) / greatest(hi - lo, 1e-6) * 3), 2) AS INTEGER) AS bin FROM tl WHERE track_id % 2 = 0 AND hi - lo > 1e-6)) WHERE best = 1
UNION SELECT track_id, frame_id FROM tl WHERE track_id % 2 = 0 AND rank <= 2""",
    """dr AS (SELECT track_id, CASE WHEN arg_max(cy, frame_id) - arg_min(cy, frame_id) < -1e-6 THEN -1 ELSE 1 END AS d FROM obs2 GROUP BY 1),
tr AS (SELECT o.*, CASE WHEN d > 0 THEN cy - min_y ELSE max_y - cy END / greatest(max_y - min_y, 1e-6) AS rr, sqrt((max_x - min_x)::DOUBLE * (max_x - min_x) + (max_y - min_y)::DOUBLE * (max_y - min_y) + (max_z - min_z)::DOUBLE * (max_z - min_z)) AS norm FROM obs2 o JOIN dr USING (track_id)),
tl AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY rr DESC, frame_id) AS rank, greatest(max(n_points) OVER (PARTITION BY track_id), 1) AS top_p, greatest(max(norm) OVER (PARTITION BY track_id), 1e-6) AS top_e, min(cy) OVER (PARTITION BY track_id) AS lo, max(cy) OVER (PARTITION BY track_id) AS hi FROM tr)""",
)
def long_vehicle_coverage(spark, sf_dir):
    """A window of every fourth frame with tails beside it, then coverage of the tracks with even ids."""
    rows = obs2(spark, sf_dir)
    tails = selection.tail_candidates(rows).select("seq_id", "track_id", "frame_id")
    window = selection.with_tails(rows.where("frame_id % 4 = 1"), rows, tails)
    long = rows.where("track_id % 2 = 0").select("seq_id", "track_id").distinct()
    return selection.with_coverage(window, rows, long, tails).select("track_id", "frame_id")


NORM = "nm AS (SELECT *, sqrt((max_x - min_x)::DOUBLE * (max_x - min_x) + (max_y - min_y)::DOUBLE * (max_y - min_y) + (max_z - min_z)::DOUBLE * (max_z - min_z)) AS norm FROM ix)"


@query(
    "SELECT track_id, frame_id FROM s3 WHERE ok OR (NOT some_ok AND top = 1)",
    f"{IDX}, {NORM}, s1 AS (SELECT *, quantile_cont(norm, 0.5) OVER (PARTITION BY track_id) AS med FROM nm), s2 AS (SELECT *, med <= 1e-6 OR norm BETWEEN med / 1.03 AND med * 1.03 AS ok, row_number() OVER (PARTITION BY track_id ORDER BY norm DESC, frame_id) AS top FROM s1), s3 AS (SELECT *, bool_or(ok) OVER (PARTITION BY track_id) AS some_ok FROM s2)",
)
def shape_consistency(spark, sf_dir):
    return selection.shape_consistent(obs2(spark, sf_dir), 1.03).select("track_id", "frame_id")


@query(
    """SELECT track_id, frame_id FROM w5 WHERE CASE WHEN best IS NOT NULL AND best.n >= 3 THEN good AND run = best.run ELSE i BETWEEN st AND st + least(n, 3) - 1 END""",
    f"""{IDX}, {NORM}, w1 AS (SELECT *, n_points / greatest(max(n_points) OVER t, 1) AS p, norm / greatest(max(norm) OVER t, 1e-6) AS e FROM nm WINDOW t AS (PARTITION BY track_id)),
w2 AS (SELECT *, p >= 0.7 AND e >= 0.9 AS good, 0.6 * p + 0.4 * e AS score FROM w1),
w3 AS (SELECT *, sum(CASE WHEN good = pg THEN 0 ELSE 1 END) OVER (PARTITION BY track_id ORDER BY i) AS run FROM (SELECT *, lag(good) OVER (PARTITION BY track_id ORDER BY i) AS pg FROM w2)),
w4 AS (SELECT *, max(score) OVER r AS rt, count(*) OVER r AS rn, avg(n_points) OVER r AS rp, min(i) OVER r AS rs FROM w3 WINDOW r AS (PARTITION BY track_id, run)),
w5 AS (SELECT *, greatest(0, least(-peak.early - floor(least(n, 3) / 2), n - least(n, 3))) AS st FROM (SELECT *, max(CASE WHEN good THEN {{'t': rt, 'n': rn, 'p': rp, 's': -rs, 'run': run}} END) OVER (PARTITION BY track_id) AS best, max({{'score': score, 'early': -i}}) OVER (PARTITION BY track_id) AS peak FROM w4))""",
)
def chunk_quality_window(spark, sf_dir):
    return selection.quality_window(obs2(spark, sf_dir), 0.7, 0.9, 3).select("track_id", "frame_id")


@query()
def length_coverage(spark, sf_dir):
    return selection.select(obs2(spark, sf_dir), "length_coverage").select("track_id", "frame_id")


@query()
def quality_coverage(spark, sf_dir):
    return selection.select(obs2(spark, sf_dir), "quality_coverage").select("track_id", "frame_id")


@query()
def tail_coverage(spark, sf_dir):
    return selection.select(obs2(spark, sf_dir), "tail_coverage", keep=4).select("track_id", "frame_id")


@query()
def center_diversity(spark, sf_dir):
    return selection.select(obs2(spark, sf_dir), "center_diversity").select("track_id", "frame_id")


# --- fusion ---------------------------------------------------------------


def chunks(spark, sf_dir):
    """Points of each object and frame, moved back to where the object was in the first frame."""
    y = F.col("y") + 1200 * F.col("frame_index")
    return lane(spark, sf_dir).select("seq_id", F.col("object_id").alias("track_id"), F.col("frame_index").alias("frame_id"), "x", y.alias("y"), "z", (F.col("point_id") % 256).cast("double").alias("intensity"))


CHUNKS = "ch AS (SELECT seq_id, object_id AS track_id, frame_index AS frame_id, x, y + 1200 * frame_index AS y, z, CAST(point_id % 256 AS DOUBLE) AS intensity FROM lane), v1 AS (SELECT track_id, frame_id, floor(x / 100) AS vx, floor(y / 100) AS vy, floor(z / 100) AS vz, avg(x) AS x, avg(y) AS y, avg(z) AS z, avg(intensity) AS i FROM ch GROUP BY 1, 2, 3, 4, 5)"
FUSED = CHUNKS + ", fu AS (SELECT track_id, vx, vy, vz, count(*) AS hits, avg(x) AS x, avg(y) AS y, avg(z) AS z, avg(i) AS intensity, count(*)::DOUBLE AS confidence FROM v1 GROUP BY 1, 2, 3, 4)"
CLOUD_OUT = f"SELECT track_id, CAST(vx AS BIGINT) AS vx, CAST(vy AS BIGINT) AS vy, CAST(vz AS BIGINT) AS vz, hits, {m('x')} AS x, {m('y')} AS y, {m('z')} AS z, {m('intensity')} AS intensity, {m('confidence')} AS confidence FROM fu"


def cloud_out(cloud: DataFrame) -> DataFrame:
    return cloud.select("track_id", *as_long("vx", "vy", "vz"), "hits", *[milli(F.col(c)).alias(c) for c in ("x", "y", "z", "intensity", "confidence")])


@query(CLOUD_OUT, FUSED)
def voxel_fusion(spark, sf_dir):
    return cloud_out(fusion.fuse(chunks(spark, sf_dir), 100))


@query(CLOUD_OUT, CHUNKS + ", w AS (SELECT track_id, frame_id, n_points::DOUBLE AS w FROM obs), fu AS (SELECT track_id, vx, vy, vz, count(*) AS hits, sum(w * x) / sum(w) AS x, sum(w * y) / sum(w) AS y, sum(w * z) / sum(w) AS z, sum(w * i) / sum(w) AS intensity, sum(w) AS confidence FROM v1 JOIN w USING (track_id, frame_id) GROUP BY 1, 2, 3, 4)")
def weighted_voxel_fusion(spark, sf_dir):
    return cloud_out(fusion.fuse(chunks(spark, sf_dir), 100, fusion.chunk_weights(obs(spark, sf_dir), "point_count"), confidence="weight"))


@query(CLOUD_OUT + " JOIN (SELECT track_id, count(DISTINCT frame_id) AS chunks FROM v1 GROUP BY 1) USING (track_id) WHERE hits >= greatest(1, ceil(0.35 * chunks))", FUSED)
def occupancy_consensus_fusion(spark, sf_dir):
    return cloud_out(fusion.fuse(chunks(spark, sf_dir), 100, consensus=0.35))


@query(CLOUD_OUT + " WHERE hits >= 3", FUSED)
def fusion_min_observations(spark, sf_dir):
    return cloud_out(fusion.fuse(chunks(spark, sf_dir), 100, least_chunks=3))


@query()
def registration_voxel_fusion(spark, sf_dir):
    from ..operators.registration import RegistrationConfig, register

    moved = register(fusion.voxel_mean(chunks(spark, sf_dir), ["seq_id", "track_id", "frame_id"], 150), RegistrationConfig(max_corr_dist=950.0, max_iter=15, max_translation=3200.0, voxel=120.0))
    return moved.groupBy("track_id", "registration").agg(F.count("*").alias("n"), F.countDistinct("frame_id").alias("frames"))


REVOX = FUSED + ", rv AS (SELECT track_id, floor(x / 200) AS wx, floor(y / 200) AS wy, floor(z / 200) AS wz, avg(x) AS x, avg(y) AS y, avg(z) AS z, avg(intensity) AS intensity, sum(confidence) AS confidence FROM fu GROUP BY 1, 2, 3, 4)"


def revox(spark, sf_dir):
    return fusion.revoxelise(fusion.fuse(chunks(spark, sf_dir), 100), 200)


@query(f"SELECT track_id, CAST(wx AS BIGINT) AS vx, CAST(wy AS BIGINT) AS vy, CAST(wz AS BIGINT) AS vz, {m('x')} AS x, {m('intensity')} AS intensity, {m('confidence')} AS confidence FROM rv", REVOX)
def revoxelised_cloud(spark, sf_dir):
    return revox(spark, sf_dir).select("track_id", *as_long("vx", "vy", "vz"), *[milli(F.col(c)).alias(c) for c in ("x", "intensity", "confidence")])


@query(
    f"SELECT track_id, {m('x')} AS x, {m('y')} AS y, {m('z')} AS z FROM (SELECT *, avg(d) OVER (PARTITION BY track_id) + 1.5 * stddev_pop(d) OVER (PARTITION BY track_id) AS lim, count(*) OVER (PARTITION BY track_id) AS n FROM kn) WHERE d <= lim OR n < 8",
    REVOX + ", pr AS (SELECT a.track_id, a.x, a.y, a.z, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)) AS d FROM rv a JOIN rv b ON a.track_id = b.track_id AND (a.wx, a.wy, a.wz) <> (b.wx, b.wy, b.wz)), kn AS (SELECT track_id, x, y, z, avg(d) AS d FROM (SELECT *, row_number() OVER (PARTITION BY track_id, x, y, z ORDER BY d) AS k FROM pr) WHERE k <= 6 GROUP BY 1, 2, 3, 4)",
)
def statistical_outlier_removal(spark, sf_dir):
    return fusion.remove_outliers(revox(spark, sf_dir), 6, 1.5).select("track_id", *[milli(F.col(a)).alias(a) for a in "xyz"])


@query(
    f"SELECT track_id, {m('x')} AS x, {m('y')} AS y, {m('z')} AS z, {m('confidence')} AS confidence, most FROM c2 WHERE n <= most OR place <= most",
    REVOX + """, c1 AS (SELECT *, row_number() OVER (PARTITION BY track_id, bin ORDER BY confidence DESC, wx, wy, wz) AS k, count(*) OVER (PARTITION BY track_id) AS n FROM (SELECT *, least(floor((y - lo) / greatest(hi - lo, 1e-9) * 8), 7) AS bin FROM (SELECT *, min(y) OVER (PARTITION BY track_id) AS lo, max(y) OVER (PARTITION BY track_id) AS hi FROM rv))),
c2 AS (SELECT c1.*, row_number() OVER (PARTITION BY c1.track_id, most ORDER BY CASE WHEN k <= floor(most / used) THEN 0 ELSE 1 END, confidence DESC, wx, wy, wz) AS place FROM (SELECT * FROM c1, (SELECT unnest([20, 5]) AS most)) c1 JOIN (SELECT track_id, count(DISTINCT bin) AS used FROM c1 GROUP BY 1) u ON u.track_id = c1.track_id)""",
)
def confidence_point_cap(spark, sf_dir):
    # A budget of two points a bin, and one below a point a bin.
    cloud = revox(spark, sf_dir)
    both = [fusion.confidence_cap(cloud, most, 8).select("track_id", *[milli(F.col(c)).alias(c) for c in ("x", "y", "z", "confidence")], F.lit(most).alias("most")) for most in (20, 5)]
    return both[0].union(both[1])


PLANE = REVOX + """, pl0 AS (SELECT track_id, quantile_cont(x, 0.05) AS a, quantile_cont(x, 0.5) AS b, quantile_cont(x, 0.95) AS c FROM rv GROUP BY 1), pl1 AS (SELECT track_id, CASE WHEN abs((a + c) / 2 - b) >= 100 THEN (a + c) / 2 ELSE b END AS plane FROM pl0),
pl AS (SELECT track_id, plane, count(*) FILTER (x - plane >= 0) AS plus, count(*) FILTER (x - plane < 0) AS minus, coalesce(avg(x - plane) FILTER (x - plane >= 0), 0) AS pf, coalesce(avg(plane - x) FILTER (x - plane < 0), 0) AS mf FROM rv JOIN pl1 USING (track_id) GROUP BY 1, 2)"""


@query(f"SELECT track_id, {m('plane')} AS plane, plus, minus, CASE WHEN plus > minus OR (plus = minus AND pf >= mf) THEN 1 ELSE -1 END AS side FROM pl", PLANE)
def symmetry_plane(spark, sf_dir):
    return fusion.symmetry_plane(revox(spark, sf_dir), size=200).select("track_id", milli(F.col("plane")).alias("plane"), "plus", "minus", "side")


@query(f"SELECT track_id, count(*) AS n, CAST(round(sum(confidence)) AS BIGINT) AS confidence FROM (SELECT track_id, x, y, z, confidence FROM kept UNION ALL SELECT track_id, 2 * plane - x, y, z, confidence FROM kept) GROUP BY 1", PLANE + ", kept AS (SELECT rv.*, plane FROM rv JOIN pl USING (track_id) WHERE (x - plane) * CASE WHEN plus > minus OR (plus = minus AND pf >= mf) THEN 1 ELSE -1 END >= 0)")
def symmetry_completion(spark, sf_dir):
    cloud = revox(spark, sf_dir)
    plane = fusion.symmetry_plane(cloud, size=200)
    kept = cloud.join(plane, ["seq_id", "track_id"]).where((F.col("x") - F.col("plane")) * F.col("side") >= 0)
    total = fusion.complete_symmetry(cloud, 200).groupBy("track_id").agg(F.round(F.sum("confidence")).cast("long").alias("confidence"))
    return kept.groupBy("track_id").agg((F.count("*") * 2).alias("n")).join(total, "track_id")


@query("SELECT track_id, half, count(DISTINCT (floor(y / 200), floor(z / 200))) AS slices FROM (SELECT rv.*, CASE WHEN x >= plane THEN 1 ELSE -1 END AS half FROM rv JOIN pl USING (track_id)) GROUP BY 1, 2", PLANE)
def symmetry_slices(spark, sf_dir):
    return fusion.symmetry_slices(revox(spark, sf_dir), 200).select("track_id", "half", "slices")


@query(f"SELECT track_id, count(*) AS n_points, {m('max(y) - min(y)')} AS length, {m('max(x) - min(x)')} AS width, {m('max(z) - min(z)')} AS height FROM rv GROUP BY 1", REVOX)
def vehicle_dimensions(spark, sf_dir):
    return fusion.dimensions(revox(spark, sf_dir)).select("track_id", "n_points", *[milli(F.col(c)).alias(c) for c in ("length", "width", "height")])


PARTS = CHUNKS + ", pt AS (SELECT track_id, CAST(frame_id // 10 AS INTEGER) AS component, y + 400 * (frame_id // 10) AS y, x, z, intensity FROM ch), bp AS (SELECT track_id, component, min(y) AS low, max(y) AS high, avg(x) AS side, avg(z) AS up FROM pt GROUP BY 1, 2), nx AS (SELECT *, lead(low) OVER w AS nl, lead(side) OVER w AS ns, lead(up) OVER w AS nu FROM bp WINDOW w AS (PARTITION BY track_id ORDER BY low, component))"


@query(f"SELECT track_id, {m('high + k / n * (nl - high)')} AS y, {m('side + k / n * (ns - side)')} AS x FROM (SELECT *, ceil((nl - high) / 10) AS n FROM nx WHERE nl - high > 0 AND nl - high <= 500 AND abs(ns - side) <= 200 AND abs(nu - up) <= 200), range(1, 60) r(k) WHERE k < n", PARTS)
def tail_bridge(spark, sf_dir):
    parts = chunks(spark, sf_dir).withColumn("component", F.floor(F.col("frame_id") / 10).cast("int")).withColumn("y", F.col("y") + 400 * F.col("component")).withColumn("confidence", F.lit(1.0))
    return fusion.tail_bridge(parts, 500, 200, 200, 10).select("track_id", milli(F.col("y")).alias("y"), milli(F.col("x")).alias("x"))


@query(
    f"SELECT track_id, frame_id, {m('min(moved)')} AS low, {m('max(moved)')} AS high FROM (SELECT p.*, y - v * (ns - quantile_cont(ns, 0.5) OVER (PARTITION BY track_id, frame_id)) / 1e9 AS moved FROM (SELECT object_id AS track_id, frame_index AS frame_id, y, frame_timestamp_ns + point_id % 1000 * 1000000000 AS ns FROM lane) p JOIN sp USING (track_id, frame_id)) GROUP BY 1, 2",
    "sp AS (SELECT track_id, frame_id, (coalesce(lead(cy) OVER w, cy) - coalesce(lag(cy) OVER w, cy)) / ((coalesce(lead(ts_ns) OVER w, ts_ns) - coalesce(lag(ts_ns) OVER w, ts_ns)) / 1e9) AS v FROM obs WINDOW w AS (PARTITION BY track_id ORDER BY frame_id))",
)
def motion_deskew(spark, sf_dir):
    rows = lane(spark, sf_dir).select("seq_id", F.col("object_id").alias("track_id"), F.col("frame_index").alias("frame_id"), "x", "y", "z", (F.col("frame_timestamp_ns") + F.col("point_id") % 1000 * 1_000_000_000).alias("point_ns"))
    out = fusion.deskew(rows, obs(spark, sf_dir), least_speed=0.0)
    return out.groupBy("track_id", "frame_id").agg(milli(F.min("y")).alias("low"), milli(F.max("y")).alias("high"))


LIFE = "life AS (SELECT track_id, max(frame_id) - min(frame_id) + 1 AS age, count(*) AS hit_count, 29 - max(frame_id) AS missed, max(frame_id) < 27 AS ended, arg_max(cy, frame_id) AS last_at FROM obs2 GROUP BY 1), ex AS (SELECT *, last_at <= 4000 + 2500 AND (ended OR missed > 0) AS exited FROM life)"


@query("SELECT track_id, exited FROM ex", LIFE)
def track_exit(spark, sf_dir):
    rows = obs2(spark, sf_dir)
    return fusion.exited(rows, ages(rows), 4000, 2500).select("track_id", "exited")


@query(
    "SELECT *, printf('track %04d: %s (%s), %d hits, %d points', track_id, status, stage, hit_count, n_points) AS summary FROM (SELECT track_id, hit_count, n_points, CASE WHEN hit_count < 24 THEN 'skipped_min_hits' WHEN NOT exited THEN 'skipped_track_exit' WHEN n_points < 60 THEN 'skipped_min_saved_points' WHEN score < 0.5 THEN 'skipped_quality_threshold' ELSE 'saved' END AS status, CASE WHEN hit_count < 24 OR NOT exited THEN 'gate' ELSE 'save' END AS stage FROM ex JOIN qual USING (track_id) JOIN (SELECT track_id, count(*) AS n_points FROM rv GROUP BY 1) USING (track_id))",
    f"{LIFE}, {QUALITY}, {REVOX}",
)
def save_decision(spark, sf_dir):
    return decided(spark, sf_dir).select("track_id", "hit_count", "n_points", "status", "stage", "summary")


def decided(spark, sf_dir):
    rows = obs2(spark, sf_dir)
    tracks = fusion.exited(rows, ages(rows), 4000, 2500).join(postprocess.quality(rows, ages(rows)).select("seq_id", "track_id", "quality_score"), ["seq_id", "track_id"])
    return fusion.decide(tracks, fusion.dimensions(revox(spark, sf_dir)), 24, 60, 0.5, True)


@query(f"SELECT track_id, {m('max(y * direction) * any_value(direction)')} AS anchor_y, {m('quantile_cont(x, 0.5)')} AS anchor_x, {m('quantile_cont(z, 0.5)')} AS anchor_z FROM rv JOIN mo USING (track_id) GROUP BY 1", f"{REVOX}, {MOTION}")
def front_anchor(spark, sf_dir):
    out = fusion.front_anchor(revox(spark, sf_dir), postprocess.motion(obs2(spark, sf_dir)))
    return out.select("track_id", *[milli(F.col(f"anchor_{a}")).alias(f"anchor_{a}") for a in "xyz"])


#: Groups of three tracks: 3k leads, the two others follow it one after the other.
VEHICLES = REVOX + """, sp AS (SELECT track_id, track_id // 3 * 3 AS grp, min(y) AS lo, max(y) AS hi FROM rv WHERE track_id < 9 GROUP BY 1),
fo AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY lo, track_id) AS k FROM sp WHERE track_id <> grp),
s1 AS (SELECT f.*, l.hi AS edge, greatest(0.0, l.hi + 100 + 40 * (f.track_id % 3 - 1) - f.lo) AS shift FROM fo f JOIN sp l ON l.track_id = f.grp WHERE k = 1),
s2 AS (SELECT f.*, greatest(0.0, greatest(s1.edge, s1.hi + s1.shift) + 100 + 40 * (f.track_id % 3 - 1) - f.lo) AS shift FROM fo f JOIN s1 USING (grp) WHERE f.k = 2),
mv AS (SELECT track_id, grp, 0.0 AS shift FROM sp WHERE track_id = grp UNION ALL SELECT track_id, grp, shift FROM s1 UNION ALL SELECT track_id, grp, shift FROM s2)"""


def vehicles(spark, sf_dir):
    """Links of the groups, from the tracks that there are; the second follower's gap is 40."""
    ids = obs(spark, sf_dir).select("seq_id", "track_id").distinct().where("track_id < 9 AND track_id % 3 > 0")
    pairs = ids.select("seq_id", (F.col("track_id") - 1).alias("lead"), F.col("track_id").alias("rear"), (40.0 * (F.col("track_id") % 3 - 1)).alias("gap_mean"))
    return postprocess.link_states(pairs, "articulated")


@query(f"SELECT mv.track_id, grp AS group_id, {m('shift')} AS shift FROM mv", VEHICLES)
def long_vehicle_shifts(spark, sf_dir):
    moves = groups.shifts(revox(spark, sf_dir), groups.link_groups(vehicles(spark, sf_dir)), postprocess.motion(obs2(spark, sf_dir)), 100)
    return moves.select("track_id", "group_id", milli(F.col("shift")).alias("shift"))


@query(f"SELECT grp AS track_id, count(*) AS n, {m('min(y)')} AS low, {m('max(y)')} AS high FROM (SELECT grp, avg(y + shift) AS y FROM rv JOIN mv USING (track_id) GROUP BY grp, floor(x / 150), floor((y + shift) / 150), floor(z / 150)) GROUP BY 1", VEHICLES)
def long_vehicle_merge(spark, sf_dir):
    keep = scratch(spark)
    cloud = revox(spark, sf_dir)
    moves = groups.shifts(cloud, groups.link_groups(vehicles(spark, sf_dir), keep), postprocess.motion(obs2(spark, sf_dir)), 100)
    out = groups.merged_clouds(cloud.drop("vx", "vy", "vz"), moves, 0, 0.0, 150, keep)
    return out.groupBy("track_id").agg(F.count("*").alias("n"), milli(F.min("y")).alias("low"), milli(F.max("y")).alias("high"))


@query(
    "SELECT e.track_id, CASE WHEN e.track_id % 3 > 0 AND e.track_id < 9 THEN 'merged_into_long_vehicle_group' WHEN e.track_id < 9 THEN CASE WHEN NOT (g.last <= 6500 AND (g.missed > 0 OR g.ended)) THEN 'skipped_track_exit' WHEN c.n < 60 THEN 'skipped_min_saved_points' WHEN g.score < 0.5 THEN 'skipped_quality_threshold' ELSE 'saved' END ELSE e.status END AS status, CASE WHEN e.track_id % 3 > 0 AND e.track_id < 9 THEN 0 WHEN e.track_id < 9 THEN c.n ELSE e.n_points END AS n_points FROM before e LEFT JOIN gt g ON g.grp = e.track_id LEFT JOIN (SELECT grp, count(*) AS n FROM (SELECT DISTINCT grp, floor(x / 150), floor((y + shift) / 150), floor(z / 150) FROM rv JOIN mv USING (track_id)) GROUP BY 1) c ON c.grp = e.track_id",
    f"{VEHICLES}, {QUALITY}, {LIFE}, bp AS (SELECT track_id, count(*) AS n_points FROM rv GROUP BY 1), "
    "before AS (SELECT track_id, n_points, CASE WHEN hit_count < 24 THEN 'skipped_min_hits' WHEN NOT exited THEN 'skipped_track_exit' WHEN n_points IS NULL THEN 'empty_selection' WHEN n_points < 60 THEN 'skipped_min_saved_points' WHEN score < 0.5 THEN 'skipped_quality_threshold' ELSE 'saved' END AS status FROM ex l LEFT JOIN bp USING (track_id) LEFT JOIN (SELECT track_id, score FROM qual) q USING (track_id)), "
    "gf AS (SELECT track_id // 3 * 3 AS grp, frame_id, sum(cy * n_points) / sum(n_points) AS cy FROM obs2 WHERE track_id < 9 GROUP BY 1, 2), "
    "gt AS (SELECT a.*, b.last FROM (SELECT l.track_id // 3 * 3 AS grp, min(missed) AS missed, bool_or(ended) AS ended, max(score) AS score FROM life l JOIN (SELECT track_id, score FROM qual) q USING (track_id) WHERE l.track_id < 9 GROUP BY 1) a JOIN (SELECT grp, arg_max(cy, frame_id) AS last FROM gf GROUP BY 1) b USING (grp))",
)
def long_vehicle_regate(spark, sf_dir):
    """Groups decided again: their exit, points and best quality; members point to their lead."""
    keep, rows = scratch(spark), obs2(spark, sf_dir)
    cloud, life = revox(spark, sf_dir), ages(rows)
    moves = keep("moves", groups.shifts(cloud, groups.link_groups(vehicles(spark, sf_dir), keep), postprocess.motion(rows), 100))
    merged = groups.merged_clouds(cloud.drop("vx", "vy", "vz"), moves, 0, 0.0, 150, keep)
    seen, joined = groups.group_tracks(rows, life, postprocess.quality(rows, life), moves)
    out = groups.regate(decided(spark, sf_dir), fusion.exited(seen, joined, 4000, 2500), merged, moves, 60, 0.5, True)
    return out.select("track_id", "status", "n_points")


@query(f"SELECT track_id, {m('x + ax')} AS x, {m('y + ay')} AS y, {m('z + az')} AS z FROM rv JOIN (SELECT track_id, quantile_cont(cx, 0.5) AS ax, quantile_cont(cy, 0.5) AS ay, quantile_cont(cz, 0.5) AS az FROM obs2 GROUP BY 1) USING (track_id)", REVOX)
def candidate_world_cloud(spark, sf_dir):
    return fusion.candidate_world(revox(spark, sf_dir), obs2(spark, sf_dir)).select("track_id", *[milli(F.col(a)).alias(a) for a in "xyz"])


def kept_chunks(spark, sf_dir):
    """Chunks as a registration might leave them: every fourth frame of even tracks, every second of odd ones."""
    rows = chunks(spark, sf_dir).where((F.col("frame_id") % F.when(F.col("track_id") % 2 == 0, 4).otherwise(2)) == 0)
    return rows.select("seq_id", "track_id", "frame_id", *[F.col(a).cast("double").alias(a) for a in ("x", "y", "z")], "intensity", F.lit(1.0).alias("weight"), F.lit("accepted").alias("registration"))


@query("SELECT track_id, count(*) AS n, count(DISTINCT frame_id) AS frames, CASE WHEN track_id % 2 = 0 THEN 'fallback' ELSE 'accepted' END AS registration FROM ch WHERE track_id % 2 = 0 OR frame_id % 2 = 0 GROUP BY 1", CHUNKS)
def registration_fallback(spark, sf_dir):
    from ..operators.registration import fill_up

    return fill_up(kept_chunks(spark, sf_dir), chunks(spark, sf_dir), 12).groupBy("track_id", "registration").agg(F.count("*").alias("n"), F.countDistinct("frame_id").alias("frames"))


@query(
    "SELECT track_id, registration, count(*) AS n FROM (SELECT track_id, frame_id, CASE WHEN frame_id % CASE WHEN track_id % 2 = 0 THEN 4 ELSE 2 END = 0 THEN 'accepted' ELSE 'restored' END AS registration FROM ch) c WHERE registration = 'accepted' OR track_id IN (3, 4) OR track_id IN (SELECT track_id FROM obs2 WHERE track_id >= 8 AND frame_id = 13) GROUP BY 1, 2",
    CHUNKS,
)
def rear_chunk_restore(spark, sf_dir):
    from ..operators.registration import restore_rejected

    rears = obs(spark, sf_dir).where("track_id IN (3, 4)").select("seq_id", "track_id").distinct()
    tails = obs2(spark, sf_dir).where("track_id >= 8 AND frame_id = 13").select("seq_id", "track_id", "frame_id")
    return restore_rejected(kept_chunks(spark, sf_dir), chunks(spark, sf_dir), rears, tails).groupBy("track_id", "registration").agg(F.count("*").alias("n"))


@query()
def fragment_linking(spark, sf_dir):
    rows = obs2(spark, sf_dir)
    together = postprocess.co_moving_pairs(rows, 6100, 400, 5, 0.5, scale=1000).select("seq_id", "a", "b")
    return postprocess.fragment_links(rows, together.join(postprocess.long_candidates(rows, 700), ["seq_id", "a", "b"]))


# --- evaluation -----------------------------------------------------------


def saved_tracks(spark, sf_dir):
    return evaluate.last_timestamp(obs2(spark, sf_dir))


#: Tracks and labels of two sequences.
GT = """lab0 AS (SELECT 's' || (object_id % 2) AS seq_id, object_id, frame_timestamp_ns AS timestamp_ns, frame_index, point_id AS row_id, point_id % 3 AS point_count FROM points WHERE (frame_index + object_id) % 3 <> 0),
lab AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seq_id, object_id ORDER BY timestamp_ns DESC, frame_index DESC, row_id) AS rn FROM lab0 WHERE point_count > 0) WHERE rn = 1),
st AS (SELECT 's' || (track_id % 2) AS seq_id, track_id, max(frame_id) AS last_frame, arg_max(ts_ns, frame_id) AS last_ns FROM obs2 GROUP BY 1, 2)"""


@query("SELECT seq_id, track_id, object_id, abs(last_ns - timestamp_ns) AS delta_ns, abs(last_frame - frame_index) AS delta_frame FROM st JOIN lab USING (seq_id)", GT)
def ground_truth_costs(spark, sf_dir):
    two = lambda rows, of: rows.withColumn("seq_id", F.concat(F.lit("s"), F.col(of) % 2))
    return evaluate.candidate_costs(two(saved_tracks(spark, sf_dir), "track_id"), crop.latest_labels(two(label_rows(spark, sf_dir), "object_id")))


def gt_labels(spark, sf_dir):
    """One label per object but the last two, at its track's last time."""
    return saved_tracks(spark, sf_dir).where("track_id < 8").select("seq_id", F.col("track_id").alias("object_id"), F.col("last_ns").alias("timestamp_ns"), F.col("last_frame").alias("frame_index"))


@query("SELECT count(*) FILTER (track_id < 8) AS matched, count(*) FILTER (track_id >= 8) AS unmatched_tracks, 0::BIGINT AS unmatched_gt, 0::BIGINT AS max_delta_ns FROM st", GT)
def ground_truth_summary(spark, sf_dir):
    return evaluate.match_summary(evaluate.match_ground_truth(saved_tracks(spark, sf_dir), gt_labels(spark, sf_dir))).drop("seq_id", "mean_delta_ns")


@query()
def ground_truth_matching(spark, sf_dir):
    return evaluate.match_ground_truth(saved_tracks(spark, sf_dir), gt_labels(spark, sf_dir))


def noted(spark, sf_dir):
    """Results with metrics from before: tracks below nine are saved, the fifth is merged into the first."""
    rows = obs2(spark, sf_dir).groupBy("seq_id", "track_id").agg(F.count("*").alias("n_points"))
    status = F.when(F.col("track_id") == 5, evaluate.MERGED).when(F.col("track_id") < 9, "saved").otherwise("skipped_min_hits")
    old = F.map_from_arrays(F.array(F.lit("mode"), F.lit("gt_unmatched_reason"), F.lit("gt_obj_class"), F.lit("predicted_class_score")), F.array(F.lit("local"), F.lit("old"), F.lit("bus"), F.lit("0.5")))
    return rows.withColumns({"status": status, "merged_target_track_id": F.when(F.col("track_id") == 5, 1), "metrics": F.when(F.col("track_id") % 2 == 0, old)})


NOTED = "nt AS (SELECT track_id, count(*) AS n, CASE WHEN track_id = 5 THEN 'merged_into_long_vehicle_group' WHEN track_id < 9 THEN 'saved' ELSE 'skipped_min_hits' END AS status, arg_max(ts_ns, frame_id) AS last_ns, max(frame_id) AS last_frame FROM obs2 GROUP BY 1)"


def as_text(rows: DataFrame) -> DataFrame:
    """The map as text, keys in order."""
    entry = F.transform(F.array_sort(F.map_keys("metrics")), lambda k: F.concat(k, F.lit("="), F.element_at("metrics", k)))
    return rows.select("track_id", "status", F.coalesce(F.array_join(entry, ";"), F.lit("")).alias("metrics"))


@query(
    "SELECT track_id, status, CASE WHEN status <> 'saved' THEN CASE WHEN track_id % 2 = 0 THEN 'gt_obj_class=bus;gt_unmatched_reason=old;mode=local;predicted_class_score=0.5' ELSE '' END ELSE 'gt_frame_index=' || last_frame || ';gt_match_assignment=one_to_one;gt_match_mode=timestamp_only;gt_matched=true;' || CASE WHEN track_id % 3 > 0 THEN 'gt_obj_class=class' || track_id || ';' ELSE '' END || CASE WHEN track_id % 4 > 0 THEN 'gt_obj_class_score=' || CAST(track_id / 4 AS VARCHAR) || ';' ELSE '' END || 'gt_object_id=' || track_id || ';gt_timestamp_delta_ns=0;gt_timestamp_ns=' || last_ns || CASE WHEN track_id % 2 = 0 THEN ';mode=local;predicted_class_score=0.5' ELSE '' END END AS metrics FROM nt WHERE track_id <> 8"
    " UNION ALL SELECT track_id, status, 'gt_match_assignment=one_to_one;gt_match_mode=timestamp_only;gt_matched=false;gt_unmatched_reason=unmatched_no_gt_available;mode=local;predicted_class_score=0.5' FROM nt WHERE track_id = 8",
    NOTED,
)
def ground_truth_annotation(spark, sf_dir):
    id_ = F.col("object_id")
    labels = gt_labels(spark, sf_dir).withColumns({"obj_class": F.when(id_ % 3 > 0, F.concat(F.lit("class"), id_)).otherwise(F.lit("")), "obj_class_score": F.when(id_ % 4 > 0, id_ / 4)})
    saved = saved_tracks(spark, sf_dir).where("track_id < 9 AND track_id <> 5")
    matches = evaluate.match_ground_truth(saved, labels.where("object_id <> 5"))
    return as_text(evaluate.annotate_ground_truth(noted(spark, sf_dir), matches, labels))


@query(
    "SELECT track_id, status, CASE WHEN k = 3 THEN CASE WHEN track_id % 2 = 0 THEN 'gt_obj_class=bus;gt_unmatched_reason=old;mode=local;predicted_class_score=0.5' ELSE '' END ELSE 'classification_backend=geometric;classification_input_point_count=' || c.n || ';classification_point_source=' || CASE WHEN nt.track_id = 5 THEN 'merged_target_track' ELSE 'result_points' END || CASE WHEN nt.track_id % 2 = 0 THEN ';gt_obj_class=bus;gt_unmatched_reason=old;mode=local' ELSE '' END || CASE WHEN k % 2 > 0 THEN ';predicted_class_id=' || k ELSE '' END || ';predicted_class_name=' || CASE WHEN k = 1 THEN 'car' ELSE 'c' || k END || CASE WHEN k % 4 > 0 THEN ';predicted_class_score=' || CAST(k / 4 AS VARCHAR) ELSE '' END END AS metrics FROM (SELECT *, CASE WHEN track_id = 5 THEN 1 ELSE track_id END AS k FROM nt) nt JOIN (SELECT track_id AS k, count(*) AS n FROM obs2 GROUP BY 1) c USING (k)",
    NOTED,
)
def prediction_write_back(spark, sf_dir):
    """All tracks but the third have a prediction, by the number of their observations; ids and scores are null for some."""
    id_ = F.col("track_id")
    said = noted(spark, sf_dir).where("track_id NOT IN (3, 5)").select("seq_id", "track_id", "n_points", F.lit("result_points").alias("point_source"), F.when(id_ % 2 > 0, id_).alias("class_id"), F.when(id_ % 4 > 0, id_ / 4).alias("score"), F.when(id_ == 1, " AUTO ").otherwise(F.concat(F.lit("c"), id_)).alias("class"))
    return as_text(evaluate.write_predictions(noted(spark, sf_dir), said, "geometric", {"auto": "car"}))


@query("SELECT CASE lower(trim(t)) WHEN 'click' THEN 'car' WHEN 'view' THEN 'truck' ELSE trim(t) END AS class, count(*) AS n FROM (SELECT CASE WHEN event_id % 2 = 0 THEN ' ' || upper(event_type) || ' ' ELSE event_type END AS t FROM events) GROUP BY 1")
def class_normalisation(spark, sf_dir):
    raw = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(" "), F.upper("event_type"), F.lit(" "))).otherwise(F.col("event_type"))
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(evaluate.normalise_class(raw, {"Click": "car", "view": "truck"}).alias("class"))
    return rows.groupBy("class").agg(F.count("*").alias("n"))


@query(
    "SELECT coalesce(a.class, b.class) AS class, coalesce(predicted_count, 0) AS predicted_count, coalesce(matched_count, 0) AS matched_count, coalesce(agree, 0) AS agree, coalesce(gt_count, 0) AS gt_count, coalesce(matched_count, 0) - coalesce(agree, 0) AS mismatch FROM (SELECT coalesce(predicted, 'TOTAL') AS class, count(*) AS predicted_count, count(*) FILTER (matched) AS matched_count, count(*) FILTER (matched AND predicted = actual) AS agree FROM cr WHERE predicted IS NOT NULL GROUP BY ROLLUP (predicted)) a FULL JOIN (SELECT coalesce(actual, 'TOTAL') AS class, count(*) AS gt_count FROM cr WHERE actual IS NOT NULL GROUP BY ROLLUP (actual)) b ON a.class = b.class",
    "cr AS (SELECT CASE WHEN event_id % 11 <> 0 THEN event_type END AS predicted, CASE WHEN event_id % 7 <> 0 THEN CASE WHEN event_id % 5 = 0 THEN 'other' ELSE event_type END END AS actual, event_id % 11 <> 0 AND event_id % 7 <> 0 AS matched FROM events)",
)
def class_statistics(spark, sf_dir):
    e, id_ = spark.read.parquet(f"{sf_dir}/events.parquet"), F.col("event_id")
    actual = F.when(id_ % 7 != 0, F.when(id_ % 5 == 0, "other").otherwise(F.col("event_type")))
    return evaluate.class_statistics(e.select(F.when(id_ % 11 != 0, F.col("event_type")).alias("predicted"), actual.alias("actual"), ((id_ % 11 != 0) & (id_ % 7 != 0)).alias("matched")))


@query()
def classification(spark, sf_dir):
    return evaluate.classify(revox(spark, sf_dir), lambda p: evaluate.by_size(p, 1000.0), 64).select("track_id", "class")


@query("SELECT track_id, coalesce(CASE WHEN track_id < 7 THEN 'saved' END, 'missing_result') AS status, hit_count, last_frame FROM life JOIN (SELECT track_id, max(frame_id) AS last_frame FROM obs2 GROUP BY 1) USING (track_id)", LIFE)
def track_outcomes(spark, sf_dir):
    rows = obs2(spark, sf_dir)
    results = ages(rows).where("track_id < 7").select("seq_id", "track_id", F.lit("saved").alias("status"))
    last = rows.groupBy("seq_id", "track_id").agg(F.max("frame_id").alias("last_frame"))
    return evaluate.track_outcomes(ages(rows), results, last).select("track_id", "status", "hit_count", "last_frame")


# --- exports, replay and reports ------------------------------------------


def object_states(spark, sf_dir):
    """Active states of the objects in the frames they are seen in."""
    return obs2(spark, sf_dir).select("seq_id", "frame_id", "track_id", F.lit("matched").alias("status"), "cx", "cy", "cz", F.lit(1).alias("age"), F.lit(0).alias("missed"))


@query("""SELECT frame_id, '{"frame_id":' || frame_id || ',"tracks":[' || string_agg('{"track_id":' || track_id || ',"status":"matched","age":1,"missed":0}', ',' ORDER BY track_id) || ']}' AS json FROM obs2 GROUP BY 1""")
def tracker_debug_json(spark, sf_dir):
    return reports.debug_rows(object_states(spark, sf_dir)).drop("seq_id")


@query("""SELECT track_id, 'track_' || lpad(track_id::VARCHAR, 4, '0') AS stem, '{"age":' || age || ',"hit_count":' || hit_count || CASE WHEN track_id % 2 = 0 THEN ',"note":"even"' ELSE '' END || '}' AS json FROM life""", LIFE)
def track_json_rows(spark, sf_dir):
    rows = ages(obs2(spark, sf_dir)).select("track_id", "age", "hit_count", F.when(F.col("track_id") % 2 == 0, "even").alias("note"))
    made = rows.withColumn("json", F.to_json(F.struct("age", "hit_count", "note")))
    return made.select("track_id", reports.stem("track", "track_id").alias("stem"), "json")


WINDOWS = "la AS (SELECT track_id, max(frame_id) AS last_index FROM obs2 GROUP BY 1)"


@query("SELECT track_id, last_index, CAST(last_index + k AS INTEGER) AS playback FROM la, range(0, 20) r(k)", WINDOWS)
def outcome_event_windows(spark, sf_dir):
    return reports.outcome_windows(obs2(spark, sf_dir).groupBy("track_id").agg(F.max("frame_id").alias("last_index")))


@query("SELECT track_id, last_index, CAST(last_index + k AS INTEGER) AS playback FROM la, range(0, 20) r(k) WHERE last_index + k <= 29", WINDOWS)
def save_event_windows(spark, sf_dir):
    return reports.save_windows(obs2(spark, sf_dir).groupBy("track_id").agg(F.max("frame_id").alias("last_index")), 29)


@query("SELECT a AS lead, b AS rear, CAST(s + k AS INTEGER) AS playback, CASE WHEN s + k < e THEN 'active' ELSE 'outcome' END AS kind FROM (SELECT a, b, min(frame_id) AS s, max(frame_id) AS e FROM sh WHERE b = a + 1 GROUP BY 1, 2), range(0, 60) r(k) WHERE s + k <= e + 19", SHARED)
def link_event_windows(spark, sf_dir):
    shared = postprocess.shared_frames(obs2(spark, sf_dir)).where("b = a + 1").groupBy("seq_id", F.col("a").alias("lead"), F.col("b").alias("rear")).agg(F.min("frame_id").alias("start"), F.max("frame_id").alias("end"))
    return reports.link_windows(shared).select("lead", "rear", "playback", "kind")


@query("SELECT frame_id, count(*) AS n FROM obs2 WHERE track_id IN (SELECT track_id FROM life WHERE hit_count >= 24) GROUP BY 1", LIFE)
def visible_aggregates(spark, sf_dir):
    return reports.visible(object_states(spark, sf_dir), ages(obs2(spark, sf_dir)).where("hit_count >= 24")).groupBy("frame_id").agg(F.count("*").alias("n"))


@query("SELECT track_id, frame_id FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY frame_id DESC) AS back FROM (SELECT *, max(isl) OVER (PARTITION BY track_id) AS cur, max(frame_id) OVER (PARTITION BY track_id) AS fin FROM (SELECT *, frame_id - row_number() OVER (PARTITION BY track_id ORDER BY frame_id) AS isl FROM obs2 WHERE frame_id <= 22)) WHERE isl = cur AND fin = 22) WHERE back <= 3")
def trajectory_tail(spark, sf_dir):
    return reports.trajectory_tail(object_states(spark, sf_dir), 22, 3).select("track_id", "frame_id")


@query("SELECT frame_id, printf('frame %d: matched %d, missed %d, spawned %d', frame_id, count(*), 0, 0) AS line FROM obs2 GROUP BY 1")
def hud_lines(spark, sf_dir):
    return reports.hud(tracking.frame_metrics(object_states(spark, sf_dir))).select("frame_id", "line")


RUNS = "runs AS (SELECT o_orderpriority AS tracker, o_orderstatus AS clusterer, o_custkey % 3 AS preset, o_orderkey AS run_index, CAST(o_totalprice * 100 + 0.5 AS BIGINT) AS wall FROM orders)"


def bench_runs(spark, sf_dir, *more):
    """Orders as runs of a benchmark: priority and status stand for components, price for seconds."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderpriority").alias("tracker"), F.col("o_orderstatus").alias("clusterer"), (F.col("o_custkey") % 3).alias("preset"), F.col("o_orderkey").alias("run_index"), cents.alias("wall"), *more)


RUNS = RUNS.replace("CAST(o_totalprice * 100 + 0.5 AS BIGINT)", "CAST(round(o_totalprice * 100) AS BIGINT)")
AGG = RUNS + ", mid AS (SELECT tracker, clusterer, quantile_cont(wall::DOUBLE, 0.5) AS median, min(wall) AS least, max(wall) AS most, quantile_cont(wall::DOUBLE, 0.9) AS p90, count(*) AS n FROM runs GROUP BY 1, 2)"


@query(f"SELECT tracker, clusterer, {m('median')} AS median, least, most, {m('p90')} AS p90, n AS runs, (SELECT run_index FROM runs r WHERE r.tracker = mid.tracker AND r.clusterer = mid.clusterer ORDER BY abs(wall - median), run_index LIMIT 1) AS representative FROM mid", AGG)
def benchmark_aggregates(spark, sf_dir):
    out = reports.run_aggregates(bench_runs(spark, sf_dir), ["tracker", "clusterer"], "wall")
    return out.select("tracker", "clusterer", milli(F.col("median")).alias("median"), "least", "most", milli(F.col("p90")).alias("p90"), "runs", "representative")


@query("SELECT tracker, clusterer, CAST(row_number() OVER (ORDER BY median, tracker, clusterer) AS INTEGER) AS place FROM mid", AGG)
def benchmark_leaderboard(spark, sf_dir):
    rows = reports.run_aggregates(bench_runs(spark, sf_dir), ["tracker", "clusterer"], "wall")
    return reports.leaderboard(rows, [F.col("median"), F.col("tracker"), F.col("clusterer")]).select("tracker", "clusterer", "place")


MEDIANS = RUNS.replace("AS wall FROM", "AS wall, o_custkey % 11 AS saved, o_custkey % 7 AS quality FROM") + ", md AS (SELECT tracker, clusterer, quantile_cont(wall::DOUBLE, 0.5) AS wall, quantile_cont(saved::DOUBLE, 0.5) AS saved, quantile_cont(quality::DOUBLE, 0.5) AS quality, max(wall) AS memory, count(*) AS runs FROM runs GROUP BY 1, 2)"


def ranked_medians(spark, sf_dir):
    """Medians of the runs; shares of the customer key stand for clouds saved and quality."""
    runs = bench_runs(spark, sf_dir, "o_custkey").withColumns({"saved": F.col("o_custkey") % 11, "quality_mean": F.col("o_custkey") % 7, "peak_rss_mb": F.col("wall").cast("double")}).withColumnRenamed("wall", "total_wall_seconds").drop("o_custkey", "preset")
    measures = {c: F.lit(0.0) for c in ("registration_accept_rate", "mean_length_saved", "mean_component_count_saved", "compute_wall_seconds", "total_cpu_seconds")}
    return reports.median_rows(runs.withColumns(measures), ["tracker", "clusterer"])


@query("SELECT tracker, clusterer, runs, CAST(row_number() OVER (ORDER BY -saved, -quality, wall, tracker, clusterer) AS INTEGER) AS overall, CAST(row_number() OVER (ORDER BY -memory, tracker, clusterer) AS INTEGER) AS most_memory, CAST(row_number() OVER (ORDER BY wall, tracker, clusterer) AS INTEGER) AS fastest FROM md", MEDIANS)
def benchmark_orders(spark, sf_dir):
    rows = ranked_medians(spark, sf_dir)
    for name in ("overall", "most_memory", "fastest"):
        rows = reports.leaderboard(rows, reports.order(name, ["tracker", "clusterer"])).withColumnRenamed("place", name)
    return rows.select("tracker", "clusterer", "runs", "overall", "most_memory", "fastest")


@query(f"SELECT 'tracker' AS component, tracker AS value, {m('quantile_cont(wall::DOUBLE, 0.5)')} AS median, count(*) AS n FROM runs GROUP BY 2", RUNS)
def benchmark_components(spark, sf_dir):
    return reports.component_medians(bench_runs(spark, sf_dir), "tracker", "wall").withColumn("median", milli(F.col("median")))


@query(f"SELECT clusterer, preset, tracker, {m('quantile_cont(wall::DOUBLE, 0.5)')} AS median FROM runs WHERE (clusterer, preset) IN (SELECT clusterer, preset FROM runs GROUP BY 1, 2 HAVING count(DISTINCT tracker) >= 2) GROUP BY 1, 2, 3", RUNS)
def benchmark_matched_comparison(spark, sf_dir):
    out = reports.matched_comparisons(bench_runs(spark, sf_dir), "tracker", ["tracker", "clusterer", "preset"], "wall")
    return out.withColumn("median", milli(F.col("median")))


# --- whole runs -----------------------------------------------------------


def preset(**how) -> Spec:
    base = {"eps": 700.0, "voxel": 250.0, "min_points": 3, "vehicle_min_points": 1, "chunk_voxel": 70.0, "fusion_voxel": 50.0, "aggregate_voxel": 60.0, "min_saved_points": 20, "exit_margin": 2500.0, "jump_abs": 450.0, "min_component": 1, "require_exit": False}
    return Spec(box=LANE, **(base | {"tracker": tracking.TrackerConfig(**MM)} | how))


def results(spark, sf_dir, **how):
    return pipeline.run(points(spark, sf_dir), preset(**how))["results"].select("track_id", "hit_count", "n_points", "status")


@query()
def preset_kalman_voxel(spark, sf_dir):
    return results(spark, sf_dir)


@query()
def preset_hungarian_weighted(spark, sf_dir):
    return results(spark, sf_dir, clusterer="euclidean_clustering", accumulator="weighted_voxel_fusion", selection="keyframe_motion", tracker=tracking.TrackerConfig("hungarian_kalman", **MM))


@query()
def preset_voxel_consensus(spark, sf_dir):
    return results(spark, sf_dir, clusterer="voxel_grid_connected_components", accumulator="occupancy_consensus_fusion", selection="length_coverage", post=("trajectory_smoothing",), smoothing_window=3)


@query()
def preset_long_vehicles(spark, sf_dir):
    """Every post-processor and every step of accumulation."""
    post = {"post": ("tracklet_stitching", "co_moving_track_merge", "articulated_vehicle_merge", "trajectory_smoothing"), "stitch_distance": 2500.0, "smoothing_window": 3, "merge_lateral": 800.0, "merge_longitudinal": 4000.0}
    link = {"link_lateral": 900.0, "link_vertical": 600.0, "link_gap": 2500.0, "link_gap_std": 600.0, "link_speed": 500.0, "link_length": 6500.0}
    fuse = {"long_vehicles": True, "long_length": 350.0, "touch_margin": 120.0, "truncate_at_lane_end": True, "quality_window": True, "shape_ratio": 2.0, "tail_bridge": True, "bridge_gap": 1500.0, "bridge_lateral": 800.0, "bridge_vertical": 500.0, "cap_points": 50, "symmetry": True}
    return results(spark, sf_dir, metre=1000.0, **post, **link, **fuse)
