"""Lists of objects: a PCD file for each row and a manifest that names exactly the committed ones.

    spark.dataSource.register(ObjectList)
    rows.write.format("object_list").option("path", folder).mode("append").save()

Rows: stem, points (array of struct x, y, z), and any columns for the manifest;
``seq_id``, if among them, is a folder. Executors write the files. A task
collects its manifest rows in a pending part; commit moves the parts of the
attempts that count to ``manifest/``, so a killed or repeated attempt leaves no
row. A task that outlives a failed job may leave files and a pending part;
nothing reads either.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyarrow import fs
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .frames import store
from .sinks import pcd

#: Columns of the manifest of labelled objects.
LABEL_COLUMNS = ("object_id", "timestamp_ns", "frame_index", "sensor_name", "obj_class", "obj_class_score", "point_count", "source_path")


@dataclass
class Part(WriterCommitMessage):
    name: str
    rows: int


class ObjectList(DataSource):
    @classmethod
    def name(cls) -> str:
        return "object_list"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if missing := {"stem", "points"} - set(schema.names):
            raise ValueError(f"columns are missing: {sorted(missing)}")
        if overwrite:
            raise ValueError("an object list is appended to; write to a new folder instead")
        return _Writer(self.options["path"])


class _Writer(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")
        #: Of this job alone: another one's end takes nothing from it.
        self.pending = f"_pending/{uuid.uuid4().hex}"

    def _put(self, name: str, text: str) -> None:
        system, inner = store(f"{self.path}/{name}")
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(inner) as out:
            out.write(text.encode())

    def write(self, iterator: Iterator[Row]) -> Part:
        rows = []
        for row in iterator:
            given = row.asDict()
            points, stem = given.pop("points"), given.pop("stem")
            folder = given.get("seq_id")
            name = f"{stem}.pcd" if folder is None else f"{folder}/{stem}.pcd"
            self._put(name, pcd(np.array([tuple(p) for p in points or []], float).reshape(-1, 3)))
            rows.append(given | {"pcd_path": name, "point_count": len(points or [])})
        part = Part(f"{uuid.uuid4().hex}.jsonl", len(rows))
        if rows:
            self._put(f"{self.pending}/{part.name}", "".join(json.dumps(r, sort_keys=True, default=str) + "\n" for r in rows))
        return part

    def commit(self, messages: list[Part | None]) -> None:
        system, inner = store(self.path)
        system.create_dir(f"{inner}/manifest", recursive=True)
        for part in messages:
            if part is not None and part.rows:
                system.move(f"{inner}/{self.pending}/{part.name}", f"{inner}/manifest/{part.name}")
        self._sweep()

    def abort(self, messages: list[Part | None]) -> None:
        self._sweep()

    def _sweep(self) -> None:
        system, inner = store(self.path)
        if system.get_file_info(f"{inner}/{self.pending}").type == fs.FileType.Directory:
            system.delete_dir(f"{inner}/{self.pending}")


def write_objects(rows: DataFrame, path: str) -> None:
    rows.sparkSession.dataSource.register(ObjectList)
    rows.write.format("object_list").option("path", path).mode("append").save()


def write_labels(labels: DataFrame, path: str) -> None:
    """The newest label of each object: its points as a file, the rest in the manifest."""
    kept = [c for c in ("seq_id", *LABEL_COLUMNS) if c in labels.columns]
    write_objects(labels.select(F.format_string("object_%04d", F.col("object_id").cast("int")).alias("stem"), "points", *kept), path)


def write_clouds(cloud: DataFrame, results: DataFrame, chosen: DataFrame, path: str) -> None:
    """A file for each cloud; the manifest holds its track's status, chosen frames and metrics.

    Rows of one cloud meet in one row, as a file is one task's anyway.
    """
    track = ["seq_id", "track_id"]
    points = cloud.groupBy(*track).agg(F.sort_array(F.collect_list(F.struct(*[F.col(a).cast("double").alias(a) for a in "xyz"]))).alias("points"))
    frames = chosen.groupBy(*track).agg(F.sort_array(F.collect_set("frame_id")).alias("selected_frame_ids"))
    known = results.select(*track, "status", "stage", F.col("hit_count"), F.col("quality_score"))
    rows = points.join(known, track).join(frames, track, "left")
    write_objects(rows.select(F.format_string("track_%04d", "track_id").alias("stem"), "points", *track, "status", "stage", "hit_count", "quality_score", "selected_frame_ids"), path)
