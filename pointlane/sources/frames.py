"""Frame files: length-delimited protocol-buffer records, as a Spark data source.

A file is [u32 little-endian length][Frame] repeated. ``frame_index`` hops from
length to length and gives a row a frame, empty ones too; ``read_points`` deals
these rows out by bytes and decodes each frame where it lands, so one large
file is many tasks, and a filter on frames or times reads no other frame.
``frame_points`` reads whole files. The wire format (varints and
length-delimited fields) is decoded vectorised. Files are opened through
``pyarrow.fs``, by path or address.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .scratch import Keep, scratch

SCHEMA = (
    "source_path string, source_index int, source_frame_index int, frame_timestamp_ns long, scan_index int, sensor_name string, x float, y float, z float, range float, "
    "row_index int, col_index int, intensity float, point_timestamp_ns long"
)


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def resolve(paths: list[str]) -> list[str]:
    """Files stay; a folder stands for its own .pb files by name; order and repeats stay; a folder without any is an error."""
    out = []
    for path in paths:
        system, inner = store(path)
        if system.get_file_info(inner).type == fs.FileType.Directory:
            names = sorted(f.base_name for f in system.get_file_info(fs.FileSelector(inner)) if f.base_name.endswith(".pb"))
            if not names:
                raise ValueError(f"no .pb file in {path}")
            out += [f"{path.rstrip('/')}/{name}" for name in names]
        else:
            out.append(path)
    return out


def varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a message: numbers as integers, 4- and 8-byte values and texts as bytes."""
    at = 0
    while at < len(data):
        key, at = varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = varint(data, at)
        elif kind == 2:
            size, at = varint(data, at)
            value, at = data[at : at + size], at + size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"wire type {kind} at byte {at}")
        yield key >> 3, value


def read_frames(path: str) -> Iterator[bytes]:
    system, inner = store(path)
    with system.open_input_file(inner) as file:
        size_of_file = file.size()
        while file.tell() < size_of_file:
            yield _body(file, path)


def _size(file, path: str) -> int:
    head = file.read(4)
    if len(head) < 4:
        raise ValueError(f"{path} ends within a frame")
    return struct.unpack("<I", head)[0]


def _body(file, path: str) -> bytes:
    size = _size(file, path)
    body = file.read(size)
    if len(body) < size:
        raise ValueError(f"{path} ends within a frame")
    return body


#: Bytes of a frame in which its timestamp, its first field, is looked for before the whole frame is read.
HEAD = 64


def index_frames(path: str) -> Iterator[tuple[int, int, int]]:
    """(offset of the frame's bytes, their number, timestamp) of every frame, reading little more than the lengths."""
    system, inner = store(path)
    with system.open_input_file(inner) as file:
        end, at = file.size(), 0
        while at < end:
            file.seek(at)
            size = _size(file, path)
            if at + 4 + size > end:
                raise ValueError(f"{path} ends within a frame")
            head = file.read(min(size, HEAD))
            stamp = 0
            if head[:1] == b"\x08":  # field 1, a number
                stamp, _ = varint(head, 1)
            elif size:
                stamp = int(dict(fields(head + file.read(size - len(head)))).get(1, 0))
            yield at + 4, size, stamp
            at += 4 + size


def signal(raw: bytes, n: int) -> np.ndarray | None:
    """Intensity in 0..1 from n bytes, 16-bit or 32-bit values; another length: none."""
    if len(raw) == n and n:
        return np.frombuffer(raw, np.uint8) / np.float32(255)
    if len(raw) == 2 * n and n:
        return np.frombuffer(raw, "<u2") / np.float32(65535)
    if len(raw) == 4 * n and n:
        v = np.nan_to_num(np.frombuffer(raw, "<f4"), nan=0, posinf=0, neginf=0)
        low, high = float(v.min()), float(v.max())
        if low < 0 or high > 1:
            v = (v - low) / max(high - low, 1e-12)
        return np.clip(v, 0, 1)
    return None


def decode_scan(data: bytes, with_intensity: bool = True) -> dict | None:
    """Columns of a scan's finite points; None if there is none."""
    scan = dict(fields(data))
    cloud = dict(fields(scan.get(3, b"")))
    xyz = np.frombuffer(cloud.get(1, b""), "<f4").reshape(-1, 3)
    ok = np.isfinite(xyz).all(1)
    if not ok.any():
        return None
    n = len(xyz)
    p = xyz[ok]
    range_ = np.linalg.norm(p.astype(float), axis=1)
    lit = None
    if with_intensity:
        bright = cloud.get(5, b"")
        lit = np.frombuffer(bright, "<u2") / np.float32(65535) if n and len(bright) == 2 * n else signal(cloud.get(2, b""), n)
        lit = None if lit is None else lit[ok] * range_**2
    offset = cloud.get(6, b"")
    stamp = int(scan.get(2, 0))
    time = np.frombuffer(offset, "<u8")[ok].astype(np.int64) + stamp if len(offset) == 8 * n else None
    cal = dict(fields(scan.get(4, b"")))
    single = lambda raw: struct.unpack("<f", raw)[0] if raw else 0.0
    as_radians = lambda v: np.radians(v) if abs(v) > np.pi else v
    up = np.arcsin(np.clip(p[:, 2] / np.maximum(range_, 1e-6), -1, 1))
    channel, beams = cloud.get(7, b""), np.frombuffer(cal.get(8, b""), "<f4").astype(float)
    rows = max(1, int(cal.get(5, 0)))
    if len(channel) == 4 * len(p):
        row = np.frombuffer(channel, "<u4").astype(int)
    elif len(beams):
        row = np.abs(up[:, None] - beams[None]).argmin(1)
    elif rows == 1:
        row = np.zeros(len(p), int)
    else:
        half = as_radians(single(cal.get(3, b""))) / 2
        low, span = (-half, 2 * half) if half > 0 else (up.min(), np.ptp(up))
        row = np.clip(np.floor((up - low) / max(span, 1e-6) * rows), 0, rows - 1).astype(int)
    cols, spacing = int(cal.get(6, 0)), as_radians(single(cal.get(7, b"")))
    if cols <= 0:
        cols = max(16, round(2 * np.pi / max(spacing, 1e-6))) if spacing > 0 else max(16, len(p))
    col = np.floor((np.arctan2(p[:, 1], p[:, 0]) + np.pi) / (2 * np.pi) * cols).astype(int) % cols
    sensor = cal.get(1, b"").decode() or "unknown"
    return {"sensor_name": sensor, "p": p, "range": range_, "row": row, "col": col, "intensity": lit, "time": time}


INDEX = "source_path string, source_index int, source_frame_index int, offset long, size long, frame_timestamp_ns long"


class FrameIndex(DataSource):
    """A row a frame of the files: ``format("frame_index")``."""

    @classmethod
    def name(cls) -> str:
        return "frame_index"

    def schema(self) -> str:
        return INDEX

    def reader(self, schema) -> _IndexReader:
        return _IndexReader(self.options)


class FramePoints(DataSource):
    """``spark.read.format("frame_points").option("paths", "a.pb,folder").load()``"""

    @classmethod
    def name(cls) -> str:
        return "frame_points"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


class _File(InputPartition):
    def __init__(self, index: int, path: str) -> None:
        self.index, self.path = index, path


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.paths = resolve([p for p in options.get("paths", options.get("path", "")).split(",") if p])
        self.with_intensity = options.get("intensity", "true").lower() == "true"

    def partitions(self) -> list[InputPartition]:
        return [_File(k, p) for k, p in enumerate(self.paths)]

    def read(self, part: _File) -> Iterator[pa.RecordBatch]:
        for k, body in enumerate(read_frames(part.path)):
            yield from decode_frame(body, part.path, part.index, k, self.with_intensity)


class _IndexReader(_Reader):
    def read(self, part: _File) -> Iterator[tuple]:
        for k, (offset, size, stamp) in enumerate(index_frames(part.path)):
            yield part.path, part.index, k, offset, size, stamp


def decode_frame(body: bytes, path: str, index: int, k: int, with_intensity: bool = True) -> Iterator[pa.RecordBatch]:
    """The points of a frame as SCHEMA has them, a batch for each scan that has any."""
    names = [c.strip().split(" ")[0] for c in SCHEMA.split(",")]
    frame: dict[int, list] = {}
    for number, value in fields(body):
        frame.setdefault(number, []).append(value)
    scans = [(n, s) for n, raw in enumerate(frame.get(2, [])) if (s := decode_scan(raw, with_intensity)) is not None]
    # Optional columns hold for a frame only if all its scans have them.
    lit, timed = all(s["intensity"] is not None for _, s in scans), all(s["time"] is not None for _, s in scans)
    for n, s in scans:
        size = len(s["p"])
        const = lambda v, t: pa.array([v] * size, t)  # noqa: B023, E731
        yield pa.RecordBatch.from_arrays([
            const(path, pa.string()), const(index, pa.int32()), const(k, pa.int32()), const(int(frame.get(1, [0])[0]), pa.int64()), const(n, pa.int32()), const(s["sensor_name"], pa.string()),
            *[pa.array(s["p"][:, a], pa.float32()) for a in range(3)], pa.array(s["range"].astype(np.float32)), pa.array(s["row"].astype(np.int32)), pa.array(s["col"].astype(np.int32)),
            pa.array(s["intensity"].astype(np.float32)) if lit else pa.nulls(size, pa.float32()), pa.array(s["time"]) if timed else pa.nulls(size, pa.int64()),
        ], names)


#: How files make sequences: all one, each file one, or each folder one.
SEQUENCES = ("all", "file", "folder")


def read_index(spark: SparkSession, paths: list[str], sequence: str = "all", keep: Keep | None = None) -> DataFrame:
    """(seq_id, frame_index, frame_timestamp_ns, source_path, source_index, source_frame_index, offset, size): a row a frame, without points too.

    frame_index runs over the files of a sequence in their order.
    """
    if sequence not in SEQUENCES:
        raise ValueError(f"unknown sequence {sequence!r}; known: {', '.join(SEQUENCES)}")
    spark.dataSource.register(FrameIndex)
    rows = spark.read.format("frame_index").option("paths", ",".join(paths)).load()
    name = {"all": F.lit("s0"), "file": F.element_at(F.split("source_path", "/"), -1), "folder": F.regexp_extract("source_path", "([^/]*)/[^/]*$", 1)}[sequence]
    rows = (keep or scratch(spark))("frame_index", rows.withColumn("seq_id", name))
    # Frames before each file: a count a file, summed up.
    counts = rows.groupBy("seq_id", "source_index").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("seq_id").orderBy("source_index").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col("source_index").alias("of"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    rows = rows.join(before, F.col("source_index") == F.col("of"))
    return rows.select("seq_id", (F.col("source_frame_index") + F.col("before")).cast("int").alias("frame_index"), "frame_timestamp_ns", "source_path", "source_index", "source_frame_index", "offset", "size")


def decode(index: DataFrame, intensity: bool = True, part_bytes: int = 32 << 20) -> DataFrame:
    """The points of the frames of ``index`` (or what a filter leaves of it), with point_id: frame_index and number in the frame.

    Frames are dealt out by hash over as many tasks as their bytes make parts; a task reads the bytes of its frames alone.
    """
    total = index.agg(F.sum("size")).first()[0] or 0
    dealt = index.repartition(max(1, -(-total // part_bytes)), "source_index", "source_frame_index").sortWithinPartitions("source_index", "source_frame_index")
    schema = f"seq_id string, frame_index int, point_id long, {SCHEMA}"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["source_path"] != path:
                    path = row["source_path"]
                    system, inner = store(path)
                    file = system.open_input_file(inner)
                file.seek(row["offset"])
                done = 0
                for part in decode_frame(file.read(row["size"]), path, row["source_index"], row["source_frame_index"], intensity):
                    n = part.num_rows
                    number = (row["frame_index"] << 32) + done + np.arange(n)
                    yield pa.RecordBatch.from_arrays([pa.array([row["seq_id"]] * n), pa.array([row["frame_index"]] * n, pa.int32()), pa.array(number), *part.columns], ["seq_id", "frame_index", "point_id", *part.schema.names])
                    done += n

    return dealt.select("seq_id", "frame_index", "source_path", "source_index", "source_frame_index", "offset", "size").mapInArrow(work, schema)


def read_points(spark: SparkSession, paths: list[str], intensity: bool = True, sequence: str = "all") -> DataFrame:
    """The points of all files, with seq_id, point_id and a frame_index that runs over the files of a sequence."""
    return decode(read_index(spark, paths, sequence), intensity)


LABELS = "source_path string, source_index int, source_frame_index int, object_id int, timestamp_ns long, obj_class string, obj_class_score float, sensor_name string, point_count int, points array<struct<x:float,y:float,z:float>>"


class FrameLabels(FramePoints):
    """The labelled objects of the same files: ``format("frame_labels")``."""

    @classmethod
    def name(cls) -> str:
        return "frame_labels"

    def schema(self) -> str:
        return LABELS

    def reader(self, schema) -> _Reader:
        return _LabelReader(self.options)


class _LabelReader(_Reader):
    def read(self, part: _File) -> Iterator[tuple]:
        for k, body in enumerate(read_frames(part.path)):
            for number, value in fields(body):
                if number != 2:
                    continue
                pairs = list(fields(value))
                sensor = dict(fields(dict(pairs).get(4, b""))).get(1, b"").decode() or "unknown"
                for of, raw in pairs:
                    if of == 5:
                        box = dict(fields(raw))
                        p = np.frombuffer(dict(fields(box.get(7, b""))).get(1, b""), "<f4").reshape(-1, 3)
                        p = p[np.isfinite(p).all(1)].tolist()
                        score = struct.unpack("<f", box[9])[0] if box.get(9) else 0.0
                        yield part.path, part.index, k, int(box.get(1, 0)), int(box.get(2, 0)), box.get(8, b"").decode(), score, sensor, len(p), [tuple(x) for x in p]


def read_labels(spark: SparkSession, paths: list[str]) -> DataFrame:
    spark.dataSource.register(FrameLabels)
    return spark.read.format("frame_labels").option("paths", ",".join(paths)).load()


def read_sequence_labels(spark: SparkSession, paths: list[str], sequence: str = "all") -> DataFrame:
    """The labelled objects with seq_id and the frame_index that ``read_points`` gives the same frames; ``row_id`` rises in a file's order."""
    index = read_index(spark, paths, sequence).select("seq_id", "frame_index", "source_index", "source_frame_index")
    return read_labels(spark, paths).withColumn("row_id", F.monotonically_increasing_id()).join(index, ["source_index", "source_frame_index"])
