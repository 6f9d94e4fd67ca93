"""Artifacts: point clouds as PCD files, tables as JSON lines, CSV and Markdown."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pcd(points: np.ndarray, reflectivity: np.ndarray | None = None) -> str:
    """An ASCII PCD file."""
    names = ["x", "y", "z"] + ["reflectivity"] * (reflectivity is not None)
    rows = points if reflectivity is None else np.column_stack([points, reflectivity])
    n, k = len(points), len(names)
    head = ["# .PCD v0.7 - Point Cloud Data file format", "VERSION 0.7", f"FIELDS {' '.join(names)}", f"SIZE {' '.join(['4'] * k)}", f"TYPE {' '.join(['F'] * k)}", f"COUNT {' '.join(['1'] * k)}", f"WIDTH {n}", "HEIGHT 1", "VIEWPOINT 0 0 0 1 0 0 0", f"POINTS {n}", "DATA ascii"]
    return "\n".join(head + [" ".join(f"{v:.6g}" for v in r) for r in rows]) + "\n"


def write_clouds(cloud: DataFrame, path: str, kind: str = "track", intensity: bool = False) -> None:
    """One PCD file per sequence and track, as text files partitioned by sequence and stem, written by the executors to any store."""

    def run(key, track: pd.DataFrame) -> pd.DataFrame:
        lit = track["intensity"].to_numpy(float) if intensity and track["intensity"].notna().all() else None
        return pd.DataFrame({"seq_id": [key[0]], "stem": [f"{kind}_{key[1]:04d}"], "value": [pcd(track[["x", "y", "z"]].to_numpy(float), lit)]})

    rows = cloud.groupBy("seq_id", "track_id").applyInPandas(run, "seq_id string, stem string, value string")
    rows.write.partitionBy("seq_id", "stem").option("lineSep", "\n").text(path)


def write_json_lines(rows: DataFrame, path: str) -> None:
    """Columns in order of name; nulls are left out."""
    rows.select(*sorted(rows.columns)).write.option("ignoreNullFields", "true").json(path)


def write_csv(rows: DataFrame, path: str) -> None:
    """Maps and structs as JSON text."""
    flat = [F.to_json(c).alias(c) if t.startswith(("map", "struct", "array")) else F.col(c) for c, t in rows.dtypes]
    rows.select(*flat).write.option("header", "true").csv(path)


def markdown(rows: Iterator, columns: list[str]) -> str:
    """A table of a few report rows."""
    lines = ["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    return "\n".join(lines + ["| " + " | ".join(str(r[c]) for c in columns) + " |" for r in rows]) + "\n"
