"""Intermediate tables written once to the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Keep = Callable[[str, DataFrame], DataFrame]


def scratch(spark: SparkSession) -> Keep:
    """A function that writes a named table under the folder that ``spark.checkpoint.dir`` names and reads it back.

    A local folder serves only in local mode, where that is unset.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="pointlane-")

    def keep(name: str, rows: DataFrame) -> DataFrame:
        path = f"{folder.rstrip('/')}/pointlane/{name}-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    return keep
