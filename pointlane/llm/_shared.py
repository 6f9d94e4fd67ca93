"""Scratch tables in the cluster's shared folder, and small helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the text operators: a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one only in local mode (tests), as executors elsewhere don't share it."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="pointlane-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/pointlane/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: what was written survives lost executors. Files stay
    until the owner of the shared folder clears it.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_fold(doc_id: str = "doc_id"):
    """crc32 of the id's text, modulo 4; null ids count as fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)), F.lit(0))


def hash_fraction(*cols: str, seed: int):
    """A reproducible number in [0, 1) for a row."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in cols]), F.lit(1 << 30)) / F.lit(float(1 << 30))


def named(name: str):
    """The column of this name, whatever its letters."""
    return F.col("`" + name.replace("`", "``") + "`")


def carried(docs: DataFrame, *own: str) -> DataFrame:
    """The columns ``own`` and, in one struct ``carried``, all others: their names can't clash with what an operator adds."""
    rest = [named(c) for c in docs.columns if c not in own]
    return docs.select(*[named(c) for c in own], *([F.struct(*rest).alias("carried")] if rest else []))


def unpacked(rows: DataFrame, names: list[str], own: tuple[str, ...]) -> DataFrame:
    """The columns ``names`` of what ``carried`` packed, ``own`` ones as they now are."""
    return rows.select(*[named(c) if c in own else F.col("carried").getField(c).alias(c) for c in names])
