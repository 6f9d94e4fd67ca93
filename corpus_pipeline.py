"""The corpus pipeline: documents in, token ids of a mixed and deduplicated corpus out.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pointlane.llm import bpe, langid, lines, minhash, mixing
from pointlane.llm._shared import stored

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts in none of the learned languages."""
    return langid.accept(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops recurring line templates from the texts, and the documents that lose all their text by it.

    Long lines wait for the next stage, which tells near copies from documents that share a passage.
    """
    return lines.cleaned(docs, shares=lines.SHARES, long_tokens=None)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates (five words, similarity 0.8), then drops literal lines that two of these hold.

    Only here is a line in two texts no mark of near copies. Documents that lose all their text by it go.
    """
    return lines.cleaned(stored(minhash.one_of_each(docs, width=5, percent=80), "one"), drops=lines.repeats)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources come near their target weights; each file follows the schedule."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the text decoded from them, and the ids."""
    return bpe.round_trip(docs, TOKENIZER, ids=True)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("mixing", mixing_stage),
    ("bpe", tokens),
]

#: Stages 1, 3 (its search), and 5 can't be put in SQL; tests/llm hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
