"""Corpus pipeline over ``documents``: a stage list and a runner.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet in the shared checkpoint folder
and read again as the next stage's ``docs``. All but the last return the columns of ``documents``. Null and empty texts
fail the quality rules; an empty table passes through all stages empty; extra columns are kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keyrelay.llm import bpe, decontaminate, pii, quality, simhash
from keyrelay.llm.common import drop_settled, settle, settled, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy rejects go."""
    return quality.passing_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates: one document of each group stays, that of the smallest id."""
    return simhash.keep_one_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; spans of personal data are replaced by their kind, and ``n_chars`` follows the text."""
    return pii.redact_documents(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with digests of the ids and of the bytes they decode to."""
    return bpe.digests(docs, keep_ids=True)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup),
          ("benchmark_decontamination", benchmark_decontamination), ("pii_redaction", pii_redaction),
          ("bpe_encoding", bpe_encoding)]

#: SQL cannot express the near-duplicate, personal-data and encoding stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage wrote on its way, and the stage before it, are dropped once its result is written."""
    docs, kept = table(spark, sf_dir, "documents"), settled()
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
        made = [p for p in settled() if p not in kept]
        drop_settled(spark, made[:-1])
    return docs
