"""From raw documents to packed training sequences: each stage works on all that the one before it kept.

All stages take and, but for the last, return the columns of documents, and keep every row that they don't decide to drop.  Null and empty texts
pass the first three stages; they have no tokens, so the last two leave them out.  Repeated rows go in near_dedup.  An empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomwright.llm import dedup, mixing, packing, pii, toxicity
from loomwright.llm.common import durable, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that aren't toxic, by a classifier fitted on a bounded sample of the labels."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, and all rows that are in none."""
    return dedup.drop_near_duplicates(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with personal data replaced."""
    return pii.redact_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with tokens, in the order of the schedule, by which the next stage packs."""
    return mixing.mix_documents(docs, whole=True)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(bin, offset, doc_id, first, n): documents packed within windows of the rows as the mix has ordered them, so that the bins keep it.  The
    order is that in which the rows are stored, in files or in partitions; nothing is scheduled again."""
    return packing.pack_rows(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: The classifier and the signatures can't be said in SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = durable(docs)
    return docs
