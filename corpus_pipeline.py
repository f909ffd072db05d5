"""Documents made ready for training: five stages, each over all that the one before has kept.

Toxic documents, repeated lines, near duplicates and documents with benchmark
passages go; what is left is packed into sequences. A document goes with line
dedup only if repeated lines were all its text. The last stage has a row for each
packed piece, the others have the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventide.llm import decontamination, line_dedup, near_dedup, packing, toxicity
from eventide.llm.common import saved, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold of their language; learned from all labelled ones."""
    return toxicity.clean_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.clean_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.clean_documents(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: A classifier and a packing decide on rows, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is a Parquet table that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
