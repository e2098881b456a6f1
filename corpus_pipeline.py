"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept, and gives the columns
of documents again, but for the last. All stages take an empty table to an empty one, keep repeated rows
apart from each other (but for near duplicates, whose copies they are), read columns by their places, so that
extra ones of any name pass through, and take texts whole, however long. run() writes each stage's rows as Parquet to the shared folder that the
session names in spark.checkpoint.dir, and reads them again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.llm import decontaminate, neardup, packing, quality, secrets
from scriptoria.llm.common import shared_folder, table

ORACLE_SQL = None


def rate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the ordinal model of the labelled ones finds good: a chance of the top grade of just the bound stays.

    Null texts rate like empty ones. Without labels, or labels of one grade, all stay.
    """
    model = quality.train(docs, quality.graded(table(spark, sf_dir, "labels")))
    return quality.select(docs, model)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates: the least id, then the least hash of the row; rows without an id come last.

    Null texts are empty ones; texts without words are of one class only where they are the same.
    """
    return neardup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents in which no benchmark item is found; null and empty texts stay, as do all without items."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts a mark in the place of every secret; n_chars is the new length. Null texts and their n_chars stay as they are."""
    out = secrets.redact(docs)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of the permitted lengths, long ones in pieces; null and empty texts have their end only."""
    return packing.pack_sequences(docs)


STAGES = [("quality", rate), ("near_duplicates", dedup), ("decontamination", decontaminated), ("secrets", redact), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, all stages applied to documents."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
