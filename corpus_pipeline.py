"""Training-data pipeline: documents to packed token sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept,
and returns a DataFrame; all but the last return the columns of documents. Ids
may repeat or be null; only the near-copy stage leaves out rows that repeat.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import jaccard, line_dedup, packing, quality, toxicity
from quire.llm.queries import token_pieces
from quire.scratch import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    judged, _ = quality.quality_filter(docs.select(*COLUMNS))
    return judged.where(F.col("failed_rule").isNull()).select(*COLUMNS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the cut-off of a model learned from labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.learn(docs, labels, toxicity.held_out())
    scored = toxicity.score_texts(docs, model, keep=COLUMNS)
    return scored.where(F.col("predicted") == 0).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share; ``n_chars`` follows the text."""
    cleaned = line_dedup.drop_shared_lines(docs.select(*COLUMNS))
    return cleaned.withColumn("text", F.col("kept_text")).select(
        "doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars")
    )


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near copies, one without an id only if the group has no other.

    Documents are told by id and text, so unrelated texts under one id all stay.
    """
    named = docs.select(F.xxhash64("doc_id", "text").alias("_id"), *COLUMNS)
    groups = jaccard.near_copies(named.select("_id", "text"), "_id").select("_id", "component_id").distinct()
    ids = named.select(F.col("_id").alias("_own"), "doc_id").distinct()
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_id")
    first = (
        groups.join(ids.hint("merge"), F.col("_id") == F.col("_own"))
        .groupBy("component_id")
        .agg(F.min_by("_id", order).alias("_first"))
    )
    kept = named.join(first.hint("merge"), F.col("_id") == F.col("_first"), "left_semi")
    return kept.dropDuplicates(["_id"]).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in sequences."""
    return packing.pack(token_pieces(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("near_copies", near_copy_stage),
    ("packing", packing_stage),
]

# A learned model, a similarity join and a packing search are no SQL: tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents table; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
