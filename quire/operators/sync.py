"""Bringing an index in line with its source table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.ids import content_hash
from quire.scratch import broadcast_if_small, checkpoint


def with_content_hash(df: DataFrame, content: str, out: str = "content_hash") -> DataFrame:
    return df.withColumn(out, content_hash(content))


def sync_diff(source: DataFrame, index: DataFrame, key: str, hashed: str = "content_hash") -> DataFrame:
    """Action per key: insert, update, delete or keep.

    Only key and hash meet in the full outer join; texts and vectors stay put.
    """
    new = source.select(key, F.col(hashed).alias("source_hash"))
    old = index.select(key, F.col(hashed).alias("index_hash"), F.lit(True).alias("_indexed"))
    action = (
        F.when(F.col("_indexed").isNull(), F.lit("insert"))
        .when(F.col("_sourced").isNull(), F.lit("delete"))
        .when(~F.col("source_hash").eqNullSafe(F.col("index_hash")), F.lit("update"))
        .otherwise(F.lit("keep"))
    )
    return (
        new.withColumn("_sourced", F.lit(True))
        .join(old, key, "full_outer")
        .select(key, action.alias("action"), "source_hash", "index_hash")
    )


def apply_sync(source: DataFrame, index: DataFrame, key: str, hashed: str = "content_hash") -> DataFrame:
    """The index after the sync: kept entries plus the source's new versions.

    The changed keys are kept in the shared folder; while they are few, neither
    the index nor the source is shuffled to apply them.
    """
    diff = sync_diff(source, index, key, hashed).select(key, "action")
    changes = checkpoint(diff.filter(F.col("action") != "keep"))
    gone = broadcast_if_small(changes.filter(F.col("action").isin("update", "delete")).select(key))
    fresh = broadcast_if_small(changes.filter(F.col("action").isin("insert", "update")).select(key))
    return index.join(gone, key, "left_anti").unionByName(
        source.join(fresh, key, "left_semi").select(*index.columns)
    )


def sync_counts(diff: DataFrame) -> DataFrame:
    return diff.groupBy("action").agg(F.count("*").alias("keys"))
