"""Category listings without collecting a category into one row or task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def category_listing(items: DataFrame, category: str, item: str) -> DataFrame:
    """Sorted categories, each followed by its items.

    A header row per category carries the number of items. Ordering is one
    range-partitioned sort on (category, item), so a category that holds a
    large share of the rows spreads over several tasks.
    """
    headers = items.groupBy(category).agg(F.count("*").alias("n_items")).select(
        F.col(category).alias("category"),
        F.lit(0).alias("level"),
        F.lit(None).cast("string").alias("item"),
        "n_items",
    )
    rows = items.select(
        F.col(category).alias("category"),
        F.lit(1).alias("level"),
        F.col(item).cast("string").alias("item"),
        F.lit(None).cast("long").alias("n_items"),
    )
    return headers.unionByName(rows).orderBy("category", "level", "item")


def category_sample(
    items: DataFrame, category: str, item: str, categories: int = 5, per_category: int = 2
) -> DataFrame:
    """First items of each of the first categories, and how many more there are."""
    first = (
        items.filter(F.col(category).isNotNull())
        .groupBy(category)
        .agg(F.count("*").alias("n_items"))
        .orderBy(category)
        .limit(categories)
    )
    order = W.partitionBy(category).orderBy(item)
    return (
        items.join(F.broadcast(first), category)  # at most `categories` rows
        .select(category, item, "n_items", F.row_number().over(order).cast("long").alias("position"))
        .filter(F.col("position") <= per_category)
        .withColumn("more", F.greatest(F.col("n_items") - per_category, F.lit(0)))
        .orderBy(category, "position")
    )
