"""Table and file sinks."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(df: DataFrame, name: str, rebalance: bool = False) -> None:
    """Managed table, replaced as a whole, schema included.

    ``rebalance`` adds a shuffle that evens out the sizes of the files.
    """
    rows = df.hint("rebalance") if rebalance else df
    rows.write.mode("overwrite").saveAsTable(name)


def write_bucketed_folders(df: DataFrame, path: str, key: str = "doc_id", buckets: int = 64) -> None:
    """Parquet folders by a hash bucket of the key.

    The number of folders is fixed, however many documents there are. The
    rebalance hint gathers a bucket in few files of even size, and splits a
    bucket that a document with very many pages makes large.
    """
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")
    placed = df.withColumn("doc_bucket", bucket).hint("rebalance", "doc_bucket")
    placed.write.mode("overwrite").partitionBy("doc_bucket").parquet(path)


def write_bucketed_table(df: DataFrame, name: str, keys: list[str], buckets: int = 64) -> DataFrame:
    """Managed table in hash buckets of ``keys``, sorted by them, replaced as a whole and read back.

    Two such tables with the same keys and number of buckets are joined on the
    keys without a shuffle. Rows are dealt by the keys first, so a bucket is one
    file; the whole key, such as document and page, spreads a large document.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def read_bucketed(spark, path: str, key: str, value, buckets: int = 64) -> DataFrame:
    """Rows of one key; only its bucket's folder is read."""
    wanted = F.lit(value)
    bucket = F.pmod(F.xxhash64(wanted), F.lit(buckets)).cast("int")
    return (
        spark.read.parquet(path)
        .filter((F.col("doc_bucket") == bucket) & (F.col(key) == wanted))
        .drop("doc_bucket")
    )


def append_evolving(df: DataFrame, path: str) -> None:
    """Append files whose schema may have new columns; read with merging."""
    df.write.mode("append").parquet(path)


def create_table_as(spark, name: str, select: str) -> None:
    """Replace a table by the result of a SELECT."""
    spark.sql(select).write.mode("overwrite").saveAsTable(name)


def write_staged(df: DataFrame, name: str) -> DataFrame:
    """Drop and rewrite a staging table, then read it back."""
    spark = df.sparkSession
    staged = f"{name}_temp"
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    df.write.saveAsTable(staged)
    return spark.table(staged)


def write_observed(df: DataFrame, path: str, **metrics: Column) -> dict:
    """Write parquet; returns metrics counted in the same pass and throughput.

    Besides the named metrics: rows_written, elapsed_seconds, rows_per_second.
    """
    seen = Observation()
    counted = F.count(F.lit(1)).alias("rows_written")
    named = [m.alias(k) for k, m in metrics.items()]
    began = time.perf_counter()
    df.observe(seen, counted, *named).write.mode("overwrite").parquet(path)
    elapsed = time.perf_counter() - began
    got = dict(seen.get)
    return {**got, "elapsed_seconds": elapsed, "rows_per_second": got["rows_written"] / elapsed}


def scalar_columns(df: DataFrame) -> list[str]:
    nested = (T.ArrayType, T.MapType, T.StructType)
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, nested)]


def export_rows(hits: DataFrame, rank: str = "rank") -> DataFrame:
    """Rank plus every scalar field as text; nested values are left out."""
    others = [c for c in scalar_columns(hits) if c != rank]
    return hits.select(F.col(rank), *[F.col(c).cast("string").alias(c) for c in others])


def export_csv(hits: DataFrame, path: str, rank: str = "rank") -> None:
    export_rows(hits, rank).write.mode("overwrite").option("header", True).csv(path)
