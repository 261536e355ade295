"""Named tables, records, manifests and catalog listings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table below a folder; the reader's settings alone decide its splits."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files whose schema grew over time, columns merged by name."""
    return spark.read.option("mergeSchema", True).parquet(path)


def from_records(spark: SparkSession, rows: Iterable, schema: T.StructType) -> DataFrame:
    """Small record list as a DataFrame of a declared schema."""
    return spark.createDataFrame(list(rows), schema)


def read_manifest(
    spark: SparkSession, path: str, schema: T.StructType | None = None, view: str | None = None
) -> DataFrame:
    """Manifest of JSON records; missing keys become NULL; optional SQL view."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.option("multiLine", False).json(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def manifest_from_records(
    spark: SparkSession, records: list[dict], schema: T.StructType, view: str | None = None
) -> DataFrame:
    """Manifest given as dictionaries; absent keys become NULL."""
    rows = [tuple(r.get(f.name) for f in schema.fields) for r in records]
    df = spark.createDataFrame(rows, schema)
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_run_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Run metadata written as one JSON object per run."""
    return spark.read.option("multiLine", True).json(path)


def lookup(df: DataFrame, **keys) -> DataFrame:
    """Rows whose columns equal the given values; pushed to the scan."""
    for name, value in keys.items():
        df = df.filter(F.col(name).isNull() if value is None else F.col(name) == F.lit(value))
    return df


def query(spark: SparkSession, sql: str, **params) -> DataFrame:
    """SQL text with named ``:parameters``."""
    return spark.sql(sql, args=params or None)


def list_catalogs(spark: SparkSession) -> DataFrame:
    rows = [(c.name,) for c in spark.catalog.listCatalogs()]
    return spark.createDataFrame(rows, "catalog string")


def list_schemas(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW SCHEMAS").withColumnRenamed("namespace", "schema_name")


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{schema}`").select(
        F.col("namespace").alias("schema_name"), F.col("tableName").alias("table_name")
    )


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
