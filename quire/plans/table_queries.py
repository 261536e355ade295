"""Managed tables, staged rewrites, catalog listings and guards over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quire.operators.extract import require_rows
from quire.plans.registry import query
from quire.sources import sinks, tables
from quire.sources.tables import read_parquet


def _name(kind: str) -> str:
    """A table name no other call uses."""
    return f"quire_{kind}_{uuid.uuid4().hex}"


@query("managed_table", "SELECT doc_id, lang, source, n_chars FROM documents")
def managed_table(spark, sf):
    """A table written, replaced as a whole with another schema, and scanned by name."""
    name = _name("managed")
    docs = read_parquet(spark, sf, "documents")
    sinks.write_table(docs.select("doc_id", "lang"), name)
    sinks.write_table(docs.select("doc_id", "lang", "source", "n_chars"), name, rebalance=True)
    return tables.read_table(spark, name)


_PER_SOURCE = "SELECT source, lang, count(*) AS n_docs, sum(n_chars)::BIGINT AS n_chars FROM documents GROUP BY source, lang"


@query("table_as_select", _PER_SOURCE)
def table_as_select(spark, sf):
    """A table replaced by the result of a SELECT, twice."""
    name, view = _name("selected"), _name("view")
    read_parquet(spark, sf, "documents").createOrReplaceTempView(view)
    sinks.create_table_as(spark, name, f"SELECT count(*) AS n_docs FROM {view}")
    counted = "SELECT source, lang, count(*) AS n_docs, sum(n_chars) AS n_chars"
    sinks.create_table_as(spark, name, f"{counted} FROM {view} GROUP BY source, lang")
    return tables.read_table(spark, name)


@query("staged_merge", "SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d JOIN labels l ON l.doc_id = d.doc_id")
def staged_merge(spark, sf):
    """Labels staged, staged anew with one more column, and merged into the documents."""
    name = _name("labels")
    labels = read_parquet(spark, sf, "labels")
    sinks.write_staged(labels.select("doc_id", "quality"), name)
    staged = sinks.write_staged(labels.select("doc_id", "quality", "toxic"), name)
    return read_parquet(spark, sf, "documents").select("doc_id", "lang").join(staged, "doc_id")


@query("sql_parameters", "SELECT doc_id, n_chars FROM documents WHERE lang = 'en' AND n_chars >= 1000")
def sql_parameters(spark, sf):
    """SQL text with named parameters over a view."""
    view = _name("view")
    read_parquet(spark, sf, "documents").createOrReplaceTempView(view)
    text = f"SELECT doc_id, n_chars FROM {view} WHERE lang = :lang AND n_chars >= :least"
    return tables.query(spark, text, lang="en", least=1000)


@query(
    "source_records",
    """SELECT source, label, count(*) AS n_docs FROM (SELECT source, CASE lang WHEN 'en' THEN 'English'
  WHEN 'de' THEN 'German' WHEN 'fr' THEN 'French' END AS label FROM documents) GROUP BY source, label""",
)
def source_records(spark, sf):
    """Records of a declared schema, joined to every document."""
    names = tables.from_records(
        spark, [("en", "English"), ("de", "German"), ("fr", "French")], "lang string, label string"
    )
    docs = read_parquet(spark, sf, "documents").join(F.broadcast(names), "lang", "left")
    return docs.groupBy("source", "label").agg(F.count("*").alias("n_docs"))


@query(
    "catalog_tables",
    """SELECT 'documents' AS table_name, count(*) AS n_rows FROM documents
UNION ALL SELECT 'labels', count(*) FROM labels UNION ALL SELECT 'pages', count(*) FROM pages""",
)
def catalog_tables(spark, sf):
    """A schema made twice, tables written to it, listed and counted."""
    schema = _name("schema")
    counts = None
    for _ in range(2):
        tables.create_schema(spark, schema)
    for name in ("documents", "labels", "pages"):
        sinks.write_table(read_parquet(spark, sf, name), f"{schema}.{name}")
        counted = tables.read_table(spark, f"{schema}.{name}").agg(
            F.lit(name).alias("table_name"), F.count("*").alias("n_rows")
        )
        counts = counted if counts is None else counts.union(counted)
    listed = tables.list_tables(spark, schema).join(tables.list_schemas(spark), "schema_name")
    return listed.select("table_name").join(counts, "table_name")


@query("guarded_rows", "SELECT doc_id, source FROM documents WHERE n_chars > 0")
def guarded_rows(spark, sf):
    """Rows that a guard let pass; it stops the run where there are none."""
    docs = read_parquet(spark, sf, "documents").filter(F.col("n_chars") > 0)
    return require_rows(docs.select("doc_id", "source"), "no document to work on")
