"""Index refresh and file ingestion, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import sync
from quire.plans.load_queries import BODY, FILES, LANDED, landed
from quire.plans.registry import query
from quire.scratch import scratch_path
from quire.sources.tables import read_parquet
from quire.streaming.index_sync import append_deletes, compact, current_index, start_sync
from quire.streaming.ingest import ingest, stream_files


def source_rows(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_parquet(spark, sf, "documents").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("key"), "text"
    )
    return sync.with_content_hash(docs, "text")


def index_rows(spark: SparkSession, sf: str) -> DataFrame:
    """An index that lags behind: the labelled documents, low quality ones in
    an older (draft) version, and web pages the source no longer has."""
    docs = read_parquet(spark, sf, "documents").join(read_parquet(spark, sf, "labels"), "doc_id")
    old = docs.select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("key"),
        F.when(F.col("quality") == 0, F.concat(F.lit("draft: "), "text")).otherwise(F.col("text")).alias("text"),
    )
    gone = read_parquet(spark, sf, "pages").select(
        F.concat(F.lit("page_"), F.col("page_id").cast("string")).alias("key"), F.col("html").alias("text")
    )
    return sync.with_content_hash(old.unionByName(gone), "text")


SYNC = """WITH src AS (SELECT 'doc_' || doc_id AS key, text, sha256(text) AS h FROM documents),
idx AS (SELECT key, text, sha256(text) AS h FROM (
  SELECT 'doc_' || d.doc_id AS key, CASE WHEN quality = 0 THEN 'draft: ' || text ELSE text END AS text
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id
  UNION ALL SELECT 'page_' || page_id, html FROM pages)),
diff AS (SELECT coalesce(src.key, idx.key) AS key, CASE WHEN idx.key IS NULL THEN 'insert'
  WHEN src.key IS NULL THEN 'delete' WHEN src.h <> idx.h THEN 'update' ELSE 'keep' END AS action,
  src.h AS source_hash, idx.h AS index_hash FROM src FULL OUTER JOIN idx ON src.key = idx.key)
"""


@query("index_sync_diff", SYNC + "SELECT * FROM diff")
def index_sync_diff(spark, sf):
    return sync.sync_diff(source_rows(spark, sf), index_rows(spark, sf), "key")


@query("index_sync_counts", SYNC + "SELECT action, count(*) AS keys FROM diff GROUP BY action")
def index_sync_counts(spark, sf):
    return sync.sync_counts(sync.sync_diff(source_rows(spark, sf), index_rows(spark, sf), "key"))


@query("index_sync_apply", SYNC + "SELECT key, text, h AS content_hash FROM src")
def index_sync_apply(spark, sf):
    return sync.apply_sync(source_rows(spark, sf), index_rows(spark, sf), "key")


@query("stream_sync", "SELECT doc_id, lang, text, n_chars, sha256(text) AS content_hash FROM documents")
def stream_sync(spark, sf):
    """Documents streamed into the index, then read as its current state."""
    path, state = scratch_path(spark, "index"), scratch_path(spark, "state")
    table = f"{sf}/documents[.]parquet"  # a pattern fits a file as well as a folder
    schema = read_parquet(spark, sf, "documents").schema
    rows = spark.readStream.schema(schema).parquet(table).select("doc_id", "lang", "text", "n_chars")
    start_sync(rows, path, state, "doc_id", "text", "n_chars").awaitTermination()
    return current_index(spark, path, "doc_id")


@query(
    "stream_late_rows",
    """SELECT d.doc_id, d.text, 2::BIGINT AS edition, sha256(d.text) AS content_hash FROM documents d
LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE coalesce(l.toxic, 0) = 0""",
)
def stream_late_rows(spark, sf):
    """The second edition arrives before the first, toxic documents are deleted, more late rows come, all is compacted."""
    landing, path, state, packed = (scratch_path(spark, n) for n in ("editions", "index", "state", "packed"))
    docs = read_parquet(spark, sf, "documents").select("doc_id", "text")
    schema = "doc_id long, text string, edition long"

    def arrive(prefix: str, edition: int) -> None:
        text = F.concat(F.lit(prefix), "text")
        docs.select("doc_id", text.alias("text"), F.lit(edition).cast("long").alias("edition")).write.mode(
            "append"
        ).option("compression", "zstd").parquet(landing)
        rows = spark.readStream.schema(schema).parquet(landing)
        start_sync(rows, path, state, "doc_id", "text", "edition").awaitTermination()

    arrive("", 2)
    arrive("first edition: ", 1)
    toxic = read_parquet(spark, sf, "labels").filter("toxic = 1").select("doc_id")
    append_deletes(spark, path, toxic, "doc_id")
    arrive("draft: ", 0)
    compact(spark, path, packed, "doc_id")
    return current_index(spark, packed, "doc_id")


@query("stream_ingest", LANDED + BODY + FILES)
def stream_ingest(spark, sf):
    """Landed files ingested as a stream; the rerun finds nothing new."""
    root, path, state = landed(spark, sf), scratch_path(spark, "store"), scratch_path(spark, "state")
    for _ in range(2):
        ingest(stream_files(spark, root, "*.txt"), path, state).awaitTermination()
    return spark.read.parquet(path).select(
        F.regexp_extract("directory", r"(source=[^/]*/lang=[^/]*)$", 1).alias("folder"),
        F.col("file_size_bytes").alias("n_bytes"),
        F.md5("binary_content").alias("body_md5"),
        F.col("file_extension").alias("extension"),
    )
