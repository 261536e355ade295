"""Corpus tables derived from the given parquet tables, in Spark and in SQL.

``documents`` stands for the files: the language decides the extension, one
source has unreadable bodies, one recorded characters as its size. Every row
and every text takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.vectors import ALPHABET
from quire.operators.answers import answer_struct, route_documents, with_provenance
from quire.operators.extract import extract
from quire.operators.pages import split_text_pages
from quire.operators.similarity import embed
from quire.sources.tables import read_parquet

ROOT = "/corpus/raw"
UNREADABLE_SOURCE = "src13"
MISSIZED_SOURCE = "src17"
FAILED_SOURCE = "src3"
EMPTY_SOURCE = "src5"
# Thresholds low enough for both processing classes to occur in the test data.
LIMITS = {"token_threshold": 500, "size_threshold": 3000}
BRIEF_CHARS = 2500


def store(spark: SparkSession, sf: str) -> DataFrame:
    """Document store, plus the document's number, source and text."""
    ext = F.when(F.col("lang") == "de", ".doc").when(F.col("lang") == "fr", ".docx").otherwise(".pdf")
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.col("file_extension"))
    folder = F.concat(F.lit(ROOT + "/"), F.col("source"))
    size = F.octet_length("text").cast("long")
    return (
        read_parquet(spark, sf, "documents")
        .withColumn("file_extension", ext)
        .withColumn("file_name", name)
        .withColumn("directory", folder)
        .select(
            "doc_id",
            "source",
            "lang",
            "text",
            "file_name",
            F.concat_ws("/", "directory", "file_name").alias("volume_path"),
            "file_extension",
            F.when(F.col("source") == MISSIZED_SOURCE, F.col("n_chars")).otherwise(size).alias("file_size_bytes"),
            F.expr("timestamp_ntz '2024-01-01 00:00:00' + doc_id * interval '1' hour").alias("modification_time"),
            "directory",
            F.when(F.col("source") != UNREADABLE_SOURCE, F.encode("text", "UTF-8")).alias("binary_content"),
        )
    )


def markdown(spark: SparkSession, sf: str) -> DataFrame:
    """Extraction results; the recorded time is the text length by a constant."""
    files = store(spark, sf)
    seconds = F.length("text") / F.lit(100_000.0)
    return extract(files, seconds=seconds)


def routed(spark: SparkSession, sf: str) -> DataFrame:
    """Documents to analyse with their prompts."""
    return route_documents(
        markdown(spark, sf), keep=["markdown_content"], brief_chars=BRIEF_CHARS, **LIMITS
    )


def analysis(spark: SparkSession, sf: str) -> DataFrame:
    """Answers: the whole text; one source failed, one came back empty."""
    source = F.substring_index(F.substring_index("file_path", "/", -2), "/", 1)
    failed = source == FAILED_SOURCE
    result = F.when(source == EMPTY_SOURCE, F.lit("")).when(~failed, F.col("markdown_content"))
    error = F.when(failed, F.lit("request timed out"))
    answered = routed(spark, sf).withColumn("analysis_result", answer_struct(result, error))
    return with_provenance(answered, "text").drop("prompt", "markdown_content")


def pagetext(spark: SparkSession, sf: str) -> DataFrame:
    """Page texts of 2000 characters."""
    docs = store(spark, sf).select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.col("file_name").alias("source_filename"),
        "file_size_bytes",
        F.col("modification_time").cast("string").alias("processing_timestamp"),
        F.to_json(F.struct("source", "lang")).alias("metadata_json"),
        F.col("modification_time").cast("string").alias("ocr_timestamp"),
        F.lit("text").alias("ocr_model"),
        F.col("text").alias("_text"),
    )
    return split_text_pages(docs, "_text")


def asked_questions(spark: SparkSession, sf: str) -> DataFrame:
    """All questions, also those without words, which have no vector."""
    return read_parquet(spark, sf, "benchmark").select(
        F.col("item_id").alias("question_id"), F.col("text").alias("question_text")
    )


def questions(spark: SparkSession, sf: str) -> DataFrame:
    """Search questions with their vectors."""
    return embed(asked_questions(spark, sf), "question_text")


def document_index(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with vectors: id, file_name, vector."""
    docs = store(spark, sf).select(F.col("doc_id").alias("id"), "file_name", "text")
    return embed(docs, "text")


# The same tables for the SQL check, as common table expressions.
_CTES = {
    "store": (
        (),
        f"""SELECT *, directory || '/' || file_name AS volume_path FROM (
  SELECT *, 'doc_' || doc_id || file_extension AS file_name FROM (
    SELECT doc_id, source, lang, text,
      CASE lang WHEN 'de' THEN '.doc' WHEN 'fr' THEN '.docx' ELSE '.pdf' END AS file_extension,
      '{ROOT}/' || source AS directory,
      CASE WHEN source = '{MISSIZED_SOURCE}' THEN n_chars
           ELSE octet_length(encode(text)) END AS file_size_bytes,
      TIMESTAMP '2024-01-01 00:00:00' + to_hours(doc_id) AS modification_time,
      CASE WHEN source <> '{UNREADABLE_SOURCE}' THEN encode(text) END AS binary_content
    FROM documents))""",
    ),
    "markdown": (
        ("store",),
        """SELECT *, length(coalesce(markdown_content, '')) AS character_count,
  CASE WHEN length(coalesce(markdown_content, '')) = 0 THEN 0
       ELSE greatest(1, length(markdown_content) // 2000) END AS page_count
  FROM (
    SELECT *, file_extension = '.pdf' AND binary_content IS NOT NULL AS extraction_success,
      CASE WHEN file_extension = '.pdf' AND binary_content IS NOT NULL THEN text END AS markdown_content,
      CASE WHEN file_extension <> '.pdf' THEN 'Unsupported file type: ' || file_extension
           WHEN binary_content IS NULL THEN 'No binary data provided' END AS error_message,
      length(text) / 100000.0::DOUBLE AS processing_time_seconds
    FROM store)""",
    ),
    "analysis": (
        ("markdown",),
        f"""SELECT volume_path AS file_path, file_name, doc_id, source, markdown_content, character_count,
    round(character_count / 4, 0) AS estimated_tokens, file_size_bytes,
    round(file_size_bytes / 1048576.0::DOUBLE, 2) AS file_size_mb,
    CASE WHEN character_count / 4 < {LIMITS["token_threshold"]}
          AND file_size_bytes < {LIMITS["size_threshold"]} THEN 'SMALL_DOC' ELSE 'LARGE_DOC' END
      AS processing_category,
    CASE WHEN source = '{FAILED_SOURCE}' THEN NULL WHEN source = '{EMPTY_SOURCE}' THEN ''
         ELSE markdown_content END AS result,
    CASE WHEN source = '{FAILED_SOURCE}' THEN 'request timed out' END AS error
  FROM markdown WHERE extraction_success AND markdown_content IS NOT NULL""",
    ),
    "pagetext": (
        ("store",),
        """SELECT CAST(doc_id AS VARCHAR) AS doc_id, file_name AS source_filename, file_size_bytes,
    modification_time, page_number::INTEGER AS page_number, total_pages::INTEGER AS total_pages,
    substr(text, (page_number - 1) * 2000 + 1, 2000) AS ocr_text
  FROM (SELECT *, CAST(ceil(length(text) / 2000.0) AS BIGINT) AS total_pages FROM store WHERE text <> '') s,
    unnest(range(1, total_pages + 1)) AS u(page_number)""",
    ),
}


def with_tables(*names: str, **more: str) -> str:
    """WITH clause of the named tables, what they need, and further ones."""
    ordered: list[str] = []

    def add(name):
        for needed in _CTES[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS ({_CTES[n][1]})" for n in ordered]
    parts += [f"{n} AS ({body})" for n, body in more.items()]
    return "WITH " + ",\n".join(parts) + "\n"


def vectors_sql(table: str, text: str) -> str:
    """DuckDB query adding the hashed word counts of a text column as ``v``."""
    words = f"list_filter(string_split_regex(lower({text}), '\\s+'), lambda w: w <> '')"
    digit = "left(to_base64(unhex(md5(w))), 1)"
    counts = (
        f"list_transform(string_split('{ALPHABET}', ''), "
        "lambda c: CAST(length(digits) - length(replace(digits, c, '')) AS DOUBLE))"
    )
    return (
        f"SELECT *, {counts} AS v FROM (SELECT *, "
        f"array_to_string(list_transform({words}, lambda w: {digit}), '') AS digits FROM {table}) "
        "WHERE digits <> ''"
    )


SCORE = "round(list_cosine_similarity(q.v, d.v), 6) + 0.0"
# What hits are ranked by: finer than the printed score, coarser than floating-point noise.
CLOSENESS = "round(list_cosine_similarity(q.v, d.v), 12)"
