"""Corpus reports: one pass and one aggregation each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.columns import double_round, rate
from quire.functions.sizes import document_class, file_size_class, kilobytes, megabytes, stored_size_check

OVERALL = "Overall Processing"
SIZE_PREFIX = "File Size: "


def row_counts(df: DataFrame, **conditions: Column) -> DataFrame:
    """Total and conditional counts in one pass."""
    parts = [F.count_if(c).alias(k) for k, c in conditions.items()]
    return df.agg(F.count("*").alias("total_rows"), *parts)


def total_size(df: DataFrame, size: str = "file_size_bytes") -> DataFrame:
    """Sum with 0 for empty input, in bytes and MB."""
    total = F.coalesce(F.sum(size), F.lit(0)).cast("long")
    return df.agg(total.alias("total_bytes"), F.round(megabytes(total), 2).alias("total_mb"))


def collection_summary(store: DataFrame, present: Column | None = None) -> DataFrame:
    """Counts, sizes and dates per extension over the files with a body.

    A stored flag given as ``present`` spares reading the bodies.
    """
    return (
        store.filter(F.col("binary_content").isNotNull() if present is None else present)
        .groupBy("file_extension")
        .agg(
            F.count("*").alias("file_count"),
            F.round(megabytes(F.sum("file_size_bytes")), 2).alias("total_mb"),
            F.round(kilobytes(F.avg("file_size_bytes")), 2).alias("avg_size_kb"),
            F.min("modification_time").alias("oldest_file"),
            F.max("modification_time").alias("newest_file"),
        )
        .orderBy(F.desc("file_count"), "file_extension")
    )


def size_validation(store: DataFrame) -> DataFrame:
    body = F.col("binary_content")
    return store.select(
        "file_name",
        "file_extension",
        "file_size_bytes",
        F.when(body.isNotNull(), F.lit("Yes")).otherwise(F.lit("No")).alias("has_binary_content"),
        F.octet_length(body).cast("long").alias("binary_size_bytes"),
        stored_size_check(body, "file_size_bytes").alias("size_validation"),
    ).orderBy("file_name")


def extraction_report(
    markdown: DataFrame, small_below: int | None = None, medium_below: int | None = None
) -> DataFrame:
    """Overall row and one row per size class from a single scan."""
    limits = {
        k: v
        for k, v in (("small_below", small_below), ("medium_below", medium_below))
        if v is not None
    }
    per_class = (
        markdown.select(
            file_size_class("file_size_bytes", **limits).alias("bucket"),
            F.col("extraction_success").cast("int").alias("ok"),
            "character_count",
            "processing_time_seconds",
            "page_count",
        )
        .groupingSets([["bucket"], []], "bucket")
        .agg(
            F.grouping("bucket").alias("is_total"),
            F.count("*").alias("document_count"),
            F.sum("ok").alias("successful_extractions"),
            F.sum("character_count").alias("characters"),
            F.avg("processing_time_seconds").alias("seconds"),
            F.sum("page_count").alias("pages"),
        )
    )
    return per_class.select(
        F.when(F.col("is_total") == 1, F.lit(OVERALL))
        .otherwise(F.concat(F.lit(SIZE_PREFIX), F.col("bucket")))
        .alias("category"),
        "document_count",
        "successful_extractions",
        rate("successful_extractions", "document_count", 1).alias("success_rate_percent"),
        F.round(F.col("characters") / F.lit(1_000_000.0), 2).alias("total_content_mb_chars"),
        F.round("seconds", 3).alias("avg_processing_time_sec"),
        F.col("pages").alias("total_pages_processed"),
    ).orderBy("category")


def extraction_stats(markdown: DataFrame) -> DataFrame:
    """Success and failure counts, rate, and totals over the successes."""
    ok = F.col("extraction_success")
    return markdown.agg(
        F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
        rate(F.count_if(ok), F.count("*"), 1).alias("success_rate"),
        F.coalesce(F.sum(F.when(ok, F.col("character_count"))), F.lit(0)).alias("total_characters"),
        F.round(F.avg(F.when(ok, F.col("character_count"))), 4).alias("avg_characters"),
        F.coalesce(F.sum(F.when(ok, F.col("page_count"))), F.lit(0)).alias("total_pages"),
        F.round(F.avg(F.when(ok, F.col("processing_time_seconds"))), 6).alias("avg_seconds"),
    )


def failure_patterns(markdown: DataFrame) -> DataFrame:
    return (
        markdown.filter(~F.col("extraction_success"))
        .groupBy("error_message")
        .agg(F.count("*").alias("failures"))
        .orderBy(F.desc("failures"), "error_message")
    )


def chars_by_pages(markdown: DataFrame) -> DataFrame:
    return markdown.groupBy("page_count").agg(
        F.round(F.avg("character_count"), 4).alias("avg_character_count")
    )


def size_distribution(markdown: DataFrame, **limits) -> DataFrame:
    label = document_class(
        "character_count", "file_size_bytes", labels=("SMALL_DOCUMENTS", "LARGE_DOCUMENTS"), **limits
    )
    return (
        markdown.filter(F.col("extraction_success") & F.col("markdown_content").isNotNull())
        .groupBy(label.alias("size_category"))
        .agg(
            F.count("*").alias("count"),
            F.round(F.avg(F.col("character_count") / 4), 4).alias("avg_estimated_tokens"),
            F.round(F.avg("file_size_bytes"), 4).alias("avg_size_bytes"),
        )
    )


def run_summary(analysis: DataFrame) -> DataFrame:
    """Per class: total, answered, failed, rate, average sizes."""
    answered = F.col("analysis_result.result").isNotNull()
    return analysis.groupBy("processing_category").agg(
        F.count("*").alias("total_docs"),
        F.count_if(answered).alias("successful"),
        F.count_if(~answered).alias("failed"),
        rate(F.count_if(answered), F.count("*"), 2).alias("success_rate"),
        F.round(F.avg("estimated_tokens"), 4).alias("avg_tokens"),
        F.round(F.avg("file_size_mb"), 6).alias("avg_size_mb"),
    )


def run_failures(analysis: DataFrame) -> DataFrame:
    return (
        analysis.filter(F.col("analysis_result.result").isNull())
        .groupBy("processing_category")
        .agg(
            F.count("*").alias("failed_count"),
            F.round(F.avg("estimated_tokens"), 4).alias("avg_tokens"),
            F.round(F.avg("file_size_mb"), 6).alias("avg_size_mb"),
        )
    )


def per_document(pages: DataFrame, doc: str = "doc_id", text: str = "ocr_text") -> DataFrame:
    """Partial counts per document, the first level of the page reports.

    Rows of one document are combined before they are shuffled, so a document
    that holds many of the pages costs no more than another.
    """
    return pages.groupBy(doc).agg(
        F.count("*").alias("page_rows"),
        F.max("page_number").alias("max_page"),
        F.min("page_number").alias("min_page"),
        F.sum(F.col("total_pages").cast("long")).alias("sum_total_pages"),
        F.count_if(F.col(text).isNull()).alias("null_pages"),
        F.sum(F.octet_length(text).cast("long")).alias("body_bytes"),
        F.count(text).alias("body_rows"),
    )


def page_monitor(pages: DataFrame, doc: str = "doc_id", text: str = "ocr_text") -> DataFrame:
    """Distinct documents, pages, documents with an empty page, pages per document."""
    docs = F.count(doc)
    return per_document(pages, doc, text).agg(
        docs.alias("total_documents"),
        F.coalesce(F.sum("page_rows"), F.lit(0)).alias("total_pages"),
        F.count_if((F.col("null_pages") > 0) & F.col(doc).isNotNull()).alias("documents_with_failures"),
        F.round(F.coalesce(F.try_divide(F.sum("page_rows").cast("double"), docs.cast("double")), F.lit(0.0)), 6).alias(
            "avg_pages_per_document"
        ),
    )


def page_validation(pages: DataFrame, doc: str = "doc_id", body: str = "ocr_text") -> DataFrame:
    return per_document(pages, doc, body).agg(
        F.count(doc).alias("unique_documents"),
        F.sum("page_rows").alias("total_pages"),
        F.round(F.sum("sum_total_pages") / F.sum("page_rows"), 6).alias("avg_pages_per_doc"),
        F.min("min_page").cast("long").alias("min_page_num"),
        F.max("max_page").cast("long").alias("max_page_num"),
        F.round(F.sum("body_bytes") / F.sum("body_rows"), 6).alias("avg_body_bytes"),
    )


def dataset_stats(pages: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Rows, highest page number, distinct documents."""
    return pages.groupBy(doc).agg(F.count("*").alias("n"), F.max("page_number").alias("p")).agg(
        F.sum("n").alias("total_rows"),
        F.max("p").cast("long").alias("max_page"),
        F.count(doc).alias("total_docs"),
    )


def document_list(pages: DataFrame) -> DataFrame:
    return (
        pages.filter(F.col("source_filename").isNotNull())
        .groupBy("source_filename")
        .agg(
            F.max("total_pages").cast("long").alias("total_pages"),
            F.max("file_size_bytes").alias("file_size_bytes"),
            F.max("processing_timestamp").alias("processing_timestamp"),
        )
        .orderBy(F.desc("processing_timestamp"), "source_filename")
    )


def markdown_tiles(markdown: DataFrame) -> DataFrame:
    return markdown.agg(
        F.count("*").alias("documents"),
        F.count_if("extraction_success").alias("successful"),
        F.coalesce(F.sum("page_count"), F.lit(0)).alias("pages"),
        F.round(F.avg("processing_time_seconds"), 6).alias("avg_seconds"),
    )


def page_tiles(documents: DataFrame) -> DataFrame:
    """Tiles over the document list."""
    return documents.agg(
        F.count("*").alias("documents"),
        F.coalesce(F.sum("total_pages"), F.lit(0)).alias("pages"),
        F.round(megabytes(F.coalesce(F.sum("file_size_bytes"), F.lit(0))), 2).alias("total_mb"),
    )


def counts_by(df: DataFrame, column: str, out: str = "item_count", by_value: bool = False) -> DataFrame:
    """Rows per value, most frequent first or sorted by value."""
    counted = df.groupBy(column).agg(F.count("*").alias(out))
    order = [F.col(column)] if by_value else [F.desc(out), F.col(column)]
    return counted.orderBy(*order)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def browse_rollup(store: DataFrame, ext: str = ".pdf") -> DataFrame:
    """Files and bytes per folder and in total, for one extension."""
    return (
        store.filter(F.col("file_extension") == ext)
        .rollup("directory")
        .agg(
            F.grouping("directory").alias("level"),
            F.count("*").alias("file_count"),
            F.coalesce(F.sum("file_size_bytes"), F.lit(0)).alias("total_bytes"),
        )
        .select(
            F.when(F.col("level") == 1, F.lit("TOTAL")).otherwise(F.col("directory")).alias("directory"),
            "file_count",
            "total_bytes",
            double_round(megabytes("total_bytes"), 4).alias("total_mb"),
        )
        .orderBy("directory")
    )


def random_pick(df: DataFrame, column: str, value, key: str, seed: int = 42, n: int = 1) -> DataFrame:
    """Seeded pick among matching rows; does not depend on the partitioning."""
    order = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    return df.filter(F.col(column) == F.lit(value)).orderBy(order, key).limit(n)


def list_view(markdown: DataFrame, condition: Column | None = None) -> DataFrame:
    """Document list without the text."""
    rows = markdown if condition is None else markdown.filter(condition)
    return rows.drop("markdown_content").orderBy("file_name")
