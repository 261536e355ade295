"""Text extraction with a status per document."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.contracts import DOCUMENT_MARKDOWN, DOCUMENT_STORE, EXTRACTION
from quire.functions.markup import html_to_markdown
from quire.functions.sizes import estimated_pages

# Status messages.
NO_BODY = "No binary data provided"
UNSUPPORTED = "Unsupported file type: "
NO_TEXT = "Body is not valid UTF-8 text"


def plain_text(content: Column) -> Column:
    """Body as text, NULL where it is not valid UTF-8."""
    return F.try_validate_utf8(content.cast("string"))


def html_text(content: Column) -> Column:
    """HTML body turned into markdown, NULL where it is not valid UTF-8."""
    return html_to_markdown(plain_text(content))


def extract(
    store: DataFrame,
    extractor: Callable[[Column], Column] = plain_text,
    supported: tuple[str, ...] = (".pdf",),
    seconds: Column | None = None,
) -> DataFrame:
    """Markdown table through an extractor of columns; errors become data.

    A NULL or unknown extension, a NULL body, and a body of which the extractor
    makes NULL are rows that did not succeed, each with its message.

    The text is a column of its own before the figures are taken from it, so
    the extractor runs once per row.
    """
    body, ext = F.col("binary_content"), F.col("file_extension")
    known = F.coalesce(F.lower(ext).isin(*supported), F.lit(False))
    staged = store.withColumn("_text", F.when(known & body.isNotNull(), extractor(body)))
    good = F.col("_text").isNotNull()
    length = F.coalesce(F.length("_text"), F.lit(0)).cast("long")
    return staged.select(
        *[c for c in DOCUMENT_STORE.fieldNames() if c != "binary_content"],
        good.alias("extraction_success"),
        F.col("_text").alias("markdown_content"),
        F.when(~known, F.concat(F.lit(UNSUPPORTED), F.coalesce(ext, F.lit(""))))
        .when(body.isNull(), F.lit(NO_BODY))
        .when(~good, F.lit(NO_TEXT))
        .alias("error_message"),
        (F.lit(0.0) if seconds is None else seconds).cast("double").alias("processing_time_seconds"),
        length.alias("character_count"),
        estimated_pages(length).alias("page_count"),
        F.current_timestamp().alias("processing_timestamp"),
    )


def extraction_udf(parse: Callable[[bytes, str], str], supported: tuple[str, ...] = (".pdf",)):
    """Extraction struct from a caller's parser, called per body in Arrow batches.

    ``parse(body, file_name)`` returns the markdown. An exception it raises
    turns into ``error_message``; the job goes on.
    """

    def run(content, file_name, ext):
        import datetime
        import time

        import pandas as pd

        rows = []
        for body, name, kind in zip(content, file_name, ext):
            began = time.perf_counter()
            text, error = None, None
            if kind is None or kind.lower() not in supported:
                error = f"Unsupported file type: {kind}"
            elif body is None:
                error = "No binary data provided"
            else:
                try:
                    text = parse(bytes(body), name)
                except Exception as e:  # noqa: BLE001 - errors are data here
                    error = f"{type(e).__name__}: {e}"
            size = len(text or "")
            rows.append(
                (
                    error is None,
                    text,
                    error,
                    round(time.perf_counter() - began, 3),
                    size,
                    max(1, size // 2000) if size else 0,
                    datetime.datetime.now(datetime.timezone.utc),
                )
            )
        names = [
            "extraction_success", "markdown_content", "error_message",
            "processing_time_seconds", "character_count", "page_count", "processing_timestamp",
        ]
        return pd.DataFrame(rows, columns=names)

    return F.pandas_udf(run, EXTRACTION)


def flatten_extraction(store: DataFrame, result: Column) -> DataFrame:
    """Store columns without the body, plus the fields of an extraction struct."""
    kept = [c for c in store.columns if c != "binary_content"]
    return (
        store.select("*", result.alias("_extraction"))
        .select(*kept, "_extraction.*")
        .select(*DOCUMENT_MARKDOWN.fieldNames())
    )


def extract_with(store: DataFrame, parse: Callable[[bytes, str], str]) -> DataFrame:
    """Extraction through a caller's Python parser."""
    udf = extraction_udf(parse)
    return flatten_extraction(
        store, udf(F.col("binary_content"), F.col("file_name"), F.col("file_extension"))
    )


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Fail early on empty input; reads one row, not a full count."""
    if df.isEmpty():
        raise ValueError(message)
    return df
