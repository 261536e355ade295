"""Size, token and page arithmetic, and the classes built on it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.columns import as_col

# Thresholds and labels of the size classes.
TOKEN_THRESHOLD = 100_000
SIZE_THRESHOLD_BYTES = 4 * 1024 * 1024
CHARS_PER_TOKEN = 4
CHARS_PER_PAGE = 2000
MAX_SPLIT_BYTES = 50 * 1024 * 1024
SUSPECT_MB = 0.1
SMALL_FILE_BYTES = 1_048_576
MEDIUM_FILE_BYTES = 10_485_760
SIZE_CLASS_LABELS = ("Small (<1MB)", "Medium (1-10MB)", "Large (>10MB)")


def kilobytes(n) -> Column:
    return as_col(n) / F.lit(1024.0)


def megabytes(n) -> Column:
    return as_col(n) / F.lit(1024.0 * 1024.0)


def gigabytes(n) -> Column:
    return as_col(n) / F.lit(1024.0**3)


def estimated_tokens(characters) -> Column:
    return F.round(as_col(characters) / F.lit(CHARS_PER_TOKEN), 0)


def estimated_pages(characters) -> Column:
    """0 when empty, else at least 1."""
    n = as_col(characters)
    return (
        F.when(n > 0, F.greatest(F.lit(1), F.floor(n / F.lit(CHARS_PER_PAGE))))
        .otherwise(F.lit(0))
        .cast("long")
    )


def is_small_document(
    characters,
    size_bytes,
    token_threshold: float = TOKEN_THRESHOLD,
    size_threshold: int = SIZE_THRESHOLD_BYTES,
) -> Column:
    return (as_col(characters) / F.lit(CHARS_PER_TOKEN) < token_threshold) & (
        as_col(size_bytes) < size_threshold
    )


def document_class(
    characters,
    size_bytes,
    token_threshold: float = TOKEN_THRESHOLD,
    size_threshold: int = SIZE_THRESHOLD_BYTES,
    labels: tuple[str, str] = ("SMALL_DOC", "LARGE_DOC"),
) -> Column:
    small = is_small_document(characters, size_bytes, token_threshold, size_threshold)
    return F.when(small, F.lit(labels[0])).otherwise(F.lit(labels[1]))


def file_size_class(
    size_bytes,
    small_below: int = SMALL_FILE_BYTES,
    medium_below: int = MEDIUM_FILE_BYTES,
) -> Column:
    n = as_col(size_bytes)
    small, medium, large = SIZE_CLASS_LABELS
    return (
        F.when(n < small_below, F.lit(small)).when(n < medium_below, F.lit(medium)).otherwise(F.lit(large))
    )


def stored_size_check(content, size_bytes) -> Column:
    """Compare the stored body with the recorded size."""
    content = as_col(content)
    return (
        F.when(F.octet_length(content) == as_col(size_bytes), F.lit("match"))
        .when(content.isNull(), F.lit("no content"))
        .otherwise(F.lit("mismatch"))
    )
