"""Keys derived from content, so a recomputed frame gives the same keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.columns import as_col


def content_hash(content) -> Column:
    return F.sha2(as_col(content).cast("binary"), 256)


def document_id(path, content) -> Column:
    """SHA-256 of path and content hash; replaces time and random based ids."""
    return F.sha2(
        F.concat_ws("|", as_col(path), F.coalesce(content_hash(content), F.lit(""))), 256
    )


def page_key(doc_id, page_number) -> Column:
    return F.concat(
        as_col(doc_id).cast("string"), F.lit("_page_"), as_col(page_number).cast("string")
    )


def row_key(*columns) -> Column:
    """``doc_`` key from the row's own columns."""
    parts = [F.coalesce(as_col(c).cast("string"), F.lit("")) for c in columns]
    return F.concat(F.lit("doc_"), F.sha2(F.concat_ws("|", *parts), 256))


def sequence_row_key() -> Column:
    """``doc_`` key from the partition-wise running number (not repeatable)."""
    return F.concat(F.lit("doc_"), F.monotonically_increasing_id().cast("string"))
