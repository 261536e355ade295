"""Row conditions used to route and filter corpus tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.columns import as_col
from quire.functions.sizes import MAX_SPLIT_BYTES, SUSPECT_MB, megabytes

# Fixed value: first four bytes of a PDF body.
PDF_MAGIC = b"%PDF"
ALL = "all"


def extractable(ext="file_extension", content="binary_content") -> Column:
    return (as_col(ext) == ".pdf") & as_col(content).isNotNull()


def splittable(
    ext="file_extension",
    content="binary_content",
    size="file_size_bytes",
    max_bytes: int = MAX_SPLIT_BYTES,
) -> Column:
    return (
        extractable(ext, content)
        & (as_col(size) <= max_bytes)
        & (F.octet_length(as_col(content)) > 0)
    )


def has_text(text) -> Column:
    text = as_col(text)
    return text.isNotNull() & (text != "")


def status_filter(
    status: str = "All", ext: str | None = None, success="extraction_success", extension="file_extension"
) -> Column:
    """Optional status (All, Successful, Failed) and optional extension."""
    parts = []
    if status == "Successful":
        parts.append(as_col(success))
    elif status == "Failed":
        parts.append(~as_col(success))
    elif status != "All":
        raise ValueError(f"unknown status {status!r}")
    if ext is not None and ext != "All":
        parts.append(as_col(extension) == ext)
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def in_categories(column, wanted: list[str]) -> Column:
    """Membership, where the entry ``all`` switches the filter off."""
    if any(w.lower() == ALL for w in wanted):
        return F.lit(True)
    return as_col(column).isin(list(wanted))


def suspect_file(ext, size, below_mb: float = SUSPECT_MB) -> Column:
    return (as_col(ext) == ".pdf") & (megabytes(size) < below_mb)


def is_pdf_body(content) -> Column:
    return F.substring(as_col(content), 1, len(PDF_MAGIC)) == F.lit(PDF_MAGIC)
