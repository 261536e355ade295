"""Splitting documents into numbered pages."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quire.contracts import VECTOR_READY
from quire.functions.ids import page_key
from quire.functions.predicates import has_text
from quire.functions.sizes import CHARS_PER_PAGE

PAGE_BATCH_BYTES = 8 * 1024 * 1024


def fixed_size_pages(text, size: int = CHARS_PER_PAGE) -> Column:
    """Array of consecutive pieces of ``size`` characters, in one pass."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def break_pages(text, mark: str = "\f") -> Column:
    """Array of pieces between page breaks."""
    text = F.col(text) if isinstance(text, str) else text
    return F.split(text, mark)


def split_text_pages(
    docs: DataFrame,
    text: str,
    pages: Column | None = None,
    out: str = "ocr_text",
) -> DataFrame:
    """One row per page: the document's columns, page_number, total_pages, text.

    A narrow operation: each document expands where it lies. Rows without
    text give no page. (The outer explode keeps the optimizer from splitting
    every text once more in a filter for empty arrays; the last filter does
    its work.)
    """
    kept = [c for c in docs.columns if c != text]
    array = fixed_size_pages(text) if pages is None else pages
    return (
        docs.filter(has_text(text))
        .select(*kept, array.alias("_pages"))
        .select(*kept, F.size("_pages").alias("total_pages"), F.posexplode_outer("_pages").alias("_pos", out))
        .filter(F.col("_pos").isNotNull())
        .select(*kept, (F.col("_pos") + 1).cast("int").alias("page_number"), "total_pages", out)
    )


def split_binary_pages(
    docs: DataFrame,
    pages_of: Callable[[bytes], Iterable[bytes | str | Exception]],
    carry: list[str],
    content: str = "binary_content",
    page_column: str = "page_image_png",
    page_type: T.DataType = T.BinaryType(),
    batch_bytes: int = PAGE_BATCH_BYTES,
) -> DataFrame:
    """Expand bodies into pages with a caller's function, without a shuffle.

    ``pages_of(body)`` gives the pages in order, best as they are made: each is
    passed on once ``batch_bytes`` of them are held, so a task holds one body and
    that many bytes of pages, not a document. ``total_pages`` is the result's
    length where it has one, else NULL. A page given as an exception is skipped
    and its number stays unused. Where the function stops with an exception, the
    pages before it stay, and a row with the number of the page that could not
    be made and ``error_message`` follows; the number is NULL for a body that
    could not be opened at all.
    """
    fields = [docs.schema[c] for c in carry]
    schema = T.StructType(
        fields
        + [
            T.StructField("page_number", T.IntegerType()),
            T.StructField("total_pages", T.IntegerType()),
            T.StructField(page_column, page_type),
            T.StructField("error_message", T.StringType()),
        ]
    )
    names, kind = schema.fieldNames(), to_arrow_type(page_type)

    def rows_of(body):
        """Number, total, page and error of each page, and its size."""
        total, number = None, None
        try:
            found = pages_of(bytes(body))
            total, number = (len(found) if hasattr(found, "__len__") else None), 0
            for number, page in enumerate(found, 1):
                if not isinstance(page, Exception):
                    yield number, total, page, None
        except Exception as e:  # noqa: BLE001 - errors are data here
            yield (None if number is None else number + 1), total, None, f"{type(e).__name__}: {e}"

    def expand(batches):
        import pyarrow as pa

        def flush(batch, source, made):
            own = batch.select(carry).take(pa.array(source, pa.int64()))
            kinds = (pa.int32(), pa.int32(), kind, pa.string())
            return pa.RecordBatch.from_arrays(
                [*own.columns, *(pa.array(c, t) for c, t in zip(zip(*made), kinds))], names=names
            )

        for batch in batches:
            source, made, held = [], [], 0
            for at, body in enumerate(batch.column(content)):
                for row in rows_of(body.as_py()):
                    source.append(at)
                    made.append(row)
                    held += len(row[2] or "") + 64
                    if held >= batch_bytes:
                        yield flush(batch, source, made)
                        source, made, held = [], [], 0
            if made:
                yield flush(batch, source, made)

    return docs.select(*carry, content).mapInArrow(expand, schema)


def vector_ready(pages: DataFrame) -> DataFrame:
    """Page texts prepared for indexing: text present, page key, fixed columns."""
    return (
        pages.filter(has_text("ocr_text"))
        .withColumn("id", page_key("doc_id", "page_number"))
        .select(*VECTOR_READY.fieldNames())
    )


def document_pages(pages: DataFrame, doc_id, size: int = 200) -> DataFrame:
    """All pages of one document in order, with a preview."""
    return (
        pages.filter(F.col("doc_id") == F.lit(doc_id))
        .select("doc_id", "page_number", F.substring("ocr_text", 1, size).alias("preview"))
        .orderBy("page_number")
    )


def page_headers(pages: DataFrame) -> DataFrame:
    """Page k of n, date part of the time stamp, text length with NULL as 0."""
    return pages.select(
        "doc_id",
        "page_number",
        F.concat_ws("/", F.col("page_number").cast("string"), F.col("total_pages").cast("string")).alias(
            "page_label"
        ),
        F.substring(F.col("ocr_timestamp").cast("string"), 1, 10).alias("ocr_date"),
        F.coalesce(F.length("ocr_text"), F.lit(0)).cast("long").alias("text_length"),
    )


def first_pages(pages: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` pages of every document; page numbers start at 1."""
    return pages.filter(F.col("page_number") <= n)


def nth_page(pages: DataFrame, index: int) -> DataFrame:
    """The page at a zero-based position of every document."""
    return pages.filter(F.col("page_number") == index + 1)
