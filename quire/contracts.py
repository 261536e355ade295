"""Column contracts of the corpus tables and a check for them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _schema(spec: str) -> T.StructType:
    kinds = {
        "s": T.StringType(),
        "l": T.LongType(),
        "i": T.IntegerType(),
        "d": T.DoubleType(),
        "b": T.BooleanType(),
        "bin": T.BinaryType(),
        "ts": T.TimestampType(),
    }
    fields = [part.split(":") for part in spec.split()]
    return T.StructType([T.StructField(n, kinds[k]) for n, k in fields])


DOCUMENT_STORE = _schema(
    "file_name:s volume_path:s file_extension:s file_size_bytes:l "
    "modification_time:ts directory:s binary_content:bin"
)
EXTRACTION = _schema(
    "extraction_success:b markdown_content:s error_message:s "
    "processing_time_seconds:d character_count:l page_count:l processing_timestamp:ts"
)
DOCUMENT_MARKDOWN = T.StructType(
    [f for f in DOCUMENT_STORE.fields if f.name != "binary_content"] + EXTRACTION.fields
)
ANSWER = _schema("result:s errorMessage:s")
ANALYSIS = T.StructType(
    _schema(
        "file_path:s file_name:s character_count:l estimated_tokens:d "
        "file_size_bytes:l file_size_mb:d processing_category:s"
    ).fields
    + [T.StructField("analysis_result", ANSWER)]
    + _schema("model_used:s processed_at:ts").fields
)
FLATTENED_ANALYSIS = _schema(
    "id:s file_path:s file_name:s character_count:l estimated_tokens:d "
    "file_size_bytes:l file_size_mb:d processing_category:s analysis_result:s "
    "analysis_error_message:s model_used:s processed_at:ts"
)
PARSED_PAGES = _schema("doc_id:s page_num:i content:s metadata:s")
SPLIT_PAGES = _schema("doc_id:s page_num:i page_bytes:bin metadata:s")
DOCUMENT_PAGES = _schema(
    "doc_id:s source_filename:s page_number:i page_image_png:bin total_pages:i "
    "file_size_bytes:l processing_timestamp:s metadata_json:s"
)
PAGE_TEXT = T.StructType(
    DOCUMENT_PAGES.fields
    + _schema("ocr_text:s ocr_timestamp:s ocr_model:s processing_mode:s").fields
)
VECTOR_READY = _schema(
    "id:s doc_id:s source_filename:s page_number:i total_pages:i file_size_bytes:l "
    "processing_timestamp:s metadata_json:s ocr_text:s ocr_timestamp:s ocr_model:s"
)
PAPER_MANIFEST = _schema("title:s authors:s year:s url:s category:s item_id:s")
COMPANY_MANIFEST = _schema(
    "company_name:s ticker:s industry:s report_url:s requires_login:b referer_page:s"
)


class ContractError(ValueError):
    """A DataFrame lacks a contract column or has it with another type."""


def assert_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Return ``df`` unchanged if it has every contract column and type.

    TIMESTAMP and TIMESTAMP_NTZ stand for each other, since parquet files
    written without a zone load as the latter. Extra columns are allowed.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    bad = []
    for field in contract.fields:
        if field.name not in have:
            bad.append(f"{field.name} is missing")
        elif not _same(have[field.name], field.dataType):
            bad.append(
                f"{field.name} is {have[field.name].simpleString()}, "
                f"not {field.dataType.simpleString()}"
            )
    if bad:
        raise ContractError("; ".join(bad))
    return df


def _same(got: T.DataType, want: T.DataType) -> bool:
    stamps = (T.TimestampType, T.TimestampNTZType)
    if isinstance(want, T.TimestampType):
        return isinstance(got, stamps)
    return got.simpleString() == want.simpleString()
