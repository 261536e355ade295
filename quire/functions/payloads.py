"""JSON metadata and chat payload expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.columns import as_col

METADATA_TYPE = T.MapType(T.StringType(), T.StringType())


def image_data_url(content, mime: str = "image/jpeg") -> Column:
    """Data URL of a body; the line breaks of MIME base64 are taken out."""
    return F.concat(F.lit(f"data:{mime};base64,"), F.translate(F.base64(as_col(content)), "\r\n", ""))


def chat_payload(
    prompt, image=None, model: str = "model", max_tokens: int = 4096, temperature: float = 0.0
) -> Column:
    """Chat request with one user message: an optional image and a text part."""
    text_part = F.struct(
        F.lit("text").alias("type"),
        as_col(prompt).alias("text"),
        F.lit(None).cast("struct<url:string>").alias("image_url"),
    )
    parts = [text_part]
    if image is not None:
        parts.insert(
            0,
            F.struct(
                F.lit("image_url").alias("type"),
                F.lit(None).cast("string").alias("text"),
                F.struct(image_data_url(image).alias("url")).alias("image_url"),
            ),
        )
    message = F.struct(F.lit("user").alias("role"), F.array(*parts).alias("content"))
    return F.to_json(
        F.struct(
            F.lit(model).alias("model"),
            F.array(message).alias("messages"),
            F.lit(max_tokens).alias("max_tokens"),
            F.lit(temperature).alias("temperature"),
        )
    )


def payload_answer(body) -> Column:
    """Content of the first choice, NULL when the body has none."""
    return F.get_json_object(as_col(body), "$.choices[0].message.content")


def page_metadata(**fields) -> Column:
    """JSON text of the given columns; empty document properties are left out."""
    return F.to_json(F.struct(*[F.nullif(as_col(c).cast("string"), F.lit("")).alias(k) for k, c in fields.items()]))


def decode_metadata(text) -> Column:
    return F.from_json(as_col(text), METADATA_TYPE)
