"""Vector columns from text, without a shuffle."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.columns import as_col, text_slices

# Fixed value: the base64 alphabet; a word's hash digit selects the dimension.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
DIMENSIONS = len(ALPHABET)
# Words whose digit a task keeps.
KNOWN_WORDS = 1 << 16


@functools.lru_cache(maxsize=KNOWN_WORDS)
def word_digit(word: str) -> int:
    """Place in the alphabet of the first base64 digit of the word's MD5."""
    return hashlib.md5(word.encode(), usedforsecurity=False).digest()[0] >> 2


def hashed_counts(text) -> Column:
    """Words of a text counted in 64 hash buckets; a task holds the words of one slice of texts, each distinct one hashed once."""

    @F.arrow_udf("array<double>")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in text_slices(batches):
            lists = pc.ascii_split_whitespace(pa.concat_arrays([pc.fill_null(texts.cast(pa.large_string()), "")]))
            words = lists.flatten()
            row = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            coded = words.dictionary_encode()
            digits = np.array([word_digit(w) for w in coded.dictionary.to_pylist()], dtype="int64")
            there = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
            if len(words):
                cell = (row * DIMENSIONS + digits[coded.indices.to_numpy(zero_copy_only=False)])[there]
            else:
                cell = np.empty(0, dtype="int64")
            flat = np.bincount(cell, minlength=len(texts) * DIMENSIONS).astype("float64")
            bounds = np.arange(len(texts) + 1, dtype="int32") * DIMENSIONS
            yield pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))

    return counted(F.lower(as_col(text)))


def with_hashed_counts(df: DataFrame, text: str, out: str) -> DataFrame:
    """Words counted in 64 hash buckets; rows without words are left out."""
    return df.filter(F.col(text).rlike(r"\S")).withColumn(out, hashed_counts(text))


def with_unit(df: DataFrame, vector: str, out: str) -> DataFrame:
    """Vector scaled to length 1; rows with an all-zero vector are left out."""
    return (
        df.withColumn("_norm", norm(vector))
        .filter(F.col("_norm") > 0)
        .withColumn("_norm", F.array_repeat("_norm", F.size(vector)))
        .withColumn(out, F.zip_with(vector, "_norm", lambda x, n: x.cast("double") / n))
        .drop("_norm")
    )


def norm(vector) -> Column:
    return F.sqrt(dot(vector, vector))


def dot(left, right) -> Column:
    """Dot product of two arrays, for joins that already paired the rows."""
    products = F.zip_with(as_col(left), as_col(right), lambda a, b: a.cast("double") * b)
    return F.aggregate(products, F.lit(0.0), lambda a, x: a + x)
