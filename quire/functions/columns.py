"""Small helpers for column arguments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Bytes of text that a Python function works on at once.
SLICE_BYTES = 1 << 20


def as_col(value) -> Column:
    """A column from a name or a column."""
    return F.col(value) if isinstance(value, str) else value


def double_round(value, digits: int) -> Column:
    """Round as double, so reports do not leak decimal scales."""
    return F.round(as_col(value).cast("double"), digits)


def rate(part, whole, digits: int | None = None, scale: float = 100.0) -> Column:
    """``part / whole`` as a percentage, 0 when ``whole`` is 0."""
    value = F.coalesce(
        F.try_divide(as_col(part).cast("double") * F.lit(scale), as_col(whole).cast("double")),
        F.lit(0.0),
    )
    return value if digits is None else F.round(value, digits)


def text_slices(batches: Iterator[pa.Array], limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Cuts arrays of texts so that about ``limit`` bytes are worked on at once; one longer text stands alone."""
    for texts in batches:
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype("int64") + 64)
        lo = 0
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + limit, side="right")))
            yield texts.slice(lo, hi - lo)
            lo = hi
