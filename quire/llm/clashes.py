"""One rule for clashing names: a result replaces an input column of its name."""

from __future__ import annotations

from pyspark.sql import DataFrame


def without(df: DataFrame, *results: str) -> DataFrame:
    """``df`` without the columns that are named like a result, whatever their case."""
    taken = {r.lower() for r in results}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])
