"""Equi-joins between corpus tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.sizes import SUSPECT_MB, megabytes

PAGE_KEY = ("doc_id", "page_number")


def attach_results(
    pages: DataFrame, results: DataFrame, on: tuple[str, ...] = PAGE_KEY
) -> DataFrame:
    """Left join of model results to page rows on the whole page key.

    Joining on the document alone would multiply pages; the composite key also
    spreads a document with very many pages over the tasks.
    """
    added = [c for c in results.columns if c not in on]
    clash = set(added) & set(pages.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    return pages.join(results, list(on), "left").select(*pages.columns, *added)


def page_lookup(
    left: DataFrame, right: DataFrame, keys: dict[str, str], columns: list[str]
) -> DataFrame:
    """Same page in two page tables whose key columns are named differently."""
    renamed = right.select(
        *[F.col(r).alias(l) for l, r in keys.items()], *[F.col(c) for c in columns]
    )
    return left.join(renamed, list(keys), "inner").select(*left.columns, *columns)


def skip_existing(
    planned: DataFrame, inventory: DataFrame, min_mb: float = SUSPECT_MB
) -> DataFrame:
    """Planned rows whose target is absent or too small; those are redone."""
    done = inventory.filter(megabytes("file_size_bytes") > min_mb).select(
        F.col("volume_path").alias("target_path")
    )
    return planned.join(done, "target_path", "left_anti")


def not_in_query(terms: DataFrame, query_words: DataFrame, on: list[str]) -> DataFrame:
    """Terms that the query does not have yet."""
    return terms.join(query_words, on, "left_anti")
