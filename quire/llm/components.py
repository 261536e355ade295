"""Connected components of links between 64-bit ids, as Spark jobs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.scratch import materialise, release


class Forest:
    """Union-find over the ids one task sees; the smaller id is the root."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.parent
        top = x
        while (nxt := up.setdefault(top, top)) != top:
            top = nxt
        while x != top:
            up[x], x = top, up[x]
        return top

    def link(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the links of one partition by stars with the same components."""
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            forest.link(a, b)
    pairs = [(x, r) for x in list(forest.parent) if (r := forest.root(x)) != x]
    for at in range(0, len(pairs), 50_000):
        part = pairs[at : at + 50_000]
        yield pa.RecordBatch.from_pydict(
            {"a": pa.array([p[0] for p in part], pa.int64()), "b": pa.array([p[1] for p in part], pa.int64())}
        )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m"))
    least = least.select(F.col("a").alias("_u"), F.least("a", "_m").alias("_m"))
    return (
        both.join(least.hint("merge"), both["a"] == least["_u"])
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("_m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("_m"))
    low = least.select(F.col("a").alias("_u"), "_m")
    moved = (
        edges.join(low.hint("merge"), edges["a"] == low["_u"])
        .where(F.col("b") != F.col("_m"))
        .select(F.col("b").alias("a"), F.col("_m").alias("b"))
    )
    return moved.union(least.select("a", F.col("_m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``id``, ``root`` of every id in ``links`` (a, b); the root is the smallest id.

    Alternating large and small stars: every round is two aggregations with
    map-side combining and two sort-merge joins, whose skew Spark splits. Links
    are first replaced by stars within each partition. Nulls and loops are
    ignored; no id and no link goes through the driver. Every round is written
    to the shared scratch folder.
    """
    found = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = materialise(found.mapInArrow(_contract, "a long, b long").distinct(), "links")
    seen = None
    while True:
        mark = edges.agg(F.count("a"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if mark[0] == 0 or mark == seen:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct()
            )
        seen = mark
        starred = _large_star(edges).distinct()
        before, edges = edges, materialise(_small_star(starred).distinct(), "links")
        release(before)
