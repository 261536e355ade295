"""Near copies among vectors: quantised tile products with proven error bounds.

Vectors of one label are cut into blocks; every pair of blocks is one task,
which multiplies the blocks quantised to int8. The error of each product is
bounded by what quantisation took from the two vectors, and only pairs that
could reach the threshold are computed again in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.components import Forest, components
from quire.scratch import materialise

THRESHOLD = 0.93
BLOCK = 2048
# Rows of a block that are multiplied at once, and pairs recomputed at once.
STRIP, CHECKED = 512, 20_000
# Covers the rounding of the bounds themselves, which are computed in double precision.
ROUNDING = 1e-9


def quantise(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scales, and the length of what each unit vector lost."""
    scale = np.abs(units).max(1) / 127
    values = np.rint(units / scale[:, None]).astype(np.int8)
    lost = np.linalg.norm(units - values * scale[:, None], axis=1)
    return values, scale, lost


def close_pairs(x: np.ndarray, y: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i, j) of x and y whose cosine in double precision is at least ``threshold``.

    For unit vectors u = q + e: u1.u2 = q1.q2 + e1.u2 + q1.e2, so the product of
    the quantised vectors is wrong by at most |e1| + |q1| |e2|. The int8
    products are sums of integers far below 2^24, which float32 adds exactly.
    """
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    qx, sx, ex = quantise(x / nx[:, None])
    qy, sy, ey = quantise(y / ny[:, None])
    right = qy.astype(np.float32).T
    exact = x.shape[1] * 127 * 127 < 1 << 24
    if not exact:
        right = right.astype(np.float64)
    for at in range(0, len(x), STRIP):
        q = qx[at : at + STRIP].astype(right.dtype)
        product = (q @ right).astype(np.float64) * sx[at : at + STRIP, None] * sy
        bound = ex[at : at + STRIP, None] + (1 + ex[at : at + STRIP, None]) * ey + ROUNDING
        i, j = np.nonzero(product + bound >= threshold)
        for k in range(0, len(i), CHECKED):
            a, b = i[k : k + CHECKED] + at, j[k : k + CHECKED]
            cosine = np.einsum("ij,ij->i", x[a], y[b]) / (nx[a] * ny[b])
            near = cosine >= threshold
            yield a[near], b[near]


def usable(vectors: DataFrame, id_column: str, vector: str, label: str) -> DataFrame:
    """``_id``, ``_label``, ``_v`` (doubles), ``_key`` (hash of label and values) of vectors that can link."""
    kind = vectors.schema[label].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, keys = [], []
            values = batch.column("_v").to_pylist()
            for k, (name, own) in enumerate(zip(batch.column("_label").to_pylist(), values)):
                v = np.array(own, np.float64) + 0.0
                # a length that overflows or vanishes has no cosine
                with np.errstate(over="ignore", under="ignore"):
                    length = float(np.linalg.norm(v))
                if np.isfinite(v).all() and 0 < length < np.inf:
                    keep.append(k)
                    digest = xxhash.xxh3_64_intdigest(repr(name).encode() + b"\0" + v.tobytes())
                    keys.append(int(np.uint64(digest).astype(np.int64)))
            out = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(keys, pa.int64())], names=[*out.schema.names, "_key"])

    rows = vectors.select(
        F.col(id_column).alias("_id"), F.col(label).alias("_label"), F.col(vector).cast("array<double>").alias("_v")
    ).where(F.col("_label").isNotNull() & F.col("_v").isNotNull() & ~F.exists("_v", lambda c: c.isNull()))
    ids = vectors.schema[id_column].dataType.simpleString()
    return rows.where(F.size("_v") > 0).mapInArrow(run, f"_id {ids}, _label {kind}, _v array<double>, _key long")


def _tile(threshold: float):
    """One pair of blocks: links per class, and links enough to connect what is connected."""

    def run(table: pa.Table) -> pa.Table:
        first, second = table.column("_bi")[0].as_py(), table.column("_bj")[0].as_py()
        block = table.column("_block").to_numpy()
        keys, copies = table.column("_key").to_numpy(), table.column("_copies").to_numpy()
        width = table.column("_width").to_numpy()
        counts: dict[int, int] = {}
        forest, ties = Forest(), []
        flat = table.column("_v").combine_chunks()
        values, ends = flat.values.to_numpy(), flat.offsets.to_numpy()
        for w in np.unique(width).tolist():
            rows = np.flatnonzero((block == first) & (width == w))
            cols = rows if first == second else np.flatnonzero((block == second) & (width == w))
            if not len(rows) or not len(cols):
                continue
            x = values[ends[rows][:, None] + np.arange(w)]
            y = values[ends[cols][:, None] + np.arange(w)]
            to_x, to_y = np.zeros(len(rows), np.int64), np.zeros(len(cols), np.int64)
            for i, j in close_pairs(x, y, threshold):
                if first == second:
                    up = i < j
                    i, j = i[up], j[up]
                np.add.at(to_x, i, copies[cols[j]])
                np.add.at(to_y, j, copies[rows[i]])
                for a, b in zip(keys[rows[i]].tolist(), keys[cols[j]].tolist()):
                    if forest.link(a, b):
                        ties.append((a, b))
            for at, got in ((rows, to_x), (cols, to_y)):
                for key, n in zip(keys[at].tolist(), got.tolist()):
                    if n:
                        counts[key] = counts.get(key, 0) + n
        a = list(counts) + [t[0] for t in ties]
        b = [None] * len(counts) + [t[1] for t in ties]
        n = list(counts.values()) + [0] * len(ties)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    return run


def near_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    block: int = BLOCK,
) -> DataFrame:
    """``id_column``, ``n_links``, ``component_id``, ``kept`` of every row of ``vectors``.

    Two rows link when their labels are equal and not null and the cosine of
    their vectors, in double precision, is at least ``threshold``. Vectors that
    are null or empty, have null or non-finite components, or a length that is
    zero or not finite link with nothing; vectors of different widths neither.
    ``n_links`` counts the other rows linked directly. The component is the
    smallest id reachable, the row's own included; ``kept`` marks that row (a
    null id links like others, never names a component, and is kept only where
    no id does). Equal vectors of a label are compared once and repeated rows
    are repeated in the result. An empty table gives an empty one; other columns
    are ignored.

    No pair of vectors is emitted: a task returns link counts and a spanning
    forest. All pairs of a label are compared, in (n / ``block``)^2 / 2 tasks.
    """
    rows = materialise(usable(vectors, id_column, vector, label), "vectors")
    classes = materialise(
        rows.groupBy("_key").agg(
            F.first("_label").alias("_label"),
            F.first("_v").alias("_v"),
            F.count(F.lit(1)).alias("_copies"),
            F.min("_id").alias("_least"),
        ),
        "classes",
    )
    sizes = classes.groupBy("_label").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("_blocks"))
    dealt = classes.join(sizes, "_label").withColumn("_block", F.expr("cast(pmod(xxhash64(_key), _blocks) as int)"))
    tiles = (
        dealt.withColumn("_other", F.explode(F.expr("sequence(0, _blocks - 1)")))
        .select(
            "_label",
            F.least("_block", "_other").alias("_bi"),
            F.greatest("_block", "_other").alias("_bj"),
            "_block",
            "_key",
            "_copies",
            F.size("_v").alias("_width"),
            "_v",
        )
        .groupBy("_label", "_bi", "_bj")
        .applyInArrow(_tile(threshold), "a long, b long, n long")
    )
    found = materialise(tiles, "tiles")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("_key")).agg(F.sum("n").alias("_links"))
    roots = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("id", "_key")
    named = classes.select("_key", "_copies", "_least").join(roots, "_key", "left")
    named = named.withColumn("root", F.coalesce("root", "_key")).join(counts, "_key", "left")
    least = named.groupBy("root").agg(F.min("_least").alias("_component"))
    of_class = materialise(
        named.join(least, "root").select(
            "_key", "_component", (F.col("_copies") - 1 + F.coalesce("_links", F.lit(0))).alias("n_links")
        ),
        "components",
    )
    linked = rows.join(of_class.hint("merge"), "_key").select("_id", "n_links", F.col("_component").alias("component_id"))
    # rows that cannot link: the others, told by the same rule, stand for themselves
    able = F.col(label).isNotNull() & F.col(vector).isNotNull()
    single = _unusable(vectors, id_column, vector, label, able)
    every = linked.union(single)
    return every.select(
        F.col("_id").alias(id_column),
        "n_links",
        "component_id",
        F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _unusable(vectors: DataFrame, id_column: str, vector: str, label: str, able) -> DataFrame:
    """Rows whose label or vector cannot link, as components of their own."""
    values = F.col(vector).cast("array<double>")
    ids = vectors.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for k, (bad, own) in enumerate(zip(batch.column("_bad").to_pylist(), batch.column("_v").to_pylist())):
                if not bad:
                    v = np.array(own, np.float64)
                    with np.errstate(over="ignore", under="ignore"):
                        length = float(np.linalg.norm(v))
                    bad = not (np.isfinite(v).all() and 0 < length < np.inf)
                if bad:
                    keep.append(k)
            got = batch.column("_id").take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_pydict({"_id": got, "n_links": pa.array([0] * len(keep), pa.int64()), "component_id": got})

    bad = ~able | (F.size(values) < 1) | F.exists(values, lambda c: c.isNull())
    rows = vectors.select(F.col(id_column).alias("_id"), F.coalesce(bad, F.lit(True)).alias("_bad"), values.alias("_v"))
    return rows.mapInArrow(run, f"_id {ids}, n_links long, component_id {ids}")
