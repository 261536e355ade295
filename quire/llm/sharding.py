"""Uniform shuffle of rows into shards of exact sizes.

How many rows each partition sends to each shard is drawn at once, from the
multivariate hypergeometric law; rows are permuted within their partition,
exchanged, and permuted again within their shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.clashes import without
from quire.scratch import materialise

SHARDS = 16
# Rows of a shard that are put in order by one task.
RUN_ROWS = 20_000


def shard_sizes(total: int, shards: int) -> np.ndarray:
    """Sizes at most one apart."""
    return np.array([total // shards + (k < total % shards) for k in range(shards)], np.int64)


def communication(counts: list[int], sizes: np.ndarray, seed: int) -> np.ndarray:
    """Rows each partition sends to each shard, as a uniform shuffle of all rows would.

    Row p is drawn without replacement from the places still free, so row sums
    are the partition sizes and column sums the shard sizes, exactly.
    """
    rng = np.random.Generator(np.random.PCG64(seed))
    free = sizes.copy()
    out = np.zeros((len(counts), len(sizes)), np.int64)
    for p, n in enumerate(counts):
        if int(free.sum()) >= 1_000_000_000:  # the sampler's own limit: halve the shards until one is left
            out[p] = _split(rng, free, n)
        else:
            out[p] = rng.multivariate_hypergeometric(free, n, method="marginals")
        free -= out[p]
    return out


def _split(rng: np.random.Generator, free: np.ndarray, n: int) -> np.ndarray:
    if len(free) == 1:
        return np.array([n], np.int64)
    half = len(free) // 2
    good, bad = int(free[:half].sum()), int(free[half:].sum())
    left = _hypergeometric(rng, good, bad, n)
    return np.concatenate([_split(rng, free[:half], left), _split(rng, free[half:], n - left)])


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Like numpy's sampler; for populations beyond its limit by inversion around the mode."""
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, n)) if n else 0
    low, high = max(0, n - bad), min(n, good)
    mode = min(high, max(low, (n + 1) * (good + 1) // (good + bad + 2)))
    mean_p, u = good / (good + bad), rng.random()
    var = n * mean_p * (1 - mean_p) * (good + bad - n) / max(1, good + bad - 1)
    span = int(12 * np.sqrt(var) + 50)
    ks = np.arange(max(low, mode - span), min(high, mode + span) + 1, dtype=np.float64)
    # log of the ratio of neighbouring probabilities, summed from the lower end
    step = np.log((good - ks[:-1]) * (n - ks[:-1])) - np.log((ks[:-1] + 1) * (bad - n + ks[:-1] + 1))
    logp = np.concatenate([[0.0], np.cumsum(step)])
    p = np.cumsum(np.exp(logp - logp.max()))
    return int(ks[np.searchsorted(p, u * p[-1])])


def shuffle_to_shards(rows: DataFrame, shards: int = SHARDS, seed: int = 17, run_rows: int = RUN_ROWS) -> DataFrame:
    """All columns of ``rows`` plus ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard).

    Columns of these names are replaced.

    Shard sizes differ by one row at most. The rows are first written to the
    scratch folder with their partition and a number, so a lost executor cannot
    change what was drawn; pass narrow rows and join wide ones by key. Equal
    rows and rows with nulls are rows like any other. An empty table gives an
    empty one. The matrix has one row per partition: it grows with partitions,
    not with rows.
    """
    rows = without(rows, "shard", "slot")
    frozen = materialise(
        rows.withColumn("_uid", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id()), "shards"
    )
    held = [(r[0], r[1]) for r in frozen.groupBy("_part").count().orderBy("_part").collect()]
    total = sum(n for _, n in held)
    sizes = shard_sizes(total, shards)
    matrix = communication([n for _, n in held], sizes, seed)
    spark = rows.sparkSession
    sent = [(part, [s for s, n in enumerate(row) if n]) for (part, _), row in zip(held, matrix.tolist())]
    ends = [[int(n) for n in np.cumsum(row)[row > 0]] for row in matrix]
    table = spark.createDataFrame(
        [(part, to, end) for (part, to), end in zip(sent, ends)], "_p int, _shards array<int>, _ends array<long>"
    )
    # first permutation: the rank of a row in its partition by a random key picks its shard
    ranked = frozen.withColumn(
        "_rank",
        F.row_number().over(Window.partitionBy("_part").orderBy(F.xxhash64(F.lit(seed), "_uid"), "_uid")) - 1,
    )
    placed = (
        ranked.join(table, ranked["_part"] == table["_p"])
        .withColumn("shard", F.expr("element_at(_shards, size(filter(_ends, e -> e <= _rank)) + 1)"))
        .drop("_p", "_shards", "_ends", "_rank", "_part")
    )
    # second permutation, in runs of bounded size: a random run of the shard, then a random key within it
    parts = max(1, -(-total // (shards * run_rows)))
    second = placed.withColumn("_key", F.xxhash64(F.lit(seed + 1), "_uid")).withColumn(
        "_run", F.pmod(F.shiftright("_key", 20), F.lit(parts)).cast("int")
    )
    second = materialise(second, "shards")
    filled = second.groupBy("shard", "_run").agg(F.count(F.lit(1)).alias("_n"))
    before = filled.select(
        F.col("shard").alias("_s"),
        F.col("_run").alias("_r"),
        (F.sum("_n").over(Window.partitionBy("shard").orderBy("_run")) - F.col("_n")).alias("_before"),
    )
    place = F.row_number().over(Window.partitionBy("shard", "_run").orderBy("_key", "_uid")) - 1
    return (
        second.withColumn("_place", place)
        .join(before, (F.col("shard") == F.col("_s")) & (F.col("_run") == F.col("_r")))
        .withColumn("slot", F.col("_before") + F.col("_place"))
        .select(*rows.columns, "shard", "slot")
    )


def write_shards(assigned: DataFrame, path: str) -> None:
    """Writes rows with ``shard`` and ``slot`` as one folder per shard, in slot order."""
    assigned.repartition("shard", F.floor(F.col("slot") / RUN_ROWS)).sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
