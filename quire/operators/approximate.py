"""Approximate search: an index written once in key buckets, of which a search reads few.

A vector's key in a table is made of its sides of a few fixed planes, one bit
each. Near vectors agree in most bits, so in one of several tables they share
the whole key. The index is written as postings (table, key, row) in folders by
key and as vectors in folders by row; a search reads the folders of its
questions' keys, joins on table and key, and scores the candidates one by one.
More rows mean more bits, so a key keeps the same few rows at any size. A key
that many rows share all the same is dealt over several salts.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions.vectors import dot, with_unit
from quire.operators.similarity import RANK_DIGITS, SCORE_DIGITS
from quire.scratch import MAX_NARROW_ROWS, broadcast_if_small, checkpoint, materialise, scratch_path

TABLES = 8
# Rows that a key has on average.
KEY_ROWS = 16
LEAST_BITS, MOST_BITS = 4, 48
# Rows of one (table, key) that one task joins.
HOT_ROWS = 4_096
# Most folders of an index, and rows that make one worth while.
FOLDERS, FOLDER_ROWS = 64, 65_536
# A prime and two of its multipliers, from which the planes are drawn.
PRIME, FIRST, SECOND = 2_147_483_647, 48_271, 69_621


def plane_signs(number: np.ndarray) -> np.ndarray:
    """+1 or -1 per coefficient number: a rule, so that any engine draws the same planes."""
    x = number * FIRST % PRIME
    x = x * x % PRIME
    return 1.0 - 2.0 * (x * SECOND % PRIME % 2)


def planes(tables: int, bits: int, dimensions: int) -> np.ndarray:
    """One row per table and bit."""
    return plane_signs(np.arange(1, tables * bits * dimensions + 1, dtype=np.int64)).reshape(-1, dimensions)


def key_bits(rows: int) -> int:
    """Bits for which a key has about ``KEY_ROWS`` rows."""
    return min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(rows, 1) / KEY_ROWS))))


def bucket_keys(vector: str, tables: int, bits: int) -> Column:
    """Array with the key of each table; a bit is set on the plane's positive side or on the plane."""

    @F.arrow_udf("array<long>")
    def keys(vectors):  # noqa: ANN001, ANN202
        import pyarrow as pa

        values = vectors.flatten().to_numpy(zero_copy_only=False).astype("float64")
        if not len(vectors) or not len(values):
            return pa.array([[0] * tables] * len(vectors), pa.list_(pa.int64()))
        rows = values.reshape(len(vectors), -1)
        sides = rows @ planes(tables, bits, rows.shape[1]).T >= 0
        weights = np.int64(1) << np.arange(bits, dtype=np.int64)
        found = sides.reshape(len(rows), tables, bits) @ weights
        ends = np.arange(len(rows) + 1, dtype=np.int32) * tables
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(found.reshape(-1)))

    return keys(F.col(vector))


def _folder(folders: int, *columns: str) -> Column:
    return F.pmod(F.hash(*columns), F.lit(folders))


class BucketIndex:
    """A written index, by its folder and the numbers it was made with; tables are opened when they are asked for."""

    def __init__(self, spark: SparkSession, path: str, tables: int, bits: int, folders: int, id_type: str) -> None:
        self.tables, self.bits, self.folders = tables, bits, folders
        self._spark, self._path, self._id_type = spark, path, id_type
        self._n_hot: int | None = None

    def _table(self, name: str, kind: str) -> DataFrame:
        return self._spark.read.schema(kind).parquet(f"{self._path}/{name}")

    @property
    def postings(self) -> DataFrame:
        return self._table("postings", "table int, key long, salt int, row long, folder int")

    @property
    def vectors(self) -> DataFrame:
        return self._table("vectors", f"row long, id {self._id_type}, vector array<double>, folder int")

    @property
    def hot(self) -> DataFrame:
        return self._table("hot", "table int, key long, salts int")

    def with_salts(self, keyed: DataFrame) -> DataFrame:
        """``keyed`` with the salts of its (table, key); a bounded number of hot keys is broadcast."""
        if self._n_hot is None:
            self._n_hot = self.hot.count()
        if not self._n_hot:
            return keyed.withColumn("salts", F.lit(1))
        hot = F.broadcast(self.hot) if self._n_hot <= MAX_NARROW_ROWS else self.hot
        return keyed.join(hot, ["table", "key"], "left").withColumn("salts", F.coalesce("salts", F.lit(1)))

    def in_folders(self, table: DataFrame, wanted: DataFrame) -> DataFrame:
        """``table`` with the folders that ``wanted`` names: a partition filter of at most as many numbers as folders."""
        if self.folders == 1:
            return table
        held = sorted(r[0] for r in wanted.select("folder").distinct().collect())
        return table.filter(F.col("folder").isin(held) if held else F.lit(False))


def write_index(
    index: DataFrame,
    path: str,
    id_col: str = "id",
    vector: str = "vector",
    tables: int = TABLES,
    bits: int | None = None,
    folders: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> BucketIndex:
    """Writes the rows of ``index`` that have a direction in key buckets below ``path``.

    ``postings``: folder, table, key, salt, row; ``vectors``: folder, row, id and
    unit vector; ``hot``: the keys with more than ``hot_rows`` rows and their
    salts. Rows keep a number of their own, so ids may repeat or be null. All
    vectors have the same length.
    """
    spark = index.sparkSession
    whole = index.select(F.col(id_col).alias("id"), F.col(vector).alias("vector")).filter(F.col("vector").isNotNull())
    rows = whole.count()
    bits = key_bits(rows) if bits is None else bits
    folders = min(FOLDERS, math.ceil(max(rows, 1) / FOLDER_ROWS)) if folders is None else folders
    numbered = with_unit(whole, "vector", "vector").withColumn("row", F.monotonically_increasing_id())
    by_row = numbered.select("row", "id", "vector", _folder(folders, "row").alias("folder"))
    by_row.repartition("folder").sortWithinPartitions("folder", "row").write.partitionBy("folder").parquet(
        f"{path}/vectors"
    )
    made = BucketIndex(spark, path, tables, bits, folders, index.schema[id_col].dataType.simpleString())
    keyed = made.vectors.select("row", F.posexplode(bucket_keys("vector", tables, bits)).alias("table", "key"))
    keyed.groupBy("table", "key").agg(F.count("row").alias("n")).filter(F.col("n") > hot_rows).select(
        "table", "key", F.ceil(F.col("n") / hot_rows).cast("int").alias("salts")
    ).write.parquet(f"{path}/hot")
    salted = made.with_salts(keyed).select(
        "table",
        "key",
        F.pmod(F.xxhash64("row"), "salts").cast("int").alias("salt"),
        "row",
        _folder(folders, "table", "key").alias("folder"),
    )
    salted.repartition("folder", "salt").sortWithinPartitions("folder", "table", "key").write.partitionBy(
        "folder"
    ).parquet(f"{path}/postings")
    return made


def candidates(index: BucketIndex, questions: DataFrame) -> DataFrame:
    """``asked``, ``row``: rows that share a key with a question, once each.

    ``questions``: ``asked`` (a number) and ``vector``, a unit vector. Both
    sides are dealt by (table, key, salt), so a key's rows beyond ``hot_rows``
    go to other tasks and only its questions are repeated there.
    """
    probes = questions.select(
        "asked", F.posexplode(bucket_keys("vector", index.tables, index.bits)).alias("table", "key")
    )
    salts = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    probes = checkpoint(
        index.with_salts(probes).select(
            "asked", "table", "key", _folder(index.folders, "table", "key").alias("folder"), salts
        )
    )
    met = index.in_folders(index.postings, probes).join(probes.drop("folder"), ["table", "key", "salt"])
    return met.select("asked", "row").distinct()


def search_index(
    index: BucketIndex, questions: DataFrame, k: int, question: str = "question_id", vector: str = "vector"
) -> DataFrame:
    """Best ``k`` candidates per question by cosine: question, id, score, rank.

    Scores are exact; equal ones are ranked by id, null ids first. Each question
    row is answered by itself; one without a direction has no hits. Fewer than
    ``k`` rows come back where fewer share a key.
    """
    asked = questions.select(F.col(question).alias("name"), F.col(vector).alias("vector"))
    asked = checkpoint(
        with_unit(asked.filter(F.col("vector").isNotNull()), "vector", "vector").withColumn(
            "asked", F.monotonically_increasing_id()
        )
    )
    met = materialise(candidates(index, asked.select("asked", "vector")), "candidates")
    rows = index.in_folders(index.vectors, met.select(_folder(index.folders, "row").alias("folder"))).select("row", "id", "vector")
    named = asked.select("asked", "name", F.col("vector").alias("asked_vector"))
    scored = (
        rows.join(broadcast_if_small(met), "row")
        .join(named, "asked")
        .select("asked", "name", "id", F.round(dot("vector", "asked_vector"), RANK_DIGITS).alias("score"))
    )
    order = W.partitionBy("asked").orderBy(F.desc("score"), F.asc("id"))
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= k)
    return ranked.select(
        F.col("name").alias(question), "id", (F.round("score", SCORE_DIGITS) + F.lit(0.0)).alias("score"), "rank"
    )


def approximate_top_k(
    index: DataFrame,
    questions: DataFrame,
    k: int,
    id_col: str = "id",
    vector: str = "vector",
    question: str = "question_id",
    question_vector: str = "vector",
    **numbers,
) -> DataFrame:
    """Top-k among the rows that share a key with the question, over an index written for this call."""
    written = write_index(index, scratch_path(index.sparkSession, "lsh"), id_col, vector, **numbers)
    return search_index(written, questions, k, question, question_vector)
