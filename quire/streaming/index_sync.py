"""Index that follows its source through Structured Streaming.

The index is kept as state by key: rows lie in buckets by a hash of the key, one
row per key, and a change writes the buckets of its keys anew as one step. A
reader takes the newest step of every bucket, so it reads each key once, however
many versions there were.

Of two versions of a key the higher one counts, whatever the order in which they
arrive; of equal versions the later batch counts, and a null version is the
lowest. Merging is the greater of two, so a repeated batch changes nothing.

Deletes do not show in a stream of rows: a batch ``sync_diff`` against the
source finds them, and ``append_deletes`` records them between two batches. A
delete stands for the highest version known when it is recorded: late rows up to
that version stay deleted, a higher version brings the key back, and so does the
same version in a later batch.

A batch is compared with the state by key and version first, so rows that come
too late are dropped before any text moves. Only buckets in which a row changes
are dealt anew; the others of the batch are written as they were read.

One writer at a time. The index folder and the state folder of the stream belong
together: a stream started anew needs a new index folder.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.functions.ids import content_hash
from quire.scratch import MAX_NARROW_ROWS, broadcast_if_small

TRIGGERED = "TRIGGERED"
CONTINUOUS = "CONTINUOUS"
# Buckets of an index. A batch writes those of its keys anew: more buckets suit smaller batches.
BUCKETS = 64
# Columns of the state that are not part of the index.
INTERNAL = ("deleted", "row_version", "epoch", "bucket", "step")
STEP = re.compile(r"step=(\d+)\.(-?\d+)")


def start_sync(
    source: DataFrame,
    path: str,
    state: str,
    key: str,
    content: str,
    version: str,
    mode: str = TRIGGERED,
    interval: str = "30 seconds",
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Follow a streaming source into an index folder.

    ``version`` orders the rows of one key, within a batch and across batches;
    of equal versions within a batch the one with the largest content hash
    counts. ``prepare`` adds columns to the changed rows only, such as their
    vectors. TRIGGERED handles what is there and stops; CONTINUOUS keeps running.
    """
    def upsert(batch: DataFrame, epoch: int) -> None:
        rows = (
            batch.withColumn("content_hash", content_hash(content))
            .withColumn("deleted", F.lit(False))
            .withColumn("row_version", F.col(version))
            .withColumn("epoch", F.lit(epoch).cast("long"))
        )
        _merge(rows, path, key, epoch, prepare)

    writer = source.writeStream.foreachBatch(upsert).option("checkpointLocation", state)
    if mode == TRIGGERED:
        writer = writer.trigger(availableNow=True)
    elif mode == CONTINUOUS:
        writer = writer.trigger(processingTime=interval)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return writer.start()


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in store.listStatus(place)] if store.exists(place) else []


def _steps(spark: SparkSession, path: str) -> list[tuple[int, int, str]]:
    """Number, epoch and folder of every step, in order."""
    found = [(STEP.fullmatch(name), name) for name in _children(spark, path)]
    return sorted((int(m[1]), int(m[2]), name) for m, name in found if m)


def newest_buckets(spark: SparkSession, path: str, buckets: list[int] | None = None) -> list[str]:
    """Folder of the newest finished step of each bucket, or of some buckets."""
    newest: dict[int, str] = {}
    for _, _, step in _steps(spark, path):
        names = _children(spark, f"{path}/{step}")
        if "_SUCCESS" in names:
            newest |= {int(n.split("=")[1]): f"{path}/{step}/{n}" for n in names if n.startswith("bucket=")}
    return [folder for b, folder in sorted(newest.items()) if buckets is None or b in buckets]


def index_state(spark: SparkSession, path: str, buckets: list[int] | None = None) -> DataFrame | None:
    """One row per key, deletes included, of all or some buckets; None where nothing was written."""
    folders = newest_buckets(spark, path, buckets)
    if not folders:
        return None
    reader = spark.read.option("basePath", path).option("mergeSchema", True)
    return reader.parquet(*folders).drop("step", "bucket")


def _bucket(key: str):
    return F.pmod(F.hash(key), F.lit(BUCKETS)).alias("bucket")


def _write_step(rows: DataFrame, path: str, key: str, epoch: int) -> None:
    """Writes rows as a new step, each task the buckets of its rows."""
    steps = _steps(rows.sparkSession, path)
    number = steps[-1][0] + 1 if steps else 0
    dealt = rows if "bucket" in rows.columns else rows.withColumn("bucket", _bucket(key))
    dealt.write.option("compression", "zstd").partitionBy("bucket").parquet(f"{path}/step={number:09d}.{epoch}")


def _greatest(rows: DataFrame, key: str) -> DataFrame:
    """The greatest row of every key, dealt by bucket: the only time that whole rows are shuffled."""
    others = [c for c in rows.columns if c not in (key, "bucket")]
    # a delete counts after the rows of its epoch and before those of the next
    place = F.struct("row_version", "epoch", "deleted", "content_hash")
    dealt = rows.withColumn("bucket", _bucket(key)).repartition("bucket")
    best = dealt.groupBy("bucket", key).agg(F.max_by(F.struct(*others), place).alias("_row"))
    return best.select(key, "_row.*", "bucket")


def _changed(rows: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """Keys of ``rows`` with a row above their state, from keys and versions alone."""
    place = F.struct("row_version", "epoch", "deleted")
    new = rows.groupBy(key).agg(F.max(place).alias("_new"))
    old = held.select(F.col(key).alias("_key"), place.alias("_old"))
    met = new.join(old, F.col(key).eqNullSafe(F.col("_key")), "left")
    return met.filter(F.col("_old").isNull() | (F.col("_new") > F.col("_old"))).select(F.col(key).alias("_key"))


def _merge(
    rows: DataFrame, path: str, key: str, epoch: int, prepare: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Writes the buckets of ``rows`` anew, each key with the greater of its state and its rows."""
    spark = rows.sparkSession
    rows = rows.persist()
    touched = [r[0] for r in rows.select(_bucket(key)).distinct().collect()]
    held = index_state(spark, path, touched) if touched else None
    if held is not None:
        changed = _changed(rows, held, key).persist()
        found = {r[0]: r[1] for r in changed.groupBy(_bucket("_key")).count().collect()}
        new = rows
        if sum(found.values()) <= MAX_NARROW_ROWS:
            new = rows.join(F.broadcast(changed), F.col(key).eqNullSafe(F.col("_key")), "left_semi")
        held = index_state(spark, path, list(found))
        step = index_state(spark, path, [b for b in touched if b not in found])
        if found:
            latest = new if prepare is None else prepare(_greatest(new, key).drop("bucket"))
            both = latest if held is None else held.unionByName(latest, allowMissingColumns=True)
            best = _greatest(both, key)
            stay = None if step is None else step.withColumn("bucket", _bucket(key))
            step = best if stay is None else stay.unionByName(best, allowMissingColumns=True)
        _write_step(step, path, key, epoch)
        changed.unpersist()
    elif touched:
        best = _greatest(rows, key)
        if prepare is not None:
            best = _greatest(prepare(best.drop("bucket")), key)
        _write_step(best, path, key, epoch)
    rows.unpersist()


def current_index(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The row of every key, without deleted keys."""
    return index_state(spark, path).filter(~F.col("deleted")).drop(*INTERNAL)


def append_deletes(spark: SparkSession, path: str, keys: DataFrame, key: str) -> None:
    """Record keys as deleted, as of the latest epoch and the highest version known of each.

    The buckets of the keys are read and written anew. A call may be repeated;
    a key that the index does not have changes nothing.
    """
    gone = keys.select(key).distinct()
    touched = [r[0] for r in gone.select(_bucket(key)).distinct().collect()]
    held = index_state(spark, path, touched) if touched else None
    if held is None:
        return
    epoch = max(e for _, e, _ in _steps(spark, path))
    named = gone.select(F.col(key).alias("_gone"), F.lit(True).alias("_is_gone")).persist()
    small = broadcast_if_small(named)
    met = held.join(small, F.col(key).eqNullSafe(F.col("_gone")), "left")
    fixed = {"deleted": True, "epoch": epoch}
    rows = met.select(
        *[
            F.col(f.name)
            if f.name in (key, "row_version")
            else F.when(F.col("_is_gone"), F.lit(fixed.get(f.name)).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
            for f in held.schema.fields
        ]
    )
    # a join with many keys has dealt the rows by key; else they stand as they were read
    _write_step(rows if small is not named else rows.repartition(_bucket(key)), path, key, epoch)
    named.unpersist()


def compact(spark: SparkSession, path: str, target: str, key: str) -> None:
    """Write the row of every key to a new folder, as one step before all others.

    Deletes stay, without content, so that late rows do not bring keys back.
    """
    _write_step(index_state(spark, path).withColumn("epoch", F.lit(-1).cast("long")), target, key, -1)
