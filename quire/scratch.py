"""Shared scratch space and bounded driver reads.

Operators that cut lineage, or that keep a table between two steps, write below
the folder the cluster names in ``spark.checkpoint.dir``. Only where that
setting is absent (tests, a laptop) does this module choose a folder itself.
"""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bounds on what a plan may hold on the driver and broadcast to the tasks.
MAX_BROADCAST_ROWS = 16_384
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# Rows of a narrow frame (keys, a score, a rank) that may be broadcast.
MAX_NARROW_ROWS = 500_000

_fallback: dict[str, str] = {}
# Tables written by `materialise`, by the frame that reads them.
_written: dict[int, tuple] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = tempfile.mkdtemp(prefix="quire-")
    return _fallback[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives executor loss."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint(eager=True)


# Spark's setting that lets a finished SQL execution delete its own shuffle files.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as parquet in the shared folder and read it back.

    For tables that several later steps scan, such as a search index: unlike a
    checkpoint it keeps column pruning and filter push-down. The shuffles that
    made the table go when it is written; the table itself stays until its owner
    calls ``release``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    out = spark.read.parquet(path)
    _written[id(out)] = weakref.ref(out, lambda _, key=id(out): _written.pop(key, None)), path
    return out


def release(*frames: DataFrame) -> None:
    """Delete tables that ``materialise`` returned and that no frame still to be computed reads."""
    for df in frames:
        held = _written.pop(id(df), None)
        if held is not None and held[0]() is df:
            place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(held[1])
            place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def bounded_rows(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> list | None:
    """Rows of ``df``, or None when there are more than ``limit`` of them.

    Reads at most ``limit + 1`` rows, so an unexpectedly large input costs a
    bounded read and the caller takes its distributed path.
    """
    rows = df.limit(limit + 1).collect()
    return None if len(rows) > limit else rows


def broadcast_if_small(df: DataFrame, limit: int = MAX_NARROW_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``limit`` rows.

    For narrow frames that are cheap to read, such as checkpointed ones. A
    larger frame comes back unmarked and joins by shuffle.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
