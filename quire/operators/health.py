"""Request health over a log, per client and in time order.

The running figures depend on all earlier requests of a client, and one client
may own a large part of the log. The log is therefore range-partitioned on
(client, time, id) and kept in the shared folder; each piece of a client is
then a window of its own, and a small table (one row per piece that continues
a client) carries the totals, the last throttling and the last nine response
times over from the pieces before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.scratch import checkpoint

# Rules of the advice.
RECENT_SAMPLES = 10
THROTTLED_SECONDS = 10.0
CALM_SECONDS = 30.0
MIN_REQUESTS = 10
MAX_ERROR_RATE = 0.2
SLOW_MIN_SAMPLES = 5
SLOW_SECONDS = 5.0
FAST_MIN_SAMPLES = 10
FAST_SECONDS = 2.0
LOW_ERROR_RATE = 0.05
BASE_DELAY = 0.05
MAX_DELAY = 2.0
MAX_MULTIPLIER = 10


def request_health(
    log: DataFrame,
    throttled_seconds: float = THROTTLED_SECONDS,
    calm_seconds: float = CALM_SECONDS,
    pieces: int | None = None,
) -> DataFrame:
    """Figures and advice after each request.

    ``log``: client, request_id, ts, seconds, success, throttled. The result
    has the keys, total requests, errors, error rate, mean of the last ten
    response times, seconds since the last throttling, action and delay.
    """
    spark = log.sparkSession
    parts = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = log.select(
        "client",
        "request_id",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
        "seconds",
        (~F.col("success")).cast("long").alias("error"),
        F.col("throttled").alias("throttled"),
    )
    placed = checkpoint(
        rows.repartitionByRange(parts, "client", "at", "request_id").withColumn(
            "piece", F.spark_partition_id()
        )
    )
    carried = checkpoint(_carried(placed))

    # A continued piece starts with the response times carried into it.
    before = carried.select(
        "client", "piece", F.posexplode("tail").alias("_pos", "seconds")
    ).select(
        "client",
        "piece",
        (F.col("_pos") - RECENT_SAMPLES).cast("long").alias("_order"),
        F.lit(None).cast("long").alias("at"),
        F.lit(None).cast(log.schema["request_id"].dataType).alias("request_id"),
        "seconds",
        F.lit(None).cast("long").alias("error"),
        F.lit(None).cast("long").alias("throttled_at"),
    )
    own = placed.select(
        "client",
        "piece",
        F.lit(0).cast("long").alias("_order"),
        "at",
        "request_id",
        "seconds",
        "error",
        F.when(F.col("throttled"), F.col("at")).alias("throttled_at"),
    )
    order = W.partitionBy("client", "piece").orderBy("_order", "at", "request_id")
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    recent = order.rowsBetween(-(RECENT_SAMPLES - 1), W.currentRow)
    local = (
        own.unionByName(before)
        .select(
            "client",
            "piece",
            "request_id",
            "at",
            F.count("error").over(so_far).alias("n"),
            F.sum("error").over(so_far).alias("e"),
            F.max("throttled_at").over(so_far).alias("t"),
            F.avg("seconds").over(recent).alias("mean_recent"),
        )
        .filter(F.col("at").isNotNull())
    )
    offsets = F.broadcast(carried.drop("tail"))  # at most one row per piece
    joined = local.join(offsets, ["client", "piece"], "left")
    return _advise(joined, throttled_seconds, calm_seconds)


def _carried(placed: DataFrame) -> DataFrame:
    """What each continued piece of a client takes over from its earlier pieces."""
    sums = placed.groupBy("client", "piece").agg(
        F.count("*").alias("n"),
        F.sum("error").alias("e"),
        F.max(F.when(F.col("throttled"), F.col("at"))).alias("t"),
    )
    # Only a piece's first or last client can reach over its border.
    split = sums.groupBy("client").agg(F.count("*").alias("_p")).filter(F.col("_p") > 1).select("client")
    split = F.broadcast(split)
    late = W.partitionBy("client", "piece").orderBy(F.desc("at"), F.desc("request_id"))
    tails = (
        placed.join(split, "client", "left_semi")
        .withColumn("_n", F.row_number().over(late))
        .filter(F.col("_n") < RECENT_SAMPLES)
        .groupBy("client", "piece")
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("_n")).alias("k"), "seconds"))).alias("tail"))
    )
    by_client = W.partitionBy("client").orderBy("piece")
    earlier = by_client.rowsBetween(W.unboundedPreceding, -1)
    near = by_client.rowsBetween(-(RECENT_SAMPLES - 1), -1)
    times = F.transform(F.flatten(F.collect_list("tail").over(near)), lambda x: x["seconds"])
    return (
        sums.join(tails, ["client", "piece"])
        .select(
            "client",
            "piece",
            F.row_number().over(by_client).alias("_nth"),
            F.sum("n").over(earlier).alias("n_before"),
            F.sum("e").over(earlier).alias("e_before"),
            F.max("t").over(earlier).alias("t_before"),
            F.slice(times, F.greatest(F.lit(1), F.size(times) - (RECENT_SAMPLES - 2)), RECENT_SAMPLES).alias("tail"),
        )
        .filter(F.col("_nth") > 1)
        .drop("_nth")
    )


def _advise(joined: DataFrame, throttled_seconds: float, calm_seconds: float) -> DataFrame:
    total = F.col("n") + F.coalesce("n_before", F.lit(0))
    errors = F.col("e") + F.coalesce("e_before", F.lit(0))
    last = F.greatest("t", "t_before")
    since = (F.col("at") - last) / F.lit(1_000_000.0)
    figures = joined.select(
        "client",
        "request_id",
        total.alias("total_requests"),
        errors.alias("errors"),
        (errors / total).alias("error_rate"),
        "mean_recent",
        since.alias("since_throttled"),
    )
    n, rate, mean = F.col("total_requests"), F.col("error_rate"), F.col("mean_recent")
    hot = F.coalesce(F.col("since_throttled") < throttled_seconds, F.lit(False))
    calm = F.coalesce(F.col("since_throttled") >= calm_seconds, F.lit(True))
    reduce_ = (
        hot
        | ((n > MIN_REQUESTS) & (rate > MAX_ERROR_RATE))
        | ((n > SLOW_MIN_SAMPLES) & (mean > SLOW_SECONDS))
    )
    increase = calm & (n > FAST_MIN_SAMPLES) & (mean < FAST_SECONDS) & (rate < LOW_ERROR_RATE)
    factor = F.least(F.lit(MAX_MULTIPLIER), F.col("errors") + 1)
    return figures.select(
        "client",
        "request_id",
        "total_requests",
        "errors",
        F.round("error_rate", 6).alias("error_rate"),
        F.round("mean_recent", 6).alias("mean_recent"),
        F.round("since_throttled", 6).alias("since_throttled"),
        F.when(reduce_, F.lit("reduce")).when(increase, F.lit("increase")).otherwise(F.lit("hold")).alias("action"),
        F.round(
            F.when(reduce_, F.least(F.lit(MAX_DELAY), F.lit(BASE_DELAY) * factor)).otherwise(F.lit(BASE_DELAY)), 6
        ).alias("delay"),
    )


def health_summary(health: DataFrame) -> DataFrame:
    """Requests per client and advised action."""
    return health.groupBy("client", "action").agg(
        F.count("*").alias("requests"), F.round(F.avg("delay"), 6).alias("avg_delay")
    )
