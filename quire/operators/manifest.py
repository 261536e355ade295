"""Load planning and run logs over manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.predicates import in_categories, suspect_file
from quire.functions.sizes import SUSPECT_MB, megabytes
from quire.functions.text import parent_dir, safe_file_name


def normalise_label(label) -> Column:
    """One spelling per category: outer and repeated blanks and case removed."""
    label = F.col(label) if isinstance(label, str) else label
    return F.lower(F.trim(F.regexp_replace(label, r"\s+", " ")))


def dedupe_by(manifest: DataFrame, key: str, order: str) -> DataFrame:
    """First row per key; rows of a key are combined before the shuffle."""
    others = [c for c in manifest.columns if c != key]
    first = F.min_by(F.struct(*others), order).alias("_row")
    return manifest.groupBy(key).agg(first).select(key, "_row.*").select(*manifest.columns)


def plan_loads(
    manifest: DataFrame,
    root: str,
    file_name: Column,
    category: str = "category",
    by_category: bool = True,
    wanted: list[str] = ("all",),
) -> DataFrame:
    """Target folder, file name and path of every wanted manifest row."""
    folder = F.lit(root)
    if by_category:
        folder = F.concat(F.lit(root + "/"), safe_file_name(category))
    return (
        manifest.filter(in_categories(category, list(wanted)))
        .withColumn("target_dir", folder)
        .withColumn("file_name", file_name)
        .withColumn("target_path", F.concat_ws("/", "target_dir", "file_name"))
    )


def load_log(planned: DataFrame, loaded: DataFrame, keep: list[str], via: Column | None = None) -> DataFrame:
    """Download log: one row per attempt, path NULL where the load failed.

    ``loaded``: target_path, file_size_bytes of the files that arrived.
    """
    arrived = loaded.select("target_path", F.col("file_size_bytes").alias("_size"))
    ok = F.col("_size").isNotNull()
    return planned.join(arrived, "target_path", "left").select(
        *keep,
        ok.alias("success"),
        "file_name",
        F.coalesce(megabytes("_size"), F.lit(0.0)).alias("size_mb"),
        F.when(ok, F.col("target_path")).alias("stored_path"),
        (F.lit(False) if via is None else via).alias("special_route"),
    )


def run_log_summary(log: DataFrame) -> DataFrame:
    """Attempted, successful, failed, special-route successes, MB and GB."""
    total = F.coalesce(F.sum(F.when(F.col("success"), F.col("size_mb"))), F.lit(0.0))
    return log.agg(
        F.count("*").alias("attempted"),
        F.count_if("success").alias("successful"),
        F.count_if(~F.col("success")).alias("failed"),
        F.count_if(F.col("success") & F.col("special_route")).alias("special_route_successes"),
        F.round(total, 6).alias("total_mb"),
        F.round(total / 1024.0, 9).alias("total_gb"),
    )


def failed_loads(log: DataFrame) -> DataFrame:
    return log.filter(~F.col("success"))


def write_run_metadata(log: DataFrame, path: str, **settings: str) -> None:
    """Run metadata: one JSON object of totals beside the log as JSON lines.

    The log is written by the tasks; it is not gathered into one object.
    """
    totals = run_log_summary(log).withColumn("run_time", F.current_timestamp())
    for name, value in settings.items():
        totals = totals.withColumn(name, F.lit(value))
    log.write.mode("overwrite").json(f"{path}/entries")
    totals.coalesce(1).write.mode("overwrite").json(f"{path}/summary")


def suspect_files(inventory: DataFrame, root: str, below_mb: float = SUSPECT_MB) -> DataFrame:
    """Small ``.pdf`` files in the root folder and one level below it."""
    depth_ok = (F.col("directory") == root) | (parent_dir("directory") == root)
    return inventory.filter(suspect_file("file_extension", "file_size_bytes", below_mb) & depth_ok).select(
        "volume_path", "file_size_bytes", F.round(megabytes("file_size_bytes"), 6).alias("size_mb")
    )
