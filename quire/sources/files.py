"""File scans: binary bodies, inventories with bodies, volume listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.contracts import DOCUMENT_STORE
from quire.functions.text import base_name, extension, parent_dir
from quire.scratch import materialise

DOCUMENT_EXTENSIONS = (".pdf", ".doc", ".docx")


def scan_binary(
    spark: SparkSession, root: str, glob: str = "*.{pdf,PDF}", recursive: bool = True
) -> DataFrame:
    """path, modificationTime, length and content of every matching file."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .option("pathGlobFilter", glob)
        .load(root)
    )


def _as_given(spark: SparkSession, root: str, path: str = "path") -> Column:
    """Paths below ``root`` in the form in which ``root`` was given."""
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    full = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString().rstrip("/")
    return F.concat(F.lit(root.rstrip("/")), F.substring(F.col(path), len(full) + 1, 2**31 - 1)).alias("path")


def list_volume(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root``: path, size, modified.

    Spark's own listing, in parallel over folders; bodies are not read. Files
    without bytes, and names that begin with a dot or an underscore, are left
    out by Spark's readers.
    """
    found = scan_binary(spark, root, "*")
    return found.select(
        _as_given(spark, root), F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )


def describe_volume(spark: SparkSession, root: str) -> DataFrame:
    """One row per extension below ``root``: files, folders that hold them, bytes in all, of the smallest and the largest."""
    return (
        list_volume(spark, root)
        .groupBy(extension("path").alias("extension"))
        .agg(
            F.count("path").alias("n_files"),
            F.count_distinct(parent_dir("path")).alias("n_folders"),
            F.sum("size").alias("n_bytes"),
            F.min("size").alias("smallest"),
            F.max("size").alias("largest"),
        )
    )


def inventory(
    spark: SparkSession,
    root: str,
    extensions: tuple[str, ...] = DOCUMENT_EXTENSIONS,
    listed: DataFrame | None = None,
) -> DataFrame:
    """Document store of the matching files, bodies included.

    Spark's binary file reader reads each body once, in the task that owns the
    file; bodies are written to the scratch folder and never shuffled. A listed
    file without a body in there could not be read: it keeps its metadata, with
    a NULL body. ``listed`` is an earlier result of ``list_volume``, if at hand.
    """
    listed = (list_volume(spark, root) if listed is None else listed).filter(extension("path").isin(*extensions))
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    bodies = reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").load(root)
    read = materialise(
        bodies.filter(extension("path").isin(*extensions)).select(
            _as_given(spark, root), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), "content"
        ),
        "bodies",
    )
    lost = listed.join(read.select("path"), "path", "left_anti").withColumn("content", F.lit(None).cast("binary"))
    return as_document_store(read.unionByName(lost), "path", "size", "modified", "content")


def as_document_store(
    files: DataFrame, path: str, size: str, modified: str, content: str
) -> DataFrame:
    """Document store columns from a path, a size, a time and a body."""
    return files.select(
        base_name(path).alias("file_name"),
        F.col(path).alias("volume_path"),
        extension(path).alias("file_extension"),
        F.col(size).cast("long").alias("file_size_bytes"),
        F.col(modified).alias("modification_time"),
        parent_dir(path).alias("directory"),
        F.col(content).alias("binary_content"),
    ).select(*DOCUMENT_STORE.fieldNames())


def list_documents(spark: SparkSession, root: str, extensions=(".pdf",)) -> DataFrame:
    """Metadata-only listing of the matching files below ``root``."""
    return list_volume(spark, root).filter(extension("path").isin(*extensions))
