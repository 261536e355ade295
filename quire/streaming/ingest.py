"""Resumable file ingestion: a rerun handles only files that are new."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quire.sources.files import as_document_store

BINARY_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def stream_files(
    spark: SparkSession, root: str, glob: str = "*.{pdf,PDF}", files_per_batch: int = 10_000
) -> DataFrame:
    """Document store rows of the files that appear below ``root``."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(root)
    )
    return as_document_store(files, "path", "length", "modificationTime", "content")


def ingest(files: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the new files' rows to a parquet table and stop."""
    return (
        files.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
