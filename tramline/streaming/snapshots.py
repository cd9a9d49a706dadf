"""Snapshot history as a stream: each new file adds its rows once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tramline.sources.snapshots import read_snapshots

# What the stream carries of a file; contents are not read for it.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


@dataclass(frozen=True)
class SnapshotStream:
    """New snapshot files, as a stream of their paths, and how to read them."""

    paths: DataFrame
    schema: T.StructType
    headers: str | None = None


def stream_snapshots(
    spark: SparkSession,
    pattern: str,
    schema: T.StructType,
    files_per_batch: int = 1000,
    headers: str | None = None,
) -> SnapshotStream:
    """Snapshot files as they come, at most `files_per_batch` at once.

    A stream has one schema, but headers drift; so the stream is one of files, and each batch
    reads its own as `read_snapshots` does, by the column lists of their writes.  `headers`
    remembers those of files from elsewhere.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(pattern)
    )
    return SnapshotStream(files.select("path"), schema, headers)


def append_history(stream: SnapshotStream, table_path: str, checkpoint: str) -> StreamingQuery:
    """Append what is there now to a parquet table partitioned by batch and day, then stop.

    A batch that is run again after a failure replaces its own folder.  A stream cannot take rows
    back: a run that is written again adds its rows again.
    """

    def add(batch: DataFrame, number: int) -> None:
        # At most `files_per_batch` paths.
        paths = [row.path for row in batch.select("path").collect()]
        if not paths:
            return
        rows = read_snapshots(
            batch.sparkSession, paths, stream.schema, headers=stream.headers
        ).withColumn("snapshot_day", F.to_date("snapshot_ts_temps"))
        folder = f"{table_path}/batch={number}"
        rows.write.mode("overwrite").partitionBy("snapshot_day").parquet(folder)

    return (
        stream.paths.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def streamed_history(spark: SparkSession, table_path: str) -> DataFrame:
    """All rows so far; a column that some batches lack is NULL there."""
    table = spark.read.option("mergeSchema", True).parquet(table_path)
    return table.drop("batch", "snapshot_day")
