"""CSV exports, warehouse tables and stamped snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.sinks import versions

FILES_PER_RUN = 4
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _csv_writer(df: DataFrame):
    return (
        df.write.option("header", True)
        .option("escape", '"')
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
    )


def export_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """Result to CSV with a header.  `one_file` is for bounded results such as a single rate."""
    _csv_writer(df.coalesce(1) if one_file else df).mode("overwrite").csv(path)


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An export read back with the types it was written from."""
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .schema(schema)
        .csv(path)
    )


def replace_table(df: DataFrame, warehouse: str, name: str) -> DataFrame:
    """Replace warehouse table `name` and return it as read back.

    The table changes at once when its new files are whole.  Those who opened it before
    keep reading the files they opened.
    """
    spark = df.sparkSession
    write = versions.new_write(spark, warehouse, name)
    path = f"{warehouse}/{name}/{versions.WRITE}{write}"
    df.write.parquet(path)
    versions.commit(spark, warehouse, name, write, df.columns)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """The newest whole write of a warehouse table, found once."""
    return spark.read.parquet(versions.newest(spark, warehouse, name))


def snapshot_folder(export_dir: str, name: str) -> str:
    return f"{export_dir}/{name}"


def snapshot_glob(export_dir: str, name: str, stamps: str = "*") -> str:
    """Glob over the snapshots of one question; `stamps` may hold a character class.

    A snapshot has a folder per write; `read_snapshots` takes the newest whole one.
    """
    return f"{snapshot_folder(export_dir, name)}/stamp={stamps}"


def write_snapshot(df: DataFrame, export_dir: str, name: str, stamp: str) -> str:
    """Add one run, labelled YYYYMMDD_HHMMSS, in the order of `df`, and return its folder.

    A repeat takes its place for readers to come; those of the earlier write go on.
    """
    spark = df.sparkSession
    write = versions.new_write(spark, export_dir, name)
    path = f"{snapshot_glob(export_dir, name, stamp)}/{versions.WRITE}{write}"
    _csv_writer(df).csv(path)
    versions.commit(spark, export_dir, name, write, df.columns)
    return path


def write_snapshots(df: DataFrame, export_dir: str, name: str) -> None:
    """Add all runs in column `stamp` in one job; runs written again replace themselves.

    Rows are dealt by stamp and a salt of `FILES_PER_RUN` values, which bounds the files of a run.
    """
    spark = df.sparkSession
    write = versions.new_write(spark, export_dir, name)
    column = versions.WRITE.removesuffix("=")
    dealt = df.repartition("stamp", F.pmod(F.xxhash64(*df.columns), F.lit(FILES_PER_RUN)))
    (
        _csv_writer(dealt.withColumn(column, F.lit(write)))
        .mode("append")
        .partitionBy("stamp", column)
        .csv(snapshot_folder(export_dir, name))
    )
    versions.commit(spark, export_dir, name, write, [c for c in df.columns if c != "stamp"])
