"""History of exported CSV snapshots, read as one relation."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions.text import snapshot_time
from tramline.sinks import versions

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
KEYS_SCHEMA = "file_key string, columns array<string>"


def _reader(spark: SparkSession):
    return spark.read.option("header", True).option("escape", '"')


def _file_key(path: Column) -> Column:
    """What the column list of a file is filed under: its write, or the file itself."""
    write = F.regexp_extract(path, f"/({versions.WRITE}[^/]+)/", 1)
    return F.when(write != "", write).otherwise(path)


def file_headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file_key, header) of files that no mark describes, from a pass over their first lines.

    Files of some storages can only be opened through Spark's text reader, which has no
    way to stop after a line, so this reads what it is given.  `remember_headers` keeps the result.
    """
    lines = spark.read.text(list(paths)).select(
        "value",
        F.col("_metadata.file_path").alias("file_key"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
    )
    return (
        lines.filter("block = 0")
        .groupBy("file_key")
        .agg(F.min_by("value", "position").alias("header"))
    )


def _columns_of(headers: DataFrame) -> DataFrame:
    """(file_key, columns) from header lines; only distinct headers reach the driver."""
    spark = headers.sparkSession
    distinct = [row.header for row in headers.select("header").distinct().collect()]
    parsed = [(line, next(csv.reader([line]))) for line in distinct]
    known = spark.createDataFrame(parsed, "header string, columns array<string>")
    return headers.join(known, "header").select("file_key", "columns")


def remember_headers(spark: SparkSession, patterns: str | Sequence[str], folder: str) -> None:
    """Add the column lists of files from elsewhere to the table in `folder`.

    `read_snapshots(..., headers=folder)` then reads such files once, for their rows.
    """
    patterns = [patterns] if isinstance(patterns, str) else list(patterns)
    paths = [p for g in patterns for p in versions.newest_of_each(spark, g)]
    if paths:
        found = _columns_of(file_headers(spark, paths))
        found.dropDuplicates(["file_key"]).write.mode("append").parquet(folder)


def _listed(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file_key) of the files themselves, none of which is opened."""
    files = spark.read.format("binaryFile").load(list(paths))
    return files.select(F.col("_metadata.file_path").alias("file_key"))


def _manifest(spark: SparkSession, paths: Sequence[str], headers: str | None) -> DataFrame:
    """(file_key, columns) of all files below the paths: marks first, then remembered lists.

    What neither knows is read for its first lines.
    """
    of_writes = {p.rsplit("/stamp=", 1)[0] for p in paths if f"/{versions.WRITE}" in p}
    foreign = [p for p in paths if f"/{versions.WRITE}" not in p]
    parts = []
    if of_writes:
        used = sorted({p.rsplit(f"/{versions.WRITE}", 1)[1].split("/")[0] for p in paths if p not in foreign})
        writes = spark.createDataFrame([(versions.WRITE + w,) for w in used], "file_key string")
        parts += [
            versions.column_lists(spark, folder).join(writes, "file_key", "left_semi")
            for folder in sorted(of_writes)
        ]
    if foreign and headers is not None:
        kept = spark.read.schema(KEYS_SCHEMA).parquet(headers).dropDuplicates(["file_key"])
        parts.append(kept)
        if _listed(spark, foreign).join(kept, "file_key", "left_anti").isEmpty():
            foreign = []
    if foreign:
        found = _columns_of(file_headers(spark, foreign))
        if headers is not None:
            found = found.join(kept, "file_key", "left_anti")
        parts.append(found)
    manifest = parts[0]
    for part in parts[1:]:
        manifest = manifest.unionByName(part)
    return manifest


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT)).cast(kind)
    return text.try_cast(kind)


def _by_name(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, headers: str | None
) -> DataFrame:
    """One scan of all files as text by position, joined with the column lists by file."""
    manifest = _manifest(spark, paths, headers)
    # The names that occur, and how many columns a file has, are few.
    names = manifest.agg(
        F.max(F.size("columns")).alias("widest"),
        F.array_distinct(F.flatten(F.collect_set("columns"))).alias("names"),
    ).first()
    places = [f"c{n}" for n in range(names.widest or 1)]
    text = T.StructType([T.StructField(p, T.StringType()) for p in places])
    scan = _reader(spark).schema(text).csv(list(paths)).withColumn(
        "filename", F.col("_metadata.file_path")
    )
    known = scan.withColumn("file_key", _file_key(F.col("filename"))).join(manifest, "file_key")

    def column(name: str) -> Column:
        place = F.array_position("columns", name).cast("int")
        return F.when(place > 0, F.get(F.array(*places), place - 1))

    declared = {f.name: f.dataType for f in schema}
    extra = sorted(set(names.names or ()) - set(declared))
    return known.select(
        *(_typed(column(n), kind).alias(n) for n, kind in declared.items()),
        *(column(n).alias(n) for n in extra),
        "filename",
    )


def read_snapshots(
    spark: SparkSession,
    patterns: str | Sequence[str],
    schema: T.StructType,
    same_header: bool = False,
    headers: str | None = None,
) -> DataFrame:
    """All snapshot files the globs match, plus `filename` and `snapshot_ts_temps`.

    Headers may drift between files: every file's columns are found by name in the column
    list of its write, with NULL for what it lacks, in one scan of the text.  Files
    from elsewhere have no such list; theirs are read from their first lines, or from `headers`, a table
    that `remember_headers` fills.  Columns outside `schema` are kept as text; a file two globs
    match counts once; of a run written twice the newest write counts.  `same_header=True`
    goes without column lists and fails on a file that differs.  No match gives an empty relation.
    """
    patterns = [patterns] if isinstance(patterns, str) else list(patterns)
    paths = list(dict.fromkeys(p for g in patterns for p in versions.newest_of_each(spark, g)))
    if not paths:
        found = spark.createDataFrame([], schema).withColumn("filename", F.lit(""))
    elif same_header:
        uniform = _reader(spark).option("enforceSchema", False)
        typed = uniform.option("timestampNTZFormat", TIMESTAMP_FORMAT).schema(schema).csv(paths)
        found = typed.withColumn("filename", F.col("_metadata.file_path"))
    else:
        found = _by_name(spark, paths, schema, headers)
    return found.withColumn("snapshot_ts_temps", snapshot_time(F.col("filename")))
