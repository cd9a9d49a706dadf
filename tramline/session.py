"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The time model: every instant is a TIMESTAMP read in UTC, and Paris wall-clock
# values are TIMESTAMP_NTZ.  Casts between the two are only neutral in UTC.
TIME_ZONE = "UTC"

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": TIME_ZONE,
    # Runtime re-planning: partition counts from real sizes, hot join partitions split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Compressed bytes a task takes of a shuffle or a file: its rows are about ten times that in a
    # sort or a hash table, and a stage holds several of them, so larger ones spill.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "64m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot trip even when that costs one more exchange after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Files of as many folders at once, before a task that writes them has to sort its rows.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # Hash instead of sort where every shuffled partition of a side is measured to be small; a
    # hash table cannot spill, so the bound leaves room for one per core in a small executor.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16m",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings on a session somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "tramline", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session; on a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())
