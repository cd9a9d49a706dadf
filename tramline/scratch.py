"""Shared scratch folder for tables a query has to write and read back."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"

# Own folder of each local application that names none.
_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder named by the cluster; a local session without one gets its own."""
    root = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if root:
        return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError(f"{SETTING} must name a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="tramline-")
    return _LOCAL_ROOTS[application]


def new_folder(spark: SparkSession, label: str) -> str:
    """Fresh folder path below the shared root, removed when the driver ends."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def written(frame: DataFrame, label: str) -> DataFrame:
    """`frame` written once below the shared root and read back."""
    spark = frame.sparkSession
    path = new_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
