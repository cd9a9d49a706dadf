"""Files through the Hadoop file system, so any storage Spark reads will do."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Files or folders a Hadoop glob names, in name order; empty when none."""
    system, path = _open(spark, pattern)
    return sorted(status.getPath().toString() for status in system.globStatus(path) or [])


def folder_version(spark: SparkSession, folder: str) -> int:
    """Number that changes with the names, sizes and times of what lies in a folder."""
    system, path = _open(spark, f"{folder}/*")
    return hash(
        tuple(
            (s.getPath().toString(), s.getLen(), s.getModificationTime())
            for s in system.globStatus(path) or []
        )
    )


def put_file(spark: SparkSession, name: str, text: str) -> None:
    """A new small file that is there whole or not at all."""
    system, path = _open(spark, name)
    draft = spark._jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{uuid.uuid4().hex}")
    stream = system.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not system.rename(draft, path):
        raise FileExistsError(name)


def read_file(spark: SparkSession, name: str) -> str:
    """Text of a small file."""
    system, path = _open(spark, name)
    stream = system.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def delete(spark: SparkSession, name: str) -> None:
    """Remove a file or folder; nothing happens if there is none."""
    system, path = _open(spark, name)
    system.delete(path, True)
