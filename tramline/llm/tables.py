"""Reading the shared tables and keeping intermediate ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.scratch import new_folder


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables, by name."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """`frame` written once to the shared scratch folder and read back.

    Cuts the lineage: what reads the result again, or reruns after a lost executor,
    starts from these files.
    """
    spark = frame.sparkSession
    path = new_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def packed(rows: DataFrame, **keys: Column) -> DataFrame:
    """Given rows as one column `row`, beside keys whose names then clash with none of theirs."""
    return rows.select(F.struct("*").alias("row"), *(c.alias(name) for name, c in keys.items()))


def field(name: str) -> Column:
    """A column of a packed row."""
    return F.col(f"row.`{name}`")


def unpacked(frame: DataFrame, rows: DataFrame, **changed: Column) -> DataFrame:
    """The columns of `rows`, some of them changed, out of packed rows."""
    return frame.select(*(changed.get(c, field(c)).alias(c) for c in rows.columns))


def join_same(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    """Join on columns of one name, where null equals null; the left ones stay."""
    condition = F.lit(True)
    for name in names:
        right = right.withColumnRenamed(name, f"same__{name}")
        condition = condition & F.col(name).eqNullSafe(F.col(f"same__{name}"))
    return left.join(right, condition, how).drop(*(f"same__{name}" for name in names))
