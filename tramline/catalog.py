"""Named views, previews and listings for interactive use."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PREVIEW_ROWS = 10


def register(tables: Mapping[str, DataFrame]) -> None:
    """Create or replace one temporary view per DataFrame."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def drop_view(spark: SparkSession, name: str) -> bool:
    """Drop a temporary view; False when there was none."""
    return spark.catalog.dropTempView(name)


def table_names(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def describe(spark: SparkSession, name: str) -> DataFrame:
    """Column names and types of a table or view."""
    return spark.table(name).transform(column_types)


def column_types(df: DataFrame) -> DataFrame:
    """(column, type) of a DataFrame, in column order."""
    return df.sparkSession.createDataFrame(df.dtypes, "column string, type string")


def preview(df: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """Any `n` rows."""
    return df.limit(n)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))

