"""Static timetable: one delimited text table per *.txt file."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline import schemas
from tramline.functions.clock import hhmmss_to_seconds
from tramline.functions.text import missing_to_null
from tramline.sources.files import matching_paths

SUFFIX = ".txt"

# Tables the typed load reads with declared types; stop_times stays text.
TYPED_TABLES: dict[str, T.StructType] = {
    "stops": schemas.STOPS,
    "routes": schemas.ROUTES,
    "trips": schemas.TRIPS,
}


def read_text_table(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """One table, every column text, missing marks as NULL.

    Timetable fields may not hold line breaks, so a large file is split over
    tasks.  `multiline` reads quoted line breaks too, at one task per file.
    """
    raw = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )
    return missing_to_null(raw)


def with_stop_seconds(stop_times: DataFrame) -> DataFrame:
    """Add arrival_time_sec and departure_time_sec and make stop_sequence a number."""
    return stop_times.withColumns(
        {
            "stop_sequence": F.col("stop_sequence").try_cast("int"),
            "arrival_time_sec": hhmmss_to_seconds(F.col("arrival_time")),
            "departure_time_sec": hhmmss_to_seconds(F.col("departure_time")),
        }
    )


def typed(table: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns `schema` names and carry the others; malformed values give NULL."""
    return table.withColumns(
        {f.name: F.col(f.name).try_cast(f.dataType) for f in schema if f.name in table.columns}
    )


def finished(
    table: DataFrame, name: str, types: Mapping[str, T.StructType] | None = None
) -> DataFrame:
    """A text table as loads give it: declared types, seconds beside stop times."""
    if types and name in types:
        table = typed(table, types[name])
    return with_stop_seconds(table) if name == "stop_times" else table


def load_timetable(
    spark: SparkSession,
    folder: str,
    types: Mapping[str, T.StructType] | None = None,
    multiline: bool = False,
) -> dict[str, DataFrame]:
    """Every `*.txt` table of a folder, keyed by file name.

    Without `types` all columns are text.  `TYPED_TABLES` gives the typed load.
    `multiline` takes line breaks inside quoted fields.
    """
    tables: dict[str, DataFrame] = {}
    for path in matching_paths(spark, f"{folder}/*{SUFFIX}"):
        name = path.rsplit("/", 1)[-1].removesuffix(SUFFIX)
        tables[name] = finished(read_text_table(spark, path, multiline), name, types)
    return tables
