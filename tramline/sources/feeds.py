"""Real-time feeds: decoded messages to flat rows, and flat CSV back to tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline import schemas
from tramline.functions.clock import epoch_to_timestamp
from tramline.functions.text import blank_to_null, missing_to_null


def flatten_trip_updates(messages: DataFrame) -> DataFrame:
    """One row per stop_time_update; an update without any gives no row.

    Ids are text with '' standing for absent, so '' becomes NULL; an absent
    stop_sequence is 0, the wire default; the other fields stay optional.
    """
    updates = (
        messages.select(F.explode("entity.trip_update").alias("update"))
        .filter(F.col("update").isNotNull())
        .select("update.trip", F.explode("update.stop_time_update").alias("stop"))
    )
    return updates.select(
        blank_to_null(F.col("trip.trip_id")).alias("trip_id"),
        blank_to_null(F.col("trip.route_id")).alias("route_id"),
        F.col("trip.direction_id").alias("direction_id"),
        blank_to_null(F.col("stop.stop_id")).alias("stop_id"),
        F.coalesce("stop.stop_sequence", F.lit(0)).alias("stop_sequence"),
        F.col("stop.arrival.time").alias("arrival_time"),
        F.col("stop.departure.time").alias("departure_time"),
    )


def flatten_vehicle_positions(messages: DataFrame) -> DataFrame:
    """One row per entity that carries a vehicle."""
    vehicles = messages.select(F.explode("entity.vehicle").alias("v")).filter(
        F.col("v").isNotNull()
    )
    position = [
        F.col(f"v.position.{c}").cast("double").alias(c)
        for c in ("latitude", "longitude", "bearing", "speed")
    ]
    return vehicles.select(
        blank_to_null(F.col("v.trip.trip_id")).alias("trip_id"),
        blank_to_null(F.col("v.trip.route_id")).alias("route_id"),
        blank_to_null(F.col("v.stop_id")).alias("stop_id"),
        *position,
        F.col("v.timestamp").alias("timestamp"),
        blank_to_null(F.col("v.vehicle.id")).alias("vehicle_id"),
    )


def _instant(df: DataFrame, column: str) -> Column:
    integral = isinstance(df.schema[column].dataType, T.IntegralType)
    return epoch_to_timestamp(F.col(column), integral)


def with_update_times(updates: DataFrame) -> DataFrame:
    """Add arrival_dt and departure_dt; the numeric columns get their table types."""
    return updates.withColumns(
        {
            "stop_sequence": F.col("stop_sequence").try_cast("int"),
            "arrival_dt": _instant(updates, "arrival_time"),
            "departure_dt": _instant(updates, "departure_time"),
        }
    )


def with_vehicle_time(vehicles: DataFrame) -> DataFrame:
    """Add timestamp_dt."""
    return vehicles.withColumn("timestamp_dt", _instant(vehicles, "timestamp"))


# Columns a feed may lack: messages need not set them.
OPTIONAL_UPDATE_COLUMNS = ("route_id", "direction_id", "departure_time")
OPTIONAL_VEHICLE_COLUMNS = ("route_id", "stop_id", "bearing", "speed")


def _number(text: Column, kind: T.DataType) -> Column:
    """Whole or decimal text; whole-number columns with gaps reach CSV with a decimal part.

    That part has to be zero: what is no whole number is NULL in a column of whole numbers.
    """
    plain = text.try_cast(kind)
    if isinstance(kind, T.IntegralType):
        exact = text.try_cast("decimal(38,18)")
        return F.coalesce(plain, F.when(exact == F.floor(exact), exact.try_cast(kind)))
    return plain


def _read_flat_csv(
    spark: SparkSession, path: str, schema: T.StructType, optional: tuple[str, ...]
) -> DataFrame:
    """The columns of `schema`, taken by header name; an absent optional one is NULL."""
    raw = missing_to_null(spark.read.option("header", True).option("escape", '"').csv(path))
    absent = [f.name for f in schema if f.name not in raw.columns and f.name not in optional]
    if absent:
        raise ValueError(f"{path} lacks the columns {', '.join(absent)}")

    def column(field: T.StructField) -> Column:
        if field.name not in raw.columns:
            return F.lit(None).cast(field.dataType)
        text = F.col(field.name)
        return text if isinstance(field.dataType, T.StringType) else _number(text, field.dataType)

    return raw.select(*(column(f).alias(f.name) for f in schema))


def read_trip_updates_csv(spark: SparkSession, path: str) -> DataFrame:
    """Flattened trip updates from CSV, typed as the flattening types them."""
    flat = _read_flat_csv(spark, path, schemas.TRIP_UPDATES, OPTIONAL_UPDATE_COLUMNS)
    return with_update_times(flat)


def read_vehicle_positions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Flattened vehicle positions from CSV, typed as the flattening types them."""
    flat = _read_flat_csv(spark, path, schemas.VEHICLE_POSITIONS, OPTIONAL_VEHICLE_COLUMNS)
    return with_vehicle_time(flat)
