"""Timetable exports: trips with route names, stops with a geometry, missing values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions.text import wkt_point

ROUTE_NAMES = ("route_short_name", "route_long_name")


def trips_plus_routes(
    trips: DataFrame, routes: DataFrame, columns: tuple[str, ...] = ROUTE_NAMES
) -> DataFrame:
    """Every trip with the chosen columns of its route.

    A missing route_id meets a missing route_id, as in a merge of data frames.
    """
    names = routes.select(F.col("route_id").alias("_route_id"), *columns)
    return trips.join(names, trips.route_id.eqNullSafe(names["_route_id"]), "left").drop("_route_id")


def stops_with_geometry(stops: DataFrame) -> DataFrame:
    """Stops with their position as point text."""
    return stops.withColumn("geometry", wkt_point(F.col("stop_lon"), F.col("stop_lat")))


def null_profile(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column, in one pass; NaN counts as missing."""

    def missing(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        fractional = isinstance(field.dataType, T.FractionalType) and not isinstance(
            field.dataType, T.DecimalType
        )
        return value.isNull() | F.isnan(value) if fractional else value.isNull()

    # An aggregate over no rows still gives a row, so the counts are never NULL.
    counts = df.agg(*(F.count_if(missing(f)).alias(f.name) for f in df.schema))
    return counts.unpivot([], df.columns, "column", "nulls")
