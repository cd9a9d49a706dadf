"""Top-k reports.  Ties are broken by the event key so that a report repeats."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.operators.questions import on_day, stop_averages, vehicles_with_time


def _event_ties():
    return [F.asc_nulls_last(c) for c in ("trip_id", "stop_sequence", "stop_id")]


def worst_events(delays: DataFrame, day: dt.date | str, top: int = 50) -> DataFrame:
    """Events of one day with the largest delay."""
    return (
        on_day(delays, day)
        .orderBy(F.desc_nulls_last("delay_min"), *_event_ties())
        .limit(top)
        .select("stop_id", "arrival_dt_utc", "scheduled_ts_utc", "delay_min")
    )


def longest_delay_intervals(intervals: DataFrame, day: dt.date | str, top: int = 10) -> DataFrame:
    """Events of one day with the longest delay interval."""
    return (
        on_day(intervals, day)
        .orderBy(F.desc_nulls_last("delay_duration"), *_event_ties())
        .limit(top)
    )


def latest_events(delays: DataFrame, top: int = 100) -> DataFrame:
    """Events with the latest arrival."""
    return delays.orderBy(F.desc_nulls_last("arrival_dt_utc"), *_event_ties()).limit(top)


def latest_vehicles(vehicle_positions: DataFrame, top: int = 5) -> DataFrame:
    """Vehicle positions with the latest time."""
    return (
        vehicles_with_time(vehicle_positions)
        .orderBy(F.desc_nulls_last("ts_utc"), "trip_id", "route_id", "latitude", "longitude")
        .limit(top)
    )


def latest_vehicle_delays(
    vehicle_positions: DataFrame, delays: DataFrame, top: int = 10
) -> DataFrame:
    """Vehicle positions with a delay of their trip, latest first.

    A left join keeps every vehicle, so the `top` latest pairs can only come
    from the `top` latest vehicles: those alone are joined.
    """
    latest = latest_vehicles(vehicle_positions, top)
    order = [F.desc_nulls_last("ts_utc"), "trip_id", "route_id", "latitude", "longitude"]
    return (
        latest.join(delays.select("trip_id", "delay_min"), "trip_id", "left")
        .orderBy(*order, F.asc_nulls_last("delay_min"))
        .limit(top)
    )


def worst_stops(delays: DataFrame, stops: DataFrame, top: int = 10) -> DataFrame:
    """Stops with the largest mean delay."""
    return (
        stop_averages(delays, stops)
        .orderBy(F.desc_nulls_last("avg_delay_min"), F.asc_nulls_last("stop_id"))
        .limit(top)
    )
