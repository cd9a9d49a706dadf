"""Delay per stop event, by trip start or by service day.

Both operators take
  trips_updates: trip_id, stop_sequence, arrival_dt
  stop_times:    trip_id, stop_sequence, stop_id, arrival_time_sec
and return
  trip_id, stop_sequence, stop_id, arrival_dt_utc, scheduled_ts_utc, delay_min

Weighted events carry a column `times` as well: a row stands for that many equal ones.
The averages in `questions` take either form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.clock import (
    MICROS_PER_MINUTE,
    MICROS_PER_SECOND,
    micros_between,
    paris_to_instant,
    paris_wall_clock,
    plus_seconds,
)

EVENT_KEY = ["trip_id", "stop_sequence"]
# Rows one step of `expanded` makes of one row.
REPEATS = 1024


def delay_micros() -> Column:
    """Exact delay of an event in microseconds, NULL without an arrival."""
    return micros_between(F.col("arrival_dt_utc"), F.col("scheduled_ts_utc"))


def observed_first_stops(trips_updates: DataFrame) -> DataFrame:
    """Lowest stop_sequence the feed still shows for each trip."""
    return trips_updates.groupBy("trip_id").agg(F.min("stop_sequence").alias("first_seq"))


def _observed(trips_updates: DataFrame) -> DataFrame:
    return trips_updates.select(*EVENT_KEY, F.col("arrival_dt").alias("arrival_dt_utc"))


def _scheduled(observed: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Observed rows with the timetable row of the same trip and stop_sequence."""
    planned = stop_times.filter(F.col("arrival_time_sec").isNotNull())
    return observed.join(planned.select(*EVENT_KEY, "stop_id", "arrival_time_sec"), EVENT_KEY)


def expanded(events: DataFrame) -> DataFrame:
    """Weighted events as one row each.

    Rows are made in two steps, so no list gets as long as the repeats.
    """
    times = F.col("times")
    last = F.call_function("div", times - 1, F.lit(REPEATS))
    left = F.least(F.lit(REPEATS).cast("long"), times - F.col("step") * REPEATS)
    return (
        events.filter("times > 0")
        .withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .withColumn("repeat", F.explode(F.sequence(F.lit(1).cast("long"), left)))
        .drop("step", "repeat", "times")
    )


def trip_relative_delays(trips_updates: DataFrame, stop_times: DataFrame) -> DataFrame:
    """The events of `weighted_trip_delays`, one row each."""
    return expanded(weighted_trip_delays(trips_updates, stop_times))


def weighted_trip_delays(trips_updates: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Delay against the timetable shifted to the trip's first observed arrival.

    A trip whose first observed stop lacks an arrival or a timetable row is left
    out whole; a later stop without an arrival stays, with NULL delay.
    Duplicate rows are not removed.  Where a first stop repeats, each event of the trip occurs
    as often: it stays one row per distinct origin, with the count in `times`.

    Events are joined on (trip_id, stop_sequence), which spreads a long trip over
    many tasks.  Only the origin, the instant in microseconds of the trip's
    timetable second zero, is joined on trip_id alone, and adaptive execution
    splits a hot trip there.  A window over the trip would shuffle less but put
    all its events in one task.

    The origins come from the same joined rows, grouped as they lie.  They are grouped by
    stop too, so both branches need the same columns of feed and timetable, and each is
    shuffled once.  Equal origins are one row with a count, which the join carries: no
    row grows with how often a first stop repeats.
    """
    known = _observed(trips_updates).filter(
        F.col("trip_id").isNotNull() & F.col("stop_sequence").isNotNull()
    )
    scheduled = _scheduled(known, stop_times)
    first = observed_first_stops(known).withColumnRenamed("first_seq", "stop_sequence")
    origin = F.unix_micros("arrival_dt_utc") - F.col("arrival_time_sec") * MICROS_PER_SECOND
    origins = (
        scheduled.join(first, EVENT_KEY)
        .withColumn("origin_us", origin)
        .groupBy(*EVENT_KEY, "stop_id", "origin_us")
        .agg(F.count("origin_us").alias("times"))
        # Unlike a filter on the origin, this one is not pushed into one branch.
        .filter("times > 0")
        .select("trip_id", "origin_us", "times")
    )
    scheduled_us = F.col("origin_us") + F.col("arrival_time_sec") * MICROS_PER_SECOND
    return (
        scheduled.join(origins, "trip_id")
        .withColumn("scheduled_ts_utc", F.timestamp_micros(scheduled_us))
        .select(
            *EVENT_KEY,
            "stop_id",
            "arrival_dt_utc",
            "scheduled_ts_utc",
            (delay_micros() / float(MICROS_PER_MINUTE)).alias("delay_min"),
            "times",
        )
    )


def service_day_events(trips_updates: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Observed events placed on the Paris calendar day of their arrival."""
    observed = _observed(trips_updates).filter(F.col("arrival_dt_utc").isNotNull())
    day = F.to_date(paris_wall_clock(F.col("arrival_dt_utc")))
    start_of_day = F.col("local_service_day").cast("timestamp_ntz")
    return (
        _scheduled(observed, stop_times)
        .withColumn("local_service_day", day)
        .withColumn(
            "scheduled_ts_utc",
            paris_to_instant(plus_seconds(start_of_day, F.col("arrival_time_sec"))),
        )
    )


def service_day_delays(trips_updates: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Superseded method: timetable seconds counted from midnight of the arrival's day.

    After-midnight stops come out about a day early or late; kept for comparison.
    """
    return service_day_events(trips_updates, stop_times).select(
        *EVENT_KEY,
        "stop_id",
        "arrival_dt_utc",
        "scheduled_ts_utc",
        (delay_micros() / float(MICROS_PER_MINUTE)).alias("delay_min"),
    )


def delay_intervals(trips_updates: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Service-day events with the delay kept as an interval."""
    return service_day_events(trips_updates, stop_times).select(
        *EVENT_KEY,
        "stop_id",
        "arrival_dt_utc",
        "local_service_day",
        "arrival_time_sec",
        "scheduled_ts_utc",
        (F.col("arrival_dt_utc") - F.col("scheduled_ts_utc")).alias("delay_duration"),
    )
