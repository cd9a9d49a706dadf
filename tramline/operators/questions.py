"""Questions over delay events.  `delays` is the result of an operator in `delay`.

The averages take weighted events too, which carry `times`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.clock import (
    MICROS_PER_MINUTE,
    epoch_to_timestamp,
    paris_wall_clock,
    start_of,
)
from tramline.functions.numbers import (
    combine_totals,
    delay_totals,
    mean_minutes,
    percent,
    round2,
)
from tramline.operators.delay import delay_micros
from tramline.scratch import written

STOP_COLUMNS = ["stop_id", "stop_name", "stop_lat", "stop_lon"]
ON_TIME_MINUTES = 5
# Pairs of a vehicle and an event that one task should make.
PAIRS_PER_RANGE = 500_000
LEAST_PAIRS = 10_000
# Steps in which a range is measured out.
STEPS_PER_RANGE = 50


def _totals(delays: DataFrame) -> list[Column]:
    times = F.col("times") if "times" in delays.columns else None
    return delay_totals(delay_micros(), times)


def _events(delays: DataFrame) -> Column:
    """How many events there are, with or without a delay."""
    if "times" in delays.columns:
        return F.coalesce(F.sum("times"), F.lit(0))
    return F.count(F.lit(1))


def _average() -> Column:
    return round2(mean_minutes()).alias("avg_delay_min")


def _descending(*ties: str) -> list[Column]:
    """Largest average first; ties keep a fixed order."""
    return [F.desc_nulls_last("avg_delay_min"), *(F.asc_nulls_last(c) for c in ties)]


def minute_totals(delays: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sums of the delays per UTC minute of arrival; they add up exactly in any order."""
    minute = start_of(F.unix_micros("arrival_dt_utc"), MICROS_PER_MINUTE)
    return delays.groupBy(*by, minute.alias("utc_minute")).agg(*_totals(delays))


def paris_minute_totals(totals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals per Paris minute from totals of UTC minutes."""
    return (
        totals.withColumn("minute_ts", paris_wall_clock(F.timestamp_micros("utc_minute")))
        .groupBy(*by, "minute_ts")
        .agg(*combine_totals())
    )


def averages_of_totals(totals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean delay per Paris minute from totals of UTC minutes, which may come in parts.

    Two UTC minutes are behind a repeated autumn minute.
    """
    return paris_minute_totals(totals, by).select(*by, "minute_ts", _average())


def minute_averages(delays: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean delay per Paris minute of arrival, unsorted, apart for each value of `by`.

    Paris is whole minutes from UTC, so events collapse to UTC minutes by plain
    arithmetic first, and only one row per minute goes through the time zone.
    """
    return averages_of_totals(minute_totals(delays, by), by)


def average_delay_by_minute(delays: DataFrame) -> DataFrame:
    """Mean delay per Paris minute of arrival; events without arrival form a NULL minute."""
    return minute_averages(delays).orderBy(F.asc_nulls_last("minute_ts"))


def stop_averages(delays: DataFrame, stops: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean delay per stop, unsorted; stops without events stay, with NULL.

    `by` names columns both inputs have, such as the run a row belongs to.

    Events collapse to one row per stop before they meet the stops, so a stop
    with very many events costs one partial sum per task.
    """
    keys = ["stop_id", *by]
    per_stop = delays.groupBy(*keys).agg(*_totals(delays))
    return (
        stops.select(*by, *STOP_COLUMNS)
        .join(per_stop, keys, "left")
        .groupBy(*by, *STOP_COLUMNS)
        .agg(*combine_totals())
        .select(*by, *STOP_COLUMNS, _average())
    )


def average_delay_by_stop(delays: DataFrame, stops: DataFrame) -> DataFrame:
    return stop_averages(delays, stops).orderBy(*_descending("stop_id"))


def on_day(delays: DataFrame, day: dt.date | str) -> DataFrame:
    """Events whose arrival falls on a UTC date."""
    start = F.lit(str(day)).cast("date").cast("timestamp")
    arrival = F.col("arrival_dt_utc")
    return delays.filter((arrival >= start) & (arrival < start + F.expr("interval 1 day")))


def average_delay_by_stop_on(delays: DataFrame, stops: DataFrame, day: dt.date | str) -> DataFrame:
    """Mean delay per stop over one day; every stop stays."""
    return average_delay_by_stop(on_day(delays, day), stops)


def _per_trip(delays: DataFrame) -> DataFrame:
    """Delay totals per trip, and how many events each has with or without a delay."""
    return delays.groupBy("trip_id").agg(*_totals(delays), _events(delays).alias("n_events"))


def average_delay_by_route(delays: DataFrame, trips: DataFrame) -> DataFrame:
    """Mean delay per route of the timetable's trips."""
    return (
        _per_trip(delays)
        .join(trips.select("trip_id", "route_id"), "trip_id")
        .groupBy("route_id")
        .agg(*combine_totals())
        .select("route_id", _average())
        .orderBy(*_descending("route_id"))
    )


def route_delay_with_counts(delays: DataFrame, trips: DataFrame) -> DataFrame:
    """As above with the number of events; trips without a route share a NULL row."""
    return (
        _per_trip(delays)
        .join(trips.select("trip_id", "route_id"), "trip_id", "left")
        .groupBy("route_id")
        .agg(*combine_totals(), F.sum("n_events").alias("num_events"))
        .select("route_id", _average(), "num_events")
        .orderBy(*_descending("route_id"))
    )


def punctuality_rate(delays: DataFrame) -> DataFrame:
    """Events, events at most five minutes late (early ones too), and their percentage."""
    if "times" in delays.columns:
        counted = F.sum(F.when(F.col("delay_min") <= ON_TIME_MINUTES, F.col("times")).otherwise(0))
        on_time = F.coalesce(counted, F.lit(0))
    else:
        on_time = F.count_if(F.col("delay_min") <= ON_TIME_MINUTES)
    return delays.agg(
        _events(delays).alias("total_events"), on_time.alias("on_time_events")
    ).withColumn("pct_on_time", round2(percent(F.col("on_time_events"), F.col("total_events"))))


def delay_summary(delays: DataFrame) -> DataFrame:
    """Smallest, largest and mean delay over all events."""
    return delays.agg(
        F.min("delay_min").alias("min_delay"),
        F.max("delay_min").alias("max_delay"),
        *_totals(delays),
    ).select("min_delay", "max_delay", mean_minutes().alias("avg_delay"))


def vehicles_with_time(vehicle_positions: DataFrame) -> DataFrame:
    """Vehicle rows with their epoch second as the instant `ts_utc`."""
    return vehicle_positions.select(
        "trip_id",
        "route_id",
        "latitude",
        "longitude",
        epoch_to_timestamp(F.col("timestamp")).alias("ts_utc"),
    )


def _dealt_by_time(
    vehicles: DataFrame, events: DataFrame, order: Sequence[Column], pairs_per_range: int
) -> tuple[DataFrame, int]:
    """Vehicles with the number of their range, and how many ranges there are.

    Ranges follow the order and hold about as many pairs each.  Bounds come from the
    vehicles alone: each counts by the events of its trip, in steps of a fixed share of a range.
    """
    counts = events.groupBy("trip_id").agg(F.count(F.lit(1)).alias("n_events"))
    weighted = vehicles.join(counts, "trip_id", "left").withColumn(
        "weight", F.coalesce("n_events", F.lit(1))
    )
    total = weighted.agg(F.sum("weight")).first()[0] or 0
    # Smaller ranges where cores would be idle; a single partition would not be kept as dealt.
    idle = min(vehicles.sparkSession.sparkContext.defaultParallelism, total // LEAST_PAIRS)
    ranges = max(2, idle, -(-total // pairs_per_range))
    step = max(1, total // (ranges * STEPS_PER_RANGE))
    steps = F.call_function("div", F.col("weight") + (step - 1), F.lit(step))
    dealt = (
        weighted.withColumn("step", F.explode(F.sequence(F.lit(1).cast("long"), steps)))
        .repartitionByRange(ranges, *order)
        .withColumn("range", F.spark_partition_id())
        .filter("step = 1")
    )
    # Both sides of the pairs take the range from here, so it is drawn once.
    return written(dealt.select(*vehicles.columns, "range"), "vehicle-ranges"), ranges


def position_bus_vehicles(
    vehicle_positions: DataFrame, delays: DataFrame, pairs_per_range: int = PAIRS_PER_RANGE
) -> DataFrame:
    """Each vehicle position with each delay of its trip, latest first.

    The result is vehicles times stop events per trip, so it is neither shuffled nor
    sampled: vehicles are dealt to ranges of time that hold about as many pairs each, the events
    of a trip go to every range that has a vehicle of it, and the pairs are made once and
    sorted where they are.  A hot trip is spread over as many ranges as its pairs need.  Sorting on
    all columns keeps positions of one second apart.
    """
    places = [F.asc_nulls_first(c) for c in ("trip_id", "route_id", "latitude", "longitude")]
    order = [F.desc_nulls_last("ts_utc"), *places]
    events = delays.filter(F.col("trip_id").isNotNull()).select("trip_id", "delay_min")
    dealt, ranges = _dealt_by_time(
        vehicles_with_time(vehicle_positions), events, order, pairs_per_range
    )
    needed = dealt.filter(F.col("trip_id").isNotNull()).select("range", "trip_id").distinct()
    # The number of the partition is the range, so partitions follow the order.
    vehicles = dealt.repartitionById(ranges, "range")
    sent = needed.join(events, "trip_id").repartitionById(ranges, "range")
    return (
        vehicles.join(sent, ["range", "trip_id"], "left")
        .sortWithinPartitions(*order, "delay_min")
        .select(
            "trip_id",
            "route_id",
            "latitude",
            "longitude",
            paris_wall_clock(F.col("ts_utc")).alias("timestamp_paris"),
            round2(F.col("delay_min")).alias("delay_min"),
        )
    )


def vehicle_route_delay(
    vehicle_positions: DataFrame, delays: DataFrame, top: int = 20
) -> DataFrame:
    """Mean delay and row count of the vehicle-event pairs per vehicle route, largest first.

    The pairs are never built: vehicles are counted per (trip, route), delays
    summed per trip, and each trip's sums taken as often as it has vehicles.
    A trip without delays counts once per vehicle.
    """
    vehicles = (
        vehicle_positions.filter(F.col("timestamp").isNotNull())
        .groupBy("trip_id", "route_id")
        .agg(F.count(F.lit(1)).alias("n_vehicles"))
    )
    pairs = F.col("n_vehicles") * F.coalesce("n_events", F.lit(1))
    return (
        vehicles.join(_per_trip(delays), "trip_id", "left")
        .groupBy("route_id")
        .agg(*combine_totals(F.col("n_vehicles")), F.sum(pairs).alias("num_events"))
        .select("route_id", _average(), "num_events")
        .orderBy(*_descending("route_id"))
        .limit(top)
    )
