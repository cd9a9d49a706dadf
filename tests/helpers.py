"""Small literal inputs and a brute-force delay for comparison."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

from pyspark.sql import functions as F

DAY = dt.datetime(2025, 9, 12)


def at(hour: int, minute: int = 0, second: int = 0) -> dt.datetime:
    return DAY.replace(hour=hour, minute=minute, second=second)


def feed(spark, rows):
    """(trip_id, stop_sequence, arrival or None) in UTC."""
    raw = spark.createDataFrame(rows, "trip_id string, stop_sequence int, arrival timestamp_ntz")
    return raw.withColumn("arrival_dt", F.col("arrival").cast("timestamp")).drop("arrival")


def plan(spark, rows):
    """(trip_id, stop_sequence, stop_id, arrival_time_sec or None)."""
    return spark.createDataFrame(
        rows, "trip_id string, stop_sequence int, stop_id string, arrival_time_sec bigint"
    )


def delay_events(spark, rows):
    """(trip_id, stop_sequence, stop_id, arrival or None, delay in seconds)."""
    raw = spark.createDataFrame(
        rows,
        "trip_id string, stop_sequence int, stop_id string, arrival timestamp_ntz, late bigint",
    )
    arrival = F.col("arrival").cast("timestamp")
    return raw.select(
        "trip_id",
        "stop_sequence",
        "stop_id",
        arrival.alias("arrival_dt_utc"),
        F.timestamp_micros(F.unix_micros(arrival) - F.col("late") * 1000000).alias(
            "scheduled_ts_utc"
        ),
        (F.when(arrival.isNotNull(), F.col("late")) / 60.0).alias("delay_min"),
    )


def brute_force(feed_rows, plan_rows):
    """(trip, sequence, stop, delay in minutes) of every event, by nested loops."""
    stops = defaultdict(list)
    for trip, sequence, stop, second in plan_rows:
        if None not in (trip, sequence, second):
            stops[trip, sequence].append((stop, second))
    first = {}
    for trip, sequence, _ in feed_rows:
        if trip is not None and sequence is not None:
            first[trip] = min(sequence, first.get(trip, sequence))
    origins = defaultdict(list)
    for trip, sequence, arrival in feed_rows:
        if arrival is not None and first.get(trip) == sequence:
            for _, second in stops[trip, sequence]:
                origins[trip].append(arrival - dt.timedelta(seconds=second))
    events = []
    for trip, sequence, arrival in feed_rows:
        for stop, second in stops[trip, sequence]:
            for origin in origins[trip]:
                late = None
                if arrival is not None:
                    late = (arrival - origin - dt.timedelta(seconds=second)).total_seconds() / 60
                events.append((trip, sequence, stop, late))
    return sorted(events, key=str)


def as_events(delays):
    return sorted(
        map(tuple, delays.select("trip_id", "stop_sequence", "stop_id", "delay_min").collect()),
        key=str,
    )
