"""Questions over the history of exported snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.clock import (
    MICROS_PER_HOUR,
    MICROS_PER_MINUTE,
    MICROS_PER_SECOND,
    as_instant,
    paris_wall_clock,
    start_of,
)
from tramline.functions.numbers import round2

# The stops watched by default.
WATCHED_STOPS = ("21265", "8064", "8077", "1183", "619")

EVOLUTION_COLUMNS = ["stop_name", "stop_lat", "stop_lon", "snapshot_ts_temps", "avg_delay_min"]


def past_minutes(minutes: DataFrame, as_of: dt.datetime | str | Column | None = None) -> DataFrame:
    """Minutes up to `as_of` (default now); feeds also hold predicted arrivals."""
    return minutes.filter(F.col("minute_ts") <= paris_wall_clock(as_instant(as_of)))


def weighted_minutes(minutes: DataFrame, totals: DataFrame) -> DataFrame:
    """History of minute averages, with the totals behind them for the runs that kept them.

    A run without totals keeps its averages, each of which counts as one event.
    """
    kept = totals.select("snapshot_ts_temps").distinct()
    bare = minutes.join(kept, "snapshot_ts_temps", "left_anti")
    return totals.unionByName(bare, allowMissingColumns=True)


def delay_heatmap(
    minutes: DataFrame,
    as_of: dt.datetime | str | Column | None = None,
    include_future: bool = False,
    weighted: bool = False,
) -> DataFrame:
    """Mean of the minute averages, and how many there are, per day and hour.

    `weighted=True` takes the result of `weighted_minutes` and gives the mean over events
    instead, and how many have a delay.

    `minutes` is the average per minute or a history of it.  Every row weighs the
    same, as snapshots carry no counts, and a minute that several snapshots hold
    counts once for each.  The stored averages are summed as decimals, so the order
    of rows does not matter, and only the mean is rounded.
    Day and hour are written out once per hour, not once per minute.
    """
    micros = F.unix_micros(F.col("minute_ts").cast("timestamp"))
    hour = F.timestamp_micros("hour_us").cast("timestamp_ntz")
    average = F.col("avg_delay_min").cast("decimal(38,18)")
    rows = minutes if include_future else past_minutes(minutes, as_of)
    n, nb_events = F.count("avg_delay_min"), F.count(F.lit(1))
    minute = 1
    if weighted:
        seconds = F.col("sum_sec").cast("decimal(38,0)") * MICROS_PER_SECOND
        bare = average * F.lit(MICROS_PER_MINUTE)
        average = F.coalesce(seconds + F.col("sum_us"), bare).cast("decimal(38,6)")
        n = F.sum(F.coalesce("n_delay", F.col("avg_delay_min").isNotNull().cast("long")))
        nb_events, minute = n, MICROS_PER_MINUTE
    return (
        rows.filter(F.col("minute_ts").isNotNull())
        .groupBy(start_of(micros, MICROS_PER_HOUR).alias("hour_us"))
        .agg(
            F.sum(average).alias("total"),
            n.alias("n"),
            nb_events.alias("nb_events"),
        )
        .select(
            F.date_format(hour, "yyyy-MM-dd").alias("jour_date"),
            F.date_format(hour, "HH").alias("heure"),
            round2(
                F.try_divide(F.col("total").cast("double"), F.col("n") * float(minute))
            ).alias("avg_delay_min"),
            "nb_events",
        )
        .orderBy("jour_date", "heure")
    )


def stop_delay_evolution(
    snapshots: DataFrame, stop_ids: Sequence[str] | None = WATCHED_STOPS
) -> DataFrame:
    """Average delay of the watched stops in every snapshot; None watches all stops."""
    rows = snapshots.withColumn("stop_id", F.col("stop_id").cast("string"))
    if stop_ids is not None:
        rows = rows.filter(F.col("stop_id").isin(*stop_ids))
    # Stops and snapshots repeat; the remaining columns only split equal sort keys.
    return rows.select("stop_id", *EVOLUTION_COLUMNS).orderBy(
        "stop_id", "snapshot_ts_temps", "stop_name", "avg_delay_min"
    )


def stop_delay_range(snapshots: DataFrame) -> DataFrame:
    """Smallest and largest snapshot average per stop, largest first."""
    return (
        snapshots.filter(F.col("avg_delay_min").isNotNull())
        .groupBy("stop_id", "stop_name")
        .agg(F.min("avg_delay_min").alias("min_delay"), F.max("avg_delay_min").alias("max_delay"))
        .orderBy(F.desc_nulls_last("max_delay"), "stop_id", "stop_name")
    )
