"""Test tables in the roles of a transit data set.

A trip is an order, its stops are its line numbers, a stop is a supplier, a
route is a customer, a vehicle position is an event.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from functools import cached_property

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline import scratch
from tramline.operators.delay import expanded, service_day_delays, weighted_trip_delays
from tramline.operators.questions import (
    minute_averages,
    minute_totals,
    paris_minute_totals,
    stop_averages,
)
from tramline.plans.daily import BY_MINUTE, BY_MINUTE_TOTALS, BY_STOP
from tramline.session import prepare
from tramline.sinks.export import replace_table, snapshot_glob, write_snapshots
from tramline.sinks.versions import newest
from tramline.sources.feeds import with_update_times, with_vehicle_time
from tramline.sources.files import folder_version
from tramline.sources.timetable import with_stop_seconds

FIRST_SECOND = 23 * 3600
STEP_SECONDS = 1800
# What stop numbers of stops outside the timetable differ by.
UNPLANNED = 50

# Labels of the runs; each sees the trips of two remainders of the trip number.
STAMPS = (
    "20250910_100000",
    "20250912_100000",
    "20250912_150000",
    "20250915_160000",
    "20250919_100000",
    "20250922_150000",
    "20250923_100000",
)


def _planned_second(stop_sequence: Column) -> Column:
    return (FIRST_SECOND + (stop_sequence - 1) * STEP_SECONDS).cast("bigint")


def _part(row: Column, remainder_of: int) -> Column:
    """Whether the part number of a visit is divisible; a missing number is not."""
    return F.coalesce(row % remainder_of == 0, F.lit(False))


def _twice_if(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet the condition occur twice."""
    copies = F.when(condition, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("copy", F.explode(copies)).drop("copy")


def _time_text(seconds: Column) -> Column:
    """Seconds after midnight as HH:MM:SS, hours up to 99."""
    minutes = F.call_function("div", seconds, F.lit(60))
    fields = (F.call_function("div", minutes, F.lit(60)), minutes % 60, seconds % 60)
    return F.concat_ws(":", *(F.lpad(f.cast("string"), 2, "0") for f in fields))


# What a session has loaded or opened, by (application, folder, its version, table).
_LOADED: dict[tuple[str, str, int, str], tuple[str, T.StructType]] = {}

# Export folder with the snapshot history of a question, by the same key.
_HISTORIES: dict[tuple[str, str, int, str], str] = {}


class Roles:
    """Role tables over one folder of parquet test tables.

    The feeds, the timetable and the delays are loaded into a warehouse in the
    shared folder on first use, as a daily run does; questions read them there.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare(spark)
        self.folder = folder
        # Tables are loaded again when the files of the folder change.
        self.version = folder_version(self.spark, folder)

    def _key(self, name: str) -> tuple[str, str, int, str]:
        return self.spark.sparkContext.applicationId, self.folder, self.version, name

    def _open(self, name: str, path: Callable[[], str]) -> DataFrame:
        """Parquet table whose path and schema are found once per session."""
        key = self._key(name)
        if key not in _LOADED:
            found = path()
            _LOADED[key] = found, self.spark.read.parquet(found).schema
        found, schema = _LOADED[key]
        return self.spark.read.schema(schema).parquet(found)

    def table(self, name: str) -> DataFrame:
        return self._open(name, lambda: f"{self.folder}/{name}.parquet")

    def _loaded(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Warehouse table `name`, written the first time this session needs it."""

        def load() -> str:
            warehouse = scratch.new_folder(self.spark, "warehouse")
            replace_table(build(), warehouse, name)
            return newest(self.spark, warehouse, name)

        return self._open(f"warehouse/{name}", load)

    @cached_property
    def visits(self) -> DataFrame:
        """One row per (trip, stop_sequence); the source repeats the pair.

        Trips whose number is divisible by 13 run a second time as extra trips, under the negative
        number, of which the table of trips knows nothing.
        """
        visits = (
            self.table("lineitem")
            .groupBy(F.col("l_orderkey").alias("trip_id"), F.col("l_linenumber").alias("stop_sequence"))
            .agg(F.min("l_suppkey").alias("stop_id"), F.min("l_partkey").alias("part"))
        )
        number = F.col("trip_id")
        runs = F.when(number % 13 == 0, F.array(number, -number)).otherwise(F.array(number))
        return visits.withColumn("trip_id", F.explode(runs))

    @cached_property
    def stop_times(self) -> DataFrame:
        """Timetable with its times as text, hours past 24, and in seconds.

        By part number, some visits have no times and some occur twice.
        """

        def build() -> DataFrame:
            part = F.col("part")
            planned = F.when(~_part(part, 29), _planned_second(F.col("stop_sequence")))
            return with_stop_seconds(
                _twice_if(self.visits, _part(part, 31)).select(
                    "trip_id",
                    _time_text(planned).alias("arrival_time"),
                    _time_text(planned + 30).alias("departure_time"),
                    "stop_id",
                    "stop_sequence",
                )
            )

        return self._loaded("stop_times", build)

    @cached_property
    def stop_times_text(self) -> DataFrame:
        return self.stop_times.drop("arrival_time_sec", "departure_time_sec")

    @cached_property
    def trips_updates(self) -> DataFrame:
        """Feed with epoch seconds and instants.

        No visit is left out; the arrival is blank for part numbers divisible by 17 and the
        departure for those divisible by 13; those divisible by 37 occur twice.  Those
        divisible by 23 have one more row at a stop that the timetable lacks, after the trip's last
        stop or, if divisible by 46, before its first.  Trips of one week start on its Monday.
        """

        def build() -> DataFrame:
            orders = self.table("orders").select(
                F.col("o_orderkey").alias("order"),
                F.col("o_custkey").alias("route_id"),
                (F.col("o_orderkey") % 2).cast("int").alias("direction_id"),
                F.unix_seconds(F.date_trunc("week", F.col("o_orderdate").cast("timestamp"))).alias(
                    "day"
                ),
            )
            arrival = (
                F.col("day") + _planned_second(F.col("stop_sequence")) + F.col("part") % 1800 - 600
            )
            part = F.col("part")
            more = F.when(_part(part, 46), -UNPLANNED).when(_part(part, 23), UNPLANNED)
            visits = _twice_if(self.visits, _part(part, 37)).withColumn(
                "shift", F.explode(F.array_compact(F.array(F.lit(0), more)))
            )
            flat = visits.join(orders, F.abs("trip_id") == F.col("order")).select(
                "trip_id",
                "route_id",
                "direction_id",
                "stop_id",
                (F.col("stop_sequence") + F.col("shift")).alias("stop_sequence"),
                F.when(F.col("part") % 17 != 0, arrival).alias("arrival_time"),
                F.when(F.col("part") % 13 != 0, arrival + 30).alias("departure_time"),
            )
            return with_update_times(flat)

        return self._loaded("trips_updates", build)

    @cached_property
    def flat_updates(self) -> DataFrame:
        return self.trips_updates.drop("arrival_dt", "departure_dt")

    @cached_property
    def vehicle_positions(self) -> DataFrame:
        """Vehicle positions; those at longitude 0 have no time."""

        def build() -> DataFrame:
            k = F.get_json_object("props", "$.k").cast("double")
            second = F.unix_seconds(F.col("ts").cast("timestamp"))
            flat = self.table("events").select(
                F.col("user_id").alias("trip_id"),
                F.concat_ws("-", "event_type", (F.col("user_id") % 7).cast("string")).alias(
                    "route_id"
                ),
                F.col("value").alias("latitude"),
                k.alias("longitude"),
                F.when(k != 0, second).alias("timestamp"),
                F.col("event_id").cast("string").alias("vehicle_id"),
            )
            return with_vehicle_time(flat)

        return self._loaded("vehicle_positions", build)

    @cached_property
    def flat_vehicles(self) -> DataFrame:
        return self.vehicle_positions.drop("timestamp_dt")

    @cached_property
    def trips(self) -> DataFrame:
        """Trips, some without a route; the extra trips are not among them."""
        number = F.col("o_orderkey")
        return self.table("orders").select(
            number.alias("trip_id"),
            F.when(number % 11 != 0, F.col("o_custkey")).alias("route_id"),
        )

    @cached_property
    def routes(self) -> DataFrame:
        """Customers, and one route without an id."""
        routes = self.table("customer").select(
            F.col("c_custkey").alias("route_id"),
            F.col("c_mktsegment").alias("route_short_name"),
            F.col("c_name").alias("route_long_name"),
        )
        nameless = self.spark.range(1).select(
            F.lit(None).cast("bigint"), F.lit("none"), F.lit("No route")
        )
        return routes.union(nameless)

    @cached_property
    def stops(self) -> DataFrame:
        """Suppliers, and one stop nothing ever visits."""
        stops = self.table("supplier").select(
            F.col("s_suppkey").alias("stop_id"),
            F.col("s_name").alias("stop_name"),
            F.col("s_acctbal").alias("stop_lat"),
            F.col("s_nationkey").cast("double").alias("stop_lon"),
        )
        unused = self.spark.range(1).select(
            F.lit(-1).cast("bigint"), F.lit("Unused"), F.lit(43.5), F.lit(7.25)
        )
        return stops.union(unused)

    @cached_property
    def delays(self) -> DataFrame:
        return self._loaded("delays", lambda: expanded(self.weighted_delays))

    @cached_property
    def weighted_delays(self) -> DataFrame:
        return self._loaded(
            "weighted_delays", lambda: weighted_trip_delays(self.trips_updates, self.stop_times)
        )

    @cached_property
    def day_delays(self) -> DataFrame:
        return self._loaded(
            "day_delays", lambda: service_day_delays(self.trips_updates, self.stop_times)
        )

    @cached_property
    def run_delays(self) -> DataFrame:
        """Delays with the labels of the two runs that saw them, whatever their time."""
        labels = F.array(*map(F.lit, STAMPS))
        place = F.pmod("trip_id", F.lit(len(STAMPS))).cast("int")
        seen_by = F.array(F.get(labels, place), F.get(labels, (place + 1) % len(STAMPS)))
        return self.delays.withColumn("stamp", F.explode(seen_by))

    @cached_property
    def run_stops(self) -> DataFrame:
        return self.stops.withColumn("stamp", F.explode(F.array(*map(F.lit, STAMPS))))

    def _history(self, name: str, build: Callable[[], DataFrame]) -> str:
        """Export folder with one CSV snapshot per run, written once per session."""
        key = self._key(name)
        if key not in _HISTORIES:
            folder = scratch.new_folder(self.spark, "exports")
            write_snapshots(build(), folder, name)
            _HISTORIES[key] = folder
        return _HISTORIES[key]

    def minute_snapshots(self, stamps: str = "*") -> str:
        """Glob over the runs' averages per minute."""
        folder = self._history(BY_MINUTE, lambda: minute_averages(self.run_delays, ["stamp"]))
        return snapshot_glob(folder, BY_MINUTE, stamps)

    def minute_total_snapshots(self) -> str:
        """Glob over the totals behind them, which the first run has not kept."""

        def build() -> DataFrame:
            kept = self.run_delays.filter(F.col("stamp") != STAMPS[0])
            return paris_minute_totals(minute_totals(kept, ["stamp"]), ["stamp"])

        return snapshot_glob(self._history(BY_MINUTE_TOTALS, build), BY_MINUTE_TOTALS)

    def _stop_runs(self) -> DataFrame:
        def build() -> DataFrame:
            return stop_averages(self.run_delays, self.run_stops, ["stamp"])

        # Written once for all the exports, each of which would scan the events again.
        return self._loaded("stop_runs", build)

    def stop_snapshots(self) -> str:
        """Glob over the runs' averages per stop."""
        return snapshot_glob(self._history(BY_STOP, self._stop_runs), BY_STOP)

    def drifting_stop_snapshots(self, stamps: str = "*") -> str:
        """The same, where every other run has its columns in another order and one more."""
        key = self._key("drifting " + BY_STOP)
        if key not in _HISTORIES:
            folder, runs = scratch.new_folder(self.spark, "exports"), self._stop_runs()
            early = F.col("stamp").isin(*STAMPS[::2])
            write_snapshots(runs.filter(early), folder, BY_STOP)
            turned = runs.filter(~early).select(*reversed(runs.columns), F.lit("x").alias("note"))
            write_snapshots(turned, folder, BY_STOP)
            _HISTORIES[key] = folder
        return snapshot_glob(_HISTORIES[key], BY_STOP, stamps)


def update_messages(updates: DataFrame, bare_stop: bool = False) -> DataFrame:
    """Flat updates back in feed messages.

    Each holds the update, an update without stops and an entity of another kind;
    `bare_stop` adds a stop with nothing set, which reads as stop_sequence 0.
    """
    trip = F.struct(
        F.col("trip_id").cast("string").alias("trip_id"),
        F.col("route_id").cast("string").alias("route_id"),
        "direction_id",
    )
    stop_type = (
        "struct<stop_id:string,stop_sequence:int,arrival:struct<time:bigint>,"
        "departure:struct<time:bigint>>"
    )
    stop = F.struct(
        F.col("stop_id").cast("string").alias("stop_id"),
        F.col("stop_sequence").cast("int").alias("stop_sequence"),
        F.when(F.col("arrival_time").isNotNull(), F.struct(F.col("arrival_time").alias("time"))).alias(
            "arrival"
        ),
        F.struct(F.col("departure_time").alias("time")).alias("departure"),
    ).cast(stop_type)
    bare = F.struct(
        F.lit("").alias("stop_id"),
        F.lit(None).cast("int").alias("stop_sequence"),
        F.lit(None).cast("struct<time:bigint>").alias("arrival"),
        F.lit(None).cast("struct<time:bigint>").alias("departure"),
    ).cast(stop_type)

    def entity(kind: str, update: Column) -> Column:
        return F.struct(F.lit(kind).alias("id"), update.alias("trip_update"))

    def update(stops: Column) -> Column:
        return F.struct(trip.alias("trip"), stops.alias("stop_time_update"))

    some = update(F.array(stop, bare) if bare_stop else F.array(stop))
    none = update(F.filter(F.array(stop), lambda s: F.lit(False)))
    other = F.when(F.lit(False), some)
    return updates.select(
        F.array(entity("1", some), entity("2", none), entity("3", other)).alias("entity")
    )


def vehicle_messages(vehicles: DataFrame) -> DataFrame:
    """Flat vehicle positions back in feed messages, with an entity of another kind."""
    vehicle = F.struct(
        F.struct(
            F.col("trip_id").cast("string").alias("trip_id"),
            F.nullif("route_id", F.lit("signup-3")).alias("route_id"),
        ).alias("trip"),
        F.lit("").alias("stop_id"),
        F.struct(
            F.col("latitude").cast("float").alias("latitude"),
            F.col("longitude").cast("float").alias("longitude"),
            F.lit(None).cast("float").alias("bearing"),
            F.lit(0.5).cast("float").alias("speed"),
        ).alias("position"),
        "timestamp",
        F.struct(F.col("vehicle_id").alias("id")).alias("vehicle"),
    )
    return vehicles.select(
        F.array(
            F.struct(F.lit("1").alias("id"), vehicle.alias("vehicle")),
            F.struct(F.lit("2").alias("id"), F.when(F.lit(False), vehicle).alias("vehicle")),
        ).alias("entity")
    )


def pack_archives(table: DataFrame, name: str) -> DataFrame:
    """Each batch of rows as one zip of two text tables: (path, content)."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            blob = io.BytesIO()
            with zipfile.ZipFile(blob, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr(f"{name}.txt", batch.to_csv(index=False))
                archive.writestr("feed_info.txt", "feed_publisher_name\nnobody\n")
                archive.writestr("readme.md", "not a table")
            yield pd.DataFrame({"path": [f"{part}-{number}.zip"], "content": [blob.getvalue()]})

    return table.mapInPandas(pack, "path string, content binary")
