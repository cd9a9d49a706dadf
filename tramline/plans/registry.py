"""Registered queries: every operator over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline import catalog, schemas, scratch
from tramline.functions.clock import epoch_to_timestamp, hhmmss_to_seconds
from tramline.operators import delay, history, questions, ranking, tables
from tramline.plans import daily
from tramline.plans.roles import STAMPS, Roles, pack_archives, update_messages, vehicle_messages
from tramline.sinks import export
from tramline.sources import archives, feeds, snapshots, timetable
from tramline.streaming.minutes import append_minute_totals, streamed_delay_by_minute
from tramline.streaming.snapshots import append_history, stream_snapshots, streamed_history

# Parameters of the registered reports.
REPORT_DAY = "1998-07-07"
AS_OF = "2000-01-01 00:00:00"
WATCHED = ("7", "19", "42", "63", "88")
STAMP_RANGE = "2025091[2-9]*"
STREAM_FILES = 8

Query = Callable[[Roles], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def _plain_times(df: DataFrame) -> DataFrame:
    """Instants as UTC wall clock and dates as text, so that results compare as plain values."""
    plain = {T.TimestampType(): "timestamp_ntz", T.DateType(): "string"}
    return df.withColumns(
        {f.name: F.col(f.name).cast(plain[f.dataType]) for f in df.schema if f.dataType in plain}
    )


# -- scalar functions over whole columns


@query
def hhmmss_to_seconds_column(r: Roles) -> DataFrame:
    """Well-formed and malformed time texts."""
    hour, minute, second = (
        F.col(c).cast("int").cast("string") for c in ("l_quantity", "l_linenumber", "l_suppkey")
    )
    kind = F.col("l_partkey") % 9
    text = (
        F.when(kind == 0, F.concat(hour, F.lit(":"), minute))
        .when(kind == 1, F.concat_ws(":", hour, minute, F.concat(second, F.lit(".5"))))
        .when(kind == 2, F.lit(""))
        .when(kind == 3, F.concat_ws(":", F.lit("x"), minute, second))
        .when(kind == 4, F.concat_ws(":", F.concat(F.lit(" "), hour), minute, F.concat(second, F.lit(" "))))
        .when(kind == 5, F.concat_ws(":", F.concat(F.lit("-"), hour), F.concat(F.lit("+"), minute), second))
        .when(kind == 6, F.concat_ws(":", hour, minute, second, second))
        .when(kind == 7, F.concat_ws(":", hour, minute, second))
    )
    return r.table("lineitem").select(
        "l_orderkey", "l_linenumber", text.alias("time_text"), hhmmss_to_seconds(text).alias("seconds")
    )


@query
def epoch_to_timestamp_column(r: Roles) -> DataFrame:
    """Epoch seconds as integer text, decimal text and junk."""
    epoch = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    kind = F.col("event_id") % 7
    text = (
        F.when(kind == 0, F.concat(epoch, F.lit(".0")))
        .when(kind == 1, F.lit("nan"))
        .when(kind == 2, F.lit("1e30"))
        .when(kind == 3, F.lit("soon"))
        .when(kind == 4, F.concat(epoch, F.lit(".75")))
        .when(kind == 5, epoch)
    )
    return r.table("events").select(
        "event_id", text.alias("epoch_text"), epoch_to_timestamp(text).alias("event_dt")
    )


# -- delay operators


@query
def trip_first_stop(r: Roles) -> DataFrame:
    return delay.observed_first_stops(r.trips_updates)


@query
def trip_relative_delay(r: Roles) -> DataFrame:
    return delay.trip_relative_delays(r.trips_updates, r.stop_times)


@query
def service_day_delay(r: Roles) -> DataFrame:
    return delay.service_day_delays(r.trips_updates, r.stop_times)


@query
def delay_interval_top10(r: Roles) -> DataFrame:
    intervals = delay.delay_intervals(r.trips_updates, r.stop_times)
    seconds = F.unix_seconds(F.timestamp_seconds(F.lit(0)) + F.col("delay_duration"))
    return ranking.longest_delay_intervals(intervals, REPORT_DAY).withColumn(
        "delay_duration", seconds
    )


# -- the seven questions and their notebook forms


@query
def avg_delay_by_minute(r: Roles) -> DataFrame:
    return questions.average_delay_by_minute(r.delays)


@query
def avg_delay_by_minute_weighted(r: Roles) -> DataFrame:
    """From events that carry how often they occur; so are the next three."""
    return questions.average_delay_by_minute(r.weighted_delays)


@query
def avg_delay_by_stop_weighted(r: Roles) -> DataFrame:
    return questions.average_delay_by_stop(r.weighted_delays, r.stops)


@query
def route_delay_with_counts_weighted(r: Roles) -> DataFrame:
    return questions.route_delay_with_counts(r.weighted_delays, r.trips)


@query
def punctuality_rate_weighted(r: Roles) -> DataFrame:
    return questions.punctuality_rate(r.weighted_delays)


@query
def avg_delay_by_minute_service_day(r: Roles) -> DataFrame:
    return questions.average_delay_by_minute(r.day_delays)


@query
def vehicle_positions_with_delay(r: Roles) -> DataFrame:
    return questions.position_bus_vehicles(r.vehicle_positions, r.delays)


@query
def vehicle_positions_service_day_delay(r: Roles) -> DataFrame:
    return questions.position_bus_vehicles(r.vehicle_positions, r.day_delays)


@query
def avg_delay_by_stop(r: Roles) -> DataFrame:
    return questions.average_delay_by_stop(r.delays, r.stops)


@query
def avg_delay_by_stop_today(r: Roles) -> DataFrame:
    return questions.average_delay_by_stop_on(r.day_delays, r.stops, REPORT_DAY)


@query
def avg_delay_by_route(r: Roles) -> DataFrame:
    return questions.average_delay_by_route(r.delays, r.trips)


@query
def route_delay_with_counts(r: Roles) -> DataFrame:
    return questions.route_delay_with_counts(r.delays, r.trips)


@query
def vehicle_route_delay_top20(r: Roles) -> DataFrame:
    return questions.vehicle_route_delay(r.vehicle_positions, r.delays)


@query
def punctuality_rate(r: Roles) -> DataFrame:
    return questions.punctuality_rate(r.delays)


@query
def delay_summary(r: Roles) -> DataFrame:
    return questions.delay_summary(r.delays)


# -- top-k reports


@query
def worst_events(r: Roles) -> DataFrame:
    return ranking.worst_events(r.day_delays, REPORT_DAY)


@query
def latest_events(r: Roles) -> DataFrame:
    return ranking.latest_events(r.delays)


@query
def latest_vehicles(r: Roles) -> DataFrame:
    return ranking.latest_vehicles(r.vehicle_positions)


@query
def latest_vehicle_delays(r: Roles) -> DataFrame:
    return ranking.latest_vehicle_delays(r.vehicle_positions, r.day_delays)


@query
def worst_stops(r: Roles) -> DataFrame:
    return ranking.worst_stops(r.delays, r.stops, top=700)


@query
def worst_stops_today(r: Roles) -> DataFrame:
    return ranking.worst_stops(questions.on_day(r.day_delays, REPORT_DAY), r.stops)


# -- timetable tables


@query
def trips_plus_routes(r: Roles) -> DataFrame:
    return tables.trips_plus_routes(r.trips, r.routes)


@query
def trips_merged_on_route(r: Roles) -> DataFrame:
    """The merge on the key alone, which brings no columns."""
    return tables.trips_plus_routes(r.trips, r.routes, ())


@query
def stops_with_geometry(r: Roles) -> DataFrame:
    return tables.stops_with_geometry(r.stops)


@query
def null_profile(r: Roles) -> DataFrame:
    return tables.null_profile(r.trips_updates)


@query
def table_row_count(r: Roles) -> DataFrame:
    return catalog.row_count(r.trips_updates)


@query
def table_columns(r: Roles) -> DataFrame:
    """What the catalog tells of a registered view."""
    name = "described_trips_updates"
    catalog.register({name: r.trips_updates})
    described = catalog.describe(r.spark, name)
    catalog.drop_view(r.spark, name)
    return described


@query
def one_row_preview(r: Roles) -> DataFrame:
    """Preview of a table of one row."""
    return catalog.preview(questions.punctuality_rate(r.delays))


# -- loads: written as text in the shared folder, then read with the library's readers


@query
def static_tables_load(r: Roles) -> DataFrame:
    folder = scratch.new_folder(r.spark, "timetable")
    export.export_csv(r.stop_times_text, f"{folder}/stop_times.txt")
    return timetable.load_timetable(r.spark, folder)["stop_times"]


@query
def typed_tables_load(r: Roles) -> DataFrame:
    folder = scratch.new_folder(r.spark, "timetable")
    export.export_csv(r.stops, f"{folder}/stops.txt")
    return timetable.load_timetable(r.spark, folder, timetable.TYPED_TABLES)["stops"]


@query
def typed_routes_load(r: Roles) -> DataFrame:
    folder = scratch.new_folder(r.spark, "timetable")
    export.export_csv(r.routes, f"{folder}/routes.txt")
    return timetable.load_timetable(r.spark, folder, timetable.TYPED_TABLES)["routes"]


@query
def typed_trips_load(r: Roles) -> DataFrame:
    folder = scratch.new_folder(r.spark, "timetable")
    export.export_csv(r.trips, f"{folder}/trips.txt")
    return timetable.load_timetable(r.spark, folder, timetable.TYPED_TABLES)["trips"]


@query
def flat_feed_load(r: Roles) -> DataFrame:
    folder = scratch.new_folder(r.spark, "trip_updates")
    # Epoch columns with gaps reach CSV with a decimal part.
    flat = r.flat_updates.withColumn("arrival_time", F.col("arrival_time").cast("double"))
    export.export_csv(flat, folder)
    return feeds.read_trip_updates_csv(r.spark, folder)


@query
def flat_vehicle_load(r: Roles) -> DataFrame:
    """Columns in another order than the schema's, and two of the optional ones absent."""
    folder = scratch.new_folder(r.spark, "vehicle_positions")
    flat = r.flat_vehicles.withColumn("timestamp", F.col("timestamp").cast("double"))
    export.export_csv(flat.select(*reversed(flat.columns)), folder)
    return feeds.read_vehicle_positions_csv(r.spark, folder)


@query
def expand_archives(r: Roles) -> DataFrame:
    """Zips of two tables, read once for both, through to the loaded table."""
    folder = scratch.new_folder(r.spark, "archives")
    packed = export.replace_table(pack_archives(r.stop_times_text, "stop_times"), folder, "zips")
    return archives.archive_tables(packed)["stop_times"]


@query
def flatten_trip_updates(r: Roles) -> DataFrame:
    return feeds.flatten_trip_updates(update_messages(r.flat_updates, bare_stop=True))


@query
def flatten_vehicle_positions(r: Roles) -> DataFrame:
    return feeds.with_vehicle_time(
        feeds.flatten_vehicle_positions(vehicle_messages(r.flat_vehicles))
    )


# -- snapshot history: stamped CSV of earlier runs, read back through globs


def _minute_history(r: Roles, stamps: str = "*") -> DataFrame:
    return snapshots.read_snapshots(
        r.spark, r.minute_snapshots(stamps), schemas.MINUTE_SNAPSHOT, same_header=True
    )


def _stop_history(r: Roles, stamps: str = "*") -> DataFrame:
    files = r.drifting_stop_snapshots(stamps)
    return snapshots.read_snapshots(r.spark, files, schemas.STOP_SNAPSHOT)


@query
def delay_heatmap(r: Roles) -> DataFrame:
    return history.delay_heatmap(_minute_history(r), AS_OF)


@query
def delay_heatmap_selected_runs(r: Roles) -> DataFrame:
    first, second = _minute_history(r, STAMP_RANGE), _minute_history(r, "20250922*")
    return history.delay_heatmap(first.unionByName(second), include_future=True)


@query
def delay_heatmap_weighted(r: Roles) -> DataFrame:
    """Mean over events, but over minutes in the run that kept no totals."""
    totals = snapshots.read_snapshots(
        r.spark, r.minute_total_snapshots(), schemas.MINUTE_TOTALS, same_header=True
    )
    minutes = history.weighted_minutes(_minute_history(r), totals)
    return history.delay_heatmap(minutes, AS_OF, weighted=True)


@query
def snapshot_union(r: Roles) -> DataFrame:
    first, second = _minute_history(r, STAMP_RANGE), _minute_history(r, "20250922*")
    return first.unionByName(second, allowMissingColumns=True).drop("filename")


@query
def stop_delay_evolution(r: Roles) -> DataFrame:
    return history.stop_delay_evolution(_stop_history(r), WATCHED)


@query
def stop_delay_evolution_all(r: Roles) -> DataFrame:
    return history.stop_delay_evolution(_stop_history(r), None)


@query
def stop_delay_evolution_dates(r: Roles) -> DataFrame:
    """All stops over the snapshots of some days."""
    return history.stop_delay_evolution(_stop_history(r, STAMP_RANGE), None)


@query
def stop_delay_range(r: Roles) -> DataFrame:
    return history.stop_delay_range(_stop_history(r))


@query
def stop_delay_range_dates(r: Roles) -> DataFrame:
    return history.stop_delay_range(_stop_history(r, STAMP_RANGE))


# -- streams, run to the end of what is there


@query
def stream_avg_delay_by_minute(r: Roles) -> DataFrame:
    """Every minute, from events that arrive in any order and in one batch per file."""
    folder = scratch.new_folder(r.spark, "delay-minutes")
    r.delays.repartition(STREAM_FILES).write.parquet(f"{folder}/events")
    events = (
        r.spark.readStream.schema(r.delays.schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{folder}/events")
    )
    # Two merges and some batches that are still apart.
    append_minute_totals(
        events, f"{folder}/table", f"{folder}/state", merge_every=3
    ).awaitTermination()
    return streamed_delay_by_minute(r.spark, f"{folder}/table")


@query
def stream_stop_snapshots(r: Roles) -> DataFrame:
    """Snapshots of two headers, a few files at once."""
    stream = stream_snapshots(r.spark, r.drifting_stop_snapshots(), schemas.STOP_SNAPSHOT, 5)
    folder = scratch.new_folder(r.spark, "stop-history")
    append_history(stream, f"{folder}/table", f"{folder}/state").awaitTermination()
    return streamed_history(r.spark, f"{folder}/table").drop("filename", "note")


# -- the whole job


@query
def daily_run(r: Roles) -> DataFrame:
    """Text timetable and nested feeds through to every answer, as (question, item, value)."""
    folder = scratch.new_folder(r.spark, "daily")
    for name, table in {
        "stop_times": r.stop_times_text,
        "stops": r.stops,
        "trips": r.trips,
        "routes": r.routes,
    }.items():
        export.export_csv(table, f"{folder}/gtfs/{name}.txt")
    answers = daily.run_daily(
        r.spark,
        f"{folder}/gtfs",
        feeds.flatten_trip_updates(update_messages(r.flat_updates)),
        feeds.flatten_vehicle_positions(vehicle_messages(r.flat_vehicles)),
        f"{folder}/warehouse",
        f"{folder}/exports",
        stamp=STAMPS[0],
        as_of=AS_OF,
        watched_stops=WATCHED,
    )

    def time(column: str) -> Column:
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss")

    def joined(*columns: Column | str) -> Column:
        return F.concat_ws("|", *columns)

    nothing = F.lit(None)
    shapes = {
        "avg_delay_by_minute": (time("minute_ts"), "avg_delay_min"),
        "avg_delay_by_stop": ("stop_id", "avg_delay_min"),
        "position_bus_vehicles": (
            joined("trip_id", "route_id", time("timestamp_paris")),
            "delay_min",
        ),
        "avg_delay_by_route": ("route_id", "avg_delay_min"),
        "punctuality_rate": ("total_events", "pct_on_time"),
        "avg_delay_heatmap_Q5": (joined("jour_date", "heure", "nb_events"), "avg_delay_min"),
        "evolution_delay_by_stop_Q7": (joined("stop_id", time("snapshot_ts_temps")), "avg_delay_min"),
        "trips_plus_routes": (
            joined("trip_id", "route_id", "route_short_name", "route_long_name"),
            nothing,
        ),
        "stops_with_geom": ("stop_id", "stop_lat"),
    }

    def column(value: Column | str) -> Column:
        return F.col(value) if isinstance(value, str) else value

    written = [
        answer.select(
            F.lit(name).alias("question"),
            column(shapes[name][0]).cast("string").alias("item"),
            column(shapes[name][1]).cast("double").alias("value"),
        )
        for name, answer in answers.items()
    ]
    return reduce(DataFrame.unionByName, written)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: _plain_times(build(Roles(spark, folder)))

    return {name: bind(build) for name, build in _QUERIES.items()}
