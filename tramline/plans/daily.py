"""One run of the whole job: load, derive delays once, answer every question."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tramline import schemas
from tramline.functions.clock import stamp as run_stamp
from tramline.operators import history, questions, tables
from tramline.operators.delay import expanded, weighted_trip_delays
from tramline.sinks import export
from tramline.sources.archives import load_archives
from tramline.sources.feeds import with_update_times, with_vehicle_time
from tramline.sources.snapshots import read_snapshots
from tramline.sources.timetable import TYPED_TABLES, load_timetable

BY_MINUTE = "avg_delay_by_minute"
BY_MINUTE_TOTALS = "avg_delay_by_minute_totals"
BY_STOP = "avg_delay_by_stop"


@dataclass(frozen=True)
class DailyRun:
    """Where a run writes, and its label.

    Every run has a warehouse folder of its own: tables of an earlier run neither stay
    behind nor change under those who read them.  A run repeated with the same label puts its
    tables and answers in place of the first ones', whose readers go on with what they opened.
    """

    warehouse: str
    export_dir: str
    stamp: str

    @property
    def tables(self) -> str:
        return f"{self.warehouse}/run={self.stamp}"


def load_warehouse(
    spark: SparkSession,
    timetable: str,
    trip_updates: DataFrame,
    vehicle_positions: DataFrame,
    warehouse: str,
    multiline: bool = False,
) -> dict[str, DataFrame]:
    """Write the tables of one run: the timetable, both feeds and the delays.

    `timetable` is a folder of unpacked text tables, or a glob that ends with .zip;
    `multiline` takes line breaks inside its quoted fields.
    """
    if timetable.endswith(".zip"):
        sources = load_archives(spark, timetable, TYPED_TABLES, multiline)
    else:
        sources = load_timetable(spark, timetable, TYPED_TABLES, multiline)
    sources["trips_updates"] = with_update_times(trip_updates)
    sources["vehicle_positions"] = with_vehicle_time(vehicle_positions)
    loaded = {
        name: export.replace_table(df, warehouse, name) for name, df in sources.items()
    }
    weighted = weighted_trip_delays(loaded["trips_updates"], loaded["stop_times"])
    loaded["weighted_delays"] = export.replace_table(weighted, warehouse, "weighted_delays")
    delays = expanded(loaded["weighted_delays"])
    loaded["delays"] = export.replace_table(delays, warehouse, "delays_with_support_columns")
    return loaded


def answer_questions(
    spark: SparkSession,
    warehouse: dict[str, DataFrame],
    run: DailyRun,
    as_of: dt.datetime | str | None = None,
    watched_stops: tuple[str, ...] | None = history.WATCHED_STOPS,
    earlier: Mapping[str, Sequence[str]] | None = None,
    weighted_heatmap: bool = False,
) -> dict[str, DataFrame]:
    """Write each question as a stamped CSV snapshot and return the results as written.

    The minute and stop averages come first: the heatmap and the evolution read
    the history those two have just extended, and the files that the globs in
    `earlier` name for either of them.  Each question is computed once; what is returned
    reads the files just written, in no order.  The totals behind the minute averages are
    written beside them; `weighted_heatmap` takes the mean over events by them.  The averages read
    weighted delays where the warehouse has them.
    """
    delays = warehouse["delays"]
    events = warehouse.get("weighted_delays", delays)

    def save(name: str, result: DataFrame) -> DataFrame:
        written = export.write_snapshot(result, run.export_dir, name, run.stamp)
        return export.read_export(spark, written, result.schema)

    def past(name: str, schema: T.StructType, same_header: bool) -> DataFrame:
        globs = [export.snapshot_glob(run.export_dir, name), *(earlier or {}).get(name, ())]
        return read_snapshots(spark, globs, schema, same_header and len(globs) == 1)

    trips, stops = warehouse["trips"], warehouse["stops"]
    vehicles = warehouse["vehicle_positions"]
    results = {
        BY_MINUTE: save(BY_MINUTE, questions.average_delay_by_minute(events)),
        BY_STOP: save(BY_STOP, questions.average_delay_by_stop(events, stops)),
        "position_bus_vehicles": save(
            "position_bus_vehicles", questions.position_bus_vehicles(vehicles, delays)
        ),
        "avg_delay_by_route": save(
            "avg_delay_by_route", questions.average_delay_by_route(events, trips)
        ),
        "punctuality_rate": save("punctuality_rate", questions.punctuality_rate(events)),
    }
    totals = questions.paris_minute_totals(questions.minute_totals(events))
    save(BY_MINUTE_TOTALS, totals)
    minutes = past(BY_MINUTE, schemas.MINUTE_SNAPSHOT, True)
    if weighted_heatmap:
        kept = past(BY_MINUTE_TOTALS, schemas.MINUTE_TOTALS, True)
        minutes = history.weighted_minutes(minutes, kept)
    results["avg_delay_heatmap_Q5"] = save(
        "avg_delay_heatmap_Q5",
        history.delay_heatmap(minutes, as_of, weighted=weighted_heatmap),
    )
    results["evolution_delay_by_stop_Q7"] = save(
        "evolution_delay_by_stop_Q7",
        history.stop_delay_evolution(past(BY_STOP, schemas.STOP_SNAPSHOT, False), watched_stops),
    )
    if "routes" in warehouse:
        results["trips_plus_routes"] = save(
            "trips_plus_routes", tables.trips_plus_routes(trips, warehouse["routes"])
        )
    results["stops_with_geom"] = save("stops_with_geom", tables.stops_with_geometry(stops))
    return results


def run_daily(
    spark: SparkSession,
    timetable: str,
    trip_updates: DataFrame,
    vehicle_positions: DataFrame,
    warehouse_dir: str,
    export_dir: str,
    stamp: str | None = None,
    as_of: dt.datetime | str | None = None,
    watched_stops: tuple[str, ...] | None = history.WATCHED_STOPS,
    earlier: Mapping[str, Sequence[str]] | None = None,
    multiline: bool = False,
    weighted_heatmap: bool = False,
) -> dict[str, DataFrame]:
    """Load and answer.  Give `stamp` and `as_of` to repeat an earlier run.

    "Now" is taken once, for the label and for the heatmap.  `earlier` names snapshot
    files from elsewhere by question, such as `{BY_MINUTE: ["old/avg_delay_by_minute_*.csv"]}`.
    `multiline` takes line breaks inside quoted fields of the timetable; `weighted_heatmap`
    weighs minutes by their events in all runs that kept their totals.
    """
    now = dt.datetime.now(dt.timezone.utc)
    run = DailyRun(warehouse_dir, export_dir, stamp or run_stamp(now))
    loaded = load_warehouse(
        spark, timetable, trip_updates, vehicle_positions, run.tables, multiline
    )
    return answer_questions(
        spark, loaded, run, as_of or now, watched_stops, earlier, weighted_heatmap
    )
