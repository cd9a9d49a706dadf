import datetime as dt
import random
import re

from pyspark.sql import functions as F

from tests.helpers import DAY, at, delay_events
from tramline.operators import delay, history, questions, ranking, tables

EVENTS = [
    ("A", 1, "s1", at(8), 0),
    ("A", 2, "s2", at(8, 0, 30), 600),
    ("A", 3, "s3", None, 0),
    ("B", 1, "s1", at(9), -120),
    ("B", 2, "s2", at(9, 5), 300),
]


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_minute_average_keeps_a_missing_minute_last(spark):
    found = rows(questions.average_delay_by_minute(delay_events(spark, EVENTS)))
    assert found == [
        (at(10), 5.0),
        (at(11), -2.0),
        (at(11, 5), 5.0),
        (None, None),
    ]


def test_repeated_autumn_minute_is_one_row(spark):
    night = dt.datetime(2025, 10, 26)
    events = [
        ("A", 1, "s", night.replace(hour=0, minute=30), 60),
        ("A", 2, "s", night.replace(hour=1, minute=30), 180),
    ]
    found = rows(questions.average_delay_by_minute(delay_events(spark, events)))
    assert found == [(night.replace(hour=2, minute=30), 2.0)]


def stops(spark, ids):
    return spark.createDataFrame(
        [(i, f"name {i}", 43.5, 7.25) for i in ids],
        "stop_id string, stop_name string, stop_lat double, stop_lon double",
    )


def test_stop_average_keeps_stops_without_events(spark):
    found = rows(
        questions.average_delay_by_stop(
            delay_events(spark, EVENTS), stops(spark, ["s1", "s2", "s3", "s4"])
        )
    )
    assert [(r[0], r[4]) for r in found] == [
        ("s2", 7.5),
        ("s1", -1.0),
        ("s3", None),
        ("s4", None),
    ]


def test_repeated_stop_rows_give_one_row(spark):
    found = rows(
        questions.average_delay_by_stop(
            delay_events(spark, EVENTS), stops(spark, ["s1", "s1", None])
        )
    )
    assert [(r[0], r[4]) for r in found] == [("s1", -1.0), (None, None)]


def test_stop_average_of_one_day(spark):
    other = [("C", 1, "s1", DAY.replace(day=13), 6000)]
    found = rows(
        questions.average_delay_by_stop_on(
            delay_events(spark, EVENTS + other), stops(spark, ["s1", "s9"]), "2025-09-12"
        )
    )
    assert [(r[0], r[4]) for r in found] == [("s1", -1.0), ("s9", None)]


def test_route_average_and_unmatched_trips(spark):
    events = delay_events(spark, EVENTS + [("C", 1, "s1", at(9), 60)])
    trips = spark.createDataFrame([("A", "r1"), ("B", "r1"), ("D", "r2")], "trip_id string, route_id string")
    assert rows(questions.average_delay_by_route(events, trips)) == [("r1", 3.25)]
    assert rows(questions.route_delay_with_counts(events, trips)) == [
        ("r1", 3.25, 5),
        (None, 1.0, 1),
    ]


def test_repeated_trips_weigh_twice(spark):
    events = delay_events(spark, [("A", 1, "s", at(8), 0), ("B", 1, "s", at(8), 180)])
    trips = spark.createDataFrame(
        [("A", "r"), ("A", "r"), ("B", "r")], "trip_id string, route_id string"
    )
    assert rows(questions.route_delay_with_counts(events, trips)) == [("r", 1.0, 3)]


def test_punctuality_counts_early_and_unknown(spark):
    assert rows(questions.punctuality_rate(delay_events(spark, EVENTS))) == [(5, 3, 60.0)]
    assert rows(questions.punctuality_rate(delay_events(spark, []))) == [(0, 0, None)]


def test_summary(spark):
    assert rows(questions.delay_summary(delay_events(spark, EVENTS))) == [(-2.0, 10.0, 3.25)]
    assert rows(questions.delay_summary(delay_events(spark, []))) == [(None, None, None)]


VEHICLES = "trip_id string, route_id string, latitude double, longitude double, timestamp bigint"


def vehicles(spark, given):
    return spark.createDataFrame([(t, r, 43.5, 7.25, s) for t, r, s in given], VEHICLES)


def test_vehicle_positions_meet_every_event_of_the_trip(spark):
    given = [("B", "r1", 1757700800), ("Z", "r2", None), (None, "r3", 1757700801)]
    found = rows(
        questions.position_bus_vehicles(vehicles(spark, given), delay_events(spark, EVENTS))
    )
    paris = dt.datetime(2025, 9, 12, 20, 13, 20)
    assert found == [
        (None, "r3", 43.5, 7.25, paris + dt.timedelta(seconds=1), None),
        ("B", "r1", 43.5, 7.25, paris, -2.0),
        ("B", "r1", 43.5, 7.25, paris, 5.0),
        ("Z", "r2", 43.5, 7.25, None, None),
    ]


def hot_trip(spark):
    """One trip has a third of the events and of the vehicles, these all in one second."""
    chance = random.Random(11)
    events = [
        ("hot" if i % 3 == 0 else f"t{chance.randrange(40)}", i, "s", at(8), chance.randrange(-600, 600))
        for i in range(600)
    ]
    given = [
        ("hot" if i % 3 == 0 else f"t{chance.randrange(50)}" if i % 50 else None, f"r{i}",
         1757700800 if i % 3 == 0 else 1757700000 + chance.randrange(2000) if i % 7 else None)
        for i in range(400)
    ]
    return events, given


def test_positions_are_paired_once_and_in_order(spark):
    events, given = hot_trip(spark)
    delays, positions = delay_events(spark, events), vehicles(spark, given)
    found = questions.position_bus_vehicles(positions, delays, pairs_per_range=1500)
    by_trip = {}
    for trip, _, _, _, late in events:
        by_trip.setdefault(trip, []).append(round(late / 60, 2) + 0.0)
    expected = [(r, d) for t, r, _ in given for d in by_trip.get(t, [None])]
    pairs = [(r.route_id, r.delay_min) for r in found.collect()]
    assert sorted(pairs, key=str) == sorted(expected, key=str)
    rows_ = found.collect()
    keys = [
        (r.timestamp_paris is None, -(r.timestamp_paris or dt.datetime.min).timestamp()
         if r.timestamp_paris else 0, r.trip_id or "", r.route_id, r.delay_min is not None, r.delay_min or 0)
        for r in rows_
    ]
    assert keys == sorted(keys)
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "rangepartitioning" not in plan
    assert len(re.findall(r"Join.*range", plan)) == 1
    sizes = sorted(r[1] for r in found.groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) > 10
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_weighted_events_give_the_same_answers(spark):
    chance = random.Random(5)
    rows_ = [
        (f"t{chance.randrange(8)}", i, f"s{i % 5}", at(8) if i % 6 else None, chance.randrange(-600, 600))
        for i in range(120)
    ]
    weighted = delay_events(spark, rows_).withColumn("times", F.col("stop_sequence") % 4 + 1)
    weighted = weighted.withColumn("times", F.col("times").cast("long"))
    plain = delay.expanded(weighted)
    assert plain.count() == sum(i % 4 + 1 for i in range(120))
    stops = spark.createDataFrame(
        [(f"s{i}", f"S{i}", 1.0, 2.0) for i in range(7)], "stop_id string, stop_name string, stop_lat double, stop_lon double"
    )
    trips = spark.createDataFrame([(f"t{i}", f"r{i % 3}") for i in range(6)], "trip_id string, route_id string")
    for ask in (
        questions.average_delay_by_minute,
        lambda d: questions.average_delay_by_stop(d, stops),
        lambda d: questions.average_delay_by_route(d, trips),
        lambda d: questions.route_delay_with_counts(d, trips),
        questions.punctuality_rate,
        questions.delay_summary,
    ):
        assert rows(ask(weighted)) == rows(ask(plain))
    none = weighted.limit(0)
    assert rows(questions.punctuality_rate(none)) == rows(questions.punctuality_rate(delay.expanded(none)))


def test_vehicle_routes_equal_the_joined_pairs(spark):
    chance = random.Random(3)
    events = [
        (f"t{chance.randrange(20)}", i, "s", at(8) if i % 5 else None, chance.randrange(-600, 600))
        for i in range(300)
    ]
    given = [
        (f"t{chance.randrange(25)}", f"r{chance.randrange(6)}", i if i % 7 else None)
        for i in range(200)
    ]
    delays, positions = delay_events(spark, events), vehicles(spark, given)
    pairs = (
        positions.filter("timestamp is not null")
        .join(delays, "trip_id", "left")
        .groupBy("route_id")
        .agg(F.avg("delay_min").alias("mean"), F.count(F.lit(1)).alias("n"))
    )
    expected = {r.route_id: (r.mean, r.n) for r in pairs.collect()}
    found = rows(questions.vehicle_route_delay(positions, delays))
    assert {r for r, _, _ in found} == set(expected)
    for route, mean, n in found:
        assert n == expected[route][1]
        assert abs(mean - expected[route][0]) <= 0.005 + 1e-9
    assert len(questions.vehicle_route_delay(positions, delays, top=2).collect()) == 2


def test_top_reports_break_ties(spark):
    tied = [(f"t{i}", 1, "s", at(8), 60) for i in range(5)]
    delays = delay_events(spark, tied + [("late", 1, "s", at(9), 600), ("none", 1, "s", None, 0)])
    worst = rows(ranking.worst_events(delays, "2025-09-12", top=3))
    assert [r[3] for r in worst] == [10.0, 1.0, 1.0]
    latest = [r.trip_id for r in ranking.latest_events(delays, top=3).collect()]
    assert latest == ["late", "t0", "t1"]


def test_latest_vehicle_delays_equal_the_full_join(spark):
    given = [(f"t{i % 4}", "r", 100 - i // 2) for i in range(20)] + [("t1", "r", None)]
    events = [(f"t{i % 3}", i, "s", at(8), 60 * i) for i in range(9)]
    positions, delays = vehicles(spark, given), delay_events(spark, events)
    full = (
        questions.vehicles_with_time(positions)
        .join(delays.select("trip_id", "delay_min"), "trip_id", "left")
        .orderBy(F.desc_nulls_last("ts_utc"), "trip_id", "route_id", "latitude", "longitude",
                 F.asc_nulls_last("delay_min"))
    )
    for top in (1, 5, 10):
        assert rows(ranking.latest_vehicle_delays(positions, delays, top)) == rows(full.limit(top))


def test_worst_stops(spark):
    found = ranking.worst_stops(delay_events(spark, EVENTS), stops(spark, ["s1", "s2", "s4"]), top=2)
    assert [r.stop_id for r in found.collect()] == ["s2", "s1"]


def test_trips_with_route_names(spark):
    trips = spark.createDataFrame(
        [("A", "r1", 0), ("B", None, 1), ("C", "r9", 1)], "trip_id string, route_id string, way int"
    )
    routes = spark.createDataFrame(
        [("r1", "1", "Line 1", "x"), (None, "?", "Unknown", "y")],
        "route_id string, route_short_name string, route_long_name string, color string",
    )
    found = tables.trips_plus_routes(trips, routes)
    assert found.columns == ["trip_id", "route_id", "way", "route_short_name", "route_long_name"]
    assert sorted(rows(found)) == [
        ("A", "r1", 0, "1", "Line 1"),
        ("B", None, 1, "?", "Unknown"),
        ("C", "r9", 1, None, None),
    ]
    assert tables.trips_plus_routes(trips, routes, ()).columns == trips.columns


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, `b c` string")
    assert rows(tables.null_profile(df)) == [("a", 1), ("b c", 2)]
    assert rows(tables.null_profile(df.filter("a > 5"))) == [("a", 0), ("b c", 0)]


MINUTES = "minute_ts timestamp_ntz, avg_delay_min double"


def test_heatmap_averages_averages_up_to_now(spark):
    minutes = spark.createDataFrame(
        [(at(10), 1.0), (at(10), 2.0), (at(10, 1), None), (at(12, 1), 9.0), (None, 5.0)], MINUTES
    )
    # 10:00 UTC is noon in Paris, and minutes are Paris time.
    found = rows(history.delay_heatmap(minutes, as_of="2025-09-12 10:00:00"))
    assert found == [("2025-09-12", "10", 1.5, 3)]
    every = rows(history.delay_heatmap(minutes, include_future=True))
    assert every == [("2025-09-12", "10", 1.5, 3), ("2025-09-12", "12", 9.0, 1)]


def test_evolution_orders_ids_as_text(spark):
    schema = (
        "stop_id bigint, stop_name string, stop_lat double, stop_lon double,"
        " snapshot_ts_temps timestamp_ntz, avg_delay_min double"
    )
    given = [
        (619, "a", 1.0, 2.0, at(10), 1.0),
        (1183, "b", 1.0, 2.0, at(15), 2.0),
        (1183, "b", 1.0, 2.0, at(10), None),
        (5, "c", 1.0, 2.0, at(10), 3.0),
    ]
    snapshots = spark.createDataFrame(given, schema)
    found = history.stop_delay_evolution(snapshots).collect()
    assert [(r.stop_id, r.snapshot_ts_temps.hour) for r in found] == [
        ("1183", 10),
        ("1183", 15),
        ("619", 10),
    ]
    assert history.stop_delay_evolution(snapshots, None).count() == 4
    assert rows(history.stop_delay_range(snapshots)) == [
        (5, "c", 3.0, 3.0),
        (1183, "b", 2.0, 2.0),
        (619, "a", 1.0, 1.0),
    ]
