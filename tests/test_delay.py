import datetime as dt
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import DAY, as_events, at, brute_force, feed, plan
from tramline.operators import delay, questions

PLAN = [("A", 1, "s1", 36000), ("A", 2, "s2", 36600), ("A", 3, "s3", 37200)]


def relative(spark, feed_rows, plan_rows=PLAN):
    return as_events(delay.trip_relative_delays(feed(spark, feed_rows), plan(spark, plan_rows)))


def test_first_observed_stop_has_no_delay(spark):
    rows = [("A", 2, at(8, 20)), ("A", 3, at(8, 32))]
    assert relative(spark, rows) == [("A", 2, "s2", 0.0), ("A", 3, "s3", 2.0)]


def test_early_arrival_is_negative(spark):
    rows = [("A", 1, at(8)), ("A", 2, at(8, 8, 30))]
    assert relative(spark, rows) == [("A", 1, "s1", 0.0), ("A", 2, "s2", -1.5)]


def test_first_stop_without_arrival_drops_the_trip(spark):
    assert relative(spark, [("A", 1, None), ("A", 2, at(8))]) == []


def test_first_stop_outside_the_timetable_drops_the_trip(spark):
    assert relative(spark, [("A", 0, at(8)), ("A", 2, at(8))]) == []
    unplanned = [("A", 1, "s1", None), ("A", 2, "s2", 36600)]
    assert relative(spark, [("A", 1, at(8)), ("A", 2, at(8))], unplanned) == []


def test_later_stop_without_arrival_stays(spark):
    rows = [("A", 1, at(8)), ("A", 2, None)]
    assert relative(spark, rows) == [("A", 1, "s1", 0.0), ("A", 2, "s2", None)]


def test_later_stop_outside_the_timetable_is_dropped(spark):
    rows = [("A", 1, at(8)), ("A", 9, at(9))]
    assert relative(spark, rows) == [("A", 1, "s1", 0.0)]


def test_duplicates_multiply(spark):
    rows = [("A", 1, at(8)), ("A", 1, at(8, 1)), ("A", 2, at(8, 12))]
    found = relative(spark, rows, PLAN + [("A", 2, "s2bis", 36600)])
    assert found == brute_force(rows, PLAN + [("A", 2, "s2bis", 36600)])
    assert len(found) == 8


def test_missing_keys_match_nothing(spark):
    rows = [(None, 1, at(8)), ("A", None, at(8)), ("A", 1, at(8))]
    unkeyed = [(None, 1, "s1", 0), ("A", None, "s1", 0)]
    assert relative(spark, rows, PLAN + unkeyed) == [("A", 1, "s1", 0.0)]


def test_scheduled_time(spark):
    found = delay.trip_relative_delays(
        feed(spark, [("A", 1, at(23, 50)), ("A", 3, at(23, 55))]), plan(spark, PLAN)
    )
    scheduled = found.filter("stop_sequence = 3").select(
        F.col("scheduled_ts_utc").cast("timestamp_ntz")
    )
    assert scheduled.collect()[0][0] == DAY.replace(day=13, hour=0, minute=10)
    assert found.columns == [
        "trip_id",
        "stop_sequence",
        "stop_id",
        "arrival_dt_utc",
        "scheduled_ts_utc",
        "delay_min",
    ]


EVENTS = st.lists(
    st.tuples(
        st.sampled_from(["A", "B", "C", None]),
        st.sampled_from([1, 2, 3, None]),
        st.one_of(st.none(), st.integers(0, 7200).map(lambda s: DAY + dt.timedelta(seconds=s))),
    ),
    max_size=12,
)
STOPS = st.lists(
    st.tuples(
        st.sampled_from(["A", "B", "C", None]),
        st.sampled_from([1, 2, 3, None]),
        st.sampled_from(["s1", "s2"]),
        st.one_of(st.none(), st.integers(0, 100_000)),
    ),
    max_size=12,
)


def _apart(cases):
    """The rows of all cases, with trips of their own."""

    def named(trip, n):
        return None if trip is None else f"{n}{trip}"

    feed_rows = [(named(t, n), *rest) for n, case in enumerate(cases) for t, *rest in case[0]]
    plan_rows = [(named(t, n), *rest) for n, case in enumerate(cases) for t, *rest in case[1]]
    moved = [
        (named(t, n), s, a and a + dt.timedelta(seconds=case[2]))
        for n, case in enumerate(cases)
        for t, s, a in case[0]
    ]
    return feed_rows, plan_rows, moved


CASES = st.lists(
    st.tuples(EVENTS, STOPS, st.integers(-86400, 86400)), min_size=15, max_size=25
)


# Each example holds at least 15 inputs, which share no trip.
@settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=list(HealthCheck),
)
@given(cases=CASES)
def test_any_input_against_brute_force(spark, cases):
    feed_rows, plan_rows, moved = _apart(cases)
    found = relative(spark, feed_rows, plan_rows)
    expected = brute_force(feed_rows, plan_rows)
    assert [e[:3] for e in found] == [e[:3] for e in expected]
    assert all(
        a[3] == b[3] or abs(a[3] - b[3]) < 1e-9 for a, b in zip(found, expected, strict=True)
    )
    # Shifting every arrival of a trip leaves its delays alone.
    assert relative(spark, moved, plan_rows) == found


def test_hot_trip_is_whole(spark):
    """A third of all events on one trip, joins shuffled and hot partitions split."""
    chance = random.Random(7)
    feed_rows, plan_rows = [], []
    for trip, n in [("hot", 3000)] + [(f"t{i}", 6) for i in range(1000)]:
        for sequence in range(n):
            feed_rows.append(
                (trip, sequence, DAY + dt.timedelta(seconds=60 * sequence + chance.randrange(300)))
            )
            plan_rows.append((trip, sequence, f"s{sequence % 50}", 60 * sequence))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        delays = delay.trip_relative_delays(
            feed(spark, feed_rows).repartition(16), plan(spark, plan_rows).repartition(16)
        )
        rows = delays.collect()
        executed = delays._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    found = sorted(((r.trip_id, r.stop_sequence, r.stop_id, r.delay_min) for r in rows), key=str)
    expected = brute_force(feed_rows, plan_rows)
    assert [e[:3] for e in found] == [e[:3] for e in expected]
    assert max(abs(a[3] - b[3]) for a, b in zip(found, expected, strict=True)) < 1e-9
    assert "skew=true" in executed


def test_feed_and_timetable_are_shuffled_once(spark):
    delays = delay.trip_relative_delays(
        feed(spark, [("A", 1, at(8)), ("A", 2, at(9))]), plan(spark, PLAN)
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        delays.collect()
        executed = delays._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    final = executed.split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") == 2
    assert "Window" not in executed


def test_small_partitions_are_joined_without_sorts(spark):
    feed_rows = [(f"t{n}", n % 3, at(8)) for n in range(300)]
    plan_rows = [(f"t{n}", n % 3, "s1", 28800) for n in range(300)]
    delays = delay.service_day_delays(feed(spark, feed_rows), plan(spark, plan_rows))
    kept = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in kept}
    for key in kept:
        spark.conf.set(key, "-1")
    try:
        assert len(delays.collect()) == 300
        executed = delays._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    final = executed.split("== Initial Plan ==")[0]
    assert "ShuffledHashJoin" in final and "SortMergeJoin" not in final


def test_repeats_of_a_first_stop_are_not_gathered(spark):
    feed_rows = [("A", 0, at(8, n % 3)) for n in range(30)] + [("A", 0, None), ("A", 1, at(9))]
    plan_rows = [("A", 0, "s1", 28800), ("A", 0, "s2", 28800), ("A", 0, "s3", 28860), ("A", 1, "s4", 32400)]
    delays = delay.trip_relative_delays(feed(spark, feed_rows), plan(spark, plan_rows))
    assert as_events(delays) == brute_force(feed_rows, plan_rows)
    assert "collect_list" not in delays._jdf.queryExecution().optimizedPlan().toString()


def test_service_day(spark):
    rows = [("A", 1, at(8, 5)), ("A", 2, None)]
    found = delay.service_day_delays(feed(spark, rows), plan(spark, PLAN))
    # 08:05 UTC is 10:05 in Paris; 36000 s is 10:00.
    assert as_events(found) == [("A", 1, "s1", 5.0)]


def test_service_day_is_a_day_off_after_midnight(spark):
    late = [("A", 1, "s1", 25 * 3600)]
    found = delay.service_day_delays(
        feed(spark, [("A", 1, DAY.replace(hour=23))]), plan(spark, late)
    )
    # 25:00 on the 12th is 01:00 on the 13th; the arrival is put on the 13th.
    assert as_events(found) == [("A", 1, "s1", -1440.0)]


def test_service_day_on_the_day_clocks_change(spark):
    rows = [("A", 1, dt.datetime(2025, 10, 26, 9)), ("A", 2, dt.datetime(2025, 10, 26, 1, 30))]
    stops = [("A", 1, "s1", 36000), ("A", 2, "s2", 9000)]
    found = delay.service_day_delays(feed(spark, rows), plan(spark, stops))
    assert as_events(found) == [("A", 1, "s1", 0.0), ("A", 2, "s2", 0.0)]


def test_interval(spark):
    rows = [("A", 1, at(8, 5))]
    (row,) = delay.delay_intervals(feed(spark, rows), plan(spark, PLAN)).collect()
    assert row.delay_duration == dt.timedelta(minutes=5)
    assert row.local_service_day == dt.date(2025, 9, 12)


def test_a_first_stop_repeated_a_million_times(spark):
    """The averages come from a row per event; only row output repeats them."""
    feed_rows = feed(spark, [("A", 2, at(9)), ("B", 1, at(8))]).unionByName(
        spark.range(1_000_000).select(
            F.lit("A").alias("trip_id"), F.lit(1).alias("stop_sequence"),
            F.lit(at(8)).cast("timestamp").alias("arrival_dt"),
        )
    )
    timetable = plan(spark, [("A", 1, "s1", 36000), ("A", 2, "s2", 36060), ("B", 1, "s1", 36000)])
    weighted = delay.weighted_trip_delays(feed_rows, timetable).persist()
    assert weighted.filter("stop_sequence = 2").count() == 1
    assert weighted.agg(F.sum("times")).first()[0] == 1_000_000 * 1_000_001 + 1
    stops = spark.createDataFrame(
        [("s1", "One", 1.0, 2.0), ("s2", "Two", 1.0, 2.0)],
        "stop_id string, stop_name string, stop_lat double, stop_lon double",
    )
    found = questions.average_delay_by_stop(weighted, stops).collect()
    assert [(r.stop_id, r.avg_delay_min) for r in found] == [("s2", 59.0), ("s1", 0.0)]
    rate = questions.punctuality_rate(weighted).first()
    assert (rate.total_events, rate.on_time_events) == (1_000_000 * 1_000_001 + 1, 10**12 + 1)
    assert delay.expanded(weighted.filter("stop_sequence = 2")).count() == 1_000_000
    weighted.unpersist()
