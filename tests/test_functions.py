import datetime as dt

import pytest
from pyspark.sql import functions as F

from tramline import prepare
from tramline.functions.clock import (
    as_instant,
    epoch_to_timestamp,
    hhmmss_to_seconds,
    paris_to_instant,
    paris_wall_clock,
    plus_seconds,
    stamp,
    start_of,
)
from tramline.functions.numbers import delay_totals, mean_minutes, percent, round2
from tramline.functions.text import missing_to_null, plain_number, snapshot_time, wkt_point


def values(spark, kind, inputs, build):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, x {kind}").coalesce(1)
    return [r[0] for r in df.orderBy("i").select(build(F.col("x"))).collect()]


def test_time_text(spark):
    cases = {
        "08:05:03": 29103,
        "26:00:00": 93600,
        " 8:05:03": 29103,
        "08:61:00": 32460,
        "-1:00:+5": -3595,
        "08:05": None,
        "08:05:03:00": None,
        "8:00:00.5": None,
        "": None,
        "a:b:c": None,
        "99999999999999999:00:00": None,
        None: None,
    }
    assert values(spark, "string", cases, hhmmss_to_seconds) == list(cases.values())


def test_time_text_with_more_or_other_colons(spark):
    cases = {"1::3": None, ":": None, "::": None, "1:2:3:": None, "é:1:2": None, "1：2:3": None}
    cases |= {"1:\t2:3 ": 3723, "9223372036854775807:0:0": None}
    assert values(spark, "string", cases, hhmmss_to_seconds) == list(cases.values())
    texts = spark.createDataFrame([("1:2:3",)], "t string").repartition(2)
    plan = texts.select(hhmmss_to_seconds(F.col("t")))._jdf.queryExecution().optimizedPlan()
    assert "split(" not in plan.toString()


def test_epoch_text(spark):
    moment = dt.datetime(2025, 9, 12, 18, 13, 20)
    cases = {
        "1757700800": moment,
        "1757700800.0": moment,
        "1757700800.9": moment,
        "nan": None,
        "inf": None,
        "1e30": None,
        "999999999999": None,
        "soon": None,
        "": None,
        None: None,
    }
    found = values(
        spark, "string", cases, lambda c: epoch_to_timestamp(c).cast("timestamp_ntz")
    )
    assert found == list(cases.values())


def test_epoch_integral_is_the_same(spark):
    seconds = [0, 1757700800, -1, 253402300800, None]
    parsed = values(spark, "bigint", seconds, lambda c: F.unix_micros(epoch_to_timestamp(c)))
    direct = values(spark, "bigint", seconds, lambda c: F.unix_micros(epoch_to_timestamp(c, True)))
    assert parsed == direct == [0, 1757700800000000, -1000000, None, None]


@pytest.mark.parametrize(
    ("utc", "paris"),
    [
        (dt.datetime(2025, 1, 15, 12), dt.datetime(2025, 1, 15, 13)),
        (dt.datetime(2025, 7, 15, 12), dt.datetime(2025, 7, 15, 14)),
        (dt.datetime(2025, 3, 30, 0, 59), dt.datetime(2025, 3, 30, 1, 59)),
        (dt.datetime(2025, 3, 30, 1, 0), dt.datetime(2025, 3, 30, 3, 0)),
        (dt.datetime(2025, 10, 26, 1, 30), dt.datetime(2025, 10, 26, 2, 30)),
    ],
)
def test_paris_and_back(spark, utc, paris):
    (there,) = values(
        spark, "timestamp_ntz", [utc], lambda c: paris_wall_clock(c.cast("timestamp"))
    )
    (back,) = values(
        spark, "timestamp_ntz", [paris], lambda c: paris_to_instant(c).cast("timestamp_ntz")
    )
    assert there == paris
    assert back == utc


def test_repeated_and_missing_hour(spark):
    local = [dt.datetime(2025, 10, 26, 2, 30), dt.datetime(2025, 3, 30, 2, 30)]
    found = values(
        spark, "timestamp_ntz", local, lambda c: paris_to_instant(c).cast("timestamp_ntz")
    )
    # The repeated hour is winter time; the missing hour moves forward.
    assert found == [dt.datetime(2025, 10, 26, 1, 30), dt.datetime(2025, 3, 30, 1, 30)]


def test_prepare_pins_the_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    prepare(spark)
    instant = F.timestamp_seconds(F.lit(1757700800))
    (row,) = spark.range(1).select(paris_wall_clock(instant)).collect()
    assert row[0] == dt.datetime(2025, 9, 12, 20, 13, 20)


def test_start_of_unit(spark):
    found = values(spark, "bigint", [119, 60, -1, None], lambda c: start_of(c, 60))
    assert found == [60, 60, -60, None]


def test_plus_seconds(spark):
    moment = dt.datetime(2025, 9, 12, 10, 5, 59, 999999)
    later = values(spark, "timestamp_ntz", [moment], lambda c: plus_seconds(c, F.lit(93600)))
    assert later == [moment + dt.timedelta(hours=26)]


def test_as_instant(spark):
    aware = dt.datetime(2025, 9, 12, 12, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    for given in ("2025-09-12 10:00:00", dt.datetime(2025, 9, 12, 10), aware):
        (row,) = spark.range(1).select(F.unix_seconds(as_instant(given))).collect()
        assert row[0] == 1757671200
    assert stamp(aware) == "20250912_120000"


def test_round2_rounds_the_scaled_binary_value(spark):
    inputs = [1.005, 2.675, -1.005, 0.125, -0.125, 5.0, None]
    assert values(spark, "double", inputs, round2) == [1.0, 2.68, -1.0, 0.13, -0.13, 5.0, None]


def test_percent_over_nothing(spark):
    (row,) = spark.range(0).agg(
        percent(F.count_if(F.col("id") > 0), F.count(F.lit(1))).alias("p")
    ).collect()
    assert row.p is None


def test_mean_of_delays_beyond_bigint_microseconds(spark):
    # 10^13 microseconds, 2 * 10^6 times: past 2^63 in one bigint sum.
    late = spark.range(2_000_000).select((F.lit(10_000_000_000_001)).alias("late"))
    (row,) = late.agg(*delay_totals(F.col("late"))).select(mean_minutes().alias("m")).collect()
    assert row.m == pytest.approx(10_000_000_000_001 / 6e7, rel=1e-15)


def test_negative_delays_with_fractions(spark):
    found = spark.createDataFrame([(-1_500_000,), (500_000,), (None,)], "late bigint")
    (row,) = found.agg(*delay_totals(F.col("late"))).select(mean_minutes().alias("m")).collect()
    assert row.m == -0.5 / 60


def test_snapshot_time(spark):
    paths = ["/x/avg_20250912_101500.csv", "/x/stamp=20250912_101500/part-0.csv", "/x/a.csv"]
    moment = dt.datetime(2025, 9, 12, 10, 15)
    assert values(spark, "string", paths, snapshot_time) == [moment, moment, None]


def test_point_text(spark):
    numbers = [7.0, 7.25, -0.0005, 100.0, 0.0, 43.123456789012345, None]
    found = values(spark, "double", numbers, plain_number)
    assert found == ["7", "7.25", "-0.0005", "100", "0", "43.123456789012344", None]
    df = spark.createDataFrame([(7.25, 43.5), (None, 43.5)], "lon double, lat double")
    points = [r[0] for r in df.select(wkt_point(F.col("lon"), F.col("lat"))).collect()]
    assert points == ["POINT (7.25 43.5)", None]


def test_missing_marks(spark):
    df = spark.createDataFrame([("NA", 1), ("None", 2), ("Nice", 3), (None, 4)], "a string, n int")
    assert [r.a for r in missing_to_null(df).orderBy("n").collect()] == [None, None, "Nice", None]
