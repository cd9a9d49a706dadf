import re

import pytest
from pyspark.sql import functions as F

from tests.helpers import at
from tests.test_daily import feeds_of, rows, write_timetable
from tramline import schemas
from tramline.plans.daily import run_daily
from tramline.sinks import export, versions
from tramline.sources import snapshots


def test_readers_keep_the_table_they_opened(spark, tmp_path):
    first = export.replace_table(spark.range(3), str(tmp_path), "t")
    opened = export.read_table(spark, str(tmp_path), "t")
    second = export.replace_table(spark.range(5), str(tmp_path), "t")
    assert (first.count(), opened.count(), second.count()) == (3, 3, 5)
    assert export.read_table(spark, str(tmp_path), "t").count() == 5
    assert versions.drop_superseded(spark, str(tmp_path), "t") == 1
    assert export.read_table(spark, str(tmp_path), "t").count() == 5
    assert len(list((tmp_path / "t").iterdir())) == 1


def test_a_killed_write_is_not_seen(spark, tmp_path, monkeypatch):
    export.replace_table(spark.range(3), str(tmp_path), "t")
    snapshot = spark.createDataFrame([(at(10), 1.0)], schemas.MINUTE_SNAPSHOT)
    export.write_snapshot(snapshot, str(tmp_path), "m", "20250912_100000")

    def killed(*args, **more):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", killed)
        for write in (
            lambda: export.replace_table(spark.range(9), str(tmp_path), "t"),
            lambda: export.write_snapshot(snapshot.union(snapshot), str(tmp_path), "m", "20250912_100000"),
            lambda: export.write_snapshot(snapshot, str(tmp_path), "m", "20250913_100000"),
        ):
            with pytest.raises(KeyboardInterrupt):
                write()
    assert export.read_table(spark, str(tmp_path), "t").count() == 3
    glob = export.snapshot_glob(str(tmp_path), "m")
    for same in (False, True):
        found = snapshots.read_snapshots(spark, glob, schemas.MINUTE_SNAPSHOT, same_header=same)
        assert [r.snapshot_ts_temps for r in found.collect()] == [at(10)]
    with pytest.raises(FileNotFoundError):
        export.read_table(spark, str(tmp_path), "none")


def test_a_run_repeated_under_its_label_leaves_earlier_answers_readable(spark, tmp_path):
    write_timetable(tmp_path / "gtfs")
    runs = [
        run_daily(
            spark,
            str(tmp_path / "gtfs"),
            *feeds_of(spark, late),
            str(tmp_path / "warehouse"),
            str(tmp_path / "exports"),
            stamp="20250912_100000",
            as_of="2025-09-13 12:00:00",
            watched_stops=("s2",),
        )
        for late in (120, 600)
    ]
    assert rows(runs[0]["avg_delay_by_route"]) == [("r1", 1.0)]
    assert rows(runs[0]["punctuality_rate"]) == [(2, 2, 100.0)]
    assert rows(runs[0]["evolution_delay_by_stop_Q7"]) == [("s2", "Two", 43.6, 7.25, at(10), 2.0)]
    assert rows(runs[1]["avg_delay_by_route"]) == [("r1", 5.0)]
    # The history holds the run once, as it was written last.
    assert rows(runs[1]["evolution_delay_by_stop_Q7"]) == [("s2", "Two", 43.6, 7.25, at(10), 10.0)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_own_history_is_one_scan_of_the_text(spark, tmp_path, monkeypatch):
    rows_ = spark.createDataFrame([("1", "A", 43.5, 7.25, 1.5)], schemas.STOP_SNAPSHOT)
    export.write_snapshot(rows_, str(tmp_path), "s", "20250912_100000")
    turned = rows_.select(*reversed(rows_.columns), F.lit("x").alias("note"))
    export.write_snapshot(turned, str(tmp_path), "s", "20250913_100000")

    def refused(*args):
        raise AssertionError("headers are known")

    monkeypatch.setattr(snapshots, "file_headers", refused)
    glob = export.snapshot_glob(str(tmp_path), "s")
    found = snapshots.read_snapshots(spark, glob, schemas.STOP_SNAPSHOT)
    assert len(re.findall("FileScan csv", plan_of(found))) == 1
    assert not re.findall("FileScan text", plan_of(found))
    assert {tuple(r) for r in found.drop("filename").collect()} == {
        ("1", "A", 43.5, 7.25, 1.5, None, at(10)),
        ("1", "A", 43.5, 7.25, 1.5, "x", at(10).replace(day=13)),
    }
    # Only the columns of the snapshots asked for.
    one = snapshots.read_snapshots(spark, export.snapshot_glob(str(tmp_path), "s", "20250912*"), schemas.STOP_SNAPSHOT)
    assert "note" not in one.columns


def test_remembered_headers_of_files_from_elsewhere(spark, tmp_path, monkeypatch):
    for day, text in {
        12: "stop_id,avg_delay_min\n1,1.5\n",
        13: 'avg_delay_min,"stop, name",stop_id\n2.5,"a ""b""",1\n',
        14: "stop_id\n",
    }.items():
        (tmp_path / f"old file_202509{day}_100000.csv").write_text(text)
    glob, kept = f"{tmp_path}/old file_*.csv", f"{tmp_path}/headers"
    plain = snapshots.read_snapshots(spark, glob, schemas.STOP_SNAPSHOT).collect()
    snapshots.remember_headers(spark, glob, kept)

    def refused(*args):
        raise AssertionError("headers are remembered")

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "file_headers", refused)
        found = snapshots.read_snapshots(spark, glob, schemas.STOP_SNAPSHOT, headers=kept)
        assert sorted(found.collect(), key=str) == sorted(plain, key=str)
    assert {(r.stop_id, r["stop, name"], r.avg_delay_min) for r in plain} == {
        ("1", 'a "b"', 2.5),
        ("1", None, 1.5),
    }
    # A file that came later is read for its header.
    (tmp_path / "old file_20250915_100000.csv").write_text("avg_delay_min,stop_id\n9,7\n")
    more = snapshots.read_snapshots(spark, glob, schemas.STOP_SNAPSHOT, headers=kept)
    assert more.filter("stop_id = 7").first().avg_delay_min == 9.0


def test_ten_thousand_small_files(spark, tmp_path):
    """Two writes with headers of their own, 250 runs of 40 files."""
    headers = ["stop_id,stop_name,avg_delay_min", "avg_delay_min,note,stop_id"]
    rows_ = ["{id},n,{delay}\n", "{delay},x,{id}\n"]
    writes = []
    for header in headers:
        writes.append(versions.new_write(spark, str(tmp_path), "s"))
        versions.commit(spark, str(tmp_path), "s", writes[-1], header.split(","))
    for n in range(10_000):
        run, late = n % 250, n % 250 % 2
        folder = tmp_path / "s" / f"stamp=20250912_{run // 60:02d}{run % 60:02d}00" / f"write={writes[late]}"
        folder.mkdir(parents=True, exist_ok=True)
        lines = [rows_[late].format(id=4 * n + k, delay=(4 * n + k) / 8) for k in range(4)]
        (folder / f"part-{n}.csv").write_text(headers[late] + "\n" + "".join(lines))
    found = snapshots.read_snapshots(spark, export.snapshot_glob(str(tmp_path), "s"), schemas.STOP_SNAPSHOT)
    total = found.agg(
        F.count("*"), F.sum("avg_delay_min"), F.count_distinct("stop_id"), F.count_distinct("snapshot_ts_temps"),
        F.count("note"),
    ).first()
    assert tuple(total) == (40_000, 40_000 * 39_999 / 16, 40_000, 250, 20_000)
