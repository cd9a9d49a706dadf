import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import at, delay_events
from tramline import schemas
from tramline.operators.questions import average_delay_by_minute
from tramline.sinks import export, versions
from tramline.sources.files import matching_paths
from tramline.streaming import minutes
from tramline.streaming.minutes import append_minute_totals, streamed_delay_by_minute
from tramline.streaming.snapshots import append_history, stream_snapshots, streamed_history


def run(spark, schema, folder, files_per_batch):
    """Streams what is there and reads the averages."""
    source = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(f"{folder}/events")
    )
    append_minute_totals(source, f"{folder}/table", f"{folder}/state").awaitTermination()
    return streamed_delay_by_minute(spark, f"{folder}/table")


def test_any_batching_equals_the_batch_question(spark, tmp_path):
    events = [
        ("A", i, "s", at(8) + dt.timedelta(seconds=20 * i), 30 * i) for i in range(600)
    ] + [("A", 900, "s", None, 0)]
    delays = delay_events(spark, events)
    delays.repartition(9).write.parquet(f"{tmp_path}/events")
    expected = sorted(map(tuple, average_delay_by_minute(delays).collect()), key=str)
    found = run(spark, delays.schema, tmp_path, 1)
    assert sorted(map(tuple, found.collect()), key=str) == expected
    assert len(list((tmp_path / "table").glob("batch=*"))) == 9


def test_restarts_add_late_events(spark, tmp_path):
    for step, hour in enumerate((11, 8, 8)):
        delay_events(spark, [("A", step, "s", at(hour), 60 * step)]).write.mode("append").parquet(
            f"{tmp_path}/events"
        )
        found = run(spark, delay_events(spark, []).schema, tmp_path, 1)
    assert {tuple(r) for r in found.collect()} == {(at(13), 0.0), (at(10), 1.5)}


def test_each_snapshot_is_read_once(spark, tmp_path):
    rows = [("1", "A", 43.5, 7.25, 1.5)]
    snapshot = spark.createDataFrame(rows, schemas.STOP_SNAPSHOT)
    for day in (12, 13):
        export.write_snapshot(snapshot, str(tmp_path), "stops", f"202509{day}_100000")
        stream = stream_snapshots(
            spark, export.snapshot_glob(str(tmp_path), "stops"), schemas.STOP_SNAPSHOT
        )
        append_history(stream, f"{tmp_path}/table", f"{tmp_path}/state").awaitTermination()
    table = spark.read.parquet(f"{tmp_path}/table")
    found = [(r.stop_id, r.snapshot_ts_temps.day) for r in table.collect()]
    assert sorted(found) == [("1", 12), ("1", 13)]


def test_files_with_other_headers_are_united(spark, tmp_path):
    snapshot = spark.createDataFrame([("1", "A", 43.5, 7.25, 1.5)], schemas.STOP_SNAPSHOT)
    turned = snapshot.select(*reversed(snapshot.columns), F.lit("x").alias("note"))
    for day, rows in ((12, snapshot), (13, turned), (14, snapshot.limit(0))):
        export.write_snapshot(rows, str(tmp_path), "stops", f"202509{day}_100000")
    stream = stream_snapshots(
        spark, export.snapshot_glob(str(tmp_path), "stops"), schemas.STOP_SNAPSHOT, files_per_batch=1
    )
    append_history(stream, f"{tmp_path}/table", f"{tmp_path}/state").awaitTermination()
    found = streamed_history(spark, f"{tmp_path}/table").collect()
    assert sorted((r.stop_id, r.stop_lat, r.avg_delay_min, r.note or "") for r in found) == [
        ("1", 43.5, 1.5, ""),
        ("1", 43.5, 1.5, "x"),
    ]


def averages(spark, table):
    return {tuple(r) for r in streamed_delay_by_minute(spark, table).collect()}


def opened(spark, table):
    return len(streamed_delay_by_minute(spark, table).inputFiles())


def test_a_thousand_batches_are_read_from_few_files(spark, tmp_path):
    table = str(tmp_path)
    totals = spark.range(1000).select(
        (F.col("id") % 7).alias("utc_minute"), F.col("id").alias("sum_sec"),
        F.lit(0).cast("long").alias("sum_us"), F.lit(1).cast("long").alias("n_delay"),
        F.col("id").alias("batch"),
    )
    totals.repartition(8, "batch").write.partitionBy("batch").mode("append").parquet(table)
    marks = tmp_path / versions.MARKS / minutes.BATCHES
    marks.mkdir(parents=True)
    for number in range(1000):
        (marks / f"{number:012d}.json").write_text("{}")
    known = averages(spark, table)
    assert len(known) == 7
    assert minutes.merge_batches(spark, table) == 1000
    assert averages(spark, table) == known
    assert opened(spark, table) <= 8
    # The folders stay for readers until the next merge.
    assert len(matching_paths(spark, f"{table}/batch=*")) == 1000
    minutes.add_batch(delay_events(spark, [("A", 1, "s", at(8), 60)]), 1000, table)
    assert minutes.merge_batches(spark, table) == 1
    assert len(matching_paths(spark, f"{table}/batch=*")) == 1
    assert len(averages(spark, table)) == 8
    assert minutes.merge_batches(spark, table) == 0


@pytest.mark.parametrize("broken", ["commit", "new_write", "drop_superseded"])
def test_a_broken_merge_loses_and_doubles_nothing(spark, tmp_path, monkeypatch, broken):
    table = str(tmp_path)

    def add(number, late):
        minutes.add_batch(delay_events(spark, [("A", 1, "s", at(8), late)]), number, table)

    for number in range(3):
        add(number, 60 * number)
    assert averages(spark, table) == {(at(10), 1.0)}

    def killed(*args, **more):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(versions, broken, killed)
        with pytest.raises(KeyboardInterrupt):
            minutes.merge_batches(spark, table)
    assert averages(spark, table) == {(at(10), 1.0)}
    # The batch whose end was not noted is run again, and so is the merge.
    add(2, 120)
    assert averages(spark, table) == {(at(10), 1.0)}
    minutes.merge_batches(spark, table)
    add(3, 300)
    minutes.merge_batches(spark, table)
    add(3, 300)
    assert averages(spark, table) == {(at(10), 2.0)}
    assert opened(spark, table) == 1


def test_batches_are_merged_as_they_come(spark, tmp_path):
    table = str(tmp_path)
    for number in range(7):
        minutes.add_batch(
            delay_events(spark, [("A", 1, "s", at(8), 60 * number)]), number, table, merge_every=3
        )
    assert averages(spark, table) == {(at(10), 3.0)}
    assert minutes._merged(spark, table)[1] == 5
    assert opened(spark, table) == 2
