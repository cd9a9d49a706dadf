import io
import zipfile

import pytest
from pyspark.sql import functions as F

from tests.helpers import at
from tramline import catalog, schemas, scratch
from tramline.sinks import export
from tramline.sources import archives, feeds, snapshots, timetable


def rows(df):
    return [tuple(r) for r in df.collect()]


STOP_TIMES = """trip_id,arrival_time,departure_time,stop_id,stop_sequence
A,08:00:00,08:00:30,s1,1
A,25:00:00,bad,s2,2
B,NA,08:00:00,s1,x
"""


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "stop_times.txt").write_text(STOP_TIMES)
    (tmp_path / "stops.txt").write_text(
        'stop_id,stop_name,stop_lat,stop_lon,zone\n001,"A ""quoted"", name",43.5,7.25,z\n002,B,north,,\n'
    )
    (tmp_path / "notes.md").write_text("not a table\n")
    return tmp_path


def test_text_load_takes_every_table(spark, folder):
    tables = timetable.load_timetable(spark, str(folder))
    assert sorted(tables) == ["stop_times", "stops"]
    assert rows(tables["stops"]) == [
        ("001", 'A "quoted", name', "43.5", "7.25", "z"),
        ("002", "B", "north", None, None),
    ]
    stop_times = tables["stop_times"].orderBy("trip_id", "arrival_time")
    assert rows(
        stop_times.select("stop_sequence", "arrival_time_sec", "departure_time_sec")
    ) == [(1, 28800, 28830), (2, 90000, None), (None, None, 28800)]


def test_typed_load(spark, folder):
    stops = timetable.load_timetable(spark, str(folder), timetable.TYPED_TABLES)["stops"]
    assert dict(stops.dtypes)["stop_lat"] == "double"
    assert rows(stops.select("stop_id", "stop_lat", "stop_lon", "zone")) == [
        ("001", 43.5, 7.25, "z"),
        ("002", None, None, None),
    ]


def test_quoted_line_break(spark, tmp_path):
    (tmp_path / "stops.txt").write_text('stop_id,stop_name\n1,"two\nlines"\n')
    table = timetable.read_text_table(spark, str(tmp_path / "stops.txt"), multiline=True)
    assert rows(table) == [("1", "two\nlines")]


def messages(spark):
    stop = [
        {"stop_id": "s1", "stop_sequence": 3, "arrival": {"time": 10}, "departure": None},
        {"stop_id": "", "stop_sequence": None, "arrival": {"time": None}, "departure": {"time": 7}},
    ]
    trip = {"trip_id": "A", "route_id": "", "direction_id": None}
    entities = [
        {"id": "1", "trip_update": {"trip": trip, "stop_time_update": stop}},
        {"id": "2", "trip_update": None},
        {"id": "3", "trip_update": {"trip": trip, "stop_time_update": []}},
    ]
    return spark.createDataFrame([(entities,)], schemas.TRIP_UPDATE_FEED)


def test_flatten_trip_updates(spark):
    assert rows(feeds.flatten_trip_updates(messages(spark))) == [
        ("A", None, None, "s1", 3, 10, None),
        ("A", None, None, None, 0, None, 7),
    ]


def test_flatten_vehicles(spark):
    position = {"latitude": 0.5, "longitude": None, "bearing": None, "speed": None}
    full = {
        "trip": {"trip_id": "A", "route_id": None},
        "stop_id": None,
        "position": position,
        "timestamp": 1757700800,
        "vehicle": {"id": ""},
    }
    bare = dict.fromkeys(full)
    entities = [{"id": "1", "vehicle": full}, {"id": "2", "vehicle": None}, {"id": "3", "vehicle": bare}]
    flat = feeds.with_vehicle_time(
        feeds.flatten_vehicle_positions(spark.createDataFrame([(entities,)], schemas.VEHICLE_FEED))
    )
    assert rows(flat.withColumn("timestamp_dt", F.unix_seconds("timestamp_dt"))) == [
        ("A", None, None, 0.5, None, None, None, 1757700800, None, 1757700800),
        (None,) * 10,
    ]


def test_feed_csv_with_decimal_epochs(spark, tmp_path):
    path = tmp_path / "trip_updates.csv"
    path.write_text(
        "trip_id,route_id,direction_id,stop_id,stop_sequence,arrival_time,departure_time\n"
        "A,r,,s1,1,1757700800.0,\nB,,1.0,NA,2,,1757700800\n"
    )
    found = feeds.read_trip_updates_csv(spark, str(path))
    assert rows(
        found.select(
            "trip_id", "route_id", "stop_id", "stop_sequence",
            F.unix_seconds("arrival_dt"), F.unix_seconds("departure_dt"),
        )
    ) == [("A", "r", "s1", 1, 1757700800, None), ("B", None, None, 2, None, 1757700800)]


def test_whole_numbers_in_decimal_text(spark):
    given = [("1757700800.0",), ("12.7",), ("9007199254740993.0",), ("-3.00",), ("1e3",), ("x",), ("7",), (None,)]
    text = spark.createDataFrame(given, "t string")
    found = text.select(feeds._number(F.col("t"), schemas.LONG)).collect()
    assert [r[0] for r in found] == [1757700800, None, 9007199254740993, -3, 1000, None, 7, None]


def test_vehicle_csv(spark, tmp_path):
    path = tmp_path / "vehicles.csv"
    path.write_text(
        "trip_id,route_id,stop_id,latitude,longitude,bearing,speed,timestamp,vehicle_id\n"
        "A,r,,43.5,7.25,,0.5,1757700800.0,v1\n"
    )
    (row,) = feeds.read_vehicle_positions_csv(spark, str(path)).collect()
    assert (row.trip_id, row.latitude, row.bearing, row.vehicle_id) == ("A", 43.5, None, "v1")
    assert row.timestamp_dt is not None


def zipped(tables):
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w") as archive:
        for name, text in tables.items():
            archive.writestr(name, text)
    return blob.getvalue()


def test_archives(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(
        zipped({"gtfs/stops.txt": '\ufeffstop_id,stop_name\n1,"x, y"\n\n2\nNA,"a ""b"""\n', "readme.md": "no"})
    )
    (tmp_path / "b.zip").write_bytes(
        zipped({"stops.txt": "stop_name,stop_id\nz,3\n", "empty.txt": ""})
    )
    found = archives.load_archives(spark, f"{tmp_path}/*.zip")
    assert list(found) == ["stops"]
    assert sorted(rows(found["stops"].select("stop_id", "stop_name")), key=str) == [
        ("1", "x, y"),
        ("2", None),
        ("3", "z"),
        (None, 'a "b"'),
    ]
    lines = archives.expand_archives(archives.read_archives(spark, f"{tmp_path}/b.zip"), ["stops"])
    picked = archives.archive_table(lines, "stops", ["stop_name,stop_id"], ["stop_id", "stop_lat"])
    assert rows(picked.drop("archive")) == [("3", None)]


def test_an_archive_loads_as_its_files_do(spark, tmp_path):
    text = STOP_TIMES + 'C,"q""x",1,NA,7:00:00,,\n\n'
    (tmp_path / "gtfs").mkdir()
    (tmp_path / "gtfs" / "stop_times.txt").write_text(text)
    shapes = "shape_id,note\n1," + "x" * 200_000 + "\n"
    (tmp_path / "g.zip").write_bytes(zipped({"stop_times.txt": text, "shapes.txt": shapes}))
    files = timetable.load_timetable(spark, str(tmp_path / "gtfs"))["stop_times"]
    tables = archives.load_archives(spark, f"{tmp_path}/*.zip")
    assert tables["stop_times"].columns == files.columns
    assert sorted(rows(tables["stop_times"]), key=str) == sorted(rows(files), key=str)
    assert len(tables["shapes"].first().note) == 200_000


def test_many_archive_lines_leave_in_batches(spark):
    text = "n\n" + "".join(f"{i}\n" for i in range(25_001))
    packed = spark.createDataFrame(
        [("a.zip", bytearray(zipped({"t.txt": text, "other.txt": "n\n1\n"})))],
        "path string, content binary",
    )
    table = archives.archive_table(archives.expand_archives(packed, ["t"]), "t", ["n"])
    assert table.agg(F.count("n"), F.sum(F.col("n").cast("int"))).collect()[0] == (
        25_001,
        25_000 * 25_001 // 2,
    )


def test_lines_cut_out_of_blocks_are_those_of_the_text(monkeypatch):
    monkeypatch.setattr(archives, "BLOCK_CHARS", 3)
    for end in ("\n", "\r\n", "\r"):
        for text in ("", "a", "a\n", "\n\na", "long line\n\nb\n \n", "é\x0bb\u2028c\nd\n\n"):
            content = text.replace("\n", end).encode("utf-8-sig")

            def opened(content=content):
                return io.TextIOWrapper(io.BytesIO(content), encoding="utf-8-sig")

            assert list(archives._lines(opened())) == [line.rstrip("\n") for line in opened()]


def test_lines_are_written_by_table_without_a_sort(spark, tmp_path):
    lines = [(f"a{n}.zip", f"t{n % 7}", "id", str(n)) for n in range(100)]
    table = spark.createDataFrame(lines, archives.LINES_SCHEMA)
    table.createOrReplaceTempView("lines_to_write")
    spark.sql("CREATE TABLE lines_by_table (archive string, header string, line string, table_name string)"
              f" USING parquet PARTITIONED BY (table_name) LOCATION '{tmp_path}'")  # fmt: skip
    try:
        plan = spark.sql(
            "EXPLAIN INSERT INTO lines_by_table SELECT archive, header, line, table_name FROM lines_to_write"
        ).first()[0]
    finally:
        spark.sql("DROP TABLE lines_by_table")
    assert "Sort" not in plan


def test_seven_tables_read_each_archive_once(spark, tmp_path):
    """What the file source gives is noted for each archive that a task asks for."""
    names = [f"t{n}" for n in range(7)]
    for n in range(3):
        tables = {f"{t}.txt": f"id,{t}\n{n},x\n" for t in names}
        (tmp_path / f"{n}.zip").write_bytes(zipped(tables))
    noted = str(tmp_path / "noted")

    def note(batches):
        for batch in batches:
            with open(noted, "a") as file:
                file.writelines(f"{path}\n" for path in batch.column(0).to_pylist())
            yield batch

    given = archives.read_archives(spark, f"{tmp_path}/*.zip")
    found = archives.archive_tables(given.mapInArrow(note, given.schema))
    assert sorted(found) == names
    for name in names:
        assert sorted(rows(found[name])) == [(str(n), "x") for n in range(3)]
    with open(noted) as file:
        assert len(file.readlines()) == 3


@pytest.mark.parametrize("kind", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2])
def test_members_in_many_parts(spark, monkeypatch, kind):
    text = "n,note\r\n" + "".join(f"{i},é{i * 7919 % 10007}\n" for i in range(30_000))
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w", kind) as archive:
        archive.writestr("deep/folder/t.txt", text)
        archive.writestr("head.txt", "a,b\n")
        archive.writestr("none.txt", "")
    packed = spark.createDataFrame([("a.zip", bytearray(blob.getvalue()))], "path string, content binary")
    monkeypatch.setattr(archives, "PART_BYTES", 1000)
    assert archives.archive_members(packed, ["t"]).count() > 1
    found = archives.archive_tables(packed)
    assert sorted(found) == ["head", "t"]
    assert found["head"].count() == 0 and found["head"].columns == ["a", "b"]
    total = found["t"].agg(F.count("*"), F.sum(F.col("n").cast("int")), F.count_distinct("note"))
    assert tuple(total.first()) == (30_000, 30_000 * 29_999 // 2, 10_007)


def test_feed_columns_are_taken_by_name(spark, tmp_path):
    (tmp_path / "u.csv").write_text(
        "route_id,trip_id,stop_sequence,stop_id,departure_time,arrival_time\n"
        '"R ""x"", y",A,1.0,s1,NaN,1757664000.0\n'
    )
    (row,) = feeds.read_trip_updates_csv(spark, str(tmp_path / "u.csv")).collect()
    assert (row.trip_id, row.route_id, row.direction_id) == ("A", 'R "x", y', None)
    assert (row.stop_sequence, row.arrival_time, row.departure_time) == (1, 1757664000, None)
    (tmp_path / "v.csv").write_text("trip_id,stop_id,arrival_time\nA,s1,1\n")
    with pytest.raises(ValueError, match="stop_sequence"):
        feeds.read_trip_updates_csv(spark, str(tmp_path / "v.csv"))


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "stops.txt").write_text('stop_id,stop_name\n1,"two\nlines"\n')
    table = timetable.load_timetable(spark, str(tmp_path), multiline=True)["stops"]
    assert rows(table) == [("1", "two\nlines")]


def test_quoted_line_breaks_in_archives(spark, tmp_path):
    text = 'stop_id,stop_name\n1,"two\n\nlines, ""so"""\n2,3" wide\n"4",\n\n5,"""open\n"\n'
    (tmp_path / "g.zip").write_bytes(zipped({"stops.txt": text}))
    (tmp_path / "stops.txt").write_text(text)
    whole = rows(archives.load_archives(spark, f"{tmp_path}/*.zip", multiline=True)["stops"])
    assert whole == rows(timetable.load_timetable(spark, str(tmp_path), multiline=True)["stops"])
    assert whole == [("1", 'two\n\nlines, "so"'), ("2", '3" wide'), ("4", None), ("5", '"open\n')]


def test_snapshots_with_drifting_headers(spark, tmp_path):
    (tmp_path / "avg_delay_by_stop_20250912_100000.csv").write_text(
        "stop_id,stop_name,stop_lat,stop_lon,avg_delay_min\n1,A,43.5,7.25,1.5\n"
    )
    (tmp_path / "avg_delay_by_stop_20250913_100000.csv").write_text(
        "avg_delay_min,stop_id,note\n2.5,1,late\n"
    )
    (tmp_path / "avg_delay_by_stop_final.csv").write_text("stop_id,avg_delay_min\n7,\n")
    (tmp_path / "other_20250913_100000.csv").write_text("x\n1\n")
    found = snapshots.read_snapshots(
        spark, f"{tmp_path}/avg_delay_by_stop_*.csv", schemas.STOP_SNAPSHOT
    )
    picked = found.select("stop_id", "stop_lat", "avg_delay_min", "note", "snapshot_ts_temps")
    assert sorted(rows(picked), key=str) == [
        ("1", 43.5, 1.5, None, at(10)),
        ("1", None, 2.5, "late", at(10).replace(day=13)),
        ("7", None, None, None, None),
    ]
    with pytest.raises(Exception):
        snapshots.read_snapshots(
            spark, f"{tmp_path}/avg_delay_by_stop_*.csv", schemas.STOP_SNAPSHOT, same_header=True
        ).collect()


def test_no_snapshots_yet(spark, tmp_path):
    found = snapshots.read_snapshots(spark, f"{tmp_path}/none_*.csv", schemas.MINUTE_SNAPSHOT)
    assert found.columns == ["minute_ts", "avg_delay_min", "filename", "snapshot_ts_temps"]
    assert found.count() == 0


def test_snapshot_date_range_by_name(spark, tmp_path):
    minutes = spark.createDataFrame([(at(10), 1.0)], schemas.MINUTE_SNAPSHOT)
    for day in (10, 12, 19, 22):
        export.write_snapshot(minutes, str(tmp_path), "m", f"202509{day}_100000")
    glob = export.snapshot_glob(str(tmp_path), "m", "2025091[2-9]*")
    for same in (False, True):
        found = snapshots.read_snapshots(spark, glob, schemas.MINUTE_SNAPSHOT, same_header=same)
        days = [r[0] for r in found.select(F.dayofmonth("snapshot_ts_temps")).collect()]
        assert sorted(days) == [12, 19]


def test_snapshot_written_again_replaces_itself(spark, tmp_path):
    for value in (1.0, 2.0):
        df = spark.createDataFrame([(at(10), value)], schemas.MINUTE_SNAPSHOT)
        export.write_snapshot(df, str(tmp_path), "m", "20250912_100000")
        export.write_snapshots(
            df.withColumn("stamp", F.lit("20250913_100000")), str(tmp_path), "m"
        )
    found = snapshots.read_snapshots(
        spark, export.snapshot_glob(str(tmp_path), "m"), schemas.MINUTE_SNAPSHOT
    )
    assert sorted(rows(found.select("avg_delay_min"))) == [(2.0,), (2.0,)]


def test_csv_text_of_times_and_missing_values(spark, tmp_path):
    df = spark.createDataFrame([(at(10), None, "")], "t timestamp_ntz, n int, s string")
    export.export_csv(df, str(tmp_path / "out"), one_file=True)
    (part,) = (tmp_path / "out").glob("part-*.csv")
    assert part.read_text() == 't,n,s\n2025-09-12 10:00:00,,""\n'


def test_replace_table(spark, tmp_path):
    for n in (3, 2):
        table = export.replace_table(spark.range(n).toDF("id"), str(tmp_path), "t")
    assert table.count() == export.read_table(spark, str(tmp_path), "t").count() == 2


def test_catalog(spark):
    df = spark.createDataFrame([(i, str(i)) for i in range(20)], "n int, s string")
    catalog.register({"numbers": df})
    assert "numbers" in catalog.table_names(spark)
    assert rows(catalog.describe(spark, "numbers")) == [("n", "int"), ("s", "string")]
    assert catalog.preview(df).count() == 10
    assert rows(catalog.row_count(df)) == [(20,)]
    assert catalog.drop_view(spark, "numbers")
    assert not catalog.drop_view(spark, "numbers")


def test_scratch_uses_the_folder_the_session_names(spark, tmp_path):
    key = scratch.SETTING
    before = spark.conf.get(key, None)
    assert scratch.new_folder(spark, "x") != scratch.new_folder(spark, "x")
    if before is None:
        assert scratch.shared_root(spark) == scratch.shared_root(spark)
