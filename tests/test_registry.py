import re
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import bench
from __spark_entry__ import entry
from tests.check import connect, differences
from tramline.plans.oracles import oracle_sql
from tramline.plans.registry import queries
from tramline.plans.roles import Roles

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_its_sql(spark, con, name):
    assert differences(spark, con, SMALL, name, queries()[name], oracle_sql()[name]) == []


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())
    assert set(bench.HEADLINE) <= set(queries())


def test_stop_runs_are_averaged_once(spark):
    runs = Roles(spark, SMALL)._stop_runs()
    assert "Aggregate" not in runs._jdf.queryExecution().optimizedPlan().toString()
    assert runs.groupBy("stamp", "stop_id").count().filter("count > 1").isEmpty()


def test_entry(spark):
    assert entry(spark).columns == ["route_id", "avg_delay_min"]


@pytest.mark.parametrize("without", [("tramline/llm",), ("tramline/llm", "corpus_pipeline.py")])
def test_the_rest_works_without_the_training_operators(tmp_path, without):
    root = Path(__file__).parent.parent
    copy = tmp_path / "copy"
    copy.mkdir()
    shutil.copytree(root / "tramline", copy / "tramline", ignore=shutil.ignore_patterns(
        "__pycache__", *(Path(p).name for p in without)))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in without and (root / name).exists():
            shutil.copy(root / name, copy / name)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True)
    assert done.stdout.split() == [str(len(queries()))] * 2, done.stderr


@pytest.mark.parametrize("name", ["trip_relative_delay", "avg_delay_by_minute", "avg_delay_by_stop",
                                  "vehicle_positions_with_delay", "static_tables_load"])
def test_plans_stay_in_the_jvm_and_read_few_columns(spark, name):
    plan = queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|MapInPandas|CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert "ReadSchema" in plan
    assert "departure" not in "".join(re.findall("ReadSchema: [^\n]*", plan)) or "static" in name


# One order, supplier, customer and user hold a third of all rows; some keys are missing.
SKEWED = {
    "lineitem": """SELECT * REPLACE (
        CASE WHEN hash(l_partkey + l_linenumber) % 3 = 0 THEN 77 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN hash(l_orderkey + l_linenumber) % 3 = 0 THEN 5 ELSE l_suppkey END AS l_suppkey,
        CASE WHEN hash(l_orderkey) % 9 = 0 THEN NULL ELSE l_partkey END AS l_partkey)""",
    "orders": """SELECT * REPLACE (
        CASE WHEN o_orderkey % 3 = 0 THEN 11 WHEN o_orderkey % 50 = 1 THEN NULL
             ELSE o_custkey END AS o_custkey)""",
    "events": """SELECT * REPLACE (
        CASE WHEN event_id % 3 = 0 THEN 77 WHEN event_id % 50 = 1 THEN NULL
             ELSE user_id END AS user_id,
        CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-05 10:00:00' ELSE ts END AS ts)""",
}


@pytest.fixture(scope="module")
def skewed_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = connect(SMALL)
    for path in Path(SMALL).glob("*.parquet"):
        select = SKEWED.get(path.stem, "SELECT *")
        con.execute(f"COPY ({select} FROM {path.stem}) TO '{folder}/{path.name}' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize(
    "name",
    [
        "trip_relative_delay",
        "service_day_delay",
        "avg_delay_by_minute",
        "avg_delay_by_stop",
        "route_delay_with_counts",
        "vehicle_positions_with_delay",
        "vehicle_route_delay_top20",
        "latest_vehicle_delays",
        "trips_plus_routes",
        "null_profile",
        "stop_delay_evolution_all",
    ],
)
def test_skewed_tables_with_missing_keys(spark, skewed_folder, name):
    con = connect(skewed_folder)
    found = differences(spark, con, skewed_folder, name, queries()[name], oracle_sql()[name])
    assert found == []
