import json
import random

import duckdb
import pytest

from tests.check import connect, differences
from tramline.llm import queries, tool_calls

TABLES = "/root/testdata/sf0.01"
CALLS = "conv_id long, call_id string, turn long, name string, arguments string, depends_on array<string>, level string"
RESULTS = "conv_id long, call_id string, turn long, content string, status string"
SCHEMA = {
    "type": "object",
    "required": ["a"],
    "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": ["string", "null"]}},
    "additionalProperties": False,
}


def linked(spark, calls, results, together=100):
    frame = tool_calls.link_calls(
        spark.createDataFrame([(*c, "extra") for c in calls], CALLS),
        spark.createDataFrame([(*r, "extra") for r in results], RESULTS),
        {"f": SCHEMA},
        together,
    )
    rows = frame.collect()
    return sorted(rows, key=lambda r: (r.conv_id is None, r.conv_id, r.level, r.turn, r.message))


@pytest.mark.parametrize("together", [100, 1])
def test_order_links_and_validation(spark, together):
    calls = [
        (1, "c", 0, "f", '{"a": 3.0, "b": null}', ["b", "a"]),
        (1, "b", 2, "f", '{"a": -1}', ["a", "nobody"]),
        (1, "a", 4, "f", '{"b":"x"}', []),
        (1, "x", 5, "g", '{"z": [1, 2.50, "é"], "a": {"y": 1, "b": 2}}', ["y"]),
        (1, "y", 6, "g", "not json", ["x"]),
    ]
    results = [(1, "a", 9, "late"), (1, "a", 8, "soon"), (1, "q", 7, "stray")]
    rows = linked(spark, calls, results, together)
    assert [(r.call_id, r.level, r.status, r.valid) for r in rows] == [
        ("x", -1, "pending", True),
        ("y", -1, "pending", False),
        ("a", 0, "answered", False),
        ("q", 0, "orphan", True),
        ("b", 1, "pending", False),
        ("c", 2, "pending", True),
    ]
    assert rows[5].message == (
        '{"call":{"arguments":{"a":3,"b":null},"name":"f"},"id":"c","status":"pending"}'
    )
    assert json.loads(rows[2].message)["results"] == ["soon", "late"]
    assert json.loads(rows[2].message)["problems"] == ["$.a: missing"]
    assert json.loads(rows[0].message)["call"]["arguments"] == {"a": {"b": 2, "y": 1}, "z": [1, 2.5, "é"]}
    assert rows[0].message.index('"b":2') < rows[0].message.index('"y":1')


def test_nulls_duplicates_and_empty_tables(spark):
    calls = [
        (1, "a", 1, "f", '{"a":1}', None),
        (1, "a", 1, "f", '{"a":1}', None),
        (1, "a", 3, "f", '{"a":2}', None),
        (1, None, 2, "f", None, None),
        (None, "a", 2, None, None, None),
    ]
    results = [(1, None, 5, "r"), (None, "a", 6, "s"), (1, "a", 4, None)]
    rows = linked(spark, calls, results)
    found = sorted((r.status, str(r.conv_id), str(r.call_id), r.turn) for r in rows)
    assert found == [
        ("answered", "1", "a", 1),
        ("duplicate", "1", "a", 1),
        ("duplicate", "1", "a", 3),
        ("orphan", "1", "None", 5),
        ("orphan", "None", "a", 6),
        ("pending", "1", "None", 2),
        ("pending", "None", "a", 2),
    ]
    assert linked(spark, [], []) == []
    assert [r.status for r in linked(spark, [], [(1, "a", 1, "x")])] == ["orphan"]


def test_long_chain_in_one_task(spark):
    calls = [(1, f"c{n}", -n, "g", "{}", [f"c{n - 1}"]) for n in range(3000)]
    levels = {r.call_id: r.level for r in linked(spark, calls, [], 10_000)}
    assert levels == {f"c{n}": n for n in range(3000)}


def levels_of(spark, calls, together):
    frame = spark.createDataFrame(calls, "conv_id long, call_id string, depends_on array<string>")
    rows = tool_calls.call_levels(frame, together).collect()
    found = {(r.conv_id, r.call_id): r.level for r in rows}
    assert len(found) == len(rows) == len(calls)
    return found


def test_chain_well_over_the_bound(spark, monkeypatch):
    writes = []
    stored = tool_calls.stored

    def counted(frame, label):
        writes.append(label)
        assert len(writes) < 60
        return stored(frame, label)

    monkeypatch.setattr(tool_calls, "stored", counted)
    calls = [(1, f"c{n}", [f"c{n - 1}"]) for n in range(50_000)]
    found = levels_of(spark, calls, tool_calls.TOGETHER)
    assert found == {(1, f"c{n}"): n for n in range(50_000)}


def test_chains_that_meet_part_and_loop(spark):
    rng = random.Random(5)
    calls = [(1, f"c{n}", [f"c{n - 1}", f"c{n - 1 - n % 3}"]) for n in range(30)]
    calls += [(2, f"c{n}", [f"c{rng.randrange(60)}" for _ in range(n % 3)]) for n in range(50)]
    calls += [(3, f"c{n}", rng.sample([f"c{m}" for m in range(n)], min(n, n % 4))) for n in range(60)]
    calls += [(4, "a", ["c"]), (4, "b", ["a"]), (4, "c", ["b"]), (4, "d", ["c", "e"]), (4, "e", None)]
    calls += [(5, "a", ["a"]), (5, "b", ["a"]), (5, "c", [None, "gone"]), (5, "d", ["c", "c"])]
    assert levels_of(spark, calls, 1) == levels_of(spark, calls, 1000)


def test_violations():
    broken = tool_calls.violations
    assert broken({"a": 1}, SCHEMA) == []
    assert broken({"a": True}, SCHEMA) == ["$.a: not of type integer"]
    assert broken({"a": -1, "c": 1}, SCHEMA) == ["$.a: below minimum", "$.c: not expected"]
    assert broken([1, "x"], {"items": {"type": "number"}}) == ["$[1]: not of type number"]
    assert broken("abc", {"maxLength": 2, "pattern": "^b"}) == [
        "$: above maxLength", "$: does not match the pattern",
    ]
    assert broken(3, {"enum": [1, 2]}) == ["$: not one of the allowed values"]
    assert tool_calls.parse("NaN")[1] is False
    assert tool_calls.parse("[" * 100_000)[1] is False


def test_query_equals_its_sql(spark):
    name = "op3_tool_calls"
    found = differences(
        spark, connect(TABLES), TABLES, name, queries.queries()[name], queries.oracle_sql()[name]
    )
    assert found == []


def test_query_against_the_table(spark):
    rows = queries.op3_tool_calls(spark, TABLES).collect()
    turns = duckdb.sql(f"SELECT * FROM '{TABLES}/conversations.parquet'").fetchall()
    by_place = {(conv, turn): (role, text) for conv, turn, role, text in turns}
    users = [key for key, value in by_place.items() if value[0] == "user"]
    assert sorted((r.conv_id, r.turn) for r in rows if r.status != "orphan") == sorted(users)
    for row in rows:
        message = json.loads(row.message)
        assert row.message == json.dumps(
            message, sort_keys=True, separators=(",", ":"), ensure_ascii=False
        )
        role, text = by_place[row.conv_id, row.turn]
        if row.status == "orphan":
            assert role == "system" and message["results"] == [text]
            continue
        assert message["call"]["arguments"] == {"question": text, "n_chars": len(text)}
        assert row.valid == (1 <= len(text) <= 1000)
        answer = by_place.get((row.conv_id, row.turn + 1))
        assert message.get("results") == (
            [answer[1]] if answer and answer[0] == "assistant" else None
        )
        first = min(turn for conv, turn in users if conv == row.conv_id)
        assert row.level == (row.turn - first) // 2
