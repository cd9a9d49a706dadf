"""Chat formatting: tool calls linked to their results, in order, as canonical JSON.

Calls and results are joined by conversation and identifier. A call may name calls it depends
on; its level is one more than the highest level among them, so an order by (level, turn) is
topological. Levels are found by peeling calls whose dependencies all have one, inside one task
for a conversation of up to `TOGETHER` calls. In larger ones the calls that wait for one call only
are chains, whose lengths pointer doubling finds in rounds that grow with the logarithm of the
longest; the calls left then wait for ends of chains, and the same is done with them until none is
left. So rounds grow with how often chains meet one after the other (in each call, if each waits
for the last two), not with levels. Arguments are checked against the schema of the called tool.
Each call, with its results, becomes one line of JSON with sorted keys, no spare white space and
shortest numbers.

Defined cases: a call without a result has `status` "pending"; a result without a call "orphan";
a null identifier links to nothing. Of calls that share an identifier the first by turn is the
call and the others are "duplicate"; all results of an identifier are listed by turn. Dependencies
that name no call are ignored; calls on a cycle have level -1 and come last. Arguments that are
no JSON object, or break the schema, leave `valid` false; a tool without schema accepts any
object. Empty tables give an empty result. Very long arguments and results are held whole with their
call; other columns are not read.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.tables import join_same, stored

TOGETHER = 20_000

_TYPES = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool)
    or isinstance(v, float) and v.is_integer(),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "null": lambda v: v is None,
}


def violations(value: object, schema: dict, where: str = "$") -> list[str]:
    """What in `value` breaks the JSON schema: types, enums, bounds, members and items."""
    kinds = schema.get("type")
    if kinds is not None:
        allowed = kinds if isinstance(kinds, list) else [kinds]
        if not any(_TYPES[kind](value) for kind in allowed):
            return [f"{where}: not of type {'/'.join(allowed)}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{where}: not one of the allowed values")
    if "const" in schema and value != schema["const"]:
        found.append(f"{where}: not the constant")
    if isinstance(value, str):
        found += _bounds(len(value), schema, "minLength", "maxLength", where)
        if "pattern" in schema and not re.search(schema["pattern"], value):
            found.append(f"{where}: does not match the pattern")
    elif isinstance(value, (int, float)) and not isinstance(value, bool):
        found += _bounds(value, schema, "minimum", "maximum", where)
    elif isinstance(value, list):
        found += _bounds(len(value), schema, "minItems", "maxItems", where)
        for n, item in enumerate(value):
            found += violations(item, schema.get("items", {}), f"{where}[{n}]")
    elif isinstance(value, dict):
        members = schema.get("properties", {})
        found += [f"{where}.{k}: missing" for k in schema.get("required", ()) if k not in value]
        for key, item in value.items():
            if key in members:
                found += violations(item, members[key], f"{where}.{key}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{where}.{key}: not expected")
    return found


def _bounds(size: float, schema: dict, least: str, most: str, where: str) -> list[str]:
    if least in schema and size < schema[least]:
        return [f"{where}: below {least}"]
    if most in schema and size > schema[most]:
        return [f"{where}: above {most}"]
    return []


def _plain(value: object) -> object:
    """Whole floats as integers, as JSON does not tell them apart."""
    if isinstance(value, float) and math.isfinite(value) and value.is_integer():
        return int(value)
    if isinstance(value, dict):
        return {key: _plain(item) for key, item in value.items()}
    if isinstance(value, list):
        return [_plain(item) for item in value]
    return value


def canonical(value: object) -> str:
    return json.dumps(
        _plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False
    )


def _refuse(constant: str):
    raise ValueError(f"{constant} is not JSON")


def parse(arguments: str | None) -> tuple[object, bool]:
    """(value, whether it is a JSON object); what is no JSON stays text."""
    try:
        value = json.loads(arguments or "", parse_constant=_refuse)
    except (ValueError, RecursionError):
        return arguments, False
    return value, isinstance(value, dict)


def _peel(calls: list[tuple]) -> list[int]:
    """Levels of (call_id, depends_on) of one conversation; -1 on cycles and behind them."""
    known = {call for call, _ in calls}
    open_deps, users = {}, {}
    for call, deps in calls:
        named = known.intersection(deps or ())
        open_deps[call] = len(named)
        for dep in named:
            users.setdefault(dep, []).append(call)
    level = {}
    ready = [call for call, count in open_deps.items() if not count]
    depth = 0
    while ready:
        level.update(dict.fromkeys(ready, depth))
        following = []
        for call in ready:
            for user in users.get(call, ()):
                open_deps[user] -= 1
                if not open_deps[user]:
                    following.append(user)
        ready, depth = following, depth + 1
    return [level.get(call, -1) for call, _ in calls]


def _peel_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Levels of rows (conv_id, call_id, depends_on) in order of the conversation."""
    current, calls = None, []
    for batch in batches:
        kinds = [batch.schema.field(n).type for n in (0, 1)]
        done: list[tuple] = []
        for conv, call, deps in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if calls and conv != current:
                done.append((current, calls))
                calls = []
            current = conv
            calls.append((call, deps))
        if done:
            yield _levels_batch(done, kinds)
    if calls:
        yield _levels_batch([(current, calls)], kinds)


def _levels_batch(done: list[tuple], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([conv for conv, calls in done for _ in calls], kinds[0]),
            pa.array([call for _, calls in done for call, _ in calls], kinds[1]),
            pa.array([level for _, calls in done for level in _peel(calls)], pa.int32()),
        ],
        names=["conv_id", "call_id", "level"],
    )


def _contract_chains(nodes: DataFrame) -> DataFrame:
    """The same levels over any number of calls, by chains.

    An edge leads from a call to one it waits for, or to null, the start of all, with the most
    levels between them. A call with one edge is a link of a chain.
    """
    key = ["conv_id", "call_id"]
    named = nodes.select(*key, F.explode_outer("depends_on").alias("dep"))
    callee = nodes.select("conv_id", F.col("call_id").alias("dep"))
    known = join_same(
        named.filter("dep is not null").distinct(), callee, ["conv_id", "dep"], "left_semi"
    ).withColumn("far", F.lit(1).cast("long"))
    known = stored(known, "call-edges")
    starts = join_same(nodes.select(*key), known.select(*key).distinct(), key, "left_anti")
    none = F.lit(None).cast(nodes.schema["call_id"].dataType)
    starts = starts.select(*key, none.alias("dep"), F.lit(0).cast("long").alias("far"))
    edges = stored(known.unionByName(starts), "call-edges")
    rounds = []
    while True:
        waits = edges.groupBy(*key).agg(
            F.count("*").alias("n"), F.max("dep").alias("dep"), F.max("far").alias("far")
        )
        links = stored(waits.filter("n = 1").drop("n"), "call-links")
        count = links.count()
        if not count:
            break
        # After so many doublings only links on a cycle, or behind one, still lead to links.
        for _ in range(count.bit_length()):
            if _behind(links, links, "left_semi").isEmpty():
                break
            links = stored(_through(links, links), "call-links")
        rounds.append(links)
        rest = join_same(edges, links.select(*key), key, "left_anti")
        edges = stored(
            _through(rest, links).groupBy(*key, "dep").agg(F.max("far").alias("far")), "call-edges"
        )
    # What waits for several calls to the end is on a cycle or behind one.
    left = edges.select(*key).distinct().withColumn("level", F.lit(-1).cast("long"))
    levels = stored(left, "call-levels")
    for links in reversed(rounds):
        ends = levels.select(
            F.col("conv_id").alias("end_conv"), F.col("call_id").alias("end"), "level"
        )
        met = (F.col("conv_id").eqNullSafe(F.col("end_conv"))) & (F.col("dep") == F.col("end"))
        level = (
            F.when(F.col("dep").isNull(), F.col("far"))
            .when(F.col("level") >= 0, F.col("level") + F.col("far"))
            .otherwise(-1)
        )
        found = links.join(ends, met, "left").select(*key, level.alias("level"))
        levels = stored(levels.unionByName(found), "call-levels")
    return levels


def _behind(edges: DataFrame, links: DataFrame, how: str) -> DataFrame:
    """Edges with the link that starts where they lead to, if any."""
    after = links.toDF("link_conv", "link", "next", "farther")
    met = (F.col("conv_id").eqNullSafe(F.col("link_conv"))) & (F.col("dep") == F.col("link"))
    return edges.join(after, met, how)


def _through(edges: DataFrame, links: DataFrame) -> DataFrame:
    """Edges that lead to a link lead on to where it leads."""
    linked = F.col("link").isNotNull()
    return _behind(edges, links, "left").select(
        "conv_id",
        "call_id",
        F.when(linked, F.col("next")).otherwise(F.col("dep")).alias("dep"),
        (F.col("far") + F.when(linked, F.col("farther")).otherwise(0)).alias("far"),
    )


def call_levels(calls: DataFrame, together: int = TOGETHER) -> DataFrame:
    """(conv_id, call_id, level) of calls (conv_id, call_id, depends_on) with distinct keys."""
    kinds = [calls.schema[name].dataType.simpleString() for name in ("conv_id", "call_id")]
    schema = f"conv_id {kinds[0]}, call_id {kinds[1]}, level int"
    sizes = calls.groupBy("conv_id").count()
    large = stored(sizes.filter(F.col("count") > together).select("conv_id"), "large-conversations")
    nodes = calls.select("conv_id", "call_id", "depends_on")
    small = join_same(nodes, large, ["conv_id"], "left_anti")
    levels = (
        small.repartition("conv_id").sortWithinPartitions("conv_id").mapInArrow(_peel_sorted, schema)
    )
    if large.isEmpty():
        return levels
    rest = stored(join_same(nodes, large, ["conv_id"], "left_semi"), "large-calls")
    return levels.unionByName(_contract_chains(rest).selectExpr("conv_id", "call_id", "int(level) level"))


def _formatted(schemas: dict[str, dict]):
    names = ["valid", "message"]

    def line(name, call_id, arguments, status, results) -> tuple[bool, str]:
        message: dict = {"id": call_id, "status": status}
        valid = True
        if name is not None or arguments is not None:
            value, valid = parse(arguments)
            problems = violations(value, schemas.get(name, {})) if valid else ["$: not an object"]
            valid = not problems
            message["call"] = {"name": name, "arguments": value}
            if problems:
                message["problems"] = problems
        if results:
            message["results"] = [row["content"] for row in results]
        return valid, canonical(message)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(n).to_pylist() for n in range(5, 10)), strict=True)
            made = [line(*row) for row in rows]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in range(5)),
                 pa.array([m[0] for m in made], pa.bool_()),
                 pa.array([m[1] for m in made], pa.string())],
                names=[*batch.schema.names[:5], *names],
            )

    return run


def link_calls(
    calls: DataFrame, results: DataFrame, schemas: dict[str, dict], together: int = TOGETHER
) -> DataFrame:
    """(conv_id, call_id, level, turn, status, valid, message), one row per call or orphan.

    `calls`: conv_id, call_id, turn, name, arguments (JSON text), depends_on (array of call_ids).
    `results`: conv_id, call_id, turn, content. Order by (conv_id, level, turn) to read them.
    """
    key = ["conv_id", "call_id"]
    fields = F.struct("turn", "name", "arguments", "depends_on")
    linkable = calls.filter("call_id is not null and conv_id is not null")
    firsts = stored(
        linkable.groupBy(*key).agg(F.min(fields).alias("first")).select(*key, "first.*"), "calls"
    )
    answers = (
        results.filter("call_id is not null and conv_id is not null")
        .groupBy(*key)
        .agg(F.sort_array(F.collect_list(F.struct("turn", "content"))).alias("results"))
    )
    levels = call_levels(firsts, together)
    ordered = join_same(firsts, levels, key, "left")
    linked = ordered.join(answers, key, "full").select(
        *key,
        F.coalesce("level", F.lit(0)).alias("level"),
        F.coalesce("turn", F.col("results")[0]["turn"]).alias("turn"),
        "name",
        "arguments",
        F.when(F.col("turn").isNull() & F.col("level").isNull(), "orphan")
        .when(F.col("results").isNull(), "pending")
        .otherwise("answered")
        .alias("status"),
        "results",
    )
    none = F.lit(None).cast(linked.schema["results"].dataType)
    again = join_same(
        linkable.select(*key, fields.alias("own")).withColumn("own_turn", F.col("own.turn")),
        firsts.select(*key, fields.alias("first")),
        key,
        "inner",
    )
    # One row per call beyond the first; rows equal to the first count as often as they repeat.
    duplicates = _beyond_first(again, key, none)
    unlinked = calls.filter("call_id is null or conv_id is null").select(
        *key, F.lit(0).alias("level"), "turn", "name", "arguments",
        F.lit("pending").alias("status"), none.alias("results"),
    )
    strays = results.filter("call_id is null or conv_id is null").select(
        *key, F.lit(0).alias("level"), "turn", F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("arguments"), F.lit("orphan").alias("status"),
        F.array(F.struct("turn", "content")).alias("results"),
    )
    everything = linked.unionByName(duplicates).unionByName(unlinked).unionByName(strays)
    kinds = [everything.schema[name].dataType.simpleString() for name in (*key, "turn")]
    schema = (
        f"conv_id {kinds[0]}, call_id {kinds[1]}, level int, turn {kinds[2]}, status string, "
        "valid boolean, message string"
    )
    shaped = everything.select(
        *key, "level", "turn", "status", "name", F.col("call_id").cast("string").alias("id"),
        "arguments", F.col("status").alias("state"), "results",
    )
    return shaped.mapInArrow(_formatted(schemas), schema)


def _beyond_first(again: DataFrame, key: list[str], none: Column) -> DataFrame:
    shape = [
        *key, F.lit(0).alias("level"), F.col("own.turn").alias("turn"),
        F.col("own.name").alias("name"), F.col("own.arguments").alias("arguments"),
        F.lit("duplicate").alias("status"), none.alias("results"),
    ]
    others = again.filter(~F.col("own").eqNullSafe(F.col("first"))).select(*shape)
    same = again.filter(F.col("own").eqNullSafe(F.col("first")))
    times = same.groupBy(*key, "own").agg(F.count("*").alias("times")).filter("times > 1")
    repeats = times.withColumn("n", F.explode(F.sequence(F.lit(2), F.col("times")))).select(*shape)
    return others.unionByName(repeats)
