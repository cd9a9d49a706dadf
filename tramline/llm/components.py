"""Connected components of links between long integers, by star contraction.

A node with many links (a hub) is the key of all of them. Smallest neighbours are found with partial
aggregation; they reach the links of hubs by broadcast, as fewer than `HUBS` nodes can hold more than
one link in `HUBS`, and all other links by a join in which no key holds more than that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.tables import stored

LINKS = "a long, b long"
HUBS = 4096
# Nodes that a task holds at once.
NODES = 1_000_000


def join_hubs(rows: DataFrame, groups: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join of rows with the one row of their group; `times` says how many rows it has.

    The `times` of all groups add up to `total`, so fewer than `HUBS` of them have more than
    total / HUBS rows. Those are sent to every task, and their rows stay where they are.
    """
    hub = F.col("times") * HUBS > total
    large, small = (groups.filter(kind).drop("times") for kind in (hub, ~hub))
    there = rows.join(F.broadcast(large), key)
    others = rows.join(F.broadcast(large.select(key)), key, "left_anti")
    return there.unionByName(others.join(small, key))


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one partition as stars around the smallest node; never more than came in."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        top = node
        while parent.get(top, top) != top:
            top = parent[top]
        while node != top:
            parent[node], node = top, parent.get(node, top)
        return top

    def stars() -> Iterator[pa.RecordBatch]:
        nodes = np.fromiter(parent, np.int64, len(parent))
        roots = np.fromiter(map(root, parent), np.int64, len(parent))
        apart = nodes != roots
        for at in range(0, int(apart.sum()), 50_000):
            part = slice(at, at + 50_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[apart][part]), pa.array(roots[apart][part])], names=["a", "b"]
            )

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = root(a), root(b)
            low, high = min(x, y), max(x, y)
            parent.setdefault(low, low)
            parent[high] = low
        if len(parent) > NODES:
            yield from stars()
            parent.clear()
    yield from stars()


def _large_star(links: DataFrame, count: int) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(
        F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("times")
    )
    moved = join_hubs(both, least, "a", 2 * count).filter("b > a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(links: DataFrame, count: int) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them; links go from large to small."""
    least = links.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("times"))
    moved = join_hubs(links, least, "a", count).filter("b <> m")
    return (
        moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", F.col("m").alias("b")))
        .distinct()
    )


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for each node with a link to another one.

    `links` has two long columns. Each round halves the depth of the trees at least and is
    written to the shared folder, so the lineage stays short. Loops and repeated links do
    not matter; nodes without a link to another node are left out.
    """
    a, b = links.columns
    current = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    current = stored(current.filter("a <> b").mapInArrow(_contract, LINKS), "links")
    state = _state(current)
    while True:
        current = stored(_large_star(current, state[0]), "links")
        current = stored(_small_star(current, current.count()), "links")
        before, state = state, _state(current)
        if state == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
