import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tests.llm.helpers import AWKWARD, collected, documents
from tramline.llm import components as linking
from tramline.llm import queries, simhash_anchors
from tramline.llm.components import components

TABLES = "/root/testdata/sf0.01"


def fingerprint(text):
    """Straight from the definition."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[n : n + 3]) for n in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(bits):
    """By comparing all pairs."""
    top = {n: n for n in bits}

    def find(n):
        while top[n] != n:
            n = top[n]
        return n

    ids = sorted(bits)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (bits[a] ^ bits[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {n: find(n) for n in ids}


def test_query_equals_all_pairs(spark):
    found = collected(queries.op8_simhash_near_dedup(spark, TABLES))
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{TABLES}/documents.parquet'").fetchall())
    bits = {n: fingerprint(text) for n, text in texts.items()}
    assert {n: r.fingerprint for n, r in found.items()} == {n: f"{b:016x}" for n, b in bits.items()}
    assert {n: r.component_id for n, r in found.items()} == smallest_reachable(bits)


def test_near_fingerprints_share_an_anchor():
    chance = random.Random(4)
    for _ in range(300):
        one = chance.getrandbits(64)
        other = one
        for bit in chance.sample(range(64), chance.randrange(3)):
            other ^= 1 << bit
        pair = np.array([one, other], np.uint64).view(np.int64)
        keys = [set(simhash_anchors.anchors(pair[n : n + 1])[0].tolist()) for n in (0, 1)]
        assert keys[0] & keys[1]
        assert all(2 <= len(k) <= 32 for k in keys)


def dense(n):
    """Fingerprints around one centre, chains away from it, and strangers."""
    chance = random.Random(n)
    centre = chance.getrandbits(64)
    found = {centre}
    for _ in range(n):
        value = centre
        for bit in chance.sample(range(64), chance.randrange(1, 5)):
            value ^= 1 << bit
        found.add(value)
    at = chance.getrandbits(64)
    for _ in range(20):
        at ^= 1 << chance.randrange(64)
        found.add(at)
    return sorted(found | {chance.getrandbits(64) for _ in range(50)})


@pytest.mark.parametrize("crowd", [2, 8, 64])
def test_crowded_anchors_lose_no_link(spark, crowd):
    values = dense(300)
    rows = [(simhash_anchors._signed(v),) for v in values]
    found = simhash_anchors.links(spark.createDataFrame(rows, "bits long").repartition(3), crowd=crowd)
    pairs = [(r.a & (2**64 - 1), r.b & (2**64 - 1)) for r in found.collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in pairs)
    number = {v: n for n, v in enumerate(values)}
    linked = spark.createDataFrame([(number[a], number[b]) for a, b in pairs], "a long, b long")
    roots = {r.node: r.root for r in components(linked).collect()}
    expected = smallest_reachable(dict(enumerate(values)))
    assert {n: roots.get(n, n) for n in expected} == expected


def test_components_of_long_chains(spark):
    chance = random.Random(9)
    chain = [(n, n + 1) for n in range(200)] + [(500, 500), (600, 601), (601, 600), (-7, 600)]
    chance.shuffle(chain)
    found = components(spark.createDataFrame(chain, "a long, b long").repartition(5))
    expected = {n: 0 for n in range(1, 201)} | {600: -7, 601: -7}
    assert {r.node: r.root for r in found.collect()} == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("hubs", [2, 40])
def test_hubs_and_other_nodes_keep_their_links(spark, monkeypatch, hubs):
    monkeypatch.setattr(linking, "HUBS", hubs)
    chance = random.Random(hubs)
    # Two hubs of leaves, joined by a path, beside small groups.
    links = [(1000, n) for n in range(300)] + [(1001, n) for n in range(400, 700)]
    links += [(299, 800), (800, 801), (801, 400)]
    links += [(2000 + 3 * n + k, 2000 + 3 * n) for n in range(30) for k in (1, 2)]
    chance.shuffle(links)
    found = components(spark.createDataFrame(links, "a long, b long").repartition(6))
    expected = {n: 0 for pair in links for n in pair if 0 < n < 2000}
    expected |= {2000 + 3 * n + k: 2000 + 3 * n for n in range(30) for k in (1, 2)}
    assert {r.node: r.root for r in found.collect()} == expected


def test_full_tables_of_nodes_are_handed_on(monkeypatch):
    chance = random.Random(3)
    links = [(chance.randrange(200), chance.randrange(200)) for _ in range(150)]
    batches = [
        pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in links[at : at + 10]])
        for at in range(0, len(links), 10)
    ]
    monkeypatch.setattr(linking, "NODES", 15)
    stars = [
        pair for batch in linking._contract(iter(batches))
        for pair in zip(*(column.to_pylist() for column in batch.columns), strict=True)
    ]

    def classes(pairs):
        top = {n: n for n in range(200)}
        for _ in range(200):
            for a, b in pairs:
                top[a] = top[b] = min(top[a], top[b])
        return top

    assert classes(stars) == classes(links)
    assert len(stars) <= len(links)


def test_awkward_rows(spark):
    docs = documents(spark, [*AWKWARD, "two words", "TWO words", "é" * 10], first_id=10)
    found = collected(simhash_anchors.near_duplicates(docs))
    for row in docs.collect():
        assert found[row.doc_id].fingerprint == f"{fingerprint(row.text):016x}"
    assert [found[n].component_id for n in (10, 11, 12)] == [10, 10, 10]
    assert found[17].component_id == found[18].component_id == 17
    kept = simhash_anchors.one_of_each(docs.union(docs))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.component_id for r in found.values()})
    assert simhash_anchors.near_duplicates(docs.limit(0)).count() == 0


def test_long_texts_are_counted_in_blocks(monkeypatch):
    text = " ".join(f"w{n % 97} v{n % 89}" for n in range(900)).encode()
    whole = simhash_anchors.simhash(text)
    monkeypatch.setattr(simhash_anchors, "BLOCK", 7)
    assert simhash_anchors.simhash(text) == whole == fingerprint(text.decode())
