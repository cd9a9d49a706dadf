import hashlib
import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import AWKWARD, EXTRA, documents
from tramline.llm import paragraph_sketch, queries

SMALL = "/root/testdata/sf0.001"


def brute_force(docs):
    """(doc_id, n_chars, edited digest, likenesses) by whole sets, in descending order of id."""
    order = sorted(docs, reverse=True)
    for n, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(n + 1) % len(order)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        near = [
            likeness(set(paragraph_sketch.digests(text).tolist()),
                     set(paragraph_sketch.digests(other).tolist()))
            for other in (changed, following)
        ]
        yield doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), *near


def likeness(one, other):
    return len(one & other) / len(one | other) if one | other else 1.0


def answer(row):
    return row.doc_id, row.n_chars, row.edited_sha256, row.near_edited, row.near_next


def test_peeling_recovers_the_difference():
    random = np.random.default_rng(5)
    for size in (0, 1, 3, 40, 400):
        shared, one, other = (random.integers(0, 1 << 63, n, np.uint64) for n in (50, size, size // 2))
        a, b = np.concatenate([shared, one]), np.concatenate([shared, other])
        cells = 15
        while True:
            found = paragraph_sketch.Sketch(a, cells).difference(paragraph_sketch.Sketch(b, cells))
            if found is not None:
                break
            cells *= 4
        assert sorted(found[0]) == sorted(one.tolist())
        assert sorted(found[1]) == sorted(other.tolist())
        assert cells <= 15 * 4 ** 5


def test_repeated_paragraphs_are_told_apart():
    once, twice = (paragraph_sketch.Fingerprint("same line\n" * n) for n in (1, 2))
    assert once.likeness(twice) == 0.5
    assert once.sketch().hex() != twice.sketch().hex()
    assert len(set(paragraph_sketch.digests("same line\n" * 50).tolist())) == 50


def test_query_equals_whole_sets(spark):
    found = sorted(map(answer, queries.op6_document_fingerprints(spark, SMALL).collect()))
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    assert found == sorted(brute_force(docs))


def test_equal_texts_have_equal_fingerprints(spark):
    rows = queries.op6_document_fingerprints(spark, SMALL).collect()
    docs = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())
    by_text = {}
    for row in rows:
        assert by_text.setdefault(docs[row.doc_id], row.fingerprint) == row.fingerprint
    assert len(set(by_text.values())) == len(by_text)


def test_any_number_of_ranges(spark):
    chance = random.Random(2)
    texts = ["\n".join("word " * chance.randrange(40) for _ in range(3)) for _ in range(25)]
    docs = documents(spark, [*AWKWARD, *texts], first_id=-5).repartition(4)
    expected = sorted(brute_force([(r.doc_id, r.text) for r in docs.collect()]))
    for ranges in (1, 2, 7, 40):
        found = paragraph_sketch.fingerprints(docs, ranges)
        assert sorted(map(answer, found.collect())) == expected


def test_ranges_follow_the_size_and_are_tasks_of_their_own(spark, monkeypatch):
    docs = documents(spark, ["some words " * 40] * 200)
    sizes = {}
    for size in (8_000, 2_000):
        monkeypatch.setattr(paragraph_sketch, "RANGE_BYTES", size)
        rows, _ = paragraph_sketch.with_next(docs)
        by_task = rows.groupBy(F.spark_partition_id().alias("task")).agg(
            F.count("*").alias("n"), F.count_distinct("range").alias("ranges")
        )
        tasks = by_task.collect()
        assert {r.ranges for r in tasks} == {1}
        sizes[size] = (len(tasks), max(r.n for r in tasks))
    assert sizes[8_000][0] == 2 + 88_000 // 8_000
    assert sizes[2_000][0] == 2 + 88_000 // 2_000
    assert sizes[2_000][1] <= 7
    monkeypatch.setattr(paragraph_sketch, "MOST_RANGES", 3)
    found = paragraph_sketch.fingerprints(docs).collect()
    assert sorted(r.doc_id for r in found) == list(range(200))


def test_one_row_no_row_and_missing_ids(spark):
    one = documents(spark, ["alone\nhere"])
    (row,) = paragraph_sketch.fingerprints(one).collect()
    assert (row.n_chars, row.near_next) == (10, 1.0)
    assert paragraph_sketch.fingerprints(one.limit(0)).count() == 0
    nameless = spark.createDataFrame(
        [(None, "last", *"abcdef"), (4, "first", *"abcdef"), (2, "next", *"abcdef")],
        f"doc_id long, text string, {EXTRA.replace('version long', 'version string')}",
    )
    found = {r.doc_id: r for r in paragraph_sketch.fingerprints(nameless, 3).collect()}
    assert found[2].edited_sha256 == hashlib.sha256(b"nela").hexdigest()
    assert found[None].edited_sha256 == hashlib.sha256(b"lafi").hexdigest()


def test_rows_of_one_id_follow_each_other(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c"), (0, "d")], "doc_id long, text string")
    found = paragraph_sketch.fingerprints(docs, 2).collect()
    assert sorted(r.doc_id for r in found) == [0, 1, 1, 1]
    assert sum(r.near_next == 1.0 for r in found) >= 1
