import random
import re

import duckdb
import numpy as np
import pytest

from tests.llm.helpers import AWKWARD, collected, documents
from tramline.llm import minhash_postings, queries

TABLES = "/root/testdata/sf0.01"


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return frozenset()
    return frozenset(" ".join(words[n : n + 4]) for n in range(max(1, len(words) - 3)))


def smallest_reachable(sets):
    """By comparing all pairs of distinct sets."""
    members = {}
    for n, found in sets.items():
        members.setdefault(found, []).append(n)
    distinct = [s for s in members if s]
    top = {s: s for s in distinct}

    def find(s):
        while top[s] != s:
            s = top[s]
        return s

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if min(len(a), len(b)) * 100 < 80 * max(len(a), len(b)):
                continue
            common = len(a & b)
            if 100 * common >= 80 * (len(a) + len(b) - common):
                top[find(a)] = find(b)
    groups = {}
    for s in distinct:
        groups.setdefault(find(s), []).extend(members[s])
    names = {n: min(group) for group in groups.values() for n in group}
    return {n: names.get(n, n) for n in sets}


def check(found, texts):
    sets = {n: shingles(text) for n, text in texts.items()}
    names = smallest_reachable(sets)
    for n, row in found.items():
        assert (row.n_shingles, row.component_id) == (len(sets[n]), names[n])
        assert row.kept == (names[n] == n)
    assert found.keys() == texts.keys()


def test_query_equals_all_pairs(spark):
    found = collected(queries.op11_minhash_near_dedup(spark, TABLES))
    check(
        found,
        dict(duckdb.sql(f"SELECT doc_id, text FROM '{TABLES}/documents.parquet'").fetchall()),
    )


def crowded_texts():
    """A dense group around one text, chains away from it, and texts that share a passage."""
    chance = random.Random(5)
    base = [f"b{n}" for n in range(120)]
    texts = []
    for _ in range(90):
        copy = list(base)
        for _ in range(chance.randrange(9)):
            copy[chance.randrange(len(copy))] = f"x{chance.random()}"
        texts.append(" ".join(copy))
    chain = list(base)
    for n in range(60):
        chain[(7 * n) % len(chain)] = f"y{n}"
        texts.append(" ".join(chain))
    passage = " ".join(f"p{n}" for n in range(60))
    for n in range(60):
        texts.append(passage + " " + " ".join(f"q{n}-{k}" for k in range(n)))
    chance.shuffle(texts)
    return texts


@pytest.mark.parametrize(("crowd", "block"), [(2, 300), (8, 5_000), (64, 200_000)])
def test_long_lists_lose_no_link(spark, crowd, block):
    texts = crowded_texts()
    docs = documents(spark, texts).repartition(4)
    found = collected(minhash_postings.near_duplicates(docs, crowd=crowd, block=block))
    check(found, dict(enumerate(texts)))


def test_signatures_agree_as_often_as_sets():
    chance = np.random.default_rng(3)
    common = chance.integers(0, 1 << 63, 800, np.uint64)
    agree = []
    for _ in range(60):
        own = [np.unique(np.concatenate([common, chance.integers(0, 1 << 63, 100, np.uint64)])) for _ in "ab"]
        a, b = map(minhash_postings.signature, own)
        agree.append((a == b).sum())
    assert abs(np.mean(agree) / 32 - 0.8) < 0.03
    assert min(agree) >= minhash_postings.MATCHES


def test_awkward_rows(spark):
    texts = [*AWKWARD, "two words", "TWO words", "a b c d e", "é" * 10]
    docs = documents(spark, texts, first_id=10)
    check(collected(minhash_postings.near_duplicates(docs)), dict(enumerate(texts, 10)))
    twice = minhash_postings.near_duplicates(docs.union(docs))
    assert twice.count() == 2 * len(texts)
    assert twice.distinct().count() == len(texts)
    assert minhash_postings.near_duplicates(docs.limit(0)).count() == 0


def test_rows_without_id(spark):
    words = " ".join(f"w{n}" for n in range(60))
    near = words + " more"
    rows = [(None, words), (None, near), (7, near), (8, "other"), (None, "alone"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = minhash_postings.near_duplicates(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in found) == [
        (0, 0, True),
        (0, 0, True),
        (0, 7, False),
        (0, 7, False),
        (7, 7, True),
        (8, 8, True),
    ]


def test_string_ids(spark):
    words = " ".join(f"w{n}" for n in range(60))
    docs = spark.createDataFrame([("b", words), ("a", words + " x")], "doc_id string, text string")
    assert {r.component_id for r in minhash_postings.near_duplicates(docs).collect()} == {"a"}


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = " ".join(f"w{n % 97} v{n % 89}" for n in range(900)).encode()
    whole = minhash_postings.shingle_hashes(text)
    tokens = minhash_postings.signature(whole)
    monkeypatch.setattr(minhash_postings, "PART", 7)
    assert (minhash_postings.shingle_hashes(text) == whole).all()
    assert (minhash_postings.signature(whole) == tokens).all()
    assert len(whole) == len(shingles(text.decode()))
