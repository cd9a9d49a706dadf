import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from tests.llm.helpers import AWKWARD, documents
from tramline.llm import phrase_subtrees

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def expected(rows, least, top=2000, longest=5):
    """Straight from the definition, over (lang, text) rows."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    found = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    scored = {}
    for (lang, phrase), a in found.items():
        cuts = []
        for k in range(1, len(phrase)):
            l, r = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
            cuts.append((1000 * a * totals[lang] // (l * r), k, l, r))
        scored[lang, phrase] = min(cuts)
    for (lang, phrase), a in found.items():
        for size in range(2, len(phrase)):
            for i in range(len(phrase) - size + 1):
                inner = (lang, phrase[i : i + size])
                if 100 * a >= 100 * found[inner]:
                    scored.pop(inner, None)
    result = []
    for lang in totals:
        own = [
            (-score, -found[g, phrase], " ".join(phrase).encode(), l, r)
            for (g, phrase), (score, _, l, r) in scored.items()
            if g == lang
        ]
        for rank, (score, a, phrase, l, r) in enumerate(sorted(own)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(result)


def mined(frame):
    assert tuple(frame.columns) == COLUMNS
    return sorted(tuple(r) for r in frame.collect())


def random_rows(n=400):
    chance = random.Random(8)
    words = ["the", "of", "Of", "a\x00b", "é", "x-1", "one", "two", "three"]
    passages = [" ".join(chance.choice(words) for _ in range(12)) for _ in range(6)]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(chance.randrange(1, 9)):
            if chance.random() < 0.4:
                parts.append(chance.choice(passages))
            else:
                parts.append(" ".join(chance.choice(words) for _ in range(chance.randrange(12))))
            parts.append(chance.choice([". ", ",", "\n", " ; ", "!\r\n", "\t", " "]))
        rows.append((chance.choice(["en", "en", "fr", None, "und"]), "".join(parts)))
    return rows


def test_small_bands_and_slices(spark, monkeypatch):
    for name, value in (("BAND", 7), ("ROWS", 3), ("PART", 64), ("TOKENS", 90)):
        monkeypatch.setattr(phrase_subtrees, name, value)
    rows = random_rows(60)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([g or "und" for g, _ in rows]), pa.array([t.encode() for _, t in rows])],
        names=["lang", "text"],
    )
    docs, runs = documents(spark, ["a b c"]), []
    given = phrase_subtrees._texts(docs)

    class Kept:
        def mapInArrow(self, run, schema):
            runs.append(run)
            return given.mapInArrow(run, schema)

    monkeypatch.setattr(phrase_subtrees, "_texts", lambda _: Kept())
    every = phrase_subtrees.Sieve(np.full(16, -1, np.int64).view(np.uint64))
    none = np.zeros(0, np.uint64)
    phrase_subtrees.pair_counts(docs, every, 1)
    phrase_subtrees.suffixes(docs, every, (none, none), 8, 5)
    pairs, suffixes = Counter(), Counter()
    for part in runs[0](iter([batch])):
        assert len(part) <= 3
        for row in part.to_pylist():
            pairs[row["lang"], row["phrase"]] += row["f"]
    for part in runs[1](iter([batch])):
        for row in part.to_pylist():
            words = [w for w in (row["p"], row["w4"], row["w5"]) if w is not None]
            suffixes[row["lang"], " ".join(words)] += row["n"]
    known_pairs, known_suffixes = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.replace("O", "o")):
            words = re.findall(r"[^\x20\x09]+", piece)
            for i in range(len(words) - 1):
                known_pairs[lang or "und", " ".join(words[i : i + 2])] += 1
            for i in range(len(words) - 2):
                known_suffixes[lang or "und", " ".join(words[i : i + 5])] += 1
    assert pairs == known_pairs
    assert suffixes == known_suffixes


@pytest.mark.parametrize(
    "settings",
    [
        {},
        {"budget": 200},
        {"budget": 20, "sieve_bits": 256},
        {"top": 7},
        {"longest": 3, "budget": 50},
    ],
)
def test_equals_brute_force(spark, settings):
    rows = random_rows()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    found = phrase_subtrees.mine(docs, least=12, **settings)
    known = expected(rows, 12, settings.get("top", 2000), settings.get("longest", 5))
    assert len(known) > 20
    assert mined(found) == known


def test_small_parts_cut_only_at_marks(spark, monkeypatch):
    rows = random_rows(60)
    monkeypatch.setattr(phrase_subtrees, "PART", 16)
    monkeypatch.setattr(phrase_subtrees, "TOKENS", 50)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([g or "und" for g, _ in rows]), pa.array([t.encode() for _, t in rows])],
        names=["lang", "text"],
    )
    pieces = Counter()
    for lang, found in phrase_subtrees._words(iter([batch])):
        words = found.words.to_pylist()
        cuts = np.flatnonzero(found.codes < 0)
        for piece in np.split(found.codes, cuts):
            text = b" ".join(words[c] for c in piece if c >= 0)
            if text:
                pieces[lang, text.decode()] += 1
    known = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            if words:
                known[lang or "und", " ".join(words).replace("O", "o")] += 1
    assert pieces == known


@pytest.mark.parametrize("step", ["words", "pairs", "suffixes"])
def test_workers_hold_little_of_a_full_chunk(spark, monkeypatch, step):
    """Beside a chunk's words, what a worker holds is bounded by parts and bands."""
    chance = np.random.default_rng(3)
    letters = chance.integers(97, 123, (1 << 16, 5)).astype(np.uint8)
    known = [bytes(word) for word in letters]
    texts = [b" ".join(known[k] for k in chance.integers(0, len(known), 340)) for _ in range(9000)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["en"] * len(texts)), pa.array(texts)], names=["lang", "text"]
    )
    assert 340 * len(texts) > phrase_subtrees.TOKENS
    docs = documents(spark, ["a b c"])
    given, runs = phrase_subtrees._texts(docs), []

    class Kept:
        def mapInArrow(self, run, schema):
            runs.append(run)
            return given.mapInArrow(run, schema)

    monkeypatch.setattr(phrase_subtrees, "_texts", lambda _: Kept())
    every = phrase_subtrees.Sieve(np.full(1 << 10, -1, np.int64).view(np.uint64))
    none = np.zeros(0, np.uint64)
    if step == "words":
        phrase_subtrees.word_counts(docs)
    elif step == "pairs":
        phrase_subtrees.pair_counts(docs, every, 1)
    else:
        phrase_subtrees.suffixes(docs, every, (none, none), 8, 5)
    tracemalloc.start()
    try:
        total = sum(pc.sum(b.column(b.num_columns - 1)).as_py() for b in runs[0](iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert total == len(texts) * {"words": 340, "pairs": 339, "suffixes": 338}[step]
    assert peak < (48 if step == "words" else 88) << 20


def test_bands_keep_words_together(monkeypatch):
    monkeypatch.setattr(phrase_subtrees, "BAND", 10)
    codes = np.array([3, 0, -1, 1, 3, 2, 7] * 9 + [5] * 40, np.int32)
    at = np.flatnonzero(codes >= 0).astype(np.int32)
    bands = list(phrase_subtrees._bands(codes, at))
    assert len(bands) > 3 and max(map(len, bands)) < 50
    assert sorted(np.concatenate(bands)) == list(at)
    words = [set(codes[band]) for band in bands]
    assert all(max(a) < min(b) for a, b in zip(words, words[1:], strict=False))
    assert list(phrase_subtrees._bands(codes, at[:0])) == []


@pytest.mark.parametrize("size", [1, 2, 5, 1 << 20, (1 << 31) - 2])
def test_packed_columns_sort_alike(size):
    chance = np.random.default_rng(size)
    few = np.append(chance.integers(-1, size, 3), [-1, size - 1])
    columns = [chance.choice(few, 500).astype(np.int32) for _ in range(5)]
    packed = phrase_subtrees._packed(columns, size)
    assert np.array_equal(np.lexsort(packed[::-1]), np.lexsort(columns[::-1]))
    assert len(set(zip(*packed, strict=True))) == len(set(zip(*columns, strict=True)))


def test_sieve_refuses_none_of_its_own(spark):
    phrases = [("en", f"w{n} v{n}") for n in range(500)] + [("fr", "é à")]
    frame = spark.createDataFrame(phrases, "lang string, phrase string")
    sieve = phrase_subtrees.build_sieve(frame, 1 << 14)
    own = np.array([phrase_subtrees._phrase_hash(g, p.encode().split(b" ")) for g, p in phrases], np.uint64)
    assert sieve.passes(own).all()
    others = np.array(
        [phrase_subtrees._phrase_hash("en", [b"v%d" % n, b"w%d" % n]) for n in range(500)], np.uint64
    )
    assert sieve.passes(others).mean() < 0.05


def test_scores_beyond_64_bits(spark):
    many = 3 * 10**12
    phrases = [("en", "a", many), ("en", "b", many), ("en", "a b", many - 1)]
    frame = spark.createDataFrame(phrases, "lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", 10**15)], "lang string, n long")
    [row] = phrase_subtrees._cuts(frame, totals).collect()
    assert row.score == 1000 * (many - 1) * 10**15 // many**2


def test_awkward_rows(spark):
    texts = [*AWKWARD, None, ". . .", "one two three four five six " * 50, "x" * 5000 + " y"] * 3
    docs = documents(spark, texts)
    rows = [("en", text) for text in texts]
    assert mined(phrase_subtrees.mine(docs, least=3)) == expected(rows, 3)
    doubled = docs.union(docs)
    assert mined(phrase_subtrees.mine(doubled, least=3)) == expected(rows * 2, 3)
    assert phrase_subtrees.mine(docs.limit(0), least=3).count() == 0
