"""Benchmark decontamination with a distributed positional inverted index.

The windows of the benchmark (13 consecutive words; a shorter item is one window) are the
phrases to look up. A first pass over the documents counts the terms of the windows. The two
rarest terms of each window are its leads; a second pass stores the postings (term, document,
positions) of the leads only. Postings of the rarest lead, shifted by its offset in the window,
are intersected with those of the second one; what survives is compared with the whole window in
the document, which gives the exact matches. `proximity_matches` loosens the intersection to
a distance.

Windows are taken in blocks of `BLOCK` distinct ones, so what is sent to every task (the terms
of a block) has a bound that does not depend on either table. Postings, shifted starts and
matches grow with the documents and are joined by shuffles only.

Defined cases: a null or empty text has no words and no hits; an item without words is no
window; repeated rows each get their result; rows that share a doc_id but not the text are told
apart by the text; an empty benchmark leaves every document clean, and an empty table of documents
gives an empty result; a very long text is one list of words in one task; other columns are not
read, and `decontaminate` hands them on as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.tables import join_same, packed, stored, unpacked

WINDOW = 13
BLOCK = 50_000
LEADS = 2

KEYS = ("document", "version")

# Bytes of words: digits, letters (A-Z become a-z) and everything beyond ASCII.
_WORD_BYTES = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A
    else byte if byte >= 0x80 or 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A
    else 0x20
    for byte in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORD_BYTES).split()


def _texts(documents: DataFrame) -> DataFrame:
    """(document, version, text as UTF-8 bytes)."""
    return documents.select(
        F.col("doc_id").alias("document"),
        F.xxhash64("text").alias("version"),
        F.col("text").cast("binary").alias("text"),
    )


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, phrase): the windows of each item, words joined by a space."""
    item = benchmark.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item_id, text in zip(batch.column(0), batch.column(1), strict=True):
                words = words_of(text.as_py())
                phrases = [
                    b" ".join(words[at : at + size]).decode()
                    for at in range(max(1, len(words) - size + 1))
                    if words
                ]
                for at in range(0, len(phrases), 10_000):
                    part = phrases[at : at + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item_id.as_py()] * len(part), batch.column(0).type),
                         pa.array(part, pa.string())],
                        names=["item_id", "phrase"],
                    )

    texts = benchmark.select("item_id", F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, f"item_id {item}, phrase string").distinct()


def term_counts(texts: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """(term, n): how often each of the numbered terms occurs in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, get, absent = np.zeros(len(terms) + 1, np.int64), terms.get, len(terms)
        for batch in batches:
            for text in batch.column(0):
                words = words_of(text.as_py())
                found = np.fromiter(map(get, words, repeat(absent)), np.int64, len(words))
                counts += np.bincount(found, minlength=len(counts))
        seen = np.flatnonzero(counts[:-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(counts[seen])], names=["term", "n"]
        )

    partial = texts.select("text").mapInArrow(run, "term int, n long")
    return partial.groupBy("term").agg(F.sum("n").alias("n"))


def postings(texts: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """(document, version, term, position): the index of the numbered terms."""
    kinds = [texts.schema[name].dataType.simpleString() for name in KEYS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = terms.get
        for batch in batches:
            rows, found, places = [], [], []
            held = 0
            for row, text in enumerate(batch.column(2)):
                words = words_of(text.as_py())
                ids = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
                at = np.flatnonzero(ids >= 0)
                if len(at):
                    rows.append(np.full(len(at), row))
                    found.append(ids[at])
                    places.append(at.astype(np.int32))
                    held += len(at)
                if held > 200_000 or (held and row == len(batch.column(2)) - 1):
                    index = pa.array(np.concatenate(rows))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(index), batch.column(1).take(index),
                         pa.array(np.concatenate(found)), pa.array(np.concatenate(places))],
                        names=[*KEYS, "term", "position"],
                    )
                    rows, found, places, held = [], [], [], 0
            if held:
                index = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(index), batch.column(1).take(index),
                     pa.array(np.concatenate(found)), pa.array(np.concatenate(places))],
                    names=[*KEYS, "term", "position"],
                )

    schema = f"document {kinds[0]}, version {kinds[1]}, term int, position int"
    return texts.mapInArrow(run, schema)


class Leads:
    """The rarest terms of each window of a block, as tables for the index."""

    def __init__(self, spark: SparkSession, texts: DataFrame, phrases: list[tuple[int, str]]):
        split = [(number, phrase.encode().split(b" ")) for number, phrase in phrases]
        every = {term: n for n, term in enumerate(sorted({t for _, ws in split for t in ws}))}
        # One row per distinct term of the block.
        counts = {row["term"]: row["n"] for row in term_counts(texts, every).collect()}
        self.terms: dict[bytes, int] = {}
        ranked: list[list[tuple[int, int, int]]] = [[] for _ in range(LEADS)]
        lengths = []
        for number, words in split:
            if any(every[word] not in counts for word in words):
                continue  # a term that no document has
            order = sorted(range(len(words)), key=lambda at: (counts[every[words[at]]], at))
            for rank, at in enumerate(order[:LEADS]):
                term = self.terms.setdefault(words[at], len(self.terms))
                ranked[rank].append((number, term, at))
            lengths.append((number, len(words)))
        schema = "window long, term int, offset int"
        self.ranked = [spark.createDataFrame(rows, schema) for rows in ranked]
        self.lengths = spark.createDataFrame(lengths, "window long, length int")


def _shifted(index: DataFrame, leads: DataFrame) -> DataFrame:
    """Where a window would start, by one of its terms."""
    return index.join(leads, "term").select(
        *KEYS, "window", (F.col("position") - F.col("offset")).alias("start")
    )


def phrase_candidates(index: DataFrame, leads: Leads) -> DataFrame:
    """(document, version, window, start): the leads of the window stand where they should."""
    first = _shifted(index, leads.ranked[0]).filter("start >= 0")
    second = _shifted(index, leads.ranked[1])
    alone = leads.lengths.filter("length = 1").select("window")
    key = [*KEYS, "window", "start"]
    both = join_same(first, second, key, "left_semi")
    return both.union(first.join(alone, "window", "left_semi").select(*key))


def proximity_matches(index: DataFrame, leads: Leads, slop: int) -> DataFrame:
    """(document, version, window, start, distance): the two leads at most `slop` words off.

    `distance` is how far apart the starts are that the two leads point to; 0 is a phrase
    candidate. A start before the text is negative. Starts meet by stretches of the text, never
    all with all.
    """
    width = slop + 1
    first = _shifted(index, leads.ranked[0]).withColumn(
        "stretch",
        F.explode(F.array(*(F.floor(F.col("start") / width) + k for k in (-1, 0, 1)))),
    )
    second = _shifted(index, leads.ranked[1]).withColumnRenamed("start", "other")
    second = second.withColumn("stretch", F.floor(F.col("other") / width))
    return (
        join_same(first, second, [*KEYS, "window", "stretch"], "inner")
        .withColumn("distance", F.abs(F.col("start") - F.col("other")))
        .filter(F.col("distance") <= slop)
        .groupBy(*KEYS, "window", "start")
        .agg(F.min("distance").alias("distance"))
    )


def _blocks(windows: DataFrame, block: int) -> list[list[tuple[int, str]]]:
    """Distinct windows, numbered, as bounded lists one after the other."""
    count = windows.count()
    parts = max(1, -(-count // block))
    for part in range(parts):
        rows = windows.filter(F.pmod(F.xxhash64("phrase"), F.lit(parts)) == part)
        # At most about `block` rows: the windows are distinct and dealt by hash.
        yield [(row["window"], row["phrase"]) for row in rows.collect()]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares candidates with the words of the document and counts the words they cover."""
    for batch in batches:
        n_words, n_hit, matched = [], [], []
        for text, candidates in zip(batch.column(2), batch.column(3), strict=True):
            words = words_of(text.as_py())
            covered, windows = np.zeros(len(words), bool), []
            for candidate in candidates if candidates.is_valid else ():
                phrase = candidate["phrase"].as_py().encode().split(b" ")
                size, met = len(phrase), False
                for start in candidate["starts"].values.to_numpy():
                    if words[start : start + size] == phrase:
                        covered[start : start + size] = met = True
                if met:
                    windows.append(candidate["window"].as_py())
            n_words.append(len(words))
            n_hit.append(int(covered.sum()))
            matched.append(sorted(windows))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n_words, pa.int64()),
             pa.array(n_hit, pa.int64()), pa.array(matched, pa.list_(pa.int64()))],
            names=[*KEYS, "n_words", "n_hit", "windows"],
        )


def contamination(
    documents: DataFrame, benchmark: DataFrame, size: int = WINDOW, block: int = BLOCK
) -> DataFrame:
    """(doc_id, version, n_words, n_hit, items): what of the benchmark each document repeats.

    `items` is the sorted array of the item_ids, as strings, that have a window in the text.
    """
    spark = documents.sparkSession
    by_item = stored(benchmark_windows(benchmark, size), "benchmark-windows")
    windows = stored(
        by_item.select("phrase").distinct().withColumn("window", F.monotonically_increasing_id()),
        "windows",
    )
    texts = _texts(documents)
    candidates = None
    for phrases in _blocks(windows, block):
        if not phrases:
            continue
        leads = Leads(spark, texts, phrases)
        index = stored(postings(texts, leads.terms), "postings")
        found = phrase_candidates(index, leads)
        candidates = found if candidates is None else candidates.union(found)
    kinds = [texts.schema[name].dataType.simpleString() for name in KEYS]
    if candidates is None:
        candidates = spark.createDataFrame(
            [], f"document {kinds[0]}, version {kinds[1]}, window long, start int"
        )
    # A window's words stand once beside the places where it may start in a document.
    places = candidates.groupBy(*KEYS, "window").agg(F.collect_set("start").alias("starts"))
    per_document = (
        places.join(windows, "window")
        .groupBy(*KEYS)
        .agg(F.collect_list(F.struct("starts", "window", "phrase")).alias("candidates"))
    )
    checked = join_same(texts, per_document, [*KEYS], "left")
    checked = checked.select(*KEYS, "text", "candidates")
    schema = (
        f"document {kinds[0]}, version {kinds[1]}, n_words long, n_hit long, windows array<long>"
    )
    results = stored(checked.mapInArrow(_verify, schema), "contamination")
    of_window = windows.join(by_item, "phrase").select(
        "window", F.col("item_id").cast("string").alias("item")
    )
    items = (
        results.select(*KEYS, F.explode("windows").alias("window"))
        .distinct()
        .join(of_window, "window")
        .groupBy(*KEYS)
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    return join_same(results, items, [*KEYS], "left").select(
        F.col("document").alias("doc_id"),
        "version",
        "n_words",
        "n_hit",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that are not contaminated, with all their columns."""
    found = contamination(documents, benchmark).filter("contaminated").select("doc_id", "version")
    bad = found.distinct().withColumnRenamed("doc_id", "document")
    keyed = packed(documents, document=F.col("doc_id"), version=F.xxhash64("text"))
    return unpacked(join_same(keyed, bad, ["document", "version"], "left_anti"), documents)
