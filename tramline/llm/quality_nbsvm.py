"""Quality classifier: a linear hinge-loss model over Naive Bayes log-count ratios.

Features are indicators of n-grams: of words (one and two), and of word shapes (one to three),
hashed to `FEATURES` places. A shape tells which kinds of characters a word has, begins and
ends with, about how long it is, and whether it repeats the word before. The number of labelled
documents of either class with each n-gram is counted over all of them; an indicator is
scaled by the log ratio of its smoothed shares in the two classes, each text by the length of
the vector. Dual coordinate descent fits the hinge loss on a sample, and a logistic curve
over margins of sampled texts that a first fit has not seen turns margins into chances.

Bound of the sample: `SAMPLE` texts of each class, dealt by a hash of doc_id, none over
`SAMPLE_BYTES` bytes. All counts cover all labelled texts outside the held-out fold.

Defined cases: a null or empty text has no features and gets the score of the bias; labels that
are null, or contradict each other evenly for one doc_id, are left out; with labels of one class
only, or none, every score is that class's share, with 0.5 for none, so an empty table of documents or
labels is no error. A very long text is counted whole, a stretch at a time; repeated rows count
again in training and get the same score; columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.svm import SparseRows, calibrate, dual_coordinate_descent, logistic, margins
from tramline.llm.tables import stored

FEATURE_BITS = 18
FEATURES = 1 << FEATURE_BITS
SAMPLE = 1500
SAMPLE_BYTES = 50_000
SMOOTHING = 1.0
COST = 1.0
HELD_OUT_FOLDS = 5
THRESHOLD = 0.3

# Kinds of bytes: 0 white space, 1 a-z, 2 A-Z, 3 digits, 4 full stop and comma, 5 other ASCII,
# 6 beyond ASCII.
_KIND = np.full(256, 5, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 3, 6
_KIND[[44, 46]] = 4
_KIND_BIT = np.where(_KIND == 0, 0, 1 << _KIND.astype(np.int64) >> 1).astype(np.uint8)
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32

# Odd, so that it has an inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_STRETCH = 1 << 16


def _powers(base: int) -> np.ndarray:
    factors = np.full(_STRETCH + 1, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash without case, shape) of each word of a stretch."""
    kind = _KIND[data]
    inside = np.concatenate([[False], kind > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_LOWER[data] * _UP[: len(data)])])
    hashes = (sums[ends] - sums[starts]) * _DOWN[starts]
    kinds = np.bitwise_or.reduceat(_KIND_BIT[data], starts).astype(np.uint64)
    length = np.minimum(np.log2(ends - starts), 4).astype(np.uint64)
    first, last = kind[starts].astype(np.uint64), kind[ends - 1].astype(np.uint64)
    return hashes, ((kinds * np.uint64(8) + first) * np.uint64(8) + last) * np.uint64(8) + length


def _stretches(text: bytes) -> Iterator[np.ndarray]:
    data, at = np.frombuffer(text, np.uint8), 0
    while len(data) - at > _STRETCH:
        spaces = np.flatnonzero(_KIND[data[at : at + _STRETCH]] == 0)
        # A word that fills a whole stretch is cut there.
        stop = at + (int(spaces[-1]) + 1 if len(spaces) else _STRETCH)
        yield data[at:stop]
        at = stop
    yield data[at:]


def _place(codes: np.ndarray, family: int) -> np.ndarray:
    mixed = (codes ^ (codes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed + np.uint64(family)) * np.uint64(0x94D049BB133111EB)
    return (mixed >> np.uint64(64 - FEATURE_BITS)).astype(np.int32)


def indicators(text: bytes | None) -> np.ndarray:
    """Places of the n-grams that the whole text has, each once, in order."""
    if not text:
        return np.zeros(0, np.int32)
    parts = [_words(stretch) for stretch in _stretches(text)]
    words = np.concatenate([p[0] for p in parts])
    if not len(words):
        return np.zeros(0, np.int32)
    shapes = np.concatenate([p[1] for p in parts]) * np.uint64(2)
    shapes[1:] += words[1:] == words[:-1]
    step = np.uint64(0x100000001B3)
    pairs = shapes[:-1] * step + shapes[1:]
    found = [
        _place(words, 1),
        _place(words[:-1] * step + words[1:], 2),
        _place(shapes, 3),
        _place(pairs, 4),
        _place(pairs[:-1] * step + shapes[2:], 5),
    ]
    return np.unique(np.concatenate(found))


@dataclass
class Model:
    """Scores by place, the ratios they were scaled with, and the curve over margins."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, text: bytes | None) -> float:
        places = indicators(text)
        margin = self.bias
        if len(places):
            values = self.ratios[places]
            norm = float(np.sqrt(values @ values))
            if norm:
                margin += float(self.weights[places] @ values) / norm
        return float(logistic(self.slope * margin + self.shift))


def held_out() -> Column:
    """Rows no label is learned from."""
    return F.crc32(F.col("doc_id").cast("string")) % HELD_OUT_FOLDS == 0


def _labelled(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, label, share): training texts, and a number by which a sample is drawn."""
    known = (
        labels.filter("quality is not null")
        .groupBy("doc_id")
        .agg(F.avg(F.col("quality").cast("double")).alias("mean"))
        .filter("mean <> 0.5")
        .select("doc_id", (F.col("mean") > 0.5).cast("int").alias("label"))
    )
    texts = documents.select("doc_id", F.col("text").cast("binary").alias("text"))
    # A null doc_id has no remainder and so no fold; the join drops it. Labels grow with the
    # documents, so they are not broadcast, however few they are.
    return (
        texts.filter(~held_out())
        .join(known.filter(~held_out()).hint("merge"), "doc_id")
        .select("text", "label", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)).alias("share"))
    )


def _gather(limits: dict[int, float]):
    """Counts of n-grams by class, and the n-grams of the texts below the class's limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["label", "place", "n", "sampled"]
        counts = np.zeros((2, FEATURES + 1), np.int64)  # the last place counts texts
        for batch in batches:
            labels, sampled = [], []
            for text, label, share in zip(*batch.columns, strict=True):
                data, label = text.as_py() or b"", label.as_py()
                places = indicators(data)
                counts[label, places] += 1
                counts[label, FEATURES] += 1
                if share.as_py() < limits[label] and len(data) <= SAMPLE_BYTES:
                    labels.append(label)
                    sampled.append(places)
            if labels:
                empty = pa.nulls(len(labels), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(labels, pa.int32()), empty, empty.cast(pa.int64()),
                     pa.array(sampled, pa.list_(pa.int32()))], names=names
                )
        for label in (0, 1):
            seen = np.flatnonzero(counts[label]).astype(np.int32)
            for at in range(0, len(seen), 100_000):
                part = seen[at : at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), label, np.int32)), pa.array(part),
                     pa.array(counts[label, part]), pa.nulls(len(part), pa.list_(pa.int32()))],
                    names=names,
                )

    return run


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns `quality` of the labels from the texts outside the held-out fold."""
    train = _labelled(documents, labels)
    sizes = labels.filter("quality is not null").groupBy("quality").count().collect()
    known = {int(row["quality"]): row["count"] for row in sizes if row["quality"] in (0, 1)}
    # Half as much again, as not every label has a text to learn from; the bound is below.
    limits = {k: 1.5 * sample / max(known.get(k, 1), 1) * (1 << 20) for k in (0, 1)}
    gathered = stored(
        train.mapInArrow(_gather(limits), "label int, place int, n long, sampled array<int>"),
        "quality-ngrams",
    )
    sums = gathered.filter("place is not null").groupBy("label", "place").agg(F.sum("n").alias("n"))
    # At most 2 * (FEATURES + 1) rows.
    counted = sums.toArrow()
    counts = np.zeros((2, FEATURES + 1))
    counts[counted["label"].to_numpy(), counted["place"].to_numpy()] = counted["n"].to_numpy()
    totals = counts[:, FEATURES]
    if not totals.all():
        share = float(totals[1] / totals.sum()) if totals.any() else 0.5
        odds = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return Model(np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 1.0, float(odds))
    ratios = _ratios(counts[:, :FEATURES])
    rows, positive = [], []
    for label in (0, 1):
        chosen = gathered.filter((F.col("label") == label) & F.col("sampled").isNotNull())
        for places in chosen.select("sampled").limit(sample).toArrow()["sampled"]:
            rows.append(places.values.to_numpy().astype(np.int32))
            positive.append(label == 1)
    if len(set(positive)) < 2:
        odds = np.log(totals[1] / totals[0])
        return Model(np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 1.0, float(odds))
    return _fit_sample(ratios, rows, np.array(positive), totals)


def _ratios(counts: np.ndarray) -> np.ndarray:
    """Log ratios of the smoothed shares of each n-gram in the two classes; unseen ones are 0."""
    shares = counts + SMOOTHING
    shares /= shares.sum(axis=1, keepdims=True)
    return np.where(counts.sum(axis=0) > 0, np.log(shares[1] / shares[0]), 0.0)


def _fit_sample(
    ratios: np.ndarray, rows: list[np.ndarray], positive: np.ndarray, totals: np.ndarray
) -> Model:
    # In an order that does not depend on how Spark delivered the rows.
    order = sorted(range(len(rows)), key=lambda i: (positive[i], len(rows[i]), rows[i].tobytes()))
    order = np.random.default_rng(1).permutation(np.array(order))
    rows, positive = [rows[i] for i in order], positive[order]
    signs = np.where(positive, 1.0, -1.0)
    # Each class weighs as much as it does among all labelled texts.
    present = np.array([(~positive).sum(), positive.sum()])
    weight = (totals / totals.sum())[positive.astype(int)] * len(rows)
    weight /= present[positive.astype(int)]

    def vectors(chosen: np.ndarray) -> SparseRows:
        values = [ratios[rows[i]] for i in chosen]
        values = [v / n if (n := np.sqrt(v @ v)) else v for v in values]
        return SparseRows([rows[i] for i in chosen], values)

    unseen = np.zeros(len(rows))
    fold = np.arange(len(rows)) % 3
    for part in range(3):
        train, test = np.flatnonzero(fold != part), np.flatnonzero(fold == part)
        fitted = dual_coordinate_descent(
            vectors(train), signs[train], FEATURES, np.full(len(train), COST)
        )
        unseen[test] = margins(vectors(test), *fitted)
    slope, shift = calibrate(unseen, positive, weight)
    weights, bias = dual_coordinate_descent(
        vectors(np.arange(len(rows))), signs, FEATURES, np.full(len(rows), COST)
    )
    return Model(ratios, weights, bias, slope, shift)


def score(model: Model, text: str = "text") -> Column:
    """Chance that a text's label is 1."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(value) for value in texts], dtype="float64")

    return scored(F.col(text).cast("binary"))


def accepted(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score reaches the threshold, with all their columns."""
    return documents.filter(score(model) >= threshold)
