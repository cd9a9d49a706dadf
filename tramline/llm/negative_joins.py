"""Hard-negative mining by threshold joins over inverted blocks of vectors.

An anchor's positives are its best other rows of its label. For each of them the hard negatives are
the best rows of other labels whose score, the inner product with the anchor, lies in a window:
`low` to `high` per cent of the positive's score. Vectors are whole numbers, and so are scores.

Anchors are a stated query set and are taken in chunks of about `CHUNK`; a chunk goes to every task,
whatever the size of the table. The join of a chunk finds all rows that score at least a threshold of
each anchor:

* Every block of rows is an inverted index by dimension. A row's last dimensions are not in it where
  their norm times that of the longest anchor is below the lowest threshold: they cannot make a
  match by themselves.
* Partial scores are accumulated slab by slab of dimensions. After each slab a pair goes on only if
  its partial score and the product of the norms of what remains can reach the anchor's threshold;
  rows that no anchor wants leave the index, and few remaining pairs are finished one by one.
* Pairs that are left are scored again in whole numbers, so results are exact.

A task keeps the best rows of each window and raises its own thresholds by them. Thresholds start at
the best score within the chunk itself that fits the window, and are lowered, to the last one that
would fill the window from the chunk alone and then to the window's end, until each window
is full or at its end. Only windows that are still open take part in the next pass.

Defined cases: rows with a null vec_id, label or vector, or a component that is null or not finite,
take no part (`usable`); shorter vectors count as if filled up with zeros, an empty vector scores
zero; an anchor's others are rows of another vec_id; an id that repeats stands for as many rows, as
anchor too; equal scores are in order of vec_id; scores beyond 64 bits are held at the ends of
their range; an empty table, or one without anchors, gives no rows; other columns are not read.
Memory of a task is bounded by a chunk and a block, whatever a vector's neighbours are. Vectors of any
length are held whole, one block at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.tables import stored
from tramline.scratch import new_folder

POSITIVES = 5
NEGATIVES = 10
LOW = 30
HIGH = 90
CHUNK = 2048
# Rows in one inverted block, and dimensions in one slab.
BLOCK = 2048
SLAB = 16
# Pairs are finished one by one when fewer than this share of a block remains.
FEW = 0.05
PAIRS = 100_000
LOWEST = -(1 << 63)
HIGHEST = (1 << 63) - 1
# Products of smaller components add up exactly in 64 bits over a million dimensions.
EXACT = 1 << 21


def usable(vector: Column | str) -> Column:
    """Whether a vector is there and all its components are finite."""

    def broken(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    column = F.col(vector) if isinstance(vector, str) else vector
    whole = column.cast("array<double>")
    return column.isNotNull() & ~F.exists(whole, broken)


def scaled(vector: Column | str, factor: int) -> Column:
    """Components times `factor`, rounded down to whole numbers."""
    column = F.col(vector) if isinstance(vector, str) else vector
    return F.transform(column.cast("array<double>"), lambda x: F.floor(x * factor))


@dataclass
class Windows:
    """What a pass looks for: score windows of anchors, in order of the anchor."""

    anchor: np.ndarray  # place of the anchor in the chunk
    upper: np.ndarray  # highest score
    lower: np.ndarray  # lowest score
    threshold: np.ndarray  # lowest score of this pass
    positive: np.ndarray  # vec_id and score of the positive, or of nothing
    positive_score: np.ndarray

    def take(self, which: np.ndarray) -> Windows:
        return Windows(*(getattr(self, name)[which] for name in self.__dataclass_fields__))


@dataclass
class Anchors:
    """One chunk of anchors."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows of whole numbers, short ones filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    filled = np.zeros((len(lengths), width), np.int64)
    filled[np.arange(width) < lengths[:, None]] = flat
    return filled


def _widened(vectors: np.ndarray, width: int) -> np.ndarray:
    return np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of rows side by side."""
    largest = max(
        (int(max(-int(v.min()), int(v.max()))) for v in (queries, rows) if v.size), default=0
    )
    if largest < EXACT:
        return np.einsum("ij,ij->i", queries, rows)
    products = [
        sum(x * y for x, y in zip(q, r, strict=True))
        for q, r in zip(queries.tolist(), rows.tolist(), strict=True)
    ]
    return np.array([max(LOWEST, min(HIGHEST, p)) for p in products], np.int64)


class Index:
    """Inverted block of rows: slabs of dimensions, each over the rows that have entries there."""

    def __init__(self, rows: np.ndarray, longest: float, threshold: float):
        self.rows = rows
        # Dimensions that carry most come first.
        values = rows.astype(np.float64)
        self.dimensions = np.argsort(-np.abs(values).sum(axis=0), kind="stable")
        self.values = values[:, self.dimensions]
        squares = self.values**2
        after = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
        #: Norm of each row from each dimension on.
        self.norms = np.sqrt(np.concatenate([after, np.zeros((len(rows), 1))], axis=1))
        #: Where the part of a row that is not in the index starts.
        omitted = self.norms * longest * (1 + 1e-9) < threshold
        self.ends = np.where(omitted.any(axis=1), omitted.argmax(axis=1), rows.shape[1])

    def matches(self, queries: np.ndarray, thresholds: np.ndarray):
        """(query, row) of all pairs that can score the query's threshold."""
        q = queries.astype(np.float64)[:, self.dimensions]
        width = q.shape[1]
        after = np.cumsum((q**2)[:, ::-1], axis=1)[:, ::-1]
        norms = np.sqrt(np.concatenate([after, np.zeros((len(q), 1))], axis=1))
        # Rounding of what is accumulated can cost no match.
        least = thresholds.astype(np.float64)
        least = least - 1 - 1e-9 * np.maximum(np.abs(least), norms[:, 0] * self.norms[:, 0].max(initial=0))
        rows = np.arange(len(self.rows))
        partial = np.zeros((len(q), len(rows)))
        for start in range(0, width, SLAB):
            end = min(start + SLAB, width)
            listed = np.flatnonzero(self.ends[rows] > start)
            entries = self.values[rows[listed], start:end]
            # The part from the row's end on is not in the index.
            entries = np.where(np.arange(start, end) < self.ends[rows[listed], None], entries, 0)
            if len(listed) == len(rows):
                partial += q[:, start:end] @ entries.T
            else:
                partial[:, listed] += q[:, start:end] @ entries.T
            known = np.minimum(end, self.ends[rows])
            # What a row keeps out of the index meets what the query has from there on.
            rest = norms[:, known] if (known < end).any() else norms[:, [end]]
            alive = partial + rest * self.norms[rows, known] >= least[:, None]
            wanted = alive.any(axis=0)
            if alive.sum() <= FEW * alive.size or end == width:
                query, at = np.nonzero(alive)
                return query, rows[at]
            if not wanted.all():
                rows, partial = rows[wanted], partial[:, wanted]
        query, at = np.nonzero(partial >= least[:, None])
        return query, rows[at]


def _best(window: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the best rows of each window, in order."""
    order = np.lexsort((ids, -score, window))
    ordered = window[order]
    first = np.searchsorted(ordered, ordered)
    return order[np.arange(len(order)) - first < most]


def _search(anchors: Anchors, windows: Windows, most: int, same_label: bool):
    """Best `most` rows of every window in a partition: (window, score, vec_id)."""
    used = np.unique(windows.anchor)
    place = np.searchsorted(used, windows.anchor)
    edges = np.searchsorted(place, np.arange(len(used) + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        threshold = windows.threshold.copy()
        window, score, ids = (np.zeros(0, np.int64) for _ in range(3))
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.slice(at, BLOCK)
                found = _found(part, threshold)
                window, score, ids = (
                    np.concatenate(pair) for pair in zip((window, score, ids), found, strict=True)
                )
                best = _best(window, score, ids, most)
                window, score, ids = window[best], score[best], ids[best]
                # A window that is full here needs nothing below its last row.
                last = np.searchsorted(window, np.arange(len(threshold)), "right") - 1
                full = np.bincount(window, minlength=len(threshold)) == most
                threshold[full] = np.maximum(threshold[full], score[last[full]])
        if len(window):
            yield pa.RecordBatch.from_arrays(
                [pa.array(window), pa.array(score), pa.array(ids)],
                names=["window", "score", "vec_id"],
            )

    def _found(part: pa.RecordBatch, threshold: np.ndarray):
        row_ids = part.column(0).to_numpy(zero_copy_only=False)
        row_labels = part.column(1).to_numpy(zero_copy_only=False)
        rows, queries = _matrix(part.column(2)), anchors.vectors[used]
        width = max(rows.shape[1], queries.shape[1])
        rows, queries = _widened(rows, width), _widened(queries, width)
        least = np.minimum.reduceat(threshold, edges[:-1])
        longest = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1)).max(initial=0)
        index = Index(rows, longest, float(least.min()))
        query, row = index.matches(queries, least)
        alike = anchors.labels[used[query]] == row_labels[row]
        if same_label:
            right = alike & (anchors.ids[used[query]] != row_ids[row])
        else:
            right = ~alike
        query, row = query[right], row[right]
        parts = [
            _scores(queries[query[at : at + PAIRS]], rows[row[at : at + PAIRS]])
            for at in range(0, len(query), PAIRS)
        ]
        score = np.concatenate([np.zeros(0, np.int64), *parts])
        # Each pair meets all windows of its anchor.
        times = (edges[1:] - edges[:-1])[query]
        pair = np.repeat(np.arange(len(query)), times)
        offset = np.arange(len(pair)) - np.repeat(np.cumsum(times) - times, times)
        window = edges[query][pair] + offset
        score = score[pair]
        inside = (score >= threshold[window]) & (score <= windows.upper[window])
        return window[inside], score[inside], row_ids[row[pair[inside]]].astype(np.int64)

    return run


def _best_of_all(rows: DataFrame, anchors: Anchors, windows: Windows, most: int, same: bool):
    """(window, score, vec_id, rank, times): the best rows of each window over all rows."""
    context = rows.sparkSession.sparkContext
    # Chunk and windows are bounded by CHUNK, whatever the table's size.
    shared = context.broadcast((anchors, windows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _search(*shared.value, most, same)(batches)

    found = rows.select("vec_id", "label", "vector").mapInArrow(
        run, "window long, score long, vec_id long"
    )
    place = "row_number() OVER (PARTITION BY window ORDER BY score DESC, vec_id)"
    best = found.withColumn("rank", F.expr(place)).filter(F.col("rank") <= most)
    return best.withColumn("times", F.expr("count(*) OVER (PARTITION BY window)"))


def _starts(scores: np.ndarray, most: int, lower: int) -> list[int]:
    """Falling thresholds of a window from scores that it is known to hold, best first."""
    steps = [int(scores[k]) for k in (0, most - 1) if k < len(scores)]
    return [*(s for s in dict.fromkeys(steps) if s > lower), lower]


def _passes(
    rows: DataFrame,
    anchors: Anchors,
    windows: Windows,
    steps: list[list[int]],
    most: int,
    same_label: bool,
) -> Iterator[tuple[Windows, np.ndarray, DataFrame]]:
    """(windows, which are done, what was found) of each pass, until every window is done."""
    number = 0
    while len(windows.anchor):
        now = [s[min(number, len(s) - 1)] for s in steps]
        windows.threshold = np.array(now, np.int64)
        found = stored(_best_of_all(rows, anchors, windows, most, same_label), "neighbours")
        counts = found.filter("rank = 1").select("window", "times").toArrow()
        times = np.zeros(len(windows.anchor), np.int64)
        times[counts.column("window").to_numpy()] = counts.column("times").to_numpy()
        done = (times >= most) | (windows.threshold <= windows.lower)
        yield windows, done, found
        windows, number = windows.take(~done), number + 1
        steps = [s for s, d in zip(steps, done, strict=True) if not d]


def _sample_scores(anchors: Anchors) -> np.ndarray:
    """Scores of the anchors of a chunk among each other, as good as floats give them."""
    vectors = anchors.vectors.astype(np.float64)
    return np.clip(np.floor(vectors @ vectors.T), -9e18, 9e18).astype(np.int64)


def _positives(rows: DataFrame, anchors: Anchors, most: int) -> Windows:
    """Windows of the negatives' search: one per anchor and positive."""
    every = np.arange(len(anchors.ids))
    scores, nothing = _sample_scores(anchors), np.zeros(len(every), np.int64)
    steps = []
    for n in every:
        others = (anchors.labels == anchors.labels[n]) & (anchors.ids != anchors.ids[n])
        steps.append(_starts(-np.sort(-scores[n][others]), most, LOWEST))
    first = Windows(every, nothing + HIGHEST, nothing + LOWEST, nothing, nothing, nothing)
    anchor, ids, positive = [], [], []
    for windows, done, found in _passes(rows, anchors, first, steps, most, True):
        table = found.toArrow()
        window = table.column("window").to_numpy()
        kept = done[window] if len(window) else np.zeros(0, bool)
        anchor.append(windows.anchor[window[kept]])
        ids.append(table.column("vec_id").to_numpy()[kept])
        positive.append(table.column("score").to_numpy()[kept])
    place = np.concatenate([np.zeros(0, np.int64), *anchor])
    ids, score = (np.concatenate([np.zeros(0, np.int64), *v]) for v in (ids, positive))
    order = np.lexsort((ids, -score, place))
    place, ids, score = place[order], ids[order], score[order]
    return Windows(place, score, score, score, ids, score)


def _bounds(windows: Windows, low: int, high: int) -> Windows:
    """Windows between both shares of the positive's score; empty ones are left out."""
    exact = windows.positive_score.tolist()
    windows.upper = np.array([high * s // 100 for s in exact], np.int64)
    windows.lower = np.array([-(-low * s // 100) for s in exact], np.int64)
    return windows.take(windows.lower <= windows.upper)


def _chunks(anchors: DataFrame, size: int) -> Iterator[Anchors]:
    numbered = stored(anchors.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    chunks = -(-numbered.count() // size)
    for chunk in range(chunks):
        own = numbered.filter(F.pmod(F.xxhash64("anchor"), F.lit(chunks)) == chunk)
        table = own.select("vec_id", "label", "vector").toArrow().combine_chunks()
        if len(table):
            vectors = table.column("vector").combine_chunks()
            yield Anchors(
                table.column("vec_id").to_numpy(),
                table.column("label").to_numpy(),
                _matrix(vectors if isinstance(vectors, pa.Array) else vectors.chunk(0)),
            )


RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long,"
    " positive_score long, negative_score long"
)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    chunk: int = CHUNK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `rows` has vec_id, label and vector, whole numbers without nulls; `is_anchor` picks the
    anchors among them; `low` and `high` are per cent of the positive's score.
    """
    spark = rows.sparkSession
    rows = stored(rows.select("vec_id", "label", "vector"), "vectors")
    folder = new_folder(spark, "hard-negatives")
    spark.createDataFrame([], RESULT).write.parquet(folder)
    for anchors in _chunks(rows.filter(is_anchor), chunk):
        windows = _bounds(_positives(rows, anchors, positives), low, high)
        scores = _sample_scores(anchors)
        steps = []
        for n in range(len(windows.anchor)):
            a = windows.anchor[n]
            known = scores[a][anchors.labels != anchors.labels[a]]
            inside = known[(known <= windows.upper[n]) & (known >= windows.lower[n])]
            steps.append(_starts(-np.sort(-inside), negatives, int(windows.lower[n])))
        for open_windows, done, found in _passes(rows, anchors, windows, steps, negatives, False):
            _written(found, anchors, open_windows, done, folder)
    return spark.read.schema(RESULT).parquet(folder)


def _written(
    found: DataFrame, anchors: Anchors, windows: Windows, done: np.ndarray, folder: str
) -> None:
    """Append what was found for the windows that are done, with their anchors and positives."""
    names = (anchors.ids[windows.anchor], windows.positive, windows.positive_score, done)
    shared = found.sparkSession.sparkContext.broadcast(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, positive, positive_score, kept = shared.value
        for batch in batches:
            window = batch.column(0).to_numpy()
            columns = [
                pa.array(anchor[window], pa.int64()),
                pa.array(positive[window], pa.int64()),
                batch.column(3).cast(pa.int32()),
                batch.column(2),
                pa.array(positive_score[window], pa.int64()),
                batch.column(1),
            ]
            named = pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in RESULT.split(",")])
            yield named.filter(pa.array(kept[window]))

    found.mapInArrow(run, RESULT).write.mode("append").parquet(folder)
