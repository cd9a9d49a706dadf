"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A paragraph is a stretch of one line: `PARAGRAPH` characters and the rest of the word they end
in. Its digest counts how often it came before in the text, so repeats are kept apart. A sketch
has cells with a count, the XOR of digests and the XOR of their check sums; each digest goes
into one cell of each third. Subtracting two sketches leaves the digests that differ; peeling
cells with a single digest recovers them, and so tells how many paragraphs two versions share. If
peeling gets stuck, both are sketched again with four times the cells.

The fingerprint is the smallest sketch as hexadecimal digits: equal texts have equal ones.
Likeness is shared paragraphs over all distinct paragraphs of both.

To meet its neighbour, each document goes to a range of doc_ids, in descending order, and the
first document of a range also goes to the range before it, as a guest. Each range is a task of its
own. There are as many as the texts have stretches of `RANGE_BYTES`, so tasks do not grow with
the table until `MOST_RANGES`; beyond it they do, as a task sorts on disk and holds two texts at once.

Defined cases: a null text is empty; an empty text has an all-zero fingerprint, and two of them
are alike with 1; rows of one doc_id follow each other by text; rows without doc_id come last; a
table of one row has itself as the next one; an empty table gives an empty result; a very long text is
cut into its pieces in one task; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARAGRAPH = 80
CELLS = 15
GROWTH = 4
THIRDS = 3
RANGE_BYTES = 16 << 20
# The bounds of all ranges pass through the driver.
MOST_RANGES = 10_000

_PIECE = re.compile(rf"[^\n]{{1,{PARAGRAPH}}}\S*")
_MASK = (1 << 64) - 1
# Odd multipliers: one per third, one for the check sum, one for repeats.
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_CHECK, _REPEAT = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


def digests(text: str) -> np.ndarray:
    """One 64-bit digest per paragraph, repeats told apart."""
    hashed = [xxhash.xxh64_intdigest(p.encode("utf-8", "replace")) for p in _PIECE.findall(text)]
    keys = np.sort(np.array(hashed, np.uint64))
    if len(keys) > 1:
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        if not new.all():
            at = np.arange(len(keys))
            since = at - np.maximum.accumulate(np.where(new, at, 0))
            keys = keys + since.astype(np.uint64) * np.uint64(_REPEAT)
    return keys


def _checks(keys: np.ndarray) -> np.ndarray:
    mixed = (keys ^ (keys >> np.uint64(31))) * np.uint64(_CHECK)
    return (mixed >> np.uint64(32)).astype(np.uint32)


def _check(key: int) -> int:
    return ((key ^ (key >> 31)) * _CHECK & _MASK) >> 32


class Sketch:
    """Counts, digests and check sums by cell."""

    def __init__(self, keys: np.ndarray, cells: int):
        self.cells = cells
        width = np.uint64(cells // THIRDS)
        places = [
            ((keys * np.uint64(odd)) >> np.uint64(20)) % width + np.uint64(n) * width
            for n, odd in enumerate(_ODD)
        ]
        at = np.concatenate(places).astype(np.int64)
        self.counts = np.bincount(at, minlength=cells)
        self.keys = np.zeros(cells, np.uint64)
        self.checks = np.zeros(cells, np.uint32)
        np.bitwise_xor.at(self.keys, at, np.tile(keys, THIRDS))
        np.bitwise_xor.at(self.checks, at, np.tile(_checks(keys), THIRDS))

    def hex(self) -> str:
        counts = self.counts.astype(">u4").tobytes()
        return (counts + self.keys.astype(">u8").tobytes() + self.checks.astype(">u4").tobytes()).hex()

    def difference(self, other: Sketch) -> tuple[list[int], list[int]] | None:
        """Digests that only one of the two has, by peeling; None if it gets stuck."""
        counts = (self.counts - other.counts).tolist()
        keys = (self.keys ^ other.keys).tolist()
        checks = (self.checks ^ other.checks).tolist()
        width = self.cells // THIRDS
        here, there = [], []
        ready = [at for at, count in enumerate(counts) if count in (1, -1)]
        while ready:
            at = ready.pop()
            count, key = counts[at], keys[at]
            if count not in (1, -1) or _check(key) != checks[at]:
                continue
            (here if count == 1 else there).append(key)
            check = checks[at]
            for n, odd in enumerate(_ODD):
                place = ((key * odd & _MASK) >> 20) % width + n * width
                counts[place] -= count
                keys[place] ^= key
                checks[place] ^= check
                if counts[place] in (1, -1):
                    ready.append(place)
        return None if any(counts) or any(keys) else (here, there)


class Fingerprint:
    """A text's paragraphs with the sketches made of them so far."""

    def __init__(self, text: str):
        self.keys = digests(text)
        self.made: dict[int, Sketch] = {}

    def sketch(self, cells: int = CELLS) -> Sketch:
        if cells not in self.made:
            self.made[cells] = Sketch(self.keys, cells)
        return self.made[cells]

    def likeness(self, other: Fingerprint) -> float:
        mine, theirs = len(self.keys), len(other.keys)
        cells = CELLS
        while True:
            # Fewer cells than paragraphs that must differ cannot be peeled.
            if cells >= abs(mine - theirs):
                found = self.sketch(cells).difference(other.sketch(cells))
                if found is not None and len(found[0]) - len(found[1]) == mine - theirs:
                    here, there = map(len, found)
                    break
            if cells > 64 * (mine + theirs + CELLS):
                # Digests that share all cells at every size: compare them as they are.
                here = len(np.setdiff1d(self.keys, other.keys))
                there = len(np.setdiff1d(other.keys, self.keys))
                break
            cells *= GROWTH
        return (mine - here) / (mine + there) if mine + there else 1.0


def edited(text: str, following: str) -> str:
    """The text with its second half replaced by as much of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _dealt(bounds: np.ndarray, guests: dict[int, list[int]]):
    """Rows with their range, and copies of the rows that are guests in other ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        invited = np.array([n for n in guests if n is not None], np.int64)
        for batch in batches:
            ids = batch.column(0)
            known = np.asarray(ids.is_valid())
            values = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            # Ranges count from the largest id; rows without one are in a last range.
            part = len(bounds) - np.searchsorted(bounds, values, side="left")
            part = np.where(known, part, len(bounds) + 1)
            rows, ranges, guest = [np.arange(len(values))], [part], [np.zeros(len(values), bool)]
            invites = np.where(known, np.isin(values, invited), None in guests)
            for row in np.flatnonzero(invites):
                targets = guests[int(values[row]) if known[row] else None]
                rows.append(np.full(len(targets), row))
                ranges.append(np.array(targets))
                guest.append(np.ones(len(targets), bool))
            index = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(ranges).astype(np.int32)), pa.array(np.concatenate(guest)),
                 ids.take(index), batch.column(1).take(index)],
                names=["range", "guest", "doc_id", "text"],
            )

    return run


def _ranges(documents: DataFrame) -> int:
    total = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(MOST_RANGES, 2 + total // RANGE_BYTES)


def with_next(documents: DataFrame, ranges: int | None = None) -> tuple[DataFrame, str]:
    """Rows (range, guest, doc_id, text) in an order in which each is followed by its next one."""
    spark = documents.sparkSession
    parts = ranges or _ranges(documents)
    kind = documents.schema["doc_id"].dataType.simpleString()
    ids = documents.select(F.col("doc_id").cast("long").alias("doc_id"))
    shares = [n / parts for n in range(1, parts)] or [0.5]
    cuts = ids.agg(F.percentile_approx("doc_id", shares, 100 * parts)).first()[0]
    bounds = np.unique(np.array(cuts or [], np.int64))
    # The first row of each range that has any; one number per range.
    number = F.lit(len(bounds)) - _rank(F.coalesce("doc_id", F.lit(0)), bounds)
    tops = (
        ids.select(
            F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(number).alias("range"),
            "doc_id",
        )
        .groupBy("range")
        .agg(F.max("doc_id").alias("top"))
        .orderBy("range")
        .collect()
    )
    guests: dict = {}
    for n, row in enumerate(tops):
        following = tops[(n + 1) % len(tops)]["top"]
        guests.setdefault(following, []).append(row["range"])
    schema = f"range int, guest boolean, doc_id {kind}, text string"
    dealt = documents.select("doc_id", "text").mapInArrow(
        _dealt(bounds, guests), schema
    )
    return (
        dealt.repartitionById(len(bounds) + 2, "range").sortWithinPartitions(
            "range", "guest", F.desc("doc_id"), F.xxhash64("text"), "text"
        ),
        kind,
    )


def _rank(value: Column, bounds: np.ndarray) -> Column:
    """How many bounds are below the value."""

    @F.pandas_udf("int")
    def below(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.fillna(0).to_numpy(), side="left"))

    return below(value)


_NAMES = [
    "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
    "near_next",
]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row against the row after it; a guest ends its range."""
    before = None
    for batch in batches:
        rows = []
        for part, guest, doc_id, text in zip(*batch.columns, strict=True):
            part, text = part.as_py(), text.as_py() or ""
            current = (part, guest.as_py(), doc_id, text, Fingerprint(text))
            if before is not None and before[0] == part and not before[1]:
                rows.append(_row(before, current))
            before = current
        if rows:
            columns = list(zip(*rows, strict=True))
            types = [batch.schema.field(2).type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v.as_py() for v in columns[0]], types[0]),
                 *(pa.array(c, t) for c, t in zip(columns[1:], types[1:], strict=True))],
                names=_NAMES,
            )


def _row(this: tuple, following: tuple) -> tuple:
    text = edited(this[3], following[3])
    changed = Fingerprint(text)
    own = this[4]
    return (
        this[2],
        len(this[3]),
        hashlib.sha256(text.encode("utf-8", "replace")).hexdigest(),
        own.sketch().hex(),
        changed.sketch().hex(),
        own.likeness(changed),
        own.likeness(following[4]),
    )


def fingerprints(documents: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row per input row: fingerprints of the text and of its edit, and their likeness."""
    rows, kind = with_next(documents, ranges)
    schema = (
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return rows.mapInArrow(_compared, schema)
