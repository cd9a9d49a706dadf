"""Phrase collocation mining by vertical partitioning of the suffixes of all texts.

Texts are lower-cased (A-Z) and cut at `.,;:!?` and line ends into pieces, pieces at spaces and
tabs into words. The suffix tree of the pieces, over words and no deeper than the longest phrase,
is never built whole:

1. Words, then word pairs, are counted; a phrase that is frequent enough has only frequent words
   and pairs. Both sets reach the tasks as a `Sieve`, a Bloom filter of fixed size, so what is sent
   does not grow; a false positive only costs a row.
2. Vertical partitioning: a group of prefixes is meant to hold `BUDGET` suffixes. Prefixes start
   with one word; a word that has more suffixes than that is extended to its pairs, and a pair that
   still has more to three words. The prefixes to extend are at most as many as there are groups
   each, and groups are at most `GROUPS`; all other prefixes are dealt to groups by hash.
3. Each position whose words pass the sieve gives its suffix, no longer than the longest phrase. Equal suffixes
   of a task are one row with a count, so a passage that many texts repeat is one row per task.
4. Each group builds its subtrees on its own: its suffixes are sorted, and the count of a node is
   the total of the leaves below it, read as the order is walked. Sorting may spill, so a group
   of any size is built in bounded memory. Nodes of one and two words lie above some prefixes; their counts
   are those of step 1.

Everything is per language; a null lang is `und`, a null text is empty. A text of any length is taken
piece after piece: only a single piece without a separator is held whole. A task numbers the words of about
`TOKENS` tokens and compares their phrases in bands by first word, so beside four bytes a token and a few
for positions it holds what a band takes, and texts only of the rows it sends on. Repeated rows count again,
an empty table gives no phrases, columns other than text and lang are not read.
Sums and products are exact: scores are computed as decimals of 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.tables import stored

LEAST = 100
LONGEST = 5
TOP = 2000
NO_LANG = "und"
# Suffixes a group of prefixes should hold, and the most groups there are.
BUDGET = 1 << 21
GROUPS = 1 << 14
# Bits of a sieve.
SIEVE_BITS = 1 << 25
SIEVE_HASHES = 4
# Bytes of text that are encoded at once, and tokens that are counted together.
PART = 1 << 20
TOKENS = 1 << 21
# Positions whose phrases are compared with each other at once, and rows sent on at once.
BAND = 1 << 18
ROWS = 1 << 16
SALTS = 64

# Separators of pieces become one mark.
_MARK = b"."
_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_TO_MARK = bytes.maketrans(_SEPARATORS, _MARK * len(_SEPARATORS))

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _parts(texts: list[bytes], size: int) -> Iterator[bytes]:
    """All texts with a mark after each, in parts of about `size` bytes that end at marks."""
    pending, held = [], 0
    for text in texts:
        text = text.lower().translate(_TO_MARK)
        at = 0
        while len(text) - at > size:
            cut = text.find(_MARK, at + size)
            if cut < 0:
                break
            yield text[at : cut + 1]
            at = cut + 1
        pending += (text[at:], _MARK)
        held += len(text) - at
        if held >= size:
            yield b"".join(pending)
            pending, held = [], 0
    if pending:
        yield b"".join(pending)


def _encoded(part: bytes) -> pa.DictionaryArray:
    tokens = part.replace(_MARK, b" . ").split()  # of bytes: ASCII white space only
    return pa.array(tokens, pa.binary()).dictionary_encode()


class Words:
    """Tokens of texts of one language: numbers, and the words they stand for."""

    def __init__(self, encoded: list[pa.DictionaryArray]):
        together = pa.chunked_array(encoded).unify_dictionaries()
        self.words = together.chunk(0).dictionary
        mark = pc.index(self.words, _MARK).as_py()
        #: -1 at the end of a piece.
        self.codes = np.concatenate([c.indices.to_numpy() for c in together.chunks])
        self.codes[self.codes == mark] = -1

    def hashes(self, seed: int) -> np.ndarray:
        """A hash of each word."""
        digest = xxhash.xxh64_intdigest
        return np.array([digest(w, seed) for w in self.words.to_pylist()], np.uint64)

    def at(self, codes: np.ndarray) -> pa.Array:
        """Words by number as text, null for -1."""
        return self.words.take(pa.array(codes, mask=codes < 0)).cast(pa.string())


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about `PART` bytes."""
    for batch in batches:
        step = max(1, len(batch) * PART // max(1, batch.nbytes))
        for at in range(0, len(batch), step):
            yield batch.slice(at, step)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    """Words of the texts, language by language, at most about `TOKENS` tokens at once."""
    held: dict[str, list[pa.DictionaryArray]] = {}
    sizes: dict[str, int] = {}
    for batch in _slices(batches):
        for lang in pc.unique(batch.column(0)).to_pylist():
            texts = batch.filter(pc.equal(batch.column(0), lang)).column(1).to_pylist()
            for part in _parts(texts, PART):
                encoded = _encoded(part)
                held.setdefault(lang, []).append(encoded)
                sizes[lang] = sizes.get(lang, 0) + len(encoded)
                if sum(sizes.values()) >= TOKENS:
                    largest = max(sizes, key=sizes.get)
                    sizes.pop(largest)
                    yield largest, Words(held.pop(largest))
    for lang, encoded in held.items():
        if sizes[lang]:
            yield lang, Words(encoded)


def _seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


def _joint(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of two hashes, in their order."""
    mixed = first * _ODD ^ (second + _ODD + (first >> np.uint64(7)))
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _ODD
    return mixed ^ (mixed >> np.uint64(29))


def _phrase_hash(lang: str, words: list[bytes]) -> int:
    seed = _seed(lang)
    found = np.array([xxhash.xxh64_intdigest(words[0], seed)], np.uint64)
    for word in words[1:]:
        found = _joint(found, np.array([xxhash.xxh64_intdigest(word, seed)], np.uint64))
    return int(found[0])


def _phrase_hashes(rows: pa.RecordBatch) -> np.ndarray:
    """Hashes of (lang, phrase) rows, as `Words.hashes` and `_joint` give them."""
    langs, phrases = rows.column(0).to_pylist(), rows.column(1).to_pylist()
    found = [_phrase_hash(g, p.encode().split(b" ")) for g, p in zip(langs, phrases, strict=True)]
    return np.array(found, np.uint64)


class Sieve:
    """Bloom filter of phrases; it never refuses one that it was built from."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells

    @staticmethod
    def bits(hashes: np.ndarray, size: int) -> np.ndarray:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        return np.stack(
            [(hashes + np.uint64(k) * step) % np.uint64(size) for k in range(SIEVE_HASHES)]
        )

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        at = self.bits(hashes, len(self.cells) * 64)
        cells = self.cells[(at >> np.uint64(6)).astype(np.int64)]
        return ((cells >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)


def build_sieve(phrases: DataFrame, size: int = SIEVE_BITS) -> Sieve:
    """Sieve of (lang, phrase) rows; the driver holds its bits, never the phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = Sieve.bits(_phrase_hashes(batch), size).ravel()
            bits = np.left_shift(np.uint64(1), at & np.uint64(63)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(bits)],
                names=["cell", "bits"],
            )

    rows = phrases.select("lang", "phrase").mapInArrow(run, "cell long, bits long")
    # At most size / 64 rows.
    filled = rows.groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    cells = np.zeros(size // 64, np.int64)
    cells[filled.column("cell").to_numpy()] = filled.column("bits").to_numpy()
    return Sieve(cells.view(np.uint64))


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.coalesce("lang", F.lit(NO_LANG)).alias("lang"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )


def _bands(codes: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """The positions in bands of about `BAND`, in the order of their words; a word is in one band."""
    word = codes[at]
    ends = np.cumsum(np.bincount(word))
    band = ((ends - 1) // BAND).astype(np.uint16)[word]
    order = np.argsort(band, kind="stable").astype(np.int32)
    sizes = np.bincount(band)
    for end, size in zip(np.cumsum(sizes), sizes, strict=True):
        if size:
            yield at[order[end - size : end]]


def _cut(size: int) -> Iterator[slice]:
    """Slices of `ROWS` rows."""
    return (slice(at, at + ROWS) for at in range(0, size, ROWS))


def word_counts(documents: DataFrame) -> DataFrame:
    """(lang, phrase, f): every word and how often it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, found in _words(batches):
            times = np.bincount(found.codes[found.codes >= 0], minlength=len(found.words))
            used = np.flatnonzero(times)
            for some in map(used.__getitem__, _cut(len(used))):
                columns = [pa.array([lang] * len(some)), found.at(some), pa.array(times[some])]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "f"])

    counted = _texts(documents).mapInArrow(run, "lang string, phrase string, f long")
    return counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _followers(codes: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Positions whose word and next word are allowed and in one piece."""
    good = np.concatenate([allowed, [False]])[codes]
    return np.flatnonzero(good[:-1] & good[1:]).astype(np.int32)


def _passing(codes: np.ndarray, hashes: np.ndarray, pairs: Sieve) -> np.ndarray:
    """Of each position, whether its word and the next are in one piece and pass as a pair."""
    passing = np.zeros(len(codes), bool)
    for at in range(0, len(codes), BAND):
        block = codes[at : at + BAND + 1]
        good = _followers(block, np.ones(len(hashes), bool))
        passed = pairs.passes(_joint(hashes[block[good]], hashes[block[good + 1]]))
        passing[at + good] = passed
    return passing


def _packed(columns: list[np.ndarray], size: int) -> list[np.ndarray]:
    """Columns of numbers below `size`, or -1, as fewer columns that sort alike."""
    bits = int(size).bit_length()
    each = max(1, 63 // bits)
    packed = []
    for at in range(0, len(columns), each):
        key = np.zeros(len(columns[0]), np.int64)
        for column in columns[at : at + each]:
            key <<= bits
            key += column
            key += 1
        packed.append(key)
    return packed


def pair_counts(documents: DataFrame, words: Sieve, least: int) -> DataFrame:
    """(lang, phrase, f): the word pairs that occur `least` times."""
    sieve = documents.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, found in _words(batches):
            size = len(found.words)
            at = _followers(found.codes, sieve.value.passes(found.hashes(_seed(lang))))
            for own in _bands(found.codes, at):
                keys = found.codes[own].astype(np.int64) * size + found.codes[own + 1]
                pairs, times = np.unique(keys, return_counts=True)
                for some in _cut(len(pairs)):
                    first, second = map(found.at, np.divmod(pairs[some], size))
                    text = pc.binary_join_element_wise(first, second, " ")
                    columns = [pa.array([lang] * len(text)), text, pa.array(times[some])]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "f"])

    counted = _texts(documents).mapInArrow(run, "lang string, phrase string, f long")
    totals = counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return totals.filter(F.col("f") >= least)


def _heavy(phrases: DataFrame, budget: int) -> np.ndarray:
    """Hashes of the prefixes with more suffixes than the budget: at most total / budget."""
    rows = phrases.filter(F.col("f") > budget).select("lang", "phrase").toArrow()
    found = [_phrase_hashes(batch) for batch in rows.to_batches()]
    return np.sort(np.concatenate([np.zeros(0, np.uint64), *found]))


def _group_of(hashes: list[np.ndarray], heavy: list[np.ndarray], groups: int) -> np.ndarray:
    """Group of each suffix, by the shortest of its prefixes that is not heavy."""
    prefix = hashes[0]
    key = prefix.copy()
    extend = np.ones(len(prefix), bool)
    for level, longer in zip(heavy, hashes[1:], strict=True):
        extend &= np.isin(prefix, level)
        prefix = _joint(prefix, longer)
        key = np.where(extend, prefix, key)
    key = _joint(key, key)
    return (key % np.uint64(groups)).astype(np.int32)


def suffixes(
    documents: DataFrame,
    pairs: Sieve,
    heavy: tuple[np.ndarray, np.ndarray],
    groups: int,
    longest: int,
) -> DataFrame:
    """(part, lang, p, w4, ..., n): suffixes of three words or more, the first three as one text."""
    sieve, extended = map(documents.sparkSession.sparkContext.broadcast, (pairs, heavy))
    tail = [f"w{k}" for k in range(4, longest + 1)]
    schema = ", ".join(
        ["part int", "lang string", "p string", *(f"{t} string" for t in tail), "n long"]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, found in _words(batches):
            hashes = found.hashes(_seed(lang))
            passing = np.pad(_passing(found.codes, hashes, sieve.value), (0, longest))
            codes = np.pad(found.codes, (0, longest), constant_values=-1)
            starts = np.flatnonzero(passing[:-1] & passing[1:]).astype(np.int32)
            for own in _bands(codes, starts):
                columns = [codes[own + k] for k in range(3)]
                alive = np.ones(len(own), bool)
                for k in range(3, longest):
                    alive &= passing[own + k - 1]
                    columns.append(np.where(alive, codes[own + k], -1))
                # Equal suffixes lie side by side in this order.
                keys = _packed(columns, len(found.words))
                order = np.lexsort(keys[::-1])
                new = np.ones(len(order), bool)
                new[1:] = np.any([np.diff(key[order]) != 0 for key in keys], axis=0)
                edges = np.flatnonzero(new)
                times = np.diff(np.append(edges, len(order)))
                for some in _cut(len(edges)):
                    rows = [c[order[edges[some]]] for c in columns]
                    three = [hashes[c] for c in rows[:3]]
                    text = pc.binary_join_element_wise(*(found.at(c) for c in rows[:3]), " ")
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(_group_of(three, extended.value, groups)),
                            pa.array([lang] * len(text)),
                            text,
                            *(found.at(c) for c in rows[3:]),
                            pa.array(times[some]),
                        ],
                        names=["part", "lang", "p", *tail, "n"],
                    )

    return _texts(documents).mapInArrow(run, schema)


def _node_totals(least: int, longest: int):
    """Sorted suffixes of whole groups to the nodes that have enough leaves."""
    tail = [f"w{k}" for k in range(4, longest + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The path the rows so far ended in, and the totals of its nodes.
        path: list[str | None] = [None] * (len(tail) + 2)
        totals = [0] * (len(tail) + 1)
        for batch in batches:
            if not len(batch):
                continue
            columns = [batch.column(name) for name in ("lang", "p", *tail)]
            counts = batch.column("n").to_numpy()
            new = np.zeros(len(batch), bool)
            found = []
            for depth, column in enumerate(columns):
                before = pa.concat_arrays([pa.array([path[depth]], pa.string()), column[:-1]])
                same = pc.equal(column, before).fill_null(False)
                neither = pc.and_(pc.is_null(column), pc.is_null(before))
                new = new | ~pc.or_(same, neither).to_numpy(zero_copy_only=False)
                if depth == 0:
                    continue
                # Node totals of this depth; the first run goes on from the batch before.
                edges = np.union1d(np.flatnonzero(new), [0])
                sums = np.add.reduceat(counts, edges)
                closed = []
                if new[0]:
                    closed.append((path[: depth + 1], totals[depth - 1]))
                else:
                    sums[0] += totals[depth - 1]
                full = edges[:-1][sums[:-1] >= least]
                values = sums[:-1][sums[:-1] >= least]
                rows = [c.take(pa.array(full)).to_pylist() for c in columns[: depth + 1]]
                closed += zip(zip(*rows, strict=True), values.tolist(), strict=True)
                found += ((node, f) for node, f in closed if node[-1] is not None and f >= least)
                totals[depth - 1] = int(sums[-1])
            path = [c[-1].as_py() for c in columns]
            yield nodes(found)
        last = [(path[: depth + 1], totals[depth - 1]) for depth in range(1, len(path))]
        yield nodes([(node, f) for node, f in last if node[-1] is not None and f >= least])

    def nodes(found) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([node[0] for node, _ in found], pa.string()),
                pa.array([" ".join(node[1:]) for node, _ in found], pa.string()),
                pa.array([f for _, f in found], pa.int64()),
            ],
            names=["lang", "phrase", "f"],
        )

    return run


def phrase_counts(
    documents: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    budget: int = BUDGET,
    most_groups: int = GROUPS,
    sieve_bits: int = SIEVE_BITS,
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases that occur `least` times, and (lang, n) of all words.

    `longest` is three words at least.
    """
    words = stored(word_counts(documents), "words")
    totals = stored(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    frequent = words.filter(F.col("f") >= least)
    pairs = stored(
        pair_counts(documents, build_sieve(frequent, sieve_bits), least), "word-pairs"
    )
    n_suffixes = pairs.agg(F.sum("f")).first()[0] or 0
    budget = max(budget, -(-n_suffixes // most_groups))
    groups = max(1, -(-n_suffixes // budget))
    heavy = (_heavy(frequent, budget), _heavy(pairs, budget))
    rows = suffixes(documents, build_sieve(pairs, sieve_bits), heavy, groups, longest)
    tail = [f"w{k}" for k in range(4, longest + 1)]
    nodes = (
        rows.repartition(groups, "part")
        .sortWithinPartitions("lang", "p", *tail)
        .drop("part")
        .mapInArrow(_node_totals(least, longest), "lang string, phrase string, f long")
    )
    return stored(frequent.union(pairs).union(nodes), "phrases"), totals


def _first_words(phrase: str, k: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), F.lit(1), k), " ")


def _cuts(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates with their lowest-scoring cut: (lang, phrase, words, a, l, r, n, score)."""
    candidates = phrases.withColumn("words", F.size(F.split("phrase", " "))).filter("words > 1")
    cut = candidates.select(
        "lang",
        "phrase",
        "words",
        F.col("f").alias("a"),
        F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"),
    ).select(
        "*",
        _first_words("phrase", F.col("k")).alias("left"),
        F.array_join(
            F.slice(F.split("phrase", " "), F.col("k") + 1, F.col("words") - F.col("k")), " "
        ).alias("right"),
    )
    left = phrases.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))

    def wide(name: str) -> Column:
        return F.col(name).cast("decimal(38,0)")

    thousand = F.lit(1000).cast("decimal(38,0)")
    scored = (
        cut.join(left, ["lang", "left"])
        .join(right, ["lang", "right"])
        .join(totals, "lang")
        .withColumn("above", thousand * wide("a") * wide("n"))
        .withColumn("below", wide("l") * wide("r"))
        .withColumn("score", F.expr("above div below"))
    )
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return (
        scored.groupBy("lang", "phrase", "words", "a", "n")
        .agg(lowest)
        .select("lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score")
    )


def _apart(candidates: DataFrame, longest: int) -> DataFrame:
    """Candidates that no longer one holds as often as they occur.

    What lies between a phrase and a longer one that is as frequent is as frequent too, so
    the longer ones by one word tell it all.
    """
    words = F.split("phrase", " ")
    inner = F.array(
        F.array_join(F.slice(words, F.lit(1), F.col("words") - 1), " "),
        F.array_join(F.slice(words, F.lit(2), F.col("words") - 1), " "),
    )
    held = (
        candidates.filter("words > 2")
        .select("lang", F.explode(inner).alias("phrase"), "a")
        .distinct()
    )
    return candidates.join(held, ["lang", "phrase", "a"], "left_anti")


def mine(
    documents: DataFrame,
    top: int = TOP,
    least: int = LEAST,
    longest: int = LONGEST,
    budget: int = BUDGET,
    sieve_bits: int = SIEVE_BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best `top` phrases of every language."""
    phrases, totals = phrase_counts(documents, least, longest, budget, sieve_bits=sieve_bits)
    found = _apart(_cuts(phrases, totals), longest).drop("words")
    # A part of a language first, so none is sorted whole in one task.
    salted = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    order = "ORDER BY score DESC, a DESC, phrase"
    few = salted.withColumn(
        "place", F.expr(f"row_number() OVER (PARTITION BY lang, salt {order})")
    ).filter(F.col("place") <= top)
    ranked = few.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang {order})"))
    return ranked.filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
