"""MinHash near-dedup: documents posted under coordinate-value pairs, collisions counted by list.

A document is the set of its distinct word shingles. Its signature has 32 coordinates, and each
coordinate with its value is one token. Documents link if their sets have a Jaccard similarity of
at least 0.8, which is confirmed on the whole sets of 64-bit shingle hashes.

Candidates are pairs of signatures that agree in at least `MATCHES` = 10 coordinates. A pair at
similarity 0.8 agrees in fewer with a chance below 5e-10; no other step can lose a link.

* Equal sets are one class from the start, so groups of copies are one row.
* Only tokens that several classes share are kept, and a class with under 10 of them is done.
* Prefix and skip merging: in one order of all tokens, rarest first, two classes with 10 tokens in
  common share one outside their 9 most frequent ones. So the 9 longest lists of a class are
  skipped and only the others are merged; the collisions in skipped lists are counted afterwards
  on the signatures of the pairs found.
* Lists of up to `CROWD` classes give their pairs. A longer list only gives the pairs of its most
  central class (that with the most frequent tokens) with each other one, one row per posting.
* Classes that long lists hold together and that these pairs have not made one component are
  compared whole, in blocks: a block has a bounded number of hashes and sets of like size, each
  pair of blocks of sizes that can reach the similarity is one task, except two blocks of the
  component that most of the crowd is in already. A task returns links that span what it found.

Defined cases: a null text, or one without words, has an empty set and is linked with nothing; fewer
words than the shingle length make one shingle; equal texts and equal rows share a class; a row
without doc_id takes part in links but never names a class unless no row of it has an id, then
component_id is null; very long texts are hashed in blocks and held once as words and as hashes in
one task; an empty table gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.components import components
from tramline.llm.tables import stored

SHINGLE = 4
SIMILARITY = 80  # per cent
COORDINATES = 32
MATCHES = 10
CROWD = 64
# Shingle hashes in one block of a crowd.
BLOCK = 200_000
# Shingles hashed at once.
PART = 1 << 13
SEED = 42

_CHANCE = np.random.default_rng(SEED)
_FACTORS = _CHANCE.integers(0, 1 << 63, COORDINATES, np.uint64) * np.uint64(2) + np.uint64(1)
_MASKS = _CHANCE.integers(0, 1 << 63, COORDINATES, np.uint64)
# The low bits of a token hold the number of its coordinate.
_NUMBERS = np.arange(COORDINATES, dtype=np.uint64)


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct XXH64 hashes of the shingles of UTF-8 text, in order."""
    words = text.lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    size = min(shingle, len(words))
    digest, parts = xxhash.xxh64_digest, []
    for at in range(0, len(words) - size + 1, PART):
        part = words[at : at + PART + size - 1]
        joined = map(b" ".join, zip(*(part[k:] for k in range(size)), strict=False))
        parts.append(np.frombuffer(b"".join([digest(s, SEED) for s in joined]), ">u8"))
    return np.unique(np.concatenate(parts).astype(np.uint64))


def signature(hashes: np.ndarray) -> np.ndarray:
    """Tokens of a set that is not empty: the least value of each coordinate, with its number."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), PART):
        values = (hashes[at : at + PART, None] ^ _MASKS) * _FACTORS
        np.minimum(least, values.min(axis=0), out=least)
    return ((least & ~np.uint64(COORDINATES - 1)) | _NUMBERS).view(np.int64)


def _lists(flat: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, flat)])
    values = np.concatenate(flat) if flat else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def signatures(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, n_shingles, digest, tokens), one row per input row.

    `digest` is that of the whole set, null if the set is empty, and `tokens` is empty then.
    """
    id_type = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, text_key long, n_shingles long, digest binary, tokens array<long>"
    nothing = np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, tokens = [], [], []
            for text in batch.column(2):
                hashes = shingle_hashes(text.as_py() or b"", shingle)
                sizes.append(len(hashes))
                some = len(hashes) > 0
                digests.append(blake2b(hashes.tobytes(), digest_size=16).digest() if some else None)
                tokens.append(signature(hashes) if some else nothing)
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                _lists(tokens, pa.int64()),
            ]
            names = ["doc_id", "text_key", "n_shingles", "digest", "tokens"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return _keyed(documents).mapInArrow(run, schema)


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(
        "doc_id", F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("text")
    )


def _classes(rows: DataFrame) -> DataFrame:
    """One row per distinct set: its number, its smallest doc_id and a row that has it."""
    # Ids before nulls.
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    return (
        rows.filter("digest is not null")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("smallest"),
            F.min(row).alias("row"),
            F.first("n_shingles").alias("n"),
            F.first("tokens").alias("tokens"),
        )
        # Numbers are drawn once, as the table is written.
        .withColumn("node", F.monotonically_increasing_id())
    )


def _prefixes(classes: DataFrame, matches: int) -> DataFrame:
    """(token, node, weight): postings of each class without its longest lists."""
    postings = classes.select("node", F.explode("tokens").alias("token"))
    # Written first, so that the join below can split a token of very many classes.
    shared = stored(
        postings.groupBy("token").agg(F.count("*").alias("times")).filter("times > 1"),
        "shared-tokens",
    )
    found = F.array_sort(F.collect_list(F.struct("times", "token")))
    return (
        postings.join(shared, "token")
        .groupBy("node")
        .agg(found.alias("found"), F.sum("times").alias("weight"))
        .filter(F.size("found") >= matches)
        .withColumn("merged", F.slice("found", F.lit(1), F.size("found") - (matches - 1)))
        .select("node", "weight", F.explode("merged.token").alias("token"))
    )


def _met(postings: DataFrame, crowd: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of short lists, and pairs of a long list's most central class with the others."""
    lists = stored(
        postings.groupBy("token")
        .agg(F.count("*").alias("members"), F.max(F.struct("weight", "node")).alias("centre"))
        .filter("members > 1"),
        "posting-lists",
    )
    known = postings.select("token", "node").join(lists, "token")
    short = (
        known.filter(F.col("members") <= crowd)
        # Dealt again, so that the join before may split a long list.
        .repartition("members", "token")
        .groupBy("members", "token")
        .agg(F.array_sort(F.collect_list("node")).alias("nodes"))
        .select("nodes", F.posexplode("nodes").alias("at", "a"))
        .select("a", F.explode(F.slice("nodes", F.col("at") + 2, F.size("nodes"))).alias("b"))
    )
    star = known.filter(F.col("members") > crowd).select(
        F.least("node", "centre.node").alias("a"), F.greatest("node", "centre.node").alias("b")
    )
    return short.distinct(), star.filter("a <> b").distinct()


def _retained(
    pairs: DataFrame, classes: DataFrame, matches: int, similarity: int
) -> DataFrame:
    """Pairs of signatures with enough collisions, skipped lists too, and of like sizes."""
    own = classes.select("node", "n", "tokens")
    left = own.select(*(F.col(c).alias(f"{c}_a") for c in own.columns))
    right = own.select(*(F.col(c).alias(f"{c}_b") for c in own.columns))
    return (
        pairs.join(left, F.col("a") == F.col("node_a"))
        .join(right, F.col("b") == F.col("node_b"))
        .filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * similarity)
        .filter(F.size(F.array_intersect("tokens_a", "tokens_b")) >= matches)
        .select("a", "b")
    )


def _sets(documents: DataFrame, classes: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """(node, n, hashes): whole sets of the classes named, from the text of one row of each."""
    wanted = classes.join(nodes.distinct(), "node").select(
        "node",
        F.col("row.doc_id").alias("wanted_id"),
        F.col("row.text_key").alias("wanted_key"),
    )
    rows = _keyed(documents)
    same = (rows["text_key"] == F.col("wanted_key")) & rows["doc_id"].eqNullSafe(F.col("wanted_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, text in zip(*batch.columns, strict=True):
                hashes = shingle_hashes(text.as_py() or b"", shingle)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([node.as_py()], pa.int64()),
                        pa.array([len(hashes)], pa.int64()),
                        pa.array([hashes.tobytes()], pa.binary()),
                    ],
                    names=["node", "n", "hashes"],
                )

    found = rows.join(wanted, same).select("node", "text")
    # Rows that repeat as a whole gave their set several times.
    return found.mapInArrow(run, "node long, n long, hashes binary").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Pairs whose sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("hashes_a"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hashes_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for one, other in zip(batch.column(2), batch.column(3), strict=True):
                x = np.frombuffer(one.as_buffer(), np.uint64)
                y = np.frombuffer(other.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                kept.append(100 * common >= similarity * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    # The sets of one side meet the pairs first, so only that side moves with them.
    met = pairs.join(right, "b").join(left, "a").select("a", "b", "hashes_a", "hashes_b")
    return met.mapInArrow(run, "a long, b long")


def _blocks(
    members: DataFrame, similarity: int, block: int
) -> tuple[DataFrame, DataFrame]:
    """Members with their block, and the pairs of blocks to compare.

    `members` has (crowd, node, n, component). Sizes of sets that can reach the similarity
    are in one size class or in neighbouring ones.
    """
    sizes = members.groupBy("crowd", "component").agg(F.count("*").alias("times"))
    main = sizes.groupBy("crowd").agg(
        F.max(F.struct("times", "component")).alias("main"), F.count("*").alias("n_components")
    )
    # A class is a little wider than the similarity, so rounding does no harm.
    width = math.log(1.04 * 100 / similarity)
    placed = members.join(main.filter("n_components > 1"), "crowd").select(
        "crowd",
        "node",
        "n",
        F.floor(F.log("n") / width).alias("size_class"),
        (F.col("component") == F.col("main.component")).alias("settled"),
    )
    key = ["crowd", "size_class", "settled"]
    groups = placed.groupBy(*key).agg(F.ceil(F.sum("n") / block).alias("n_blocks"))
    number = F.pmod(F.xxhash64("node"), F.col("n_blocks")).alias("part")
    placed = placed.join(groups, key).select(*key, number, "node", "n")
    found = groups.select(*key, F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("part"))
    other = found.select(*(F.col(c).alias(f"{c}_2") for c in found.columns))
    pairs = (
        found.withColumn("near", F.explode(F.array(F.col("size_class"), F.col("size_class") + 1)))
        .join(other, (F.col("crowd") == F.col("crowd_2")) & (F.col("near") == F.col("size_class_2")))
        .filter(~(F.col("settled") & F.col("settled_2")))
        .filter(
            (F.col("near") > F.col("size_class"))
            | (F.struct("settled", "part") <= F.struct("settled_2", "part_2"))
        )
        .withColumn("pair", F.monotonically_increasing_id())
    )
    return placed, pairs


def _spanning(similarity: int):
    """Links within one pair of blocks that connect all that are similar enough."""

    def run(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        sides = table.column("side").to_numpy()
        sets = [
            np.frombuffer(value.as_buffer(), np.uint64) for value in table.column("hashes")
        ]
        sizes = np.array([len(s) for s in sets], np.int64)
        codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
        starts = np.cumsum([0, *sizes[:-1]])
        mark = np.zeros(codes.max() + 1, np.int64)
        # One block is met with itself if there is no second side.
        right = np.flatnonzero(sides == sides.max())
        left = np.flatnonzero(sides == sides.min())
        one = np.concatenate([codes[starts[r] : starts[r] + sizes[r]] for r in right])
        cuts = np.cumsum([0, *sizes[right][:-1]])
        labels = np.arange(len(nodes))
        links = []
        for x in left:
            own = codes[starts[x] : starts[x] + sizes[x]]
            mark[own] = 1
            common = np.add.reduceat(mark[one], cuts)
            mark[own] = 0
            near = right[100 * common >= similarity * (sizes[x] + sizes[right] - common)]
            for label in np.setdiff1d(labels[near], labels[x]):
                links.append((nodes[x], nodes[near[labels[near] == label][0]]))
                labels[labels == label] = labels[x]
        a, b = zip(*links, strict=True) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _crowd_links(
    members: DataFrame, sets: DataFrame, similarity: int, block: int
) -> DataFrame:
    """Links of the crowds, by blocks."""
    placed, pairs = _blocks(members, similarity, block)
    pairs = stored(pairs, "block-pairs")
    key = ["crowd", "size_class", "settled", "part"]
    one = pairs.select("pair", F.lit(0).alias("side"), *key)
    two = pairs.select("pair", F.lit(1).alias("side"), *(F.col(f"{c}_2").alias(c) for c in key))
    itself = F.lit(True)
    for name in key:
        itself = itself & (F.col(name) == F.col(f"{name}_2"))
    two = two.join(pairs.filter(itself).select("pair"), "pair", "left_anti")
    held = placed.join(sets.select("node", "hashes"), "node")
    return (
        one.union(two)
        .join(held, key)
        .select("pair", "side", "node", "hashes")
        .groupBy("pair")
        .applyInArrow(_spanning(similarity), "a long, b long")
    )


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node"))


def _roots(
    documents: DataFrame,
    classes: DataFrame,
    shingle: int,
    similarity: int,
    matches: int,
    crowd: int,
    block: int,
) -> DataFrame:
    """(node, root) of all classes that are linked with another one."""
    postings = stored(_prefixes(classes, matches), "postings")
    short, star = _met(postings, crowd)
    star = stored(star, "long-lists")
    pairs = stored(_retained(short.union(star).distinct(), classes, matches, similarity), "pairs")
    sets = stored(
        _sets(documents, classes, _ends(pairs).union(_ends(star)), shingle), "shingle-sets"
    )
    links = stored(_confirmed(pairs, sets, similarity), "links")
    roots = components(links)
    if star.isEmpty():
        return roots
    crowds = components(star)
    members = (
        crowds.union(crowds.select("root", "root").distinct())
        .toDF("node", "crowd")
        .join(sets.select("node", "n"), "node")
        .join(roots, "node", "left")
        .select("crowd", "node", "n", F.coalesce("root", "node").alias("component"))
    )
    more = _crowd_links(stored(members, "crowds"), sets, similarity, block)
    return components(links.union(stored(more, "crowd-links")))


def near_duplicates(
    documents: DataFrame,
    shingle: int = SHINGLE,
    similarity: int = SIMILARITY,
    matches: int = MATCHES,
    crowd: int = CROWD,
    block: int = BLOCK,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row.

    `similarity` is in per cent, `matches` the collisions a pair needs to be confirmed.
    """
    rows = stored(signatures(documents, shingle), "signatures")
    classes = stored(_classes(rows), "classes")
    roots = _roots(documents, classes, shingle, similarity, matches, crowd, block)
    labelled = classes.join(roots, "node", "left").select(
        "digest", "smallest", F.coalesce("root", "node").alias("root")
    )
    names = labelled.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = labelled.join(names, "root").select("digest", "component_id")
    linked = rows.filter("digest is not null").join(named, "digest")
    alone = rows.filter("digest is null").withColumn("component_id", F.col("doc_id"))
    return (
        linked.select("doc_id", "n_shingles", "component_id")
        .union(alone.select("doc_id", "n_shingles", "component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
