"""SimHash near-dedup with an anchor covering.

Fingerprints that differ in at most two bits differ in at most one bit of one 32-bit half.
The code words of the perfect [31,26] Hamming code are the anchors: every 31-bit string has
one within distance 1 (the covering radius). Each half of a fingerprint, taken without its
top bit, is replicated to all anchors within 1 + 1 = 2: one if it is a code word, else 16. Of
two near fingerprints, one half of the first has its anchor within 1, and the other lies within
2 of the same anchor: they meet there and are compared in full.

A fingerprint goes to at most 32 anchors, so no anchor holds more than 1/16 of a half's rows,
and equal fingerprints are one row before that. An anchor with more than `CROWD` fingerprints
(one dense cluster) is not compared pair by pair: its fingerprints are grouped by all 65
strings within one bit of them. Two fingerprints within two bits share such a string, and all
that share one are within two bits, so linking each to the smallest is exact and linear.

Defined cases: a null or empty text, or one without words, has fingerprint zero and is linked
like any other; fewer words than the shingle length make one shingle of all; equal rows share a
class; a row without doc_id takes part in links but never names a class unless its class has no id;
very long texts are hashed a block of shingles at a time; an empty table gives an empty result; other
columns are not read, and `one_of_each` hands them on as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.components import components, join_hubs
from tramline.llm.tables import field, join_same, packed, stored, unpacked

SHINGLE = 3
MAX_BITS = 2
SEED = 42
CROWD = 64
HALF_BITS = 31
# Shingles whose bits are counted at once.
BLOCK = 1 << 15


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint of UTF-8 text; bit i is set if set in over half the shingle hashes."""
    words = text.lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    size = min(shingle, len(words))
    counts = np.zeros(64, np.int64)
    total = len(words) - size + 1
    digest = xxhash.xxh64_digest
    for at in range(0, total, BLOCK):
        part = words[at : at + BLOCK + size - 1]
        joined = map(b" ".join, zip(*(part[k:] for k in range(size)), strict=False))
        hashes = b"".join([digest(s, SEED) for s in joined])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, bits): the fingerprint as a signed long, one row per input row."""
    schema = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, bits long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [
                _signed(simhash(value.as_py() or b"", shingle)) for value in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(bits, pa.int64())], names=["doc_id", "bits"]
            )

    return documents.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, schema
    )


def _masks() -> np.ndarray:
    """By syndrome, what leads to every code word within two bits; row 0 holds only the word."""
    masks = np.zeros((HALF_BITS + 1, 16), np.int64)
    for syndrome in range(1, HALF_BITS + 1):
        pairs = {
            (1 << (i - 1)) | (1 << ((i ^ syndrome) - 1))
            for i in range(1, HALF_BITS + 1)
            if i != syndrome
        }
        masks[syndrome] = [1 << (syndrome - 1), *sorted(pairs)]
    return masks


def _syndromes(values: np.ndarray) -> np.ndarray:
    """XOR of the positions, from 1, of the bits that are set."""
    result = np.zeros(len(values), np.int64)
    for position in range(1, HALF_BITS + 1):
        result ^= np.where((values >> (position - 1)) & 1, position, 0)
    return result


def anchors(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, fingerprint) of every replica; the top half's anchors have bit 31 set."""
    masks, keys, replicas = _masks(), [], []
    for half in (0, 1):
        part = (bits >> (32 * half)) & ((1 << HALF_BITS) - 1)
        syndromes = _syndromes(part)
        exact = syndromes == 0
        keys.append(part[exact] | (half << HALF_BITS))
        replicas.append(bits[exact])
        words = part[~exact, None] ^ masks[syndromes[~exact]]
        keys.append(words.ravel() | (half << HALF_BITS))
        replicas.append(np.repeat(bits[~exact], 16))
    return np.concatenate(keys), np.concatenate(replicas)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        keys, replicas = anchors(values)
        for at in range(0, len(keys), 100_000):
            part = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[part]), pa.array(replicas[part])], names=["anchor", "bits"]
            )


def _pairs(
    keys: np.ndarray, bits: np.ndarray, most: int, crowd: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of one key; keys are in order and hold `crowd` rows at most."""
    left, right = [], []
    at = np.arange(len(keys))
    for shift in range(1, crowd):
        at = at[at + shift < len(keys)]
        at = at[keys[at] == keys[at + shift]]
        if not len(at):
            break
        x, y = bits[at], bits[at + shift]
        near = np.bitwise_count((x ^ y).view(np.uint64)) <= most
        left.append(x[near])
        right.append(y[near])
    empty = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (empty, empty)


def _compare(most: int, crowd: int):
    """Partitions in order of the anchor: (a, b) is a link, (a, null) a member of a crowd."""

    def batch_of(a, b) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, bits = np.zeros(0, np.int64), np.zeros(0, np.int64)
        ended_in = None  # key of the crowd that the rows so far ended in
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
            bits = np.concatenate([bits, batch.column(1).to_numpy(zero_copy_only=False)])
            yield from done(keys, bits, ended_in, last=False)
            keys, bits, ended_in = rest(keys, bits, ended_in)
        yield from done(keys, bits, ended_in, last=True)

    def split(keys: np.ndarray, ended_in: int | None, last: bool):
        """Rows of crowds, rows of whole small groups; the open last group is in neither."""
        _, first, times = np.unique(keys, return_index=True, return_counts=True)
        many = times > crowd
        if ended_in is not None and len(keys) and keys[0] == ended_in:
            many[0] = True
        whole = np.ones(len(times), bool)
        if not last and len(times):
            whole[-1] = many[-1]
        return np.repeat(many, times), np.repeat(whole & ~many, times)

    def done(keys, bits, ended_in, last):
        crowded, small = split(keys, ended_in, last)
        a, b = _pairs(keys[small], bits[small], most, crowd)
        if len(a):
            yield batch_of(a, b)
        if crowded.any():
            yield batch_of(bits[crowded], [None] * int(crowded.sum()))

    def rest(keys, bits, ended_in):
        crowded, small = split(keys, ended_in, False)
        open_rows = ~(crowded | small)
        ended_in = keys[-1] if len(keys) and crowded[-1] else None
        return keys[open_rows], bits[open_rows], ended_in

    return run


def _within_one_bit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flips = np.concatenate([[0], np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))])
    flips = flips.astype(np.uint64).view(np.int64)
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(values), 2_000):
            part = values[at : at + 2_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array((part[:, None] ^ flips).ravel()), pa.array(np.repeat(part, 65))],
                names=["middle", "bits"],
            )


def links(distinct_bits: DataFrame, max_bits: int = MAX_BITS, crowd: int = CROWD) -> DataFrame:
    """(a, b) links that connect all fingerprints within `max_bits` of each other."""
    if max_bits != 2:
        raise ValueError("the covering is laid out for two differing bits")
    replicas = distinct_bits.select("bits").mapInArrow(_replicate, "anchor long, bits long")
    met = stored(
        replicas.repartition("anchor")
        .sortWithinPartitions("anchor", "bits")
        .mapInArrow(_compare(max_bits, crowd), "a long, b long"),
        "anchor-links",
    )
    crowds = met.filter("b is null").select(F.col("a").alias("bits")).distinct()
    around = crowds.mapInArrow(_within_one_bit, "middle long, bits long")
    hubs = around.groupBy("middle").agg(
        F.min("bits").alias("a"), F.collect_set("bits").alias("members")
    )
    close = hubs.select("a", F.explode("members").alias("b")).filter("a <> b")
    return met.filter("b is not null").union(close)


def near_duplicates(
    documents: DataFrame,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    crowd: int = CROWD,
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row."""
    rows = stored(fingerprints(documents, shingle), "fingerprints")
    distinct = stored(
        rows.groupBy("bits").agg(F.min("doc_id").alias("smallest")), "distinct-fingerprints"
    )
    roots = components(links(distinct, max_bits, crowd))
    labelled = distinct.join(roots, distinct["bits"] == roots["node"], "left").select(
        "bits", "smallest", F.coalesce("root", "bits").alias("class")
    )
    names = labelled.groupBy("class").agg(
        F.min("smallest").alias("component_id"), F.count("*").alias("times")
    )
    classes = stored(
        join_hubs(labelled, names, "class", distinct.count()).select("bits", "component_id"), "classes"
    )
    return rows.join(classes, "bits").select(
        "doc_id",
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(
    documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """Rows of the document that names its class, repeated rows once; all columns stay."""
    classes = near_duplicates(documents, shingle, max_bits)
    keep = (
        classes.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy(F.col("doc_id").alias("document"))
        .agg(F.count("*").alias("times"))
    )
    kept = join_same(packed(documents, document=F.col("doc_id")), keep, ["document"], "inner")
    # Few ids occur in several rows; only those are shuffled again.
    once = kept.filter("times = 1").withColumn("text", F.lit(None).cast("string"))
    several = kept.filter("times > 1").withColumn("text", field("text"))
    return unpacked(
        once.unionByName(several.dropDuplicates(["document", "text"])), documents
    )
