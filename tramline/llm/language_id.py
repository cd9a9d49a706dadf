"""Language identification in two steps: the family first, then the language within it.

Texts are lower-cased, and counted as hashed n-grams of three and of four bytes, where
anything but a letter is a space. Counts of all training texts give each family a smoothed
multinomial model; the family with the highest chance is predicted. Languages of one family
are told apart by one-versus-one linear support vector machines over the logarithms of the
counts; each pair votes, and the mean margin of a language's pairs breaks ties.

Bound of the sample that the machines are fitted on: `SAMPLE` texts of each language, those with
the smallest hashes of doc_id, each with at most `SAMPLE_BYTES` bytes. The counts cover all training
texts. At most `LANGUAGES` languages are learned, those with the most texts, as their counts and
machines are held by the driver and every task. The table is read twice, whatever languages it has.

Defined cases: a text that is null or has no letter (of a Unicode category L) is `und` with score 1; a
language without a known family is one of its own; if nothing can be learned, or the table is empty,
every text with letters is `und` with score 0; very long texts are counted whole, a stretch at a time;
repeated rows count, and may be sampled, again; other columns than doc_id, text and lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.svm import SparseRows, dual_coordinate_descent, logistic
from tramline.llm.tables import stored

PLACE_BITS = 16
PLACES = 1 << PLACE_BITS
SAMPLE = 600
SAMPLE_BYTES = 50_000
LANGUAGES = 256
SMOOTHING = 0.5
COST = 10.0
FOLDS, HELD_OUT_FOLD = 4, 2
UNKNOWN = "und"

FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "bg", "pl", "cs", "sk", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "bn", "mr", "ur", "pa", "gu"),
}

_BYTE = np.arange(256, dtype=np.uint32)
_BYTE[:97], _BYTE[123:128] = 32, 32
_STRETCH = 1 << 20


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def family_of(language: str) -> str:
    for family, languages in FAMILIES.items():
        if language in languages:
            return family
    return language


def ngram_counts(text: str) -> np.ndarray:
    """How often each place is hit by the n-grams of the whole text."""
    data = _BYTE[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)]
    counts = np.zeros(PLACES, np.int64)
    for at in range(0, len(data), _STRETCH):
        part = data[at : at + _STRETCH + 3]
        three = part[:-2] | part[1:-1] << 8 | part[2:] << 16
        four = three[:-1] | part[3:] << 24
        if at + _STRETCH + 3 <= len(data):  # the next stretch begins with these
            three = three[:_STRETCH]
        for codes, odd in ((three, 0x9E3779B1), (four, 0x85EBCA6B)):
            hashed = (codes * np.uint32(odd)) >> np.uint32(32 - PLACE_BITS)
            counts += np.bincount(hashed, minlength=PLACES)
    return counts


def _vector(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    places = np.flatnonzero(counts)
    values = np.log1p(counts[places])
    norm = np.sqrt(values @ values)
    return places, values / norm if norm else values


@dataclass
class Model:
    families: list[str] = field(default_factory=list)
    # By family: log prior, and log share of every place.
    priors: np.ndarray = field(default_factory=lambda: np.zeros(0))
    shares: np.ndarray = field(default_factory=lambda: np.zeros((0, PLACES)))
    members: dict[str, list[str]] = field(default_factory=dict)
    pairs: dict[tuple[str, str], tuple[np.ndarray, float]] = field(default_factory=dict)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not has_letter(text):
            return UNKNOWN, 1.0
        if not self.families:
            return UNKNOWN, 0.0
        counts = ngram_counts(text)
        chances = self.priors + self.shares @ counts
        best = int(np.argmax(chances))
        family = self.families[best]
        sure = float(1.0 / np.exp(chances - chances[best]).sum())
        languages = self.members[family]
        if len(languages) == 1:
            return languages[0], sure
        places, values = _vector(counts)
        votes = dict.fromkeys(languages, 0)
        margin = dict.fromkeys(languages, 0.0)
        for one, other in combinations(languages, 2):
            weights, bias = self.pairs[one, other]
            value = float(weights[places] @ values + bias)
            votes[one if value >= 0 else other] += 1
            margin[one] += value
            margin[other] -= value
        winner = max(languages, key=lambda x: (votes[x], margin[x]))
        mean = margin[winner] / (len(languages) - 1)
        return winner, sure * float(logistic(4 * mean))


def held_out() -> Column:
    """Rows nothing is learned from."""
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT_FOLD


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by language of one partition; the place after the last counts texts."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if has_letter(text):
                held = counts.setdefault(lang, np.zeros(PLACES + 1, np.int64))
                held[:PLACES] += ngram_counts(text)
                held[PLACES] += 1
    for lang, held in counts.items():
        places = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(places)), pa.array(places.astype(np.int32)),
             pa.array(held[places])], names=["lang", "place", "n"]
        )


def fit(documents: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from text and lang of the rows outside the held-out fold."""
    train = documents.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sums = stored(
        train.select("text", "lang")
        .mapInArrow(_gather, "lang string, place int, n long")
        .groupBy("lang", "place")
        .agg(F.sum("n").alias("n")),
        "language-ngrams",
    )
    texts = sums.filter(F.col("place") == PLACES).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    learned = [row["lang"] for row in texts.collect()]
    # At most PLACES + 1 rows for each language.
    counts: dict[str, np.ndarray] = {}
    found = sums.filter(F.col("lang").isin(learned)).toArrow()
    langs = found["lang"].to_numpy()
    for lang in sorted(set(langs)):
        own = langs == lang
        counts[lang] = np.zeros(PLACES + 1)
        counts[lang][found["place"].to_numpy()[own]] = found["n"].to_numpy()[own]
    if not counts:
        return Model()
    model = Model()
    for lang in sorted(counts):
        model.members.setdefault(family_of(lang), []).append(lang)
    model.families = sorted(model.members)
    totals = np.array([sum(counts[x] for x in model.members[f]) for f in model.families])
    model.priors = np.log(totals[:, PLACES] / totals[:, PLACES].sum())
    shares = totals[:, :PLACES] + SMOOTHING
    model.shares = np.log(shares / shares.sum(axis=1, keepdims=True))
    related = [x for languages in model.members.values() if len(languages) > 1 for x in languages]
    vectors = _sampled(train, {x: counts[x][PLACES] for x in related}, sample)
    for languages in model.members.values():
        for one, other in combinations(languages, 2):
            model.pairs[one, other] = _pair(vectors.get(one, []), vectors.get(other, []))
    return model


def _sampled(train: DataFrame, sizes: dict[str, float], sample: int) -> dict[str, list]:
    """Vectors of about `sample` texts of each language, and never more, however rows lie."""
    vectors: dict[str, list] = {lang: [] for lang in sizes}
    if not sizes:
        return vectors
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    limit = F.lit(0.0)
    for lang, size in sizes.items():
        limit = F.when(F.col("lang") == lang, 1.2 * sample / size * (1 << 20)).otherwise(limit)
    some = (
        train.select("doc_id", "lang", "text", share.alias("share"))
        .filter((F.col("share") < limit) & (F.octet_length("text") <= SAMPLE_BYTES))
    )
    place = "row_number() OVER (PARTITION BY lang ORDER BY share, doc_id, text)"
    chosen = some.withColumn("number", F.expr(place)).filter(F.col("number") <= sample)
    for row in sorted(chosen.select("lang", "text").collect()):
        if has_letter(row["text"]):
            vectors[row["lang"]].append(_vector(ngram_counts(row["text"])))
    return vectors


def _pair(one: list, other: list) -> tuple[np.ndarray, float]:
    rows = [*one, *other]
    signs = np.array([1.0] * len(one) + [-1.0] * len(other))
    sparse = SparseRows([r[0] for r in rows], [r[1] for r in rows])
    return dual_coordinate_descent(sparse, signs, PLACES, np.full(len(rows), COST))


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per input row; no doc_id is in no fold."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(text.as_py()) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return documents.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text"
    ).mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
