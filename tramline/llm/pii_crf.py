"""Personal data: fixed patterns, and a skip-chain conditional random field around them.

The base spans are what four patterns match. The field then labels the tokens that may belong to
personal data: those with a digit or an @, and those equal to the name before the @ of an
address in the text. Potentials come from the token's shape, from the label of the token just
before it (chain), and from the labels of equal or similar tokens anywhere in the document
(skip links). Each occurrence is linked to the first of its group, so links grow with the tokens
and evidence reaches every occurrence in two steps. Loopy message passing spreads it until no message
changes by `STILL`, or for `MOST_ROUNDS` where loops never settle; the labels of base spans are
fixed during it. Tokens
that end up with an entity label at a chance that was measured to be right often enough and lie outside
of base spans are added as spans of a kind of their own, `like_email` and so on, so that counts of the
four kinds are those of the patterns.

Weights are trained on spans that the patterns do not give away: a share `BROKEN` of the base spans
of the sample is damaged (an address loses its domain's end or is split, a number loses a digit, its
sign or a part), names of addresses and bare digits of phone numbers are repeated alone, and the labels
of all those stay.
Shapes are fitted by softmax regression on indicators that are none of the patterns' own tests,
chain and skip potentials from how often labels meet. Every third text is kept out of that; on
those the lowest chance is found at which added labels are right in a share `PRECISION` of cases. Bound
of the sample: `SAMPLE` texts with a digit or an @, those with the smallest hashes of doc_id, none over
`SAMPLE_CHARS` characters.

Defined cases: a null or empty text has no spans; a text without digit and @ cannot have any and
is not tokenised; repeated rows each get their result; if nothing can be learned, or the table is
empty, only base spans are returned; a very long text is one graph of its candidate tokens, linear in
them; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
SAMPLE = 2_000
SAMPLE_CHARS = 50_000
SURE = 0.9
# Share of spans that are damaged for training, and how often added labels should be right.
BROKEN = 0.3
PRECISION = 0.9
LEAST_MEASURED = 20
STILL = 1e-4
MOST_ROUNDS = 200
DAMPING = 0.3
FIXED = 50.0

# Fixed patterns of the four kinds; an address is looked for from its @ on.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: before an @ that has a domain, the longest run of name characters."""
    free = at = 0
    while (at := text.find("@", at)) >= 0:
        domain = _DOMAIN.match(text, at)
        start = at
        if domain:
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
        if start < at:
            yield start, domain.end()
            free = at = domain.end()
        else:
            at += 1


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) in code points, by start, then by kind."""
    found: list[Span] = [("email", *span) for span in _emails(text)]
    if _DIGIT.search(text):
        for match in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in match[0].split(".")):
                found.append(("ip", *match.span()))
        for match in _CARD.finditer(text):
            digits = _digits(match[0]) if match.end() - match.start() >= 12 else ""
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *match.span()))
        for match in _PHONE.finditer(text) if "+" in text else ():
            if 9 <= len(_digits(match[0])) <= 15:
                found.append(("phone", *match.span()))
    return sorted(found, key=lambda span: (span[1], KINDS.index(span[0])))


@dataclass
class Tokens:
    """The tokens of a text that can be personal data, in order."""

    spans: list[tuple[int, int]]
    words: list[str]
    follows: list[bool]  # only white space between it and the token before
    labels: list[int]  # by the base spans; 0 where there is none

    def __len__(self) -> int:
        return len(self.words)


_TOKEN = re.compile(r"\S+")
_EDGE = "\"'.,;:!?<>[]{}"


def tokens(text: str, base: list[Span]) -> Tokens:
    names = {text[s:e].split("@")[0].casefold() for kind, s, e in base if kind == "email"}
    found = Tokens([], [], [], [])
    before = -1
    for number, match in enumerate(_TOKEN.finditer(text)):
        raw = match[0]
        if not ("@" in raw or _DIGIT.search(raw) or raw.strip(_EDGE).casefold() in names):
            continue
        word = raw.strip(_EDGE) or raw
        start = match.start() + raw.index(word)
        found.spans.append((start, start + len(word)))
        found.words.append(word)
        found.follows.append(number == before + 1)
        before = number
    found.labels = labels_of(found.spans, base)
    return found


def labels_of(places: list[tuple[int, int]], spans: list[Span]) -> list[int]:
    """The label of each place by the spans it meets, 0 if it meets none."""
    order = sorted(spans, key=lambda span: span[1])
    labels, at = [], 0
    for start, end in places:
        while at < len(order) and order[at][2] <= start:
            at += 1
        near = order[at : at + len(KINDS)]
        labels.append(next((1 + KINDS.index(k) for k, s, e in near if s < end and e > start), 0))
    return labels


def _broken(kind: str, text: str, chance: random.Random) -> str:
    """A span's text, damaged so that its pattern mostly fails."""
    if kind == "email":
        name, _, domain = text.partition("@")
        return chance.choice([f"{name}@{domain.split('.')[0]}", f"{name} @{domain}"])
    if kind == "ip":
        parts, at = text.split("."), chance.randrange(4)
        parts[at : at + 1] = chance.choice([[], [str(256 + chance.randrange(744))]])
        return ".".join(parts)
    if kind == "phone":
        return text[1:]
    at = chance.randrange(1, len(text) - 1)
    return text[:at] + text[at + 1 :]


def damaged(
    text: str, base: list[Span], chance: random.Random, share: float = BROKEN
) -> tuple[str, list[Span]]:
    """The text with some of its spans damaged or repeated in part, and where all of them are."""
    parts, spans, tail = [], [], []
    size = at = 0
    for kind, start, end in base:
        if start < at:
            continue
        part = text[start:end]
        if chance.random() < share:
            part = _broken(kind, part, chance)
        elif kind in ("email", "phone") and chance.random() < share:
            tail.append((kind, part.split("@")[0] if kind == "email" else _digits(part)))
        parts += (text[at:start], part)
        size += start - at
        spans.append((kind, size, size + len(part)))
        size += len(part)
        at = end
    parts.append(text[at:])
    size += len(text) - at
    for kind, again in tail:
        parts.append(f" {again}")
        spans.append((kind, size + 1, size + 1 + len(again)))
        size += 1 + len(again)
    return "".join(parts), spans


def _shape(word: str, follows: bool) -> list[int]:
    """Places of the indicators of a token."""
    digits = _digits(word)
    letters = sum(c.isalpha() for c in word)
    facts = (
        True,
        "@" in word,
        "@" in word and "." in word.rpartition("@")[2],
        word.startswith("+"),
        word.startswith("("),
        "-" in word,
        word.count(".") == 3,
        word.count(".") in (2, 4),
        letters == 0,
        letters > len(digits),
        follows,
        *(len(digits) == n for n in range(8)),
        8 <= len(digits) <= 11,
        12 <= len(digits) <= 14,
        15 <= len(digits) <= 16,
        17 <= len(digits) <= 19,
        len(digits) > 19,
    )
    return [place for place, fact in enumerate(facts) if fact]


WIDTH = 24


def _features(found: Tokens) -> np.ndarray:
    """Indicators of each token, of the one before and of the one after it."""
    own = np.zeros((len(found) + 2, WIDTH))
    for n, (word, follows) in enumerate(zip(found.words, found.follows, strict=True)):
        own[n + 1, _shape(word, follows)] = 1.0
    before, after = own[:-2].copy(), own[2:].copy()
    follows = np.array(found.follows, bool)
    before[~follows] = 0.0
    after[:-1][~follows[1:]] = 0.0
    return np.hstack([own[1:-1], before, after])


def skip_links(found: Tokens) -> np.ndarray:
    """(first token, later token) of groups of equal words and of those with equal last digits.

    A word that is in two groups makes them one, so links alone form no loop.
    """
    first: dict[str, int] = {}
    group = list(range(len(found)))

    def head(n: int) -> int:
        while group[n] != n:
            group[n] = n = group[group[n]]
        return n

    for n, word in enumerate(found.words):
        digits = _digits(word)
        keys = ["=" + word.casefold()]
        if len(digits) >= 7:
            keys.append("~" + digits[-7:])
        if "@" in word:
            keys.append("=" + word.split("@")[0].casefold())
        for key in keys:
            one, other = sorted((head(first.setdefault(key, n)), head(n)))
            group[other] = one
    links = [(head(n), n) for n in range(len(found)) if head(n) != n]
    return np.array(links, np.int64).reshape(-1, 2)


@dataclass
class Field:
    """Log potentials: of shapes, of neighbouring labels, of labels across skip links.

    `sure` is the chance from which on a label is added.
    """

    shapes: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    sure: float = SURE

    def chances(self, found: Tokens) -> np.ndarray:
        """Marginals of the labels of every token, by loopy message passing."""
        nodes = _features(found) @ self.shapes
        fixed = np.flatnonzero(found.labels)
        nodes[fixed, np.array(found.labels)[fixed]] += FIXED
        chain = np.flatnonzero(np.array(found.follows, bool))
        chain = np.stack([chain - 1, chain], axis=1)
        skip = skip_links(found)
        pairs = np.concatenate([chain, skip])
        if not len(pairs):
            return _softmax(nodes)
        tables = np.concatenate(
            [np.repeat(t[None], len(e), 0) for t, e in ((self.chain, chain), (self.skip, skip))]
        )
        # Messages along each pair, then against it.
        source = np.concatenate([pairs[:, 0], pairs[:, 1]])
        target = np.concatenate([pairs[:, 1], pairs[:, 0]])
        tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
        messages = np.zeros((len(source), len(LABELS)))
        for _ in range(MOST_ROUNDS):
            belief = nodes.copy()
            np.add.at(belief, target, messages)
            out = belief[source] - messages[back]
            new = _log_sum(out[:, :, None] + tables)
            new -= new.max(axis=1, keepdims=True)
            moved = (1 - DAMPING) * (new - messages)
            messages = messages + moved
            if np.abs(moved).max() < STILL:
                break
        belief = nodes.copy()
        np.add.at(belief, target, messages)
        return _softmax(belief)


def _log_sum(values: np.ndarray) -> np.ndarray:
    top = values.max(axis=1, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=1, keepdims=True)))[:, 0]


def _softmax(values: np.ndarray) -> np.ndarray:
    spread = np.exp(values - values.max(axis=1, keepdims=True))
    return spread / spread.sum(axis=1, keepdims=True)


def _affinity(pairs: np.ndarray) -> np.ndarray:
    """Log of how much more often two labels meet than by chance, smoothed."""
    counts = np.full((len(LABELS), len(LABELS)), 0.1) + np.eye(len(LABELS))
    np.add.at(counts, (pairs[:, 0], pairs[:, 1]), 1.0)
    joint = counts / counts.sum()
    return np.log(joint / (joint.sum(axis=1, keepdims=True) * joint.sum(axis=0, keepdims=True)))


def train(texts: list[str], steps: int = 300) -> Field | None:
    """The field that fits damaged spans of the texts; None if no text has a candidate."""
    features, labels, chain, skip, unseen = [], [], [], [], []
    chance = random.Random(7)
    for number, text in enumerate(texts):
        text, spans = damaged(text, base_spans(text), chance)
        found = tokens(text, base_spans(text))
        if not len(found):
            continue
        known = np.array(labels_of(found.spans, spans))
        if number % 3 == 2:
            unseen.append((found, known))
            continue
        features.append(_features(found))
        labels.append(known)
        follows = np.flatnonzero(found.follows)
        chain.append(np.stack([known[follows - 1], known[follows]], axis=1))
        links = skip_links(found)
        skip.append(known[links])
    if not features:
        return None
    x, y = np.concatenate(features), np.eye(len(LABELS))[np.concatenate(labels)]
    weights = np.zeros((x.shape[1], len(LABELS)))
    speed = np.zeros_like(weights)
    for _ in range(steps):
        gradient = x.T @ (_softmax(x @ weights) - y) / len(x) + 1e-4 * weights
        speed = 0.9 * speed - 0.5 * gradient
        weights += speed
    both = np.concatenate(skip)
    both = np.concatenate([both, both[:, ::-1]])
    field = Field(weights, _affinity(np.concatenate(chain)), _affinity(both))
    field.sure = _sure(field, unseen)
    return field


def _sure(field: Field, unseen: list[tuple[Tokens, np.ndarray]]) -> float:
    """The lowest chance from which on added labels were right often enough; over 1 if none was."""
    sure, right = [np.zeros(0)], [np.zeros(0, bool)]
    for found, known in unseen:
        chances = field.chances(found)
        best = chances.argmax(axis=1)
        added = (np.array(found.labels) == 0) & (best > 0)
        sure.append(chances.max(axis=1)[added])
        right.append((best == known)[added])
    sure, right = np.concatenate(sure), np.concatenate(right)
    order = np.argsort(-sure)
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    enough = np.flatnonzero((share >= PRECISION) & (np.arange(1, len(order) + 1) >= LEAST_MEASURED))
    return float(sure[order[enough[-1]]]) if len(enough) else 1.1


def added_spans(text: str, base: list[Span], field: Field) -> list[Span]:
    """Spans that the field adds, outside of the base spans."""
    found = tokens(text, base)
    if not len(found) or all(found.labels):
        return []
    chances = field.chances(found)
    best = chances.argmax(axis=1)
    spans: list[Span] = []
    previous = -2
    for n, (start, end) in enumerate(found.spans):
        if found.labels[n] or not best[n] or chances[n, best[n]] < field.sure:
            continue
        kind = "like_" + LABELS[best[n]]
        if previous == n - 1 and found.follows[n] and spans[-1][0] == kind:
            spans[-1] = (kind, spans[-1][1], end)
        else:
            spans.append((kind, start, end))
        previous = n
    return spans


def find_spans(text: str | None, field: Field | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans by start)."""
    if not text or not ("@" in text or _DIGIT.search(text)):
        return [], []
    base = base_spans(text)
    if field is None:
        return base, base
    return base, sorted(
        base + added_spans(text, base, field),
        key=lambda span: (span[1], KINDS.index(span[0].removeprefix("like_")), span[0]),
    )


def fit(documents: DataFrame, sample: int = SAMPLE) -> Field | None:
    """Trains on a bounded sample of the texts that can hold personal data."""
    able = documents.filter(F.col("text").rlike("[0-9@]")).filter(
        F.length("text") <= SAMPLE_CHARS
    )
    size = max(able.count(), 1)
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    some = able.filter(share < 1.2 * sample / size * (1 << 20))
    # The smallest hashes, however the rows lie.
    chosen = some.orderBy(share, "doc_id", "text").select("text").limit(sample)
    return train(sorted(row["text"] for row in chosen.collect()))


SPANS = "array<struct<kind:string,start:int,end:int>>"


def personal_data(documents: DataFrame, field: Field | None) -> DataFrame:
    """(doc_id, base, spans), one row per input row: the pattern matches, and all spans."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    struct = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    fields = ("kind", "start", "end")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find_spans(text.as_py(), field) for text in batch.column(1)]
            columns = [
                pa.array(
                    [[dict(zip(fields, s, strict=True)) for s in f[n]] for f in found],
                    pa.list_(struct),
                )
                for n in (0, 1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], names=["doc_id", "base", "spans"]
            )

    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, base {SPANS}, spans {SPANS}"
    )
