"""BPE encoding and decoding over a trie of the distinct words.

Byte-pair merges are deterministic: the encoding of a string is known from the last token of
each of its prefixes. A token can follow another one if no merge crosses their border before
both are complete, so the last token of a prefix is the one token that ends there and may
follow the last token of what it leaves. The distinct words of a batch, in sorted order, are a
depth-first walk through their trie: the states of a prefix shared with the word before are
kept, and only the rest is computed. The last symbol of a word has an end mark of its own, so
it is a leaf of the trie and never mixes with inner symbols.

Encoded words are kept in a bounded cache for the batches that follow in the same worker.

Defined cases: a null text is an empty one; a text without words has no ids and decodes to an
empty string; strings of the
special tokens in a text become those tokens; repeated rows each get their result; a very long text
is encoded whole in one task, in a trie of its own; an empty table gives an empty result; columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer as Library

# Entries of either cache, and characters that share a trie.
CACHE = 700_000
PIECE = 1 << 21
# Last letter that no version of Unicode has added to, and that composes with nothing before it.
LATIN = "\u024f"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (byte for byte in range(256) if byte not in plain)
    moved = {byte: 0x100 + n for n, byte in enumerate(others)}
    return [chr(moved.get(byte, byte)) for byte in range(256)]


class Merges:
    """Vocabulary and merge ranks: which token may follow which."""

    def __init__(self, model: dict):
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            pair = self.ids[left], self.ids[right]
            self.rank[pair] = rank
            self.parts[self.ids[left + right]] = (*pair, rank)
        self.known: dict[tuple[int, int], bool] = {}

    def _border(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens at one end of `token` while it is built, with the rank that used each up."""
        chain, used = [], len(self.rank)
        while True:
            chain.append((token, used))
            if token not in self.parts:
                return chain
            parts = self.parts[token]
            token, used = parts[side], parts[2]

    def follows(self, left: int, right: int) -> bool:
        """Whether no merge joins the two across their border; remembered in `known`."""
        if len(self.known) > 1_000_000:
            self.known.clear()
        fits = self.known[left, right] = self._may_follow(left, right)
        return fits

    def _may_follow(self, left: int, right: int) -> bool:
        starts = self._border(right, 0)
        for a, a_used in self._border(left, 1):
            for b, b_used in starts:
                rank = self.rank.get((a, b))
                # At equal ranks the merge further left goes first.
                if rank is not None and rank < a_used and rank <= b_used:
                    return False
        return True


class TrieEncoder:
    """Encodes sorted distinct words (in byte symbols) with shared prefixes."""

    def __init__(self, merges: Merges):
        self.merges = merges
        stems = {token.removesuffix(merges.end) for token in merges.ids}
        self.prefixes = {stem[:end] for stem in stems for end in range(1, len(stem) + 1)}

    def encode(self, words: list[str]) -> Iterator[tuple[str, list[int]]]:
        """(word, ids) for words in sorted order."""
        get, prefixes = self.merges.ids.get, self.prefixes
        known, follows = self.merges.known.get, self.merges.follows
        # For each prefix of the path: last token, its length, and the length of the longest
        # stretch at its end that begins some token; no token that ends later is longer than
        # that by more than what was added.
        last: list[int] = []
        size: list[int] = []
        reach: list[int] = []
        before = ""
        for word in words:
            shared, most = 0, min(len(last), len(word) - 1)
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared:], size[shared:], reach[shared:]
            longest = reach[-1] if shared else 0
            mark = ""
            for end in range(shared + 1, len(word) + 1):
                if end == len(word):
                    mark = self.merges.end
                longest += 1
                while longest > 1 and word[end - longest : end] not in prefixes:
                    longest -= 1
                for start in range(end - longest, end):
                    token = get(word[start:end] + mark)
                    if token is not None:
                        if start == 0:
                            break
                        left = last[start - 1]
                        fits = known((left, token))
                        if follows(left, token) if fits is None else fits:
                            break
                else:
                    raise ValueError(f"symbol {word[end - 1]!r} is not in the vocabulary")
                length = end - start
                if not mark:
                    last.append(token)
                    size.append(length)
                    reach.append(longest)
            ids, at = [token], len(word) - length
            while at:
                ids.append(last[at - 1])
                at -= size[at - 1]
            ids.reverse()
            before = word
            yield word, ids


class Tokenizer:
    """One tokenizer file: words, ids and back."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Library.from_file(path)
        self.merges = Merges(spec["model"])
        self.trie = TrieEncoder(self.merges)
        self.symbols = byte_symbols()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        by_id = {n: token for token, n in (self.merges.ids | self.special).items()}
        self.strings = pa.array([by_id.get(n) for n in range(max(by_id) + 1)])
        splits = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        # Python and Arrow count four control characters as white space, Unicode does not.
        pattern = splits[0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        self.word = regex.compile(pattern)
        self.space = regex.compile(r"\p{White_Space}+")
        self.marker = regex.compile("|".join(map(regex.escape, self.special)))
        # Bytes of UTF-8, read as Latin-1, to byte symbols.
        self.spelling = {n: s for n, s in enumerate(self.symbols) if chr(n) != s}
        # Ids, as bytes of 32-bit integers, of words and of what stands between white space.
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def split(self, texts: pa.Array) -> pa.Array:
        """For each text what stands between white space, as a dictionary-encoded list.

        No word and no special token crosses white space.
        """
        if pc.any(pc.match_substring_regex(texts, "[\x1c-\x1f]")).as_py():
            lists = pa.array([self.space.split(t) for t in texts.to_pylist()], pa.list_(pa.string()))
        else:
            lists = pc.utf8_split_whitespace(texts)
        flat = lists.flatten()
        filled = pc.not_equal(flat, "")
        before = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
        offsets = before[np.cumsum([0, *pc.list_value_length(lists).to_pylist()])]
        chunks = flat.filter(filled).dictionary_encode()
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), chunks)

    def _words(self, chunk: str) -> list[str]:
        """Normalised words: NFC, then lower case letter by letter.

        Beyond Latin letters the library normalises and splits, as which characters are
        letters, and how they compose, depends on the version of Unicode.
        """
        if not chunk.isascii() and max(chunk) > LATIN:
            text = self.library.normalizer.normalize_str(chunk)
            spans = self.library.pre_tokenizer.pre_tokenize_str(text)
            return [text[start:stop] for _, (start, stop) in spans]
        lower = chunk.lower()
        return [lower] if lower.isalpha() else self.word.findall(lower)

    def _parts(self, chunk: str) -> list[str | int]:
        """Words and the ids of special tokens."""
        if "<|" not in chunk:
            return self._words(chunk)
        found, at = [], 0
        for mark in self.marker.finditer(chunk):
            found += [*self._words(chunk[at : mark.start()]), self.special[mark[0]]]
            at = mark.end()
        return found + self._words(chunk[at:])

    def learn(self, chunks: list[str]) -> None:
        """Adds what the caches lack, in one walk through the trie of the missing words."""
        missing = [chunk for chunk in chunks if chunk not in self.chunks]
        if len(self.chunks) + len(missing) > CACHE:
            self.chunks.clear()
            missing = chunks
        split = [self._parts(chunk) for chunk in missing]
        distinct = {word for words in split for word in words if type(word) is str}
        new = distinct - self.words.keys()
        if len(self.words) + len(new) > CACHE:
            self.words.clear()
            new = distinct
        spelled = {w.encode().decode("latin-1").translate(self.spelling): w for w in new}
        known = self.words
        for word, ids in self.trie.encode(sorted(spelled)):
            known[spelled[word]] = array("i", ids).tobytes()
        for chunk, words in zip(missing, split, strict=True):
            self.chunks[chunk] = b"".join(
                [known[w] if type(w) is str else array("i", [w]).tobytes() for w in words]
            )

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """The ids of each text; null is an empty text."""
        lists = self.split(pc.fill_null(texts, ""))
        distinct = lists.values.dictionary.to_pylist()
        self.learn(distinct)
        entries = [self.chunks[chunk] for chunk in distinct]
        lengths = np.array([len(entry) // 4 for entry in entries], np.int64)
        starts = np.cumsum(lengths) - lengths
        ids = np.frombuffer(b"".join(entries), np.int32)
        order = lists.values.indices.to_numpy()
        # Places of all ids of all chunks, in the order of the texts.
        times = lengths[order]
        ends = np.concatenate([[0], np.cumsum(times)])
        places = np.arange(ends[-1]) + np.repeat(starts[order] - ends[:-1], times)
        offsets = ends[lists.offsets.to_numpy()]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids[places]))

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Token strings joined by a space: the file names no decoder."""
        strings = self.strings.take(ids.values)
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, strings), " ")


# One per worker process, with its cache of words.
_LOADED: dict[str, Tokenizer] = {}


def loaded(path: str) -> Tokenizer:
    if path not in _LOADED:
        _LOADED[path] = Tokenizer(path)
    return _LOADED[path]


def _slices(texts: pa.Array, characters: int) -> Iterator[tuple[int, int]]:
    """(start, length) of rows that hold about so many characters."""
    lengths = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(lengths) // characters
    starts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(lengths)]])
    for start, stop in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if stop > start:
            yield start, stop - start


def encode_documents(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, token_ids, decoded), one row per input row."""
    path = tokenizer or default_tokenizer()
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(path)
        for batch in batches:
            for start, length in _slices(batch.column(1), PIECE):
                ids = encoder.encode(batch.column(1).slice(start, length))
                columns = [
                    batch.column(0).slice(start, length),
                    pc.list_value_length(ids).cast(pa.int64()),
                    ids,
                    encoder.decode(ids),
                ]
                names = ["doc_id", "n_tokens", "token_ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {kind}, n_tokens long, token_ids array<int>, decoded string"
    return documents.select("doc_id", "text").mapInArrow(run, schema)
