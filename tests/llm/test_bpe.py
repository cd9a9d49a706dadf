import hashlib
import random

import duckdb
import pyarrow as pa
import pytest
from tokenizers import Tokenizer as Library

from tests.llm.helpers import AWKWARD, collected, documents
from tramline.llm import bpe_trie, queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Library.from_file(bpe_trie.default_tokenizer())


def random_texts(n):
    chance = random.Random(3)
    ranges = [(32, 127), (0x80, 0x500), (0x4E00, 0x9000), (0x1F300, 0x1F700), (0, 33), (0x2000, 0x2100)]
    return [
        "".join(chr(chance.randrange(*chance.choice(ranges))) for _ in range(chance.randrange(80)))
        for _ in range(n)
    ]


ODD = [
    "Hello World's ΑΣ x<|endoftext|> 123 été $$$!! İ",
    "<|startoftext|><|endoftext|>a<|endoftext|>b <|x|> <|",
    "a" * 5000 + " " + "ab" * 3000 + "!" * 999,
    "don't I'LL we've \x00\x01 \x85x y a\x1cb !\x1c! \x1f",
    "̸ ̸a é ẞ ﬁ ½ ² ǅ",
]


def test_ids_and_text_equal_the_library(library):
    texts = ["", *ODD, *random_texts(400)]
    encoder = bpe_trie.Tokenizer(bpe_trie.default_tokenizer())
    ids = encoder.encode(pa.array(texts))
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ids.to_pylist() == expected
    decoded = encoder.decode(ids).to_pylist()
    assert decoded == [library.decode(i, skip_special_tokens=False) for i in expected]


def test_a_full_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe_trie, "CACHE", 5)
    encoder = bpe_trie.Tokenizer(bpe_trie.default_tokenizer())
    for text in random_texts(30):
        ids = encoder.encode(pa.array([text])).to_pylist()
        assert ids == [library.encode(text, add_special_tokens=False).ids]


def test_shared_prefixes_are_walked_once():
    merges = bpe_trie.Tokenizer(bpe_trie.default_tokenizer()).merges
    trie = bpe_trie.TrieEncoder(merges)
    alone = {w: next(trie.encode([w]))[1] for w in ("then", "there", "therein", "this")}
    assert dict(trie.encode(sorted(alone))) == alone


def test_awkward_rows(spark, library):
    docs = documents(spark, AWKWARD)
    found = collected(bpe_trie.encode_documents(docs))
    for n, text in enumerate(AWKWARD):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert (found[n].token_ids, found[n].n_tokens) == (ids, len(ids))
        assert found[n].decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe_trie.encode_documents(docs.limit(0)).count() == 0


def test_query_equals_the_library(spark, library):
    found = collected(queries.op1_bpe(spark, SMALL))
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    assert len(rows) == len(found)
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected = (doc_id, len(ids), digest(" ".join(map(str, ids))), digest(decoded))
        assert tuple(found[doc_id]) == expected
