import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import AWKWARD, collected, documents
from tests.llm.test_index import brute_force as contaminated
from tests.llm.test_lines import brute_force as without_repeats
from tests.llm.test_simhash import fingerprint, smallest_reachable
from tramline.llm import bpe_trie, quality_nbsvm
from tramline.llm.tables import read_table

TABLES = "/root/testdata/sf0.01"


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.fixture(scope="module")
def outputs(spark):
    """Rows after every stage, and the columns."""
    docs, found = read_table(spark, TABLES, "documents"), []
    for name, function in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(function(spark, docs, TABLES), name)
        found.append((name, docs.columns, docs.collect()))
    return found


def test_each_stage_equals_brute_force(spark, outputs):
    docs = read_table(spark, TABLES, "documents")
    assert all(columns == docs.columns for _, columns, _ in outputs[:-1])
    before = {r.doc_id: r.text for r in docs.collect()}
    after = [{r.doc_id: r for r in rows} for _, _, rows in outputs]
    model = quality_nbsvm.fit(docs, read_table(spark, TABLES, "labels"))
    good = {n for n, text in before.items() if model.score((text or "").encode()) >= 0.3}
    assert after[0].keys() == good

    ids = sorted(after[0])
    lines = without_repeats([after[0][n].text for n in ids], 50)
    assert {n: r.text for n, r in after[1].items()} == dict(zip(ids, lines, strict=True))
    assert all(r.n_chars == len(r.text) for r in after[1].values())

    bits = {n: fingerprint(r.text) for n, r in after[1].items()}
    assert after[2].keys() == set(smallest_reachable(bits).values())

    items = duckdb.sql(f"SELECT item_id, text FROM '{TABLES}/benchmark.parquet'").fetchall()
    assert after[3].keys() <= after[2].keys()
    dropped = after[2].keys() - after[3].keys()
    assert dropped
    for n in [*dropped, *sorted(after[3])[:40]]:
        assert contaminated(after[2][n].text, items, 13)[3] == (n in dropped)

    encoder = bpe_trie.loaded(bpe_trie.default_tokenizer())
    import pyarrow as pa

    order = sorted(after[3])
    expected = encoder.encode(pa.array([after[3][n].text for n in order])).to_pylist()
    assert [after[4][n].token_ids for n in order] == expected


def test_run_is_all_stages(spark, outputs):
    found = collected(corpus_pipeline.run(spark, TABLES))
    assert {n: r.n_tokens for n, r in found.items()} == {
        r.doc_id: r.n_tokens for r in outputs[-1][2]
    }


def test_awkward_rows_through_every_stage(spark):
    for docs in (documents(spark, AWKWARD), documents(spark, AWKWARD).limit(0)):
        for name, _ in corpus_pipeline.STAGES:
            result = stage(name)(spark, docs, TABLES)
            assert name == "bpe" or result.columns == docs.columns
            assert result.count() <= len(AWKWARD)


# Names that stages use for helper columns.
CLASHES = (
    "version deleted document row times place window fingerprint content clean bits root node"
    " same__doc_id same__document same__version same__times same__text component_id term score"
).split()


def test_every_other_column_goes_through_unchanged(spark):
    docs = read_table(spark, TABLES, "documents").limit(200).cache()
    given = docs.union(docs.limit(3)).select(
        "*", *(F.concat(F.lit(f"{name} "), F.col("doc_id")).alias(name) for name in CLASHES)
    )
    for name, _ in corpus_pipeline.STAGES[:-1]:
        result = stage(name)(spark, given, TABLES)
        assert result.columns == given.columns
        rows = result.collect()
        assert len(rows) > 20
        for row in rows:
            assert all(row[c] == f"{c} {row.doc_id}" for c in CLASHES)
    docs.unpersist()
