import random
import re

from tests.check import connect, differences
from tests.llm.helpers import AWKWARD, documents
from tramline.llm import positional_index, queries
from tramline.llm.tables import stored

TABLES = "/root/testdata/sf0.01"


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_force(text, items, size):
    own, hit, named = words(text), set(), set()
    for item, content in items:
        phrase = words(content)
        for at in range(max(1, len(phrase) - size + 1)) if phrase else ():
            window = phrase[at : at + size]
            for start in range(len(own) - len(window) + 1):
                if own[start : start + len(window)] == window:
                    hit.update(range(start, start + len(window)))
                    named.add(str(item))
    return len(own), len(hit), sorted(named), len(hit) > 0 and 20 * len(hit) >= len(own)


def items_table(spark, items):
    rows = [(item, text, "x", 1) for item, text in items]
    return spark.createDataFrame(rows, "item_id long, text string, term string, window long")


def answers(found):
    return {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in found.collect()}


def test_query_equals_its_sql(spark):
    name = "op9_decontamination"
    found = differences(
        spark, connect(TABLES), TABLES, name, queries.queries()[name], queries.oracle_sql()[name]
    )
    assert found == []


def test_blocks_of_windows_equal_brute_force(spark):
    chance = random.Random(6)
    texts = [" ".join(chance.choices("abcde", k=chance.randrange(40))) for _ in range(60)]
    items = [(n, " ".join(chance.choices("abcde", k=chance.randrange(9)))) for n in range(25)]
    items += [(100, None), (101, ""), (102, "A b, C"), (103, "unseen word here"), (11, "a")]
    for block in (4, 1000):
        found = positional_index.contamination(
            documents(spark, [*texts, *AWKWARD]), items_table(spark, items), 4, block
        )
        expected = {
            n: brute_force(text, items, 4) for n, text in enumerate([*texts, *AWKWARD])
        }
        assert answers(found) == expected


def test_repeated_rows_and_shared_ids(spark):
    item = " ".join(f"w{n}" for n in range(13))
    docs = documents(spark, [item, "clean text"])
    twice = docs.union(docs).union(docs.selectExpr("0L AS doc_id", "* EXCEPT (doc_id)"))
    rows = positional_index.contamination(twice, items_table(spark, [(5, item)])).collect()
    assert len(rows) == 6
    assert {(r.n_words, r.contaminated) for r in rows} == {(13, True), (2, False)}
    left = positional_index.decontaminate(twice, items_table(spark, [(5, item)]))
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [
        (0, "clean text"), (1, "clean text"), (1, "clean text"),
    ]


def test_empty_tables(spark):
    docs, items = documents(spark, AWKWARD), items_table(spark, [(1, "one two")])
    clean = answers(positional_index.contamination(docs, items.limit(0)))
    assert {(hit, tuple(names), bad) for _, hit, names, bad in clean.values()} == {(0, (), False)}
    assert positional_index.contamination(docs.limit(0), items).count() == 0
    assert positional_index.decontaminate(docs, items.limit(0)).count() == len(AWKWARD)


def test_one_twentieth_is_enough(spark):
    item = " ".join(f"w{n}" for n in range(13))
    filler = [" ".join(["x"] * n) for n in (247, 248)]
    docs = documents(spark, [f"{item} {f}" for f in filler])
    found = answers(positional_index.contamination(docs, items_table(spark, [(5, item)])))
    assert [found[n][3] for n in (0, 1)] == [True, False]


def test_a_long_text_that_repeats_a_window(spark):
    item = " ".join(f"w{n}" for n in range(13))
    docs = documents(spark, [f"{item} " * 100_000, f"w5 w6 {item}"])
    found = answers(positional_index.contamination(docs, items_table(spark, [(5, item)])))
    assert found == {0: (1_300_000, 1_300_000, ["5"], True), 1: (15, 13, ["5"], True)}


def test_proximity(spark):
    texts = ["far a b c d rare1 e rare2", "rare1 x x x rare2", "rare1 rare2", "rare2 y y rare1"]
    docs = documents(spark, [*texts, *["a b c d e"] * 5])
    phrase = "rare1 e rare2"
    parts = positional_index._texts(docs)
    leads = positional_index.Leads(spark, parts, [(0, phrase)])
    index = stored(positional_index.postings(parts, leads.terms), "postings")

    def near(slop):
        found = positional_index.proximity_matches(index, leads, slop).collect()
        return {(r.document, r.distance) for r in found}

    # The leads are `rare1` at 0 and `rare2` at 2 of the phrase.
    assert near(0) == {(0, 0)}
    assert near(2) == {(0, 0), (1, 2), (2, 1)}
    assert near(5) == {(0, 0), (1, 2), (2, 1), (3, 5)}
