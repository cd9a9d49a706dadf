import numpy as np
import pytest
from pyspark.sql import functions as F

from tramline.llm import negative_joins, queries

SCHEMA = "vec_id long, label int, vector array<long>"


def expected(rows, every=100, positives=5, negatives=10, low=30, high=90):
    """Straight from the definition, over (vec_id, label, vector) rows."""
    result = []

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    for anchor, label, vector in rows:
        if anchor % every:
            continue
        others = [(-score(vector, v), n, g) for n, g, v in rows if n != anchor]
        alike = sorted((s, n) for s, n, g in others if g == label)[:positives]
        unlike = sorted((s, n) for s, n, g in others if g != label)
        for p, positive in alike:
            inside = [(s, n) for s, n in unlike if low * -p <= 100 * -s <= high * -p]
            for rank, (s, n) in enumerate(inside[:negatives], 1):
                result.append((anchor, positive, rank, n, -p, -s))
    return sorted(result)


def mined(spark, rows, every=100, parts=3, **settings):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = negative_joins.mine(frame, F.col("vec_id") % every == 0, **settings)
    return sorted(tuple(r) for r in found.collect())


def random_rows(n, width, labels=4, spread=60, seed=1):
    chance = np.random.default_rng(seed)
    centres = chance.integers(-spread, spread, (labels * 2, width))
    rows = []
    for k in range(n):
        vector = centres[chance.integers(labels * 2)] // 2 + chance.integers(-spread, spread, width)
        rows.append((k, int(chance.integers(labels)), [int(x) for x in vector]))
    return rows


@pytest.mark.parametrize(("block", "slab", "few", "chunk"), [(2048, 16, 0.05, 2048), (64, 3, 0.5, 7), (17, 1, 0.0, 3)])
def test_equals_brute_force(spark, monkeypatch, block, slab, few, chunk):
    monkeypatch.setattr(negative_joins, "BLOCK", block)
    monkeypatch.setattr(negative_joins, "SLAB", slab)
    monkeypatch.setattr(negative_joins, "FEW", few)
    rows = random_rows(500, 12)
    known = expected(rows, 25)
    assert len(known) > 300
    assert mined(spark, rows, 25, chunk=chunk) == known


def test_index_finds_all_pairs(monkeypatch):
    monkeypatch.setattr(negative_joins, "SLAB", 4)
    chance = np.random.default_rng(2)
    rows = chance.integers(-90, 90, (300, 20)) * (chance.random((300, 20)) < 0.5)
    queries_ = chance.integers(-90, 90, (30, 20))
    scores = queries_ @ rows.T
    for share in (0.5, 0.9, 0.99, 1.0):
        thresholds = np.quantile(scores, share, axis=1).astype(np.int64)
        longest = np.sqrt((queries_**2).sum(axis=1)).max()
        index = negative_joins.Index(rows, longest, float(thresholds.min()))
        query, row = index.matches(queries_, thresholds)
        found = set(zip(query.tolist(), row.tolist()))
        assert set(zip(*(x.tolist() for x in np.nonzero(scores >= thresholds[:, None])))) <= found
        # A superset, but a small one.
        assert len(found) <= 1.5 * (scores >= thresholds[:, None]).sum() + 0.05 * scores.size
    # With a high threshold rows keep dimensions out of the index.
    high = negative_joins.Index(rows, longest, float(scores.max()))
    assert (high.ends < 20).all()


def test_windows_that_never_fill(spark):
    # Few rows of other labels, far away scores, positives with negative and zero scores.
    rows = [
        (0, 1, [10, 0]), (1, 1, [9, 1]), (2, 1, [-5, 0]), (3, 1, [0, 7]), (4, 2, [4, 4]),
        (5, 2, [0, 3]), (6, 2, [-9, 0]), (7, 3, [8, 0]), (8, 3, [3, 0]), (9, 2, [0, 0]),
        (100, 9, [5, 5]),
    ]
    known = expected(rows)
    assert mined(spark, rows) == known
    assert {r[4] for r in known} == {90, 0}


def test_ties_go_to_the_smaller_id(spark):
    rows = [(n, n % 2, [3, 4]) for n in range(60)] + [(n, n % 2, [2, 2]) for n in range(60, 140)]
    assert mined(spark, rows, 50) == expected(rows, 50)


def test_large_components_stay_exact(spark):
    chance = np.random.default_rng(4)
    rows = [
        (n, int(chance.integers(2)), [int(x) for x in chance.integers(0, 1 << 30, 8)]) for n in range(80)
    ]
    assert mined(spark, rows, 20) == expected(rows, 20)


def test_awkward_rows(spark):
    rows = [
        (0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.5]), (2, 1, [1.0]), (3, 2, []), (4, 2, [0.7, 0.3]),
        (5, None, [1.0, 1.0]), (6, 2, None), (7, 2, [float("nan"), 1.0]), (8, 2, [float("inf"), 1.0]),
        (9, 2, [None, 1.0]), (None, 2, [0.5, 0.5]), (100, 3, [-0.5, -0.1]), (10, 2, [0.8, 0.1]),
    ]
    frame = spark.createDataFrame(
        [(*r, 5, "x") for r in rows],
        "vec_id long, label int, embedding array<float>, window long, score string",
    )
    used = frame.filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & negative_joins.usable("embedding")
    ).withColumn("vector", negative_joins.scaled("embedding", 256))
    assert sorted(r.vec_id for r in used.collect()) == [0, 1, 2, 3, 4, 10, 100]
    found = negative_joins.mine(used, F.col("vec_id") % 100 == 0)
    plain = [(r.vec_id, r.label, r.vector + [0] * (2 - len(r.vector))) for r in used.collect()]
    assert sorted(tuple(r) for r in found.collect()) == expected(plain)
    twice = negative_joins.mine(used.union(used), F.col("vec_id") % 100 == 0)
    assert sorted(tuple(r) for r in twice.collect()) == expected(plain * 2)
    assert negative_joins.mine(used.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert negative_joins.mine(used, F.lit(False)).count() == 0


def test_query_rounds_down_in_doubles(spark, tmp_path):
    chance = np.random.default_rng(6)
    rows = [(n, int(chance.integers(10)), [float(x) for x in chance.normal(0, 0.2, 6)]) for n in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    plain = [
        (n, (g + 1) % 10 if n % 7 == 0 else g, [int(np.floor(256 * float(np.float32(x)))) for x in v])
        for n, g, v in rows
    ]
    found = queries.op13_hard_negatives(spark, str(tmp_path))
    assert sorted(tuple(r) for r in found.collect()) == expected(plain)
