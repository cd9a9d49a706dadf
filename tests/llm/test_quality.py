import zlib

import numpy as np

from tests.llm.helpers import AWKWARD, collected, documents
from tramline.llm import quality_nbsvm, queries
from tramline.llm.svm import SparseRows, calibrate, dual_coordinate_descent
from tramline.llm.tables import read_table

TABLES = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in read_table(spark, TABLES, "labels").collect()}
    found = collected(queries.op2_quality(spark, TABLES))
    assert len(found) == read_table(spark, TABLES, "documents").count()
    for row in found.values():
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0.0 <= row.score <= 1.0
        assert row.predicted == (row.score >= 0.3)
    unseen = [r for r in found.values() if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in unseen)
    assert right / len(unseen) >= 0.95
    assert all(r.predicted for r in unseen if labels[r.doc_id] == 1)


def test_descent_reaches_the_minimum():
    random = np.random.default_rng(0)
    points = random.normal(size=(60, 4))
    signs = np.where(points @ [1, -2, 0.5, 0] + 0.3 * random.normal(size=60) > 0, 1.0, -1.0)
    rows = SparseRows([np.arange(4)] * 60, list(points))
    weights, bias = dual_coordinate_descent(rows, signs, 4, np.full(60, 1.0), 2000, 1e-9)

    def loss(w):
        return w @ w / 2 + np.maximum(0, 1 - signs * (points @ w[:4] + w[4])).sum()

    best = np.append(weights, bias)
    for _ in range(500):
        assert loss(best) <= loss(best + random.normal(scale=0.02, size=5)) + 1e-9


def test_calibration_recovers_a_curve():
    random = np.random.default_rng(1)
    margin = random.normal(size=20_000) * 2
    positive = random.random(20_000) < 1 / (1 + np.exp(-(1.5 * margin - 0.5)))
    slope, shift = calibrate(margin, positive, np.ones(20_000))
    assert abs(slope - 1.5) < 0.1 and abs(shift + 0.5) < 0.1


def test_indicators_see_the_whole_text():
    head = b"plain words " * 30_000
    tail = b"ODD### ending"
    assert len(head) > 4 * quality_nbsvm._STRETCH
    whole = set(quality_nbsvm.indicators(head + tail).tolist())
    assert set(quality_nbsvm.indicators(tail).tolist()) & whole
    assert len(whole - set(quality_nbsvm.indicators(head).tolist())) >= 5
    # Words and pairs do not depend on where a stretch ends.
    assert set(quality_nbsvm.indicators(head).tolist()) == set(
        quality_nbsvm.indicators(b"plain words " * 3).tolist()
    )


def training(spark, n=80):
    texts = [f"calm words number {i} follow" if i % 2 else f"BUY!! NOW!! {i}!!" for i in range(n)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(n)], LABELS)
    return documents(spark, texts), labels


def test_awkward_rows(spark):
    docs, labels = training(spark)
    extra = spark.createDataFrame([(1, None, 0), (2, 1, 0), (999, 1, 0), (None, 1, 0)], LABELS)
    model = quality_nbsvm.fit(docs, labels.union(extra))
    odd = documents(spark, AWKWARD)
    scores = collected(odd.select("doc_id", quality_nbsvm.score(model).alias("score")))
    assert scores[0].score == scores[1].score
    assert scores[3].score == scores[4].score
    assert all(0 <= row.score <= 1 for row in scores.values())
    kept = quality_nbsvm.accepted(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id % 2 for r in kept.collect()} == {1}
    assert quality_nbsvm.accepted(docs.limit(0), model).count() == 0


def test_one_class_or_no_label(spark):
    docs, labels = training(spark, 20)
    good = quality_nbsvm.fit(docs, labels.filter("quality = 1"))
    assert good.score(b"anything") > 0.99
    none = quality_nbsvm.fit(docs, labels.limit(0))
    assert none.score(b"anything") == 0.5
    assert quality_nbsvm.fit(docs.limit(0), labels).score(b"") == 0.5
