import zlib

import numpy as np
import pytest
from conftest import TESTDATA
from llm_cases import documents, odd_texts
from pyspark.sql import functions as F

from meetmart.llm import quality_rff as q

LABELS = "doc_id bigint, quality int, toxic int"


def test_held_out_accuracy_on_the_given_documents(spark):
    docs, labels = (spark.read.parquet(f"{TESTDATA}/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = q.quality_digest(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(found) > 80
    good = np.array([r.quality for r in found])
    score = np.array([r.score for r in found])
    assert ((score >= 0) & (score <= 1)).all()
    assert np.mean([r.predicted == r.quality for r in found]) > 0.93
    order = (score[good == 1][:, None] > score[good == 0]).mean() + (score[good == 1][:, None] == score[good == 0]).mean() / 2
    assert order > 0.97


def labelled(spark, n=400):
    random = np.random.default_rng(2)
    stats = random.normal(0, 1, (n, q.N_STATS))
    label = (stats[:, 0] ** 2 + stats[:, 1] > 0.5).astype(float)
    rows = [([float(x) for x in s], float(y)) for s, y in zip(stats, label)]
    return stats, label, spark.createDataFrame(rows, "stats array<double>, label double").repartition(7)


def test_summed_equations_agree_with_one_matrix(spark):
    stats, label, rows = labelled(spark)
    mean, scale, n = q.moments(rows)
    assert n == len(stats)
    np.testing.assert_allclose(mean, stats.mean(axis=0))
    np.testing.assert_allclose(scale, stats.std(axis=0))
    parts = (mean, scale, *q._projection(3))
    z = np.hstack([q.features(stats, *parts), label[:, None]])
    fold = np.array([zlib.crc32(s.tobytes()) % q.FOLDS for s in stats])
    sums = q.equations(rows, parts)
    for f in range(q.FOLDS):
        np.testing.assert_allclose(sums[f], z[fold == f].T @ z[fold == f], atol=1e-8)
    # the weights minimise the penalised error
    whole, w = sums.sum(axis=0), q.solve(sums.sum(axis=0), 1e-3)
    size = q.FEATURES + 1
    penalty = np.r_[np.full(q.FEATURES, 1e-3 * n), 1e-9 * n]
    np.testing.assert_allclose(whole[:size, :size] @ w + penalty * w, whole[:size, size], atol=1e-6)
    assert q.squared_error(whole, w) == pytest.approx(((z[:, :size] @ w - label) ** 2).sum())


def test_features_approximate_the_gaussian_kernel():
    random = np.random.default_rng(5)
    stats = random.normal(0, 1, (40, q.N_STATS))
    near = []
    for seed in range(30):
        z = q.features(stats, np.zeros(q.N_STATS), np.ones(q.N_STATS), *q._projection(seed))[:, :-1]
        near.append(z @ z.T)
    kernel = np.exp(-((stats[:, None] - stats[None]) ** 2).sum(axis=2) / (2 * q.N_STATS))
    np.testing.assert_allclose(np.mean(near, axis=0), kernel, atol=0.06)


def test_isotonic_agrees_with_the_min_max_formula():
    random = np.random.default_rng(8)
    n, y = random.integers(1, 9, 30).astype(float), random.integers(0, 5, 30).astype(float)
    block, means = q.isotonic(n, y)
    mean = lambda a, b: y[a : b + 1].sum() / n[a : b + 1].sum()
    want = [max(min(mean(a, b) for b in range(k, 30)) for a in range(k + 1)) for k in range(30)]
    np.testing.assert_allclose(means[block], want)
    assert (np.diff(means) > 0).all()


def test_odd_texts_and_equal_scores_of_equal_texts(spark):
    docs = documents(spark, odd_texts(), extra=True)
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(8)] + [(3, None, 0), (3, 0, 1), (None, 1, 0)], LABELS)
    got = q.quality_digest(docs, labels).collect()
    assert len(got) == len(odd_texts())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    texts = dict(odd_texts())
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert len({s.score for s in got if texts[s.doc_id] == texts[r.doc_id]}) == 1
    assert {r.doc_id: r.score for r in got}[0] == {r.doc_id: r.score for r in got}[1]  # null is empty


@pytest.mark.parametrize("quality, score", [(None, 0.5), (1, 1.0), (0, 0.0)])
def test_nothing_to_learn_from(spark, quality, score):
    docs = documents(spark, odd_texts())
    labels = spark.createDataFrame([(k, quality, 0) for k in range(11)], LABELS)
    assert {r.score for r in q.quality_digest(docs, labels).collect()} == {score}
    assert q.quality_digest(documents(spark, []), labels).count() == 0


def test_labels_of_the_quarter_held_out_teach_nothing(spark):
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.col("id") % 37 + 2), lambda k: F.hex(k * F.col("id")))).alias("text")
    )
    rows = [(k, k % 2, 0) for k in range(300)]
    held = lambda k: zlib.crc32(str(k).encode()) % 4 == 2
    flipped = [(k, 1 - y if held(k) else y, t) for k, y, t in rows]
    a, b = ({r.doc_id: r.score for r in q.quality_digest(docs, spark.createDataFrame(x, LABELS)).collect()} for x in (rows, flipped))
    assert a == pytest.approx(b)
