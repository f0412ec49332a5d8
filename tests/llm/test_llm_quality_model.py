"""The pairwise quality model against an independent optimum, quantile and score."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import quality_classifier as qc

SF = "/root/testdata/sf0.01"


def pair_loss(w, d, ridge):
    return np.logaddexp(0, -(d @ w)).mean() + ridge / 2 * w @ w


def test_weights_are_the_optimum_of_the_pairwise_loss():
    """Long plain gradient descent on the same pairs ends at the same weights."""
    rng = np.random.default_rng(3)
    good, bad = rng.normal(0.6, 1, (200, 4)), rng.normal(-0.2, 1, (150, 4))
    pairs, ridge = 2000, 1e-2
    w = qc.bradley_terry(good, bad, pairs, ridge, seed=11)
    draw = np.random.default_rng(11)
    d = good[draw.integers(0, len(good), pairs)] - bad[draw.integers(0, len(bad), pairs)]
    v = np.zeros(4)
    for _ in range(20_000):
        v -= 0.2 * (-(d.T @ (1 / (1 + np.exp(d @ v)))) / pairs + ridge * v)
    np.testing.assert_allclose(w, v, atol=1e-6)
    for k in range(4):  # no step along an axis lowers the loss
        for step in (-1e-3, 1e-3):
            assert pair_loss(w + step * np.eye(4)[k], d, ridge) > pair_loss(w, d, ridge)


def test_threshold_and_scores_recomputed(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").filter("doc_id % 3 <> 0")
    counted = qc.feature_counts(docs).checkpoint()
    model = qc.fit(counted, labels)
    x = {r["doc_id"]: np.array(r["x"]) for r in counted.select("doc_id", F.array(*qc.features()).alias("x")).collect()}
    strength = {i: float(np.dot(model.weights, v)) for i, v in x.items()}
    marks = {r["doc_id"]: r["quality"] for r in labels.collect() if r["doc_id"] in x}
    known = sorted(strength[i] for i in marks)
    share = sum(q == 0 for q in marks.values()) / len(marks)
    # the quantile of all labelled rows at the share of bad ones
    assert model.threshold == pytest.approx(known[max(1, math.ceil(share * len(known))) - 1], abs=1e-9)
    for r in qc.score(counted, model).select("doc_id", "score").collect():
        z = min(30.0, max(-30.0, strength[r["doc_id"]] - model.threshold)) + math.log(qc.CUT / (1 - qc.CUT))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)
        if abs(strength[r["doc_id"]] - model.threshold) > 1e-9:
            assert (r["score"] >= qc.CUT) == (strength[r["doc_id"]] > model.threshold)
    # equal texts have equal scores, whatever their labels
    twice = docs.limit(20).union(docs.limit(20).withColumn("doc_id", F.col("doc_id") + 10**6))
    same = {}
    for r in qc.score(qc.feature_counts(twice), model).collect():
        same.setdefault(r["doc_id"] % 10**6, set()).add(r["score"])
    assert all(len(v) == 1 for v in same.values())
