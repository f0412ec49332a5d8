"""Pinball boosting, successive halving, and the roll-out against numpy."""
import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import boosting as bst
from shelfcast.operators import features as feat
from shelfcast.operators import models as mdl
from shelfcast.operators.rollout import lag_features, roll_out
from shelfcast.plans.panel import build_panel


def order_statistic(values, q):
    values = sorted(values)
    return values[max(1, math.ceil(q * len(values))) - 1]


@pytest.mark.parametrize("accuracy,bins", [(10_000, 512), (5, 2), (5, 7), (50, 512)])
def test_exact_quantiles(spark, accuracy, bins):
    """The same order statistic, whether read at once or by narrowing brackets."""
    rng = np.random.default_rng(3)
    groups = {0: rng.normal(size=700), 1: rng.integers(0, 4, 300).astype(float), 2: np.array([5.0]), 3: np.full(40, -2.5),
              4: np.concatenate([np.full(200, 1.0), rng.normal(1e9, 1, 5)]), 5: rng.exponential(size=3000) ** 5}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [(0, None), (6, None)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(3)
    for q in (0.1, 0.5, 0.9, 1.0):
        found, _ = bst.exact_quantiles(df, "g", "v", q, accuracy=accuracy, bins=bins)
        assert found == {g: order_statistic(vs, q) for g, vs in groups.items()}, q


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(7)
    x = rng.uniform(-1, 1, (3000, 3))
    y = 3 * (x[:, 0] > 0.2) + 2 * x[:, 1] + rng.normal(0, 0.3 + (x[:, 2] > 0), 3000)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(y=y, id=np.arange(3000), val=np.arange(3000) % 4 == 0)
    df = spark.createDataFrame(pdf).cache()
    rows = bst.training_rows(df.filter("not val"), df.filter("val"), ["a", "b", "c"], "y", ("id",)).cache()
    return pdf, df, rows


def loss(y, f, q):
    return float(np.maximum(q * (y - f), (q - 1) * (y - f)).mean())


def test_boosting_lowers_the_pinball_loss(noisy):
    pdf, df, rows = noisy
    val = pdf[pdf["val"]]
    model, leaves = mdl.fit_leaf_quantiles(df.filter("not val"), ["a", "b", "c"], "y", max_depth=3)
    table = mdl.predict_quantiles(model, leaves, df.filter("val")).toPandas().sort_values("id")
    fitted = bst.fit_quantiles(rows, ["a", "b", "c"], [0.1, 0.5, 0.9], rounds=12, params={"maxDepth": 3, "stepSize": 0.4})
    for q, name in ((0.1, "q10"), (0.5, "q50"), (0.9, "q90")):
        e = fitted[q]
        got = e.score(val[["a", "b", "c"]].to_numpy())
        assert e.start == order_statistic(pdf.loc[~pdf["val"], "y"], q)
        # the loss kept per round is that of the ensemble read from the trees
        assert e.losses[-1] == pytest.approx(loss(val["y"], got, q), rel=1e-9) and e.losses[0] == pytest.approx(loss(val["y"], e.start, q))
        assert len(e.losses) == len(e.trees) + 1 == 13 and e.losses[-1] < e.losses[0]
        # predictions are clipped at 0; compare with the unclipped table where it is not at the bound
        if q != 0.1:
            assert loss(val["y"], got, q) < loss(table["y"], table[name], q) * 1.02
    out = bst.predict_quantiles(df.filter("val"), fitted).toPandas()
    assert (out["q10"] <= out["q50"]).all() and (out["q50"] <= out["q90"]).all() and (out["q10"] >= 0).all()


def test_leaf_steps_are_exact_quantiles(noisy):
    """One round without sampling: every leaf adds step x the exact quantile of its errors."""
    pdf, _, rows = noisy
    train = pdf[~pdf["val"]]
    e = bst.boost(rows, ["a", "b", "c"], 0.9, 1, {"subsamplingRate": 1.0, "featureSubsetFraction": 1.0, "maxDepth": 3, "stepSize": 0.5})
    add = e.trees[0].add(train[["a", "b", "c"]].to_numpy())
    error = train["y"].to_numpy() - e.start
    steps = np.unique(add)
    assert 2 <= len(steps) <= 8
    for s in steps:
        assert 0.5 * order_statistic(error[add == s], 0.9) == pytest.approx(s, abs=1e-12)


def test_continuing_equals_one_go_and_patience_drops_trees(noisy):
    _, _, rows = noisy
    whole = bst.boost(rows, ["a", "b", "c"], 0.5, 4)
    half = bst.boost(rows, ["a", "b", "c"], 0.5, 2)
    rest = bst.boost(rows, ["a", "b", "c"], 0.5, 2, begin=half)
    assert len(half.trees) == 2 and rest.losses == pytest.approx(whole.losses)
    wild = bst.boost(rows, ["a", "b", "c"], 0.5, 14, {"stepSize": 3.0}, patience=2)
    assert len(wild.trees) == int(np.argmin(wild.losses)) < 14


def test_rows_without_target_and_without_validation(spark):
    rows = [(i, float(i % 5), None if i % 7 == 0 else float(i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, a double, y double")
    e = bst.boost(bst.training_rows(df, None, ["a"], "y", ("id",)), ["a"], 0.5, 6, {"minInstancesPerNode": 5, "stepSize": 1.0, "featureSubsetFraction": 1.0}, patience=2)
    assert all(map(math.isnan, e.losses)) and len(e.trees) == 6
    assert np.allclose(e.score(np.arange(5.0)[:, None]), np.arange(5.0), atol=0.51)


def test_successive_halving_keeps_the_best_third(noisy):
    _, _, rows = noisy
    draws = [{"stepSize": s, "maxDepth": 2, "subsamplingRate": 1.0, "featureSubsetFraction": 1.0, "minInstancesPerNode": 10}
             for s in (0.01, 0.3, 0.02, 0.5, 0.015, 0.25)]
    out = bst.successive_halving(rows, ["a", "b", "c"], draws, 2.0, first_rounds=1, keep=3, last_rounds=9)
    assert [r["trial"] for r in out] == list(range(6))
    assert sorted(r["rounds"] for r in out) == [1, 1, 1, 1, 3, 9]
    first = [bst.boost(rows, ["a", "b", "c"], 0.5, 1, d, seed=42 + i).losses[-1] for i, d in enumerate(draws)]
    kept = {r["trial"] for r in out if r["rounds"] > 1}
    assert kept == set(np.argsort(first, kind="stable")[:2].tolist())
    for r in out:
        if r["rounds"] == 1:
            assert r["value"] == pytest.approx(first[r["trial"]])  # 2 x pinball over a scale of 2


@pytest.fixture(scope="module")
def panel(spark):
    full = build_panel(spark, "/root/testdata/sf0.001")
    return full.filter("date >= '2000-06-01' and item_id in ('SMALL', 'PROMO')").checkpoint()


def test_min_lag_features_do_not_see_the_horizon(spark, panel):
    cut = dt.date(2001, 9, 9)
    changed = panel.withColumn("sales", F.when(F.col("date") > cut, F.col("sales") + 1000).otherwise(F.col("sales")))
    a, b = (mdl.model_frame(feat.build_features(p, until=cut, min_lag=28)) for p in (panel, changed))
    cols = feat.feature_columns(a)
    assert "sales_lag_28" in cols and "sales_roll_mean_7_from_28" in cols and "sales_lag_7" not in cols
    span = (F.col("date") > cut) & (F.col("date") <= F.date_add(F.lit(cut), 28))
    pick = lambda d: d.filter(span).select("id", "date", *cols).orderBy("id", "date").toPandas()
    pd.testing.assert_frame_equal(pick(a), pick(b))
    one = feat.build_features(panel, until=cut).filter("date = '2001-09-01'").orderBy("id").toPandas()
    late = feat.build_features(panel, until=cut, min_lag=28).filter("date = '2001-09-28'").orderBy("id").toPandas()
    np.testing.assert_allclose(one["sales_roll_mean_28"], late["sales_roll_mean_28_from_28"])
    np.testing.assert_allclose(one["sales_roll_std_7"], late["sales_roll_std_7_from_28"])


def test_roll_out_feeds_its_own_forecasts(spark, panel):
    cut = dt.date(2001, 9, 9)
    frame = mdl.model_frame(feat.build_features(panel, until=cut)).checkpoint()
    cols = feat.feature_columns(frame)
    e = bst.boost(bst.training_rows(frame.filter(F.col("date") <= cut), None, cols), cols, 0.5, 3)
    got = roll_out(frame, e, F.lit(cut), 28).toPandas().sort_values(["id", "h"])
    n = panel.select("id").distinct().count()
    assert len(got) == 28 * n and (got["yhat"] >= 0).all()
    # the first step sees only known days: it equals the one-step forecast
    one = bst.predict(frame.filter(F.col("date") == F.date_add(F.lit(cut), 1)), e).orderBy("id").toPandas()
    np.testing.assert_allclose(got[got["h"] == 1]["yhat"].to_numpy(), one["yhat"].to_numpy())
    # later steps: put the forecasts into the panel as sales and build the features there
    replaced = panel.join(spark.createDataFrame(got[["id", "date", "yhat"]]).withColumn("date", F.to_date("date")), ["id", "date"], "left")
    later = mdl.model_frame(feat.build_features(replaced.withColumn("sales", F.coalesce("yhat", F.col("sales").cast("double"))).drop("yhat"), until=cut))
    for h in (2, 9, 28):
        want = bst.predict(later.filter(F.col("date") == F.date_add(F.lit(cut), h)), e).orderBy("id").toPandas()
        np.testing.assert_allclose(got[got["h"] == h]["yhat"].to_numpy(), want["yhat"].to_numpy(), atol=1e-9)


def test_lag_features_match_numpy():
    recent = np.arange(112.0).reshape(2, 56)
    out = lag_features(recent, ["month", "sales_lag_7", "sales_roll_mean_28", "sales_roll_std_56"])
    assert set(out) == {1, 2, 3} and out[1].tolist() == [49.0, 105.0]
    assert out[2][0] == recent[0, 28:].mean() and out[3][1] == pytest.approx(recent[1].std(ddof=1))
