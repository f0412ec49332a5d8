"""Models: SARIMA regression recovers known coefficients; forecasts are non-negative with
one row per series x horizon; quantile bands are ordered."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import sarima


def _simulate(n=900, seed=4):
    rng = np.random.default_rng(seed)
    w = np.zeros(n)
    e = rng.normal(0, 1, n)
    for t in range(8, n):
        w[t] = 0.5 * w[t - 1] + 0.3 * w[t - 7] - 0.15 * w[t - 8] + e[t]
    y = np.zeros(n + 7)
    y[:7] = 50
    for t in range(n):
        y[t + 7] = y[t] + w[t]
    return w, y


def test_hannan_rissanen_recovers_coefficients():
    w, _ = _simulate()
    b, lags, _, _ = sarima.fit_numpy(w, p=1, q=0)
    coef = dict(zip(lags, b))
    assert abs(coef[1] - 0.5) < 0.08 and abs(coef[7] - 0.3) < 0.08 and abs(coef[8] + 0.15) < 0.08


def test_spark_fit_equals_numpy_fit(spark):
    """Grouped normal equations in Spark give the same forecasts and AIC as a direct
    least-squares fit of each series in numpy."""
    _, y = _simulate(400, 21)
    y = np.round(np.clip(y, 0, None))
    rows = [("a", dt.date(2020, 1, 1) + dt.timedelta(days=i), float(v)) for i, v in enumerate(y)]
    rows += [("b", dt.date(2020, 1, 1) + dt.timedelta(days=i), float(v) + 7) for i, v in enumerate(y)]
    hist = spark.createDataFrame(rows, "id string, date date, sales double")
    for auto in (False, True):
        fc, _ = sarima.sarima_forecast(hist, dt.date(2021, 12, 31), horizon=14, auto=auto)
        got = fc.toPandas().sort_values(["id", "h"])
        for sid, off in (("a", 0.0), ("b", 7.0)):
            g = got[got["id"] == sid]
            p, q = int(g["p"].iloc[0]), int(g["q"].iloc[0])
            if not auto:
                assert (p, q) == sarima.DEFAULT_ORDER
            exp, aic = sarima.forecast_numpy(y + off, 14, p, q)
            np.testing.assert_allclose(g["yhat"].to_numpy(), exp, rtol=1e-6, atol=1e-6)
            assert g["aic"].iloc[0] == pytest.approx(aic, rel=1e-6)
            if auto:
                best = min(sarima.forecast_numpy(y + off, 14, pp, qq)[1]
                           for pp in range(sarima.AUTO_MAX_P + 1) for qq in range(sarima.AUTO_MAX_Q + 1))
                assert aic == pytest.approx(best, rel=1e-6)


def test_sarima_grouped_forecast(spark):
    _, y = _simulate(300, 9)
    rows = [(sid, dt.date(2020, 1, 1) + dt.timedelta(days=i), float(max(v + off, 0)))
            for sid, off in [("a", 0), ("b", 20)] for i, v in enumerate(y)]
    rows += [("tiny", dt.date(2020, 1, 1) + dt.timedelta(days=i), 1.0) for i in range(10)]
    hist = spark.createDataFrame(rows, "id string, date date, sales double")
    fc, failed = sarima.sarima_forecast(hist, dt.date(2020, 12, 31), horizon=28)
    pdf = fc.toPandas()
    assert set(pdf["id"]) == {"a", "b"} and len(pdf) == 56
    assert (pdf["yhat"] >= 0).all()
    assert [r["id"] for r in failed.collect()] == ["tiny"]
    auto, _ = sarima.sarima_forecast(hist.filter(F.col("id") == "a"), dt.date(2020, 12, 31), horizon=7, auto=True)
    r = auto.first()
    assert 0 <= r["p"] <= 3 and 0 <= r["q"] <= 2


def test_gbt_quantiles_ordered(spark):
    from shelfcast.operators import features as feat
    from shelfcast.operators import models as mdl
    from shelfcast.plans.panel import build_panel
    panel = build_panel(spark, "/root/testdata/sf0.001")
    fm = mdl.model_frame(feat.build_features(panel)).filter(F.col("date") >= "2000-01-01").cache()
    cols = feat.feature_columns(fm)
    train = fm.filter(F.col("date") < "2001-09-01")
    test = fm.filter(F.col("date") >= "2001-09-01")
    model = mdl.fit_point_model(train, cols, params={"maxIter": 5, "maxDepth": 3})
    qm, leaves = mdl.fit_leaf_quantiles(train, cols, max_depth=4)
    out = mdl.predict_quantiles(qm, leaves, mdl.predict_point(model, test)).toPandas()
    assert len(out) == test.count()
    assert (out["yhat"] >= 0).all()
    assert (out["q10"] <= out["q50"]).all() and (out["q50"] <= out["q90"]).all()
    imp = mdl.feature_importance(model, cols, spark, top=5).toPandas()
    assert len(imp) == 5 and abs(imp["share_pct"].sum() - 100) < 1e-6
    fm.unpersist()
