"""Closed-form metric cases (restated from the reference's metric tests) on Spark."""
import datetime as dt

import numpy as np
import pytest

from shelfcast.operators import metrics as met


def _scored(spark, actual, forecast, q10=None, q90=None, sid="s1"):
    start = dt.date(2020, 1, 1)
    rows = []
    for i, (a, f) in enumerate(zip(actual, forecast)):
        r = [sid, start + dt.timedelta(days=i), float(a), float(f)]
        if q10 is not None:
            r += [float(q10[i]), float(q90[i])]
        rows.append(tuple(r))
    schema = "id string, date date, actual double, yhat double"
    if q10 is not None:
        schema += ", q10 double, q90 double"
    return spark.createDataFrame(rows, schema)


def _history(spark, values, sid="s1", start=dt.date(2019, 1, 1)):
    return spark.createDataFrame([(sid, start + dt.timedelta(days=i), int(v)) for i, v in enumerate(values)],
                                 "id string, date date, sales int")


def test_mae_exact_zero(spark):
    assert met.mae(_scored(spark, [10, 20, 30], [10, 20, 30])).first()["MAE"] == 0.0


def test_mae_known_value(spark):
    assert met.mae(_scored(spark, [10, 20, 15], [8, 25, 14])).first()["MAE"] == pytest.approx(8 / 3)


def test_mae_symmetric(spark):
    a = met.mae(_scored(spark, [10, 20], [15, 25])).first()["MAE"]
    b = met.mae(_scored(spark, [15, 25], [10, 20])).first()["MAE"]
    assert a == b


PATTERN = [5, 3, 7, 2, 8, 4, 6]


def test_mase_naive_band(spark):
    rng = np.random.default_rng(42)
    train = np.clip(np.round(np.tile(PATTERN, 10) + rng.normal(0, 1, 70)), 0, None)
    actual = np.tile(PATTERN, 1) + rng.normal(0, 1, 7)
    forecast = train[-7:]
    m = met.mase(_scored(spark, actual, forecast), _history(spark, train)).first()["MASE"]
    assert 0.3 < m < 3.0


def test_mase_perfect_is_zero(spark):
    train = np.tile(PATTERN, 10)
    m = met.mase(_scored(spark, PATTERN, PATTERN), _history(spark, train)).first()["MASE"]
    assert m == 0.0


def test_mase_bad_forecast_above_one(spark):
    rng = np.random.default_rng(0)
    train = np.round(np.tile(PATTERN, 10) + rng.normal(0, 1, 70)).clip(0)
    bad = np.array(PATTERN) * 10
    m = met.mase(_scored(spark, PATTERN, bad), _history(spark, train)).first()["MASE"]
    assert m > 1.0


def test_coverage_cases(spark):
    a = [10, 20, 30, 40]
    assert met.coverage(_scored(spark, a, a, [0] * 4, [100] * 4)).first()["Coverage_80%"] == 1.0
    assert met.coverage(_scored(spark, a, a, [50] * 4, [60] * 4)).first()["Coverage_80%"] == 0.0
    assert met.coverage(_scored(spark, a, a, [0, 0, 50, 50], [25, 25, 60, 60])).first()["Coverage_80%"] == 0.5


def test_wrmsse_perfect_and_error(spark):
    hist = _history(spark, [10, 20, 30] * 3, start=dt.date(2020, 1, 1))
    cutoff = dt.date(2020, 1, 9)
    fut = [cutoff + dt.timedelta(days=i) for i in range(1, 4)]
    perfect = spark.createDataFrame([("s1", d, float(v), float(v)) for d, v in zip(fut, [10, 20, 30])],
                                    "id string, date date, actual double, yhat double")
    off = spark.createDataFrame([("s1", d, float(v), float(v + 5)) for d, v in zip(fut, [10, 20, 30])],
                                "id string, date date, actual double, yhat double")
    assert met.wrmsse(perfect, hist, cutoff, horizon=3).first()["WRMSSE"] == pytest.approx(0.0, abs=1e-6)
    assert met.wrmsse(off, hist, cutoff, horizon=3).first()["WRMSSE"] > 0


def test_report_with_and_without_coverage(spark):
    hist = _history(spark, np.tile(PATTERN, 10))
    with_q = met.evaluate(_scored(spark, PATTERN, PATTERN, [0] * 7, [10] * 7), hist, "m")
    without = met.evaluate(_scored(spark, PATTERN, PATTERN), hist, "m")
    assert "Coverage_80%" in with_q.columns and "MASE" in with_q.columns
    assert "Coverage_80%" not in without.columns


def test_leaderboard_ranks_by_mae(spark):
    hist = _history(spark, np.tile(PATTERN, 10))
    good = met.evaluate(_scored(spark, PATTERN, PATTERN), hist, "good")
    bad = met.evaluate(_scored(spark, PATTERN, np.array(PATTERN) + 3, [0] * 7, [9] * 7), hist, "bad")
    board = met.leaderboard([bad, good]).orderBy("Rank").collect()
    assert [r["model"] for r in board] == ["good", "bad"]
    assert board[0]["Rank"] == 1 and board[0]["Coverage_80%"] is None
    best = met.best_model(met.leaderboard([bad, good])).first()
    assert best["best_model"] == "good"


def test_pinball_loss(spark):
    s = _scored(spark, [10, 10], [8, 12])
    # q=0.9: e=2 -> 1.8 ; e=-2 -> 0.2 ; mean 1.0
    assert met.pinball_loss(s, 0.9, "yhat").first()["pinball_yhat"] == pytest.approx(1.0)


def test_report_in_one_pass_equals_the_single_metrics(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    history = spark.createDataFrame([(k, s, d, float((i * 7 + j) % 11)) for j, (k, s) in enumerate((("a", "S"), ("b", "S"), ("c", "T")))
                                     for i, d in enumerate(days)], "id string, store_id string, date date, sales double")
    scored = history.filter("date > '2020-02-01'").selectExpr(
        "id", "store_id", "date", "sales AS actual", "sales + 1.5 AS yhat", "sales - dayofmonth(date) % 3 + 1 AS q10", "sales + 2 AS q90",
        "CASE WHEN id = 'a' THEN NULL ELSE sales - 0.5 END AS q50")
    for by in (None, "store_id"):
        keys = [by] if by else []
        out = {tuple(r[k] for k in keys): r for r in met.evaluate(scored, history, "m", by, quantiles={"q10": 0.1, "q50": 0.5}).collect()}
        for part, name in ((met.mase(scored, history, by), "MASE"), (met.mae(scored, by), "MAE"), (met.coverage(scored, by), "Coverage_80%"),
                           (met.pinball_loss(scored, 0.1, "q10", by), "pinball_q10"), (met.pinball_loss(scored, 0.5, "q50", by), "pinball_q50")):
            rows = part.collect()
            assert len(rows) == len(out)
            for r in rows:
                assert r[name] == pytest.approx(out[tuple(r[k] for k in keys)][name])
