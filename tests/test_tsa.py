"""Time-series operators against brute-force numpy versions of the same definitions."""
import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import tsa


def _series_df(spark, values, sid="s"):
    start = dt.date(2020, 1, 1)
    return spark.createDataFrame([(sid, start + dt.timedelta(days=i), int(v)) for i, v in enumerate(values)],
                                 "id string, date date, sales int")


def _decompose_np(x, period=7):
    """Centred moving average, edges extended by a least-squares line through the
    nearest ``period`` trend points, phase means minus their mean."""
    n = len(x)
    h = period // 2
    trend = np.full(n, np.nan)
    for t in range(h, n - h):
        trend[t] = x[t - h:t + h + 1].mean()
    front, back = h, n - 1 - h
    idx = np.arange(front, front + period)
    k, c = np.polyfit(idx, trend[idx], 1)
    trend[:front] = k * np.arange(front) + c
    idx = np.arange(back - period, back)
    k, c = np.polyfit(idx, trend[idx], 1)
    trend[back + 1:] = k * np.arange(back + 1, n) + c
    det = x - trend
    pm = np.array([det[i::period].mean() for i in range(period)])
    pm -= pm.mean()
    seasonal = np.tile(pm, n // period + 1)[:n]
    return trend, seasonal, det - seasonal


def test_decomposition_matches_numpy(spark):
    rng = np.random.default_rng(3)
    x = np.round(20 + 5 * np.sin(np.arange(100) * 2 * np.pi / 7) + np.arange(100) * 0.1 + rng.normal(0, 2, 100)).clip(0)
    out = tsa.decompose(_series_df(spark, x)).orderBy("date").toPandas()
    trend, seasonal, resid = _decompose_np(x.astype(float))
    np.testing.assert_allclose(out["trend"], trend, atol=1e-9)
    np.testing.assert_allclose(out["seasonal"], seasonal, atol=1e-9)
    np.testing.assert_allclose(out["resid"], resid, atol=1e-9)


def _acf_np(x, nlags):
    d = x - x.mean()
    c0 = (d * d).sum()
    return np.array([(d[:len(d) - k] * d[k:]).sum() / c0 for k in range(nlags + 1)])


def test_acf_matches_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.poisson(10, 200)
    out = tsa.acf(_series_df(spark, x), nlags=10).orderBy("lag").toPandas()
    np.testing.assert_allclose(out["acf"], _acf_np(x.astype(float), 10), atol=1e-12)


def test_pacf_equals_yule_walker_solution(spark):
    rng = np.random.default_rng(1)
    e = rng.normal(size=500)
    x = np.zeros(500)
    for t in range(2, 500):
        x[t] = 0.6 * x[t - 1] - 0.2 * x[t - 2] + e[t]
    r = _acf_np(x, 8)
    got = spark.createDataFrame([([float(v) for v in r],), ([1.0],), ([1.0, 0.25],)], "r array<double>").select(tsa.levinson(F.col("r")).alias("p")).collect()
    p = np.array(got[0]["p"])
    assert got[1]["p"] == [1.0] and got[2]["p"] == [1.0, 0.25]
    for k in range(1, 9):
        mat = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        phi = np.linalg.solve(mat, r[1:k + 1])
        assert p[k] == pytest.approx(phi[-1], abs=1e-10)


def _ols(y: np.ndarray, x: np.ndarray):
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    resid = y - x @ beta
    nobs, k = x.shape
    ssr = float(resid @ resid)
    llf = -nobs / 2.0 * (math.log(2 * math.pi) + math.log(ssr / nobs) + 1.0)
    sigma2 = ssr / (nobs - k)
    cov = sigma2 * np.linalg.inv(x.T @ x)
    return beta, np.sqrt(np.diag(cov)), -2.0 * llf + 2.0 * k


def _adf_design(y: np.ndarray, lag: int, start: int):
    dy = np.diff(y)
    n = len(dy)
    cols = [y[start:n]]                                       # y_{t-1} aligned with dy[t]
    cols += [dy[start - i:n - i] for i in range(1, lag + 1)]
    cols.append(np.ones(n - start))
    return dy[start:], np.column_stack(cols)


def adf_statistic(y: np.ndarray, maxlag: int | None = None) -> dict:
    """ADF with constant; lag chosen by AIC over a common sample, then refit on the full
    sample with the chosen lag.  Returns the t-statistic of y_{t-1}, the lag, nobs and
    the MacKinnon critical values."""
    y = np.asarray(y, dtype=float)
    nobs_all = len(y)
    if maxlag is None:
        maxlag = int(math.ceil(12.0 * (nobs_all / 100.0) ** 0.25))
        maxlag = min(nobs_all // 2 - 2, maxlag)
    best_lag, best_aic = 0, math.inf
    for lag in range(0, maxlag + 1):
        yt, x = _adf_design(y, lag, maxlag)
        _, _, aic = _ols(yt, x)
        if aic < best_aic - 1e-12:
            best_lag, best_aic = lag, aic
    yt, x = _adf_design(y, best_lag, best_lag)
    beta, se, _ = _ols(yt, x)
    n = len(yt)
    crit = {k: b[0] + b[1] / n + b[2] / n ** 2 + b[3] / n ** 3 for k, b in tsa.ADF_CRIT_CONST.items()}
    stat = float(beta[0] / se[0])
    return {"adf_stat": stat, "used_lag": best_lag, "nobs": n, "crit_1": crit["1%"],
            "crit_5": crit["5%"], "crit_10": crit["10%"], "stationary_5pct": bool(stat < crit["5%"])}


def test_adf_blocks_equal_a_direct_fit(spark, monkeypatch):
    """Summed cross products of blocks give the statistic of a least-squares fit of each
    whole series, also where a block ends inside the lags."""
    rng = np.random.default_rng(12)
    series = {"walk": rng.normal(size=1300).cumsum() + 40, "noise": rng.normal(5, 1, 777), "season": np.sin(np.arange(400) * 0.9) * 5 + rng.normal(size=400),
              "short": rng.normal(size=60).cumsum()}
    start = dt.date(2018, 1, 1)
    df = spark.createDataFrame([(k, start + dt.timedelta(days=i), float(v)) for k, vs in series.items() for i, v in enumerate(vs)],
                               "id string, date date, sales double").repartition(3)
    for days in (512, 64):
        monkeypatch.setattr(tsa, "BLOCK_DAYS", days)
        got = {r["id"]: r for r in tsa.adf(df).collect()}
        for k, vs in series.items():
            want = adf_statistic(vs)
            assert got[k]["error"] is None and got[k]["used_lag"] == want["used_lag"] and got[k]["nobs"] == want["nobs"]
            assert got[k]["adf_stat"] == pytest.approx(want["adf_stat"], rel=1e-7) and got[k]["crit_5"] == pytest.approx(want["crit_5"])
            assert got[k]["stationary_5pct"] == want["stationary_5pct"] == (got[k]["p_value"] < 0.05)


def test_adf_p_values():
    """Published asymptotic critical values have their levels as p-values."""
    for stat, level in ((-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)):
        assert tsa.adf_p_value(stat) == pytest.approx(level, abs=1e-3)
    p = [tsa.adf_p_value(x) for x in np.linspace(-20, 3, 200)]
    assert p == sorted(p) and p[0] == 0.0 and p[-1] == 1.0


def test_pacf_operator_runs(spark):
    rng = np.random.default_rng(2)
    out = tsa.pacf(_series_df(spark, rng.poisson(5, 150)), nlags=10).toPandas()
    assert len(out) == 11 and out.loc[out["lag"] == 0, "pacf"].iloc[0] == 1.0


def test_adf_verdicts(spark):
    rng = np.random.default_rng(11)
    walk = 1000 + np.cumsum(rng.normal(0, 5, 400))
    noise = 50 + rng.normal(0, 5, 400)
    assert not adf_statistic(walk)["stationary_5pct"]
    assert adf_statistic(noise)["stationary_5pct"]
    out = tsa.adf(_series_df(spark, np.round(noise))).first()
    assert out["stationary_5pct"] and out["crit_5"] < -2.8


def _several(spark, **series):
    out = None
    for sid, values in series.items():
        df = _series_df(spark, values, sid)
        out = df if out is None else out.unionByName(df)
    return out


def test_constant_and_short_series_do_not_stop_the_others(spark):
    rng = np.random.default_rng(11)
    df = _several(spark, good=rng.poisson(9, 120), flat=[0] * 120, short=[1, 5, 2])
    acf = {(r["id"], r["lag"]): r["acf"] for r in tsa.acf(df, nlags=5).collect()}
    assert acf["good", 0] == pytest.approx(1.0) and acf["flat", 1] is None
    pacf = {(r["id"], r["lag"]): r["pacf"] for r in tsa.pacf(df, nlags=5).collect()}
    assert pacf["good", 1] == pytest.approx(acf["good", 1]) and pacf["flat", 1] is None
    adf = {r["id"]: r for r in tsa.adf(df).collect()}
    assert adf["good"]["error"] is None and adf["good"]["adf_stat"] < 0
    for s in ("flat", "short"):
        assert adf[s]["adf_stat"] is None and adf[s]["error"]


def test_decomposition_of_fractions(spark):
    rng = np.random.default_rng(12)
    x = np.round(rng.uniform(0, 3, 80), 2)
    start = dt.date(2020, 1, 1)
    df = spark.createDataFrame([("s", start + dt.timedelta(days=i), float(v)) for i, v in enumerate(x)],
                               "id string, date date, sales double")
    out = tsa.decompose(df).orderBy("date").toPandas()
    for name, want in zip(("trend", "seasonal", "resid"), _decompose_np(x), strict=True):
        np.testing.assert_allclose(out[name], want, atol=1e-9)
    np.testing.assert_allclose(out["sales"], x)


def test_decomposition_shares_one_exchange_and_gives_short_series_nulls(spark):
    start = dt.date(2020, 1, 1)
    rows = [(k, start + dt.timedelta(days=i), i % 5) for k, n in (("long", 40), ("short", 9), ("one", 1)) for i in range(n)]
    out = tsa.decompose(spark.createDataFrame(rows, "id string, date date, sales int"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    seen = out.groupBy("id").agg(F.count("*").alias("n"), F.count("trend").alias("t"), F.count("seasonal").alias("s"), F.count("resid").alias("r"))
    assert {tuple(r) for r in seen.collect()} == {("long", 40, 40, 40, 40), ("short", 9, 0, 0, 0), ("one", 1, 0, 0, 0)}
