"""Per-series seasonal ARIMA (M2, M3), re-aimed for Spark.

The reference fits SARIMA(1,0,1)(1,1,0)[7] by maximum likelihood on a 50-series sample in
a Python loop.  Here every series is fitted with a two-stage Hannan-Rissanen regression in
which Spark does all the per-row work:

  w_t = y_t - y_{t-7}                      seasonal difference (D = 1); zeros floored first
  stage 1: long autoregression of order m = 21 by Yule-Walker (uncentred autocovariance
           sums r_0..r_m, Toeplitz solve) -> residuals e_t
  stage 2: w_t on w_{t-1..t-p}, w_{t-7}, w_{t-8}, e_{t-1..t-q}

Lags come from the shared per-series window; the autocovariances and the stage-2 normal
equations (X'X, X'y, y'y) are grouped sums by ``id``; only the small solves (a 21 x 21
Toeplitz and at most a 7 x 7 system per series) and the 28-step roll-out run in numpy, in
``mapInPandas`` over one row per series.
The lag-8 term is estimated freely (maximum likelihood ties it to -phi * Phi).
``auto=True`` (M3) fits every (p, q) with p <= 3, q <= 2 on the same sample and keeps the
lowest AIC.  A series that cannot be fitted becomes a row with ``error``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.numeric import floor_zeros
from shelfcast.plans.panel import series_window
from shelfcast.session import ship_package
from shelfcast.sources.sinks import materialize

# ---- fixed values ----------------------------------------------------------------
SEASON = 7
ZERO_FLOOR = 0.1          # zeros are replaced before fitting (P11)
DEFAULT_ORDER = (1, 1)    # (p, q): SARIMA(1,0,1)(1,1,0)[7]
AUTO_MAX_P = 3
AUTO_MAX_Q = 2
LONG_AR = 21
# ------------------------------------------------------------------------------------

STAGE2_W_LAGS = sorted(set(range(1, AUTO_MAX_P + 1)) | {SEASON, SEASON + 1})   # 1, 2, 3, 7, 8
STAGE2_E_LAGS = list(range(1, AUTO_MAX_Q + 1))                                  # 1, 2
STAGE2_START = LONG_AR + max(STAGE2_W_LAGS + STAGE2_E_LAGS)                     # first row of stage 2
MIN_POINTS = 3 * LONG_AR + 10


def candidate_lags(p: int, q: int, season: int = SEASON) -> tuple[list[int], list[int]]:
    ar = sorted(set(range(1, p + 1)) | {season} | ({season + 1} if p >= 1 else set()))
    return ar, list(range(1, q + 1))


# ---- numpy reference (one series); also used by the tests as the brute force --------------

def _toeplitz(r: np.ndarray) -> np.ndarray:
    idx = np.arange(len(r))
    return r[np.abs(idx[:, None] - idx[None, :])]


def _lagmat(x: np.ndarray, lags: list[int], start: int) -> np.ndarray:
    return np.column_stack([x[start - k:len(x) - k] for k in lags]) if lags else np.empty((len(x) - start, 0))


def fit_numpy(w: np.ndarray, p: int, q: int, season: int = SEASON):
    """The same two-stage fit on one differenced series: (coefs, ar_lags, aic, resid)."""
    n = len(w)
    m = LONG_AR
    if n < MIN_POINTS:
        raise ValueError(f"series too short for the fit ({n} differenced points)")
    r = np.array([float(w[k:] @ w[:n - k]) for k in range(m + 1)])
    b1 = np.linalg.solve(_toeplitz(r[:m]), r[1:])
    x1 = _lagmat(w, list(range(1, m + 1)), m)
    e = np.zeros(n)
    e[m:] = w[m:] - x1 @ b1
    ar_lags, e_lags = candidate_lags(p, q, season)
    start = STAGE2_START
    x = np.column_stack([_lagmat(w, ar_lags, start), _lagmat(e, e_lags, start)])
    y = w[start:]
    b, *_ = np.linalg.lstsq(x, y, rcond=None)
    resid = y - x @ b
    sigma2 = float(resid @ resid) / len(y)
    aic = len(y) * math.log(max(sigma2, 1e-300)) + 2 * x.shape[1]
    return b, ar_lags, aic, e


def roll_out(y_tail, w_tail, e_tail, coefs, ar_lags, n_e: int, horizon: int, season: int = SEASON):
    """Recursive forecast: future shocks 0, seasonal difference undone, clipped at 0."""
    w_ext, e_ext, y_ext = list(w_tail), list(e_tail), list(y_tail)
    phi, theta = coefs[:len(ar_lags)], coefs[len(ar_lags):len(ar_lags) + n_e]
    out = []
    for _ in range(horizon):
        val = sum(c * w_ext[len(w_ext) - k] for c, k in zip(phi, ar_lags))
        val += sum(theta[j] * e_ext[len(e_ext) - 1 - j] for j in range(len(theta)))
        w_ext.append(val)
        e_ext.append(0.0)
        y_next = val + y_ext[len(y_ext) - season]
        y_ext.append(y_next)
        out.append(max(y_next, 0.0))
    return np.array(out)


def forecast_numpy(y: np.ndarray, horizon: int, p: int, q: int, season: int = SEASON):
    """Fit and forecast one series in numpy: (forecast, aic)."""
    y = np.where(y == 0, ZERO_FLOOR, y.astype(float))
    w = y[season:] - y[:-season]
    b, ar_lags, aic, e = fit_numpy(w, p, q, season)
    return roll_out(y[-season:], w[-(season + 1):], e[-AUTO_MAX_Q:], b, ar_lags, q, horizon, season), aic


# ---- Spark implementation --------------------------------------------------------------------

def _solve_stage1(batches):
    m = LONG_AR
    for pdf in batches:
        out_ids, out_n, out_b, out_err = [], [], [], []
        for _, r in pdf.iterrows():
            out_ids.append(r["id"])
            out_n.append(r["n_rows"])
            if pd.isna(r["n_w"]) or r["n_w"] < MIN_POINTS:
                out_b.append(None)
                out_err.append("series too short for the fit")
                continue
            acov = np.array([r[f"r{k}"] for k in range(m + 1)], dtype=float)
            try:
                out_b.append(np.linalg.solve(_toeplitz(acov[:m]), acov[1:]).tolist())
                out_err.append(None)
            except np.linalg.LinAlgError:
                out_b.append(None)
                out_err.append("singular stage-1 system")
        yield pd.DataFrame({"id": out_ids, "n_rows": out_n, "b1": out_b, "error": out_err})


def _stage2_names():
    return [f"w{k}" for k in STAGE2_W_LAGS] + [f"e{k}" for k in STAGE2_E_LAGS]


def _solve_stage2(horizon: int, order: tuple[int, int], auto: bool):
    names = _stage2_names()
    cands = ([(p, q) for p in range(AUTO_MAX_P + 1) for q in range(AUTO_MAX_Q + 1)] if auto else [order])

    def run(batches):
        for pdf in batches:
            rows = []
            for _, r in pdf.iterrows():
                n = r["n2"]
                best = None
                for p, q in cands:
                    ar, el = candidate_lags(p, q)
                    cols = [f"w{k}" for k in ar] + [f"e{k}" for k in el]
                    idx = [names.index(c) for c in cols]
                    xtx = np.array([[r[f"x_{names[min(a, b)]}_{names[max(a, b)]}"] for b in idx] for a in idx])
                    xty = np.array([r[f"y_{names[a]}"] for a in idx])
                    try:
                        b = np.linalg.solve(xtx, xty)
                    except np.linalg.LinAlgError:
                        continue
                    ssr = r["yy"] - 2.0 * b @ xty + b @ xtx @ b
                    aic = n * math.log(max(ssr / n, 1e-300)) + 2 * len(idx)
                    if best is None or aic < best[3]:
                        best = (b, ar, q, aic, p)
                if best is None:
                    rows.append({"id": r["id"], "h": None, "yhat": None, "p": None, "q": None, "aic": None,
                                 "error": "singular stage-2 regression"})
                    continue
                b, ar, q, aic, p = best
                tail = sorted(r["tail"], key=lambda s: s["t"])
                fc = roll_out([s["y"] for s in tail][-SEASON:], [s["w"] for s in tail][-(SEASON + 1):],
                              [s["e"] for s in tail][-AUTO_MAX_Q:], b, ar, q, horizon)
                for h, v in enumerate(fc, start=1):
                    rows.append({"id": r["id"], "h": h, "yhat": float(v), "p": p, "q": q, "aic": float(aic),
                                 "error": None})
            yield pd.DataFrame(rows, columns=["id", "h", "yhat", "p", "q", "aic", "error"])
    return run


def sarima_forecast(history: DataFrame, cutoff, horizon: int = 28, order: tuple[int, int] = DEFAULT_ORDER,
                    auto: bool = False) -> tuple[DataFrame, DataFrame]:
    """M2 (fixed order) / M3 (``auto``): forecasts (id, h, date, yhat, p, q, aic) for every
    series and the failure list (id, error).  ``history`` is the dense panel up to ``cutoff``."""
    ship_package(history.sparkSession)
    cut = cutoff if isinstance(cutoff, Column) else F.lit(cutoff).cast("date")
    m = LONG_AR
    w = series_window()
    # both stages read this one, so the source and the first windows run once
    base = materialize(history.select("id", "date", floor_zeros("sales").alias("y"))
                              .withColumn("t", F.row_number().over(w) - 1)
                              .withColumn("w", F.col("y") - F.lag("y", SEASON).over(w)))
    # stage 1: uncentred autocovariance sums r_k = sum_t w_t w_{t-k}, k = 0..m, per series
    lagged = base.withColumns({f"l{i}": F.lag("w", i).over(w) for i in range(1, m + 1)})
    sums1 = lagged.groupBy("id").agg(
        F.count("*").alias("n_rows"), F.count("w").alias("n_w"), F.sum(F.col("w") * F.col("w")).alias("r0"),
        *[F.sum(F.col("w") * F.col(f"l{k}")).alias(f"r{k}") for k in range(1, m + 1)])
    b1 = sums1.mapInPandas(_solve_stage1, "id string, n_rows long, b1 array<double>, error string")
    b1 = materialize(b1)  # one row per series, read for the fits and for the failures; joined by id
    ok1 = b1.filter(F.col("error").isNull()).select("id", "n_rows", "b1")
    # residuals of stage 1 (0 where the lags do not exist yet), same window partitioning
    fit1 = sum((F.col("b1")[i - 1] * F.col(f"l{i}") for i in range(1, m + 1)), F.lit(0.0))
    resid = (lagged.join(ok1, "id")
                   .withColumn("e", F.when(F.col("t") >= SEASON + m, F.col("w") - fit1).otherwise(F.lit(0.0)))
                   .select("id", "date", "t", "n_rows", "y", "w", "e"))
    # stage 2: every candidate's regressors, summed once on a common sample, and the last
    # rows of each series, which seed the roll-out (bounded: 8 rows, all in the sample)
    names = _stage2_names()
    reg = resid.withColumns({**{f"w{k}": F.lag("w", k).over(w) for k in STAGE2_W_LAGS},
                             **{f"e{k}": F.lag("e", k).over(w) for k in STAGE2_E_LAGS}})
    last = F.when(F.col("t") >= F.col("n_rows") - (SEASON + 1), F.struct("t", "y", "w", "e"))
    sums2 = reg.filter(F.col("t") >= SEASON + STAGE2_START).groupBy("id").agg(
        F.count("*").alias("n2"), F.sum(F.col("w") * F.col("w")).alias("yy"),
        *[F.sum(F.col(a) * F.col(b)).alias(f"x_{a}_{b}") for i, a in enumerate(names) for b in names[i:]],
        *[F.sum(F.col(a) * F.col("w")).alias(f"y_{a}") for a in names],
        F.collect_list(last).alias("tail"))
    out = sums2.mapInPandas(_solve_stage2(horizon, order, auto),
                            "id string, h int, yhat double, p int, q int, aic double, error string")
    fc = (out.filter(F.col("error").isNull()).drop("error")
             .withColumn("date", F.date_add(cut, F.col("h"))))
    failed = (b1.filter(F.col("error").isNotNull()).select("id", "error")
                .unionByName(out.filter(F.col("error").isNotNull()).select("id", "error").distinct()))
    return fc, failed
