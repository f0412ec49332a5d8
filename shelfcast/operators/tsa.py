"""Time-series analysis per series.

X1 and X2 are relational (windows + grouped sums, every series at once).  X3 folds the
autocorrelations of a series by array expressions.  X4 sums cross products of blocks of days;
numpy multiplies a block's bounded rows and solves the equations, one row per series.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.session import ship_package

# ---- fixed values ---------------------------------------------------------------------
PERIOD = 7
ACF_LAGS = 28
PACF_LAGS = 56
# MacKinnon (2010) response-surface coefficients, constant-only regression, one series:
MIN_ADF_DAYS = 12
# critical value = b0 + b1/n + b2/n^2 + b3/n^3
ADF_CRIT_CONST = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}
# -----------------------------------------------------------------------------------------


# ---- X1: additive decomposition ------------------------------------------------------------

def decompose(df: DataFrame, key: str = "id", value: str = "sales", period: int = PERIOD,
              since=None) -> DataFrame:
    """Additive decomposition with an odd ``period``: centred moving-average trend whose
    missing edges are extended by a least-squares line through the nearest ``period``
    trend points, phase means of the detrended values minus their mean as the seasonal
    part, and the residual.  Every series at once.

    Exactness: for whole numbers all sums are integer, and each output is one IEEE
    division of an exact numerator by ``D = period^2 * sum(j^2)``; so the result does not
    depend on how partitions add up.  Fractional values are summed as doubles.  Series
    shorter than ``3 * period`` get NULLs.
    """
    if period % 2 != 1:
        raise ValueError("period must be odd")
    h = period // 2
    k2 = sum(j * j for j in range(-h, h + 1))
    den = period * period * k2
    kind = "long" if df.schema[value].dataType.typeName() in ("byte", "short", "integer", "long") else "double"
    src = df if since is None else df.filter(F.col("date") >= F.lit(since).cast("date"))
    w, whole = Window.partitionBy(key).orderBy("date"), Window.partitionBy(key)
    # every sum is a window over the series, so all steps share one exchange and one sort
    base = src.select(key, "date", F.col(value).cast(kind).alias("x")).withColumns({
        "t": F.row_number().over(w) - 1,
        "n": F.count("*").over(whole),
        "s": F.sum("x").over(w.rowsBetween(-h, h)).cast(kind),
    })
    t, n, s = F.col("t"), F.col("n"), F.col("s")
    cf = F.lit(2 * h)                       # centre of the front fit points t = h .. h+period-1
    cb = n - 1 - period                      # centre of the back fit points t = n-1-h-period .. n-2-h
    front = t.between(h, h + period - 1)
    back = t.between(n - 1 - h - period, n - 2 - h)
    fitted = base.withColumns({
        "a_f": F.sum(F.when(front, s)).over(whole), "b_f": F.sum(F.when(front, (t - cf) * s)).over(whole),
        "a_b": F.sum(F.when(back, s)).over(whole), "b_b": F.sum(F.when(back, (t - cb) * s)).over(whole)})
    num = (F.when(n < 3 * period, F.lit(None).cast(kind))
            .when(t < h, F.lit(k2) * F.col("a_f") + F.lit(period) * F.col("b_f") * (t - cf))
            .when(t > n - 1 - h, F.lit(k2) * F.col("a_b") + F.lit(period) * F.col("b_b") * (t - cb))
            .otherwise(s * F.lit(period * k2)))
    x = (fitted.withColumn("num", num)
               .withColumn("dn", F.lit(den) * F.col("x") - F.col("num"))
               .withColumn("phase", (t % period).cast("int")))
    of_phase = [F.when(F.col("phase") == q, F.col("dn")) for q in range(period)]
    x = x.withColumns({f"p{q}": F.sum(v).over(whole).cast("double") / F.count(v).over(whole) for q, v in enumerate(of_phase)})
    total = F.col("p0")
    for q in range(1, period):
        total = total + F.col(f"p{q}")
    season = F.get(F.array(*[F.col(f"p{q}") for q in range(period)]), F.col("phase")) - total / F.lit(float(period))
    out = x.withColumn("sn", season)
    return out.select(
        key, "date", F.col("x").alias(value),
        (F.col("num").cast("double") / F.lit(float(den))).alias("trend"),
        (F.col("sn") / F.lit(float(den))).alias("seasonal"),
        ((F.col("dn").cast("double") - F.col("sn")) / F.lit(float(den))).alias("resid"))


# ---- X2: autocorrelation --------------------------------------------------------------------

def acf_array(df: DataFrame, key: str, value: str, nlags: int) -> DataFrame:
    """(key, r array<double>) with r_0..r_nlags, see ``acf``."""
    w = Window.partitionBy(key).orderBy("date")
    base = df.select(key, "date", F.col(value).cast("double").alias("v")).withColumn(
        "d", F.col("v") - F.avg("v").over(Window.partitionBy(key)))
    base = base.withColumns({f"l{k}": F.lag("d", k).over(w) for k in range(1, nlags + 1)})
    sums = base.groupBy(key).agg(F.sum(F.col("d") * F.col("d")).alias("c0"),
                                 *[F.sum(F.col("d") * F.col(f"l{k}")).alias(f"c{k}") for k in range(1, nlags + 1)])
    return sums.select(key, F.array(*[F.try_divide(F.col(f"c{k}"), F.col("c0")) for k in range(0, nlags + 1)]).alias("r"))


def acf(df: DataFrame, key: str = "id", value: str = "sales", nlags: int = ACF_LAGS) -> DataFrame:
    """Biased sample autocorrelation r_k = sum (x_t - m)(x_{t+k} - m) / sum (x_t - m)^2,
    k = 0..nlags, per key; long output (key, lag, acf).  ``nlags`` lag columns come from
    one sort; no self-join, no row explosion.  A constant series has no autocorrelation:
    its rows are NULL."""
    return acf_array(df, key, value, nlags).select(key, F.posexplode("r").alias("lag", "acf"))


# ---- X3: partial autocorrelation ------------------------------------------------------------

def levinson(r: Column) -> Column:
    """Partial autocorrelations 1, phi_11, phi_22, ... from the array r_0 = 1, r_1, ..., by the
    Durbin-Levinson recursion: a fold over the lags that carries the coefficients of the last
    order, the share of variance left, and the results."""
    def step(state: Column, k: Column) -> Column:
        phi = state["phi"]
        # phi_1..phi_{k-1} against r_{k-1}..r_1
        past = F.zip_with(phi, F.reverse(F.slice(r, F.lit(2), F.size(phi))), lambda a, b: a * b)
        known = F.aggregate(past, F.lit(0.0), lambda total, x: total + x)
        partial = F.try_divide(F.element_at(r, k + 1) - known, state["left"])

        def with_partial(p: Column) -> Column:  # evaluated once, not once per coefficient
            return F.struct(
                F.concat(F.zip_with(phi, F.reverse(phi), lambda a, b: a - p * b), F.array(p)).alias("phi"),
                (state["left"] * (F.lit(1.0) - p * p)).alias("left"),
                F.concat(state["out"], F.array(p)).alias("out"))

        return F.get(F.transform(F.array(partial), with_partial), F.lit(0))

    empty = F.array().cast("array<double>")
    begin = F.struct(empty.alias("phi"), F.lit(1.0).alias("left"), F.array(F.lit(1.0)).alias("out"))
    lags = F.when(F.size(r) > 1, F.sequence(F.lit(1), F.size(r) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(lags, begin, step, lambda state: state["out"])


def pacf(df: DataFrame, key: str = "id", value: str = "sales", nlags: int = PACF_LAGS) -> DataFrame:
    """Yule-Walker (biased autocovariance) partial autocorrelation per key: X2, then the
    recursion over each key's ``nlags + 1`` numbers.  A constant or too short series has NULL
    autocorrelations, hence NULL partial ones."""
    # the fold reads r many times: it must be a column by then, not a formula
    r = acf_array(df, key, value, nlags).select(key, F.transform("r", lambda x: x).alias("r"))
    whole = F.forall("r", lambda x: x.isNotNull())
    none = F.array_repeat(F.lit(None).cast("double"), nlags + 1)
    out = r.select(key, F.when(whole, levinson(F.col("r"))).otherwise(none).alias("p"))
    return out.select(key, F.posexplode("p").alias("lag", "pacf"))


# ---- X4: augmented Dickey-Fuller ------------------------------------------------------------

#: MacKinnon's published response surface for the constant-only case: the
#: statistic's range, the border of its two parts, and the polynomials in the statistic.
P_RANGE, P_BORDER = (-18.83, 2.74), -1.61
P_LOW = (2.1659, 1.4412, 0.038269)
P_HIGH = (1.7339, 0.93202, -0.12745, -0.010368)

#: Days of a block whose cross products are summed in one task.
BLOCK_DAYS = 512


def adf_p_value(stat: float) -> float:
    """Approximate p-value of the statistic (regression with a constant)."""
    if stat <= P_RANGE[0]:
        return 0.0
    if stat >= P_RANGE[1]:
        return 1.0
    z = sum(c * stat ** i for i, c in enumerate(P_LOW if stat <= P_BORDER else P_HIGH))
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def _adf_rows(y: np.ndarray, lags: int) -> np.ndarray:
    """Rows (1, y_{t-1}, dy_{t-1} .. dy_{t-lags}, dy_t) for every t with all of them."""
    dy = np.diff(y)
    n = len(dy) - lags
    cols = [np.ones(n), y[lags:-1], *[dy[lags - i:len(dy) - i] for i in range(1, lags + 1)], dy[lags:]]
    return np.column_stack(cols)


class NoStatistic(Exception):
    """A series for which the test says nothing; the message is the reason."""


def _adf_solve(gram: np.ndarray, lag: int, full: int) -> tuple[float, float, float, int]:
    """(statistic, AIC, squared residuals, rows) of the regression with ``lag`` lags from the
    cross products of all columns."""
    use = [*range(lag + 2), full + 2]
    g = gram[np.ix_(use, use)]
    xx, xy, n, k = g[:-1, :-1], g[:-1, -1], g[0, 0], lag + 2
    scale = np.sqrt(np.diag(xx))
    if not (scale > 0).all():
        raise NoStatistic("a lag is zero throughout")
    inverse = np.linalg.inv(xx / np.outer(scale, scale)) / np.outer(scale, scale)
    beta = inverse @ xy
    ssr = float(g[-1, -1] - beta @ xy)
    if ssr <= 1e-12 * g[-1, -1] or n <= k:
        raise NoStatistic("the regression fits exactly")
    aic = n * (math.log(2 * math.pi) + math.log(ssr / n) + 1.0) + 2.0 * k
    return float(beta[1] / math.sqrt(ssr / (n - k) * inverse[1, 1])), aic, ssr, int(n)


def max_adf_lag(n: int) -> int:
    return min(n // 2 - 2, int(math.ceil(12.0 * (n / 100.0) ** 0.25)))


def adf(df: DataFrame, key: str = "id", value: str = "sales", lag: int | None = None) -> DataFrame:
    """X4 per key: ADF with a constant; the number of lags has the least AIC over a common
    sample (or is ``lag``), the statistic comes from all rows that have these lags.

    A series is cut into blocks of ``BLOCK_DAYS`` days, each with the values before it that
    its lags need.  A task sums the cross products of a block; their sums per series hold the
    normal equations of every candidate at once, so the regressions need one row per series,
    however long it is.  A series without a statistic (constant, too short, or fitted
    exactly) keeps its row, with NULLs and the reason in ``error``.
    """
    ship_package(df.sparkSession)
    key_type = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("k"), "date", F.col(value).cast("double").alias("y")).withColumn("t", F.row_number().over(Window.partitionBy("k").orderBy("date")) - 1)
    of = Window.partitionBy("k")
    rows = rows.withColumns({"n": F.count(F.lit(1)).over(of)})
    most = F.least(F.floor(F.col("n") / 2) - 2, F.ceil(F.pow(F.col("n") / 100.0, F.lit(0.25)) * 12)).cast("int")
    rows = rows.withColumn("lags", F.greatest(most if lag is None else F.lit(int(lag)), F.lit(0)))
    block = F.floor(F.col("t") / BLOCK_DAYS)
    # the last lags + 1 values of a block also begin the next one
    both = F.when((F.col("t") % BLOCK_DAYS >= BLOCK_DAYS - 1 - F.col("lags")) & (F.col("t") < F.col("n") - 1), F.array(block, block + 1)).otherwise(F.array(block))
    dealt = rows.withColumn("block", F.explode(both))

    def sums(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("t")
        y, lags = frame["y"].to_numpy(float), int(frame["lags"].iloc[0])
        whole = np.isfinite(y).all()
        x = _adf_rows(y, lags) if whole and len(y) > lags + 1 else np.zeros((0, lags + 3))
        # rows of the first block that only fewer lags have
        head = y[:lags + 1] if frame["t"].iloc[0] == 0 else y[:0]
        return pd.DataFrame({"k": [frame["k"].iloc[0]], "lags": [lags], "n": [frame["n"].iloc[0]], "gram": [(x.T @ x).ravel()],
                             "head": [head], "whole": [whole], "low": [y.min() if whole else None], "high": [y.max() if whole else None]})

    parts = dealt.groupBy("k", "block").applyInPandas(
        sums, f"k {key_type}, lags int, n long, gram array<double>, head array<double>, whole boolean, low double, high double")
    total = (parts.select("k", "lags", "n", "whole", "low", "high", "head", F.posexplode("gram").alias("pos", "g"))
                  .groupBy("k", "pos").agg(F.sum("g").alias("g"), F.max("lags").alias("lags"), F.max("n").alias("n"), F.min("whole").alias("whole"),
                                           F.min("low").alias("low"), F.max("high").alias("high"), F.max_by("head", F.size("head")).alias("head"))
                  .groupBy("k").agg(F.sort_array(F.collect_list(F.struct("pos", "g"))).alias("gram"), F.max("lags").alias("lags"), F.max("n").alias("n"),
                                    F.min("whole").alias("whole"), F.min("low").alias("low"), F.max("high").alias("high"), F.max_by("head", F.size("head")).alias("head"))
                  .select("k", F.col("gram.g").alias("gram"), "lags", "n", "whole", "low", "high", "head"))
    fields = "adf_stat double, p_value double, used_lag int, nobs int, crit_1 double, crit_5 double, crit_10 double, stationary_5pct boolean, error string"
    names = [f.split()[0] for f in fields.split(", ")]

    def one(gram, lags, n, whole, low, high, head) -> dict:
        if n < MIN_ADF_DAYS:
            raise NoStatistic(f"fewer than {MIN_ADF_DAYS} values")
        if not whole or low == high:
            raise NoStatistic("the series is constant or holds a missing value")
        gram = np.array(gram, float).reshape(lags + 3, lags + 3)
        best = lags
        if lag is None:
            aic = [_adf_solve(gram, i, lags)[1] for i in range(lags + 1)]
            best = min(range(lags + 1), key=lambda i: (round(aic[i], 9), i))
        # rows that have the chosen lags, but not all candidates
        extra = _adf_rows(np.asarray(head, float), best) if lags > best else np.zeros((0, best + 3))
        use = [*range(best + 2), lags + 2]
        gram[np.ix_(use, use)] += extra.T @ extra
        stat, _, _, rows_used = _adf_solve(gram, best, lags)
        crit = {c: b[0] + b[1] / rows_used + b[2] / rows_used ** 2 + b[3] / rows_used ** 3 for c, b in ADF_CRIT_CONST.items()}
        return {"adf_stat": stat, "p_value": adf_p_value(stat), "used_lag": best, "nobs": rows_used, "crit_1": crit["1%"],
                "crit_5": crit["5%"], "crit_10": crit["10%"], "stationary_5pct": bool(stat < crit["5%"])}

    def solve(frames):
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                found = dict.fromkeys(names)
                try:
                    found |= one(r.gram, int(r.lags), int(r.n), r.whole, r.low, r.high, r.head)
                except (NoStatistic, np.linalg.LinAlgError) as exc:
                    found["error"] = str(exc)
                out.append({"k": r.k, **found})
            yield pd.DataFrame(out, columns=["k", *names]).astype({"used_lag": "Int32", "nobs": "Int32", "stationary_5pct": "boolean"})

    return total.mapInPandas(solve, f"k {key_type}, {fields}").withColumnRenamed("k", key)
