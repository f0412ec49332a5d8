"""Registered time-series analysis queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.operators import explore as ex
from shelfcast.operators import tsa
from shelfcast.plans.catalog import register, rounded
from shelfcast.plans.oracle_sql import with_panel
from shelfcast.plans.panel import build_panel


def _panel(spark, sf_dir):
    return build_panel(spark, sf_dir, "region")


def _daily_series(spark, sf_dir):
    """Aggregate daily total as one keyed series (bounded by the calendar length)."""
    return (ex.daily_totals(_panel(spark, sf_dir))
              .select(F.lit("total").alias("series"), "date", F.col("total_sales").alias("sales")))


def _decompose_sql() -> str:
    p, h = tsa.PERIOD, tsa.PERIOD // 2
    k2 = sum(j * j for j in range(-h, h + 1))
    den = p * p * k2
    piv = ", ".join(f"max(CASE WHEN phase = {q} THEN p END) AS p{q}" for q in range(p))
    total = " + ".join(f"p{q}" for q in range(p))
    ctes = f"""
base AS (
  SELECT id, date, CAST(sales AS BIGINT) AS x,
         row_number() OVER (PARTITION BY id ORDER BY date) - 1 AS t,
         count(*) OVER (PARTITION BY id) AS n,
         CAST(sum(sales) OVER (PARTITION BY id ORDER BY date ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) AS BIGINT) AS s
  FROM panel
),
fits AS (
  SELECT id,
         sum(CASE WHEN t BETWEEN {h} AND {h + p - 1} THEN s END) AS a_f,
         sum(CASE WHEN t BETWEEN {h} AND {h + p - 1} THEN (t - {2 * h}) * s END) AS b_f,
         sum(CASE WHEN t BETWEEN n - 1 - {h} - {p} AND n - 2 - {h} THEN s END) AS a_b,
         sum(CASE WHEN t BETWEEN n - 1 - {h} - {p} AND n - 2 - {h} THEN (t - (n - 1 - {p})) * s END) AS b_b
  FROM base GROUP BY id
),
xx AS (
  SELECT b.*,
         CASE WHEN n < {3 * p} THEN NULL
              WHEN t < {h} THEN {k2} * a_f + {p} * b_f * (t - {2 * h})
              WHEN t > n - 1 - {h} THEN {k2} * a_b + {p} * b_b * (t - (n - 1 - {p}))
              ELSE s * {p * k2} END AS num
  FROM base b JOIN fits f USING (id)
),
x2 AS (SELECT *, {den} * x - num AS dn, CAST(t % {p} AS INTEGER) AS phase FROM xx),
pa AS (SELECT id, phase, CAST(sum(dn) AS DOUBLE) / count(dn) AS p FROM x2 GROUP BY id, phase),
piv AS (SELECT id, {piv} FROM pa GROUP BY id),
mn AS (SELECT id, ({total}) / {float(p)} AS m FROM piv),
sn AS (SELECT pa.id, pa.phase, pa.p - mn.m AS sn FROM pa JOIN mn USING (id))"""
    body = f"""SELECT x2.id, x2.date, x2.x AS sales, CAST(num AS DOUBLE) / {float(den)} AS trend,
       sn / {float(den)} AS seasonal, (CAST(dn AS DOUBLE) - sn) / {float(den)} AS resid
FROM x2 LEFT JOIN sn USING (id, phase)"""
    return with_panel(body, extra_ctes=ctes)


@register("decomposition", _decompose_sql())
def q_decompose(spark, sf_dir):
    """Additive weekly decomposition of every series (trend edges extrapolated)."""
    return rounded(tsa.decompose(_panel(spark, sf_dir)), keep=("trend", "seasonal", "resid"))


def _regression_sql() -> str:
    """X1 stated by means and regressions, for daily totals of a store."""
    p, h = tsa.PERIOD, tsa.PERIOD // 2
    front, back = f"t BETWEEN {h} AND {h + p - 1}", f"t BETWEEN n - 1 - {h} - {p} AND n - 2 - {h}"
    ctes = f"""
totals AS (SELECT store_id, date, CAST(sum(sales) AS DOUBLE) AS x FROM panel GROUP BY store_id, date),
smooth AS (
  SELECT store_id, date, x, row_number() OVER w - 1 AS t, count(*) OVER (PARTITION BY store_id) AS n,
         avg(x) OVER (PARTITION BY store_id ORDER BY date ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) AS m
  FROM totals WINDOW w AS (PARTITION BY store_id ORDER BY date)
),
ends AS (
  SELECT store_id, regr_slope(m, t) FILTER ({front}) AS fs, regr_intercept(m, t) FILTER ({front}) AS fi,
         regr_slope(m, t) FILTER ({back}) AS bs, regr_intercept(m, t) FILTER ({back}) AS bi
  FROM smooth GROUP BY store_id
),
line AS (
  SELECT s.store_id, date, x, t % {p} AS phase, CASE WHEN t < {h} THEN fi + fs * t WHEN t > n - 1 - {h} THEN bi + bs * t ELSE m END AS trend
  FROM smooth s JOIN ends USING (store_id) WHERE n >= {3 * p}
),
phases AS (SELECT store_id, phase, avg(x - trend) AS p FROM line GROUP BY ALL),
centred AS (SELECT store_id, phase, p - avg(p) OVER (PARTITION BY store_id) AS seasonal FROM phases)"""
    return with_panel("""SELECT store_id, date, CAST(x AS BIGINT) AS sales, round(trend, 6) + 0.0 AS trend, round(seasonal, 6) + 0.0 AS seasonal,
       round(x - trend - seasonal, 6) + 0.0 AS resid
FROM line JOIN centred USING (store_id, phase)""", extra_ctes=ctes)


@register("store_decomposition", _regression_sql())
def q_store_decomposition(spark, sf_dir):
    """X1 of the daily total of each store; the oracle fits the ends of the trend by regression
    instead of the sums the operator uses."""
    totals = _panel(spark, sf_dir).groupBy("store_id", "date").agg(F.sum("sales").alias("sales"))
    out = rounded(tsa.decompose(totals, key="store_id"))
    return out.select("store_id", "date", "sales", *[(F.col(c) + F.lit(0.0)).alias(c) for c in ("trend", "seasonal", "resid")])


def _acf_sql(src: str, key: str, nlags: int) -> str:
    lags = ", ".join(f"lag(d, {k}) OVER (PARTITION BY {key} ORDER BY date) AS l{k}" for k in range(1, nlags + 1))
    sums = ", ".join(f"sum(d * l{k}) AS c{k}" for k in range(1, nlags + 1))
    ctes = f"""
dv AS (SELECT {key}, date, CAST(sales AS DOUBLE) - avg(CAST(sales AS DOUBLE)) OVER (PARTITION BY {key}) AS d FROM {src}),
lg AS (SELECT {key}, d, {lags} FROM dv),
sm AS (SELECT {key}, sum(d * d) AS c0, {sums} FROM lg GROUP BY {key})"""
    body = "\nUNION ALL\n".join(f"SELECT {key}, {k} AS lag, round(c{k} / c0, 6) AS acf FROM sm"
                                for k in range(0, nlags + 1))
    return ctes, body


_ctes, _body = _acf_sql("panel", "id", tsa.ACF_LAGS)


@register("series_acf", with_panel(_body, extra_ctes=_ctes))
def q_series_acf(spark, sf_dir):
    """Autocorrelation to lag 28 of every series."""
    return rounded(tsa.acf(_panel(spark, sf_dir), "id", "sales", tsa.ACF_LAGS))


_ctes2, _body2 = _acf_sql("dts", "series", tsa.ACF_LAGS)


@register("daily_total_acf", with_panel(
    _body2, extra_ctes="dts AS (SELECT 'total' AS series, date, sum(sales) AS sales FROM panel GROUP BY date),"
    + _ctes2))
def q_daily_acf(spark, sf_dir):
    """Autocorrelation to lag 28 of the aggregate daily total (the notebook's view)."""
    return rounded(tsa.acf(_daily_series(spark, sf_dir), "series", "sales", tsa.ACF_LAGS))


_ctes56, _body56 = _acf_sql("dts", "series", tsa.PACF_LAGS)
_DAILY = "dts AS (SELECT 'total' AS series, date, sum(sales) AS sales FROM panel GROUP BY date),"


@register("daily_total_acf_56", with_panel(_body56, extra_ctes=_DAILY + _ctes56))
def q_daily_acf_56(spark, sf_dir):
    """Autocorrelation to lag 56 of the aggregate daily total (the notebook's plot)."""
    return rounded(tsa.acf(_daily_series(spark, sf_dir), "series", "sales", tsa.PACF_LAGS))


def _pacf_sql(src: str, key: str, nlags: int, extra: str = "") -> str:
    """Durbin-Levinson as a recursive query: a row per order carries the coefficients."""
    ctes, _ = _acf_sql(src, key, nlags)
    ctes = extra + ctes + f""",
rr AS (SELECT {key}, [{", ".join(f"c{k} / c0" for k in range(0, nlags + 1))}] AS r FROM sm),
lev AS (
  SELECT {key}, 0 AS lag, []::DOUBLE[] AS phi, 1.0::DOUBLE AS sigma, r, 1.0::DOUBLE AS p FROM rr
  UNION ALL
  SELECT {key}, lag + 1, list_concat(list_transform(range(1, lag + 1), lambda j: phi[j] - q * phi[lag + 1 - j]), [q]),
         sigma * (1 - q * q), r, q
  FROM (SELECT *, (r[lag + 2] - coalesce(list_sum(list_transform(range(1, lag + 1), lambda j: phi[j] * r[lag + 2 - j])), 0)) / sigma AS q
        FROM lev WHERE lag < {nlags})
)"""
    sql = with_panel(f"SELECT {key}, lag, round(p, 6) AS pacf FROM lev", extra_ctes=ctes)
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@register("daily_total_pacf", _pacf_sql("dts", "series", tsa.PACF_LAGS, _DAILY))
def q_daily_pacf(spark, sf_dir):
    """Partial autocorrelation to lag 56 of the daily total (Yule-Walker, Levinson)."""
    return rounded(tsa.pacf(_daily_series(spark, sf_dir), "series", "sales", tsa.PACF_LAGS))


@register("series_pacf", _pacf_sql("panel", "id", tsa.PACF_LAGS))
def q_series_pacf(spark, sf_dir):
    """X3 for every series."""
    return rounded(tsa.pacf(_panel(spark, sf_dir), "id", "sales", tsa.PACF_LAGS))


@register("daily_total_adf", None)
def q_daily_adf(spark, sf_dir):
    """ADF test of the daily total, lag by AIC, p-value and verdict at 5%."""
    return tsa.adf(_daily_series(spark, sf_dir), "series", "sales")


@register("series_adf", None)
def q_series_adf(spark, sf_dir):
    """X4 for every series."""
    return tsa.adf(_panel(spark, sf_dir), "id", "sales")


def _adf_sql(src: str, key: str, extra: str = "") -> str:
    """ADF with one lag and a constant by the normal equations of centred variables."""
    crit = {n: tsa.ADF_CRIT_CONST[f"{n}%"] for n in (1, 5, 10)}
    crits = ", ".join(f"round({b[0]} + {b[1]} / n + {b[2]} / n ** 2 + {b[3]} / n ** 3, 6) AS crit_{n}" for n, b in crit.items())
    ctes = extra + f"""
yy AS (SELECT {key} AS k, date, CAST(sales AS DOUBLE) AS y, lag(CAST(sales AS DOUBLE)) OVER (PARTITION BY {key} ORDER BY date) AS y1 FROM {src}),
dy AS (SELECT k, y - y1 AS d, y1, lag(y - y1) OVER (PARTITION BY k ORDER BY date) AS d1 FROM yy),
sm AS (SELECT k, count(*) AS n, count(*) * var_pop(y1) AS s11, count(*) * var_pop(d1) AS s22, count(*) * covar_pop(y1, d1) AS s12,
              count(*) * covar_pop(y1, d) AS s1y, count(*) * covar_pop(d1, d) AS s2y, count(*) * var_pop(d) AS syy
       FROM dy WHERE d1 IS NOT NULL GROUP BY k),
bb AS (SELECT *, s11 * s22 - s12 * s12 AS det, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
              (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM sm),
tt AS (SELECT *, b1 / sqrt((syy - b1 * s1y - b2 * s2y) / (n - 3) * s22 / det) AS stat FROM bb)"""
    return with_panel(f"SELECT k AS {key}, round(stat, 6) AS adf_stat, 1 AS used_lag, CAST(n AS INTEGER) AS nobs, {crits} FROM tt", extra_ctes=ctes)


def _fixed_lag(out, key):
    return rounded(out.select(key, "adf_stat", "used_lag", "nobs", "crit_1", "crit_5", "crit_10"))


@register("series_adf_one_lag", _adf_sql("panel", "id"))
def q_series_adf_one_lag(spark, sf_dir):
    """X4 with one lag for every series, for the oracle."""
    return _fixed_lag(tsa.adf(_panel(spark, sf_dir), "id", "sales", lag=1), "id")


@register("daily_total_adf_one_lag", _adf_sql("dts", "series", _DAILY))
def q_daily_adf_one_lag(spark, sf_dir):
    """X4 with one lag of the daily total, for the oracle."""
    return _fixed_lag(tsa.adf(_daily_series(spark, sf_dir), "series", "sales", lag=1), "series")
