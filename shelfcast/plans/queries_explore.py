"""Registered exploration queries (A1-A17, A20-A23, J5-J8, T2, T7, W7-W12, M10) with
their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.operators import explore as ex
from shelfcast.operators import forecast as fcst
from shelfcast.plans.catalog import register, rounded
from shelfcast.plans.oracle_sql import with_panel
from shelfcast.plans.panel import build_panel, daily_sales, raw_tables, star_facts
from shelfcast.plans.queries_core import NAIVE_CTES, naive_scored


def _panel(spark, sf_dir):
    return build_panel(spark, sf_dir, "region")


DAILY_CTE = """daily_tot AS (
  SELECT date, event_name_1, event_type_1, event_name_2, event_type_2,
         CAST(sum(sales) AS BIGINT) AS total_sales,
         CAST(isodow(date) - 1 AS INTEGER) AS dow, CAST(month(date) AS INTEGER) AS month,
         CAST(year(date) AS INTEGER) AS year, CAST(weekofyear(date) AS INTEGER) AS week,
         event_name_1 IS NOT NULL AS has_event
  FROM panel GROUP BY date, event_name_1, event_type_1, event_name_2, event_type_2
)"""


# ---- A1, A2 ------------------------------------------------------------------------------------

@register("dataset_profile", with_panel("""
SELECT count(*) AS n_series, count(DISTINCT item_id) AS n_items, count(DISTINCT store_id) AS n_stores,
       count(DISTINCT dept_id) AS n_depts, count(DISTINCT cat_id) AS n_cats, count(DISTINCT state_id) AS n_states,
       CAST(sum(n_obs) AS BIGINT) AS n_obs, min(first_date) AS first_date, max(last_date) AS last_date,
       (SELECT count(DISTINCT date) FROM panel) AS n_days
FROM (SELECT id, item_id, dept_id, cat_id, store_id, state_id, count(*) AS n_obs,
             min(date) AS first_date, max(date) AS last_date FROM panel GROUP BY ALL) s"""))
def q_profile(spark, sf_dir):
    """A1: dataset profile."""
    return ex.dataset_profile(_panel(spark, sf_dir))


@register("series_counts", with_panel("""
SELECT 'store_id' AS level, store_id AS value, count(*) AS n_series FROM (SELECT DISTINCT id, store_id FROM panel) GROUP BY store_id
UNION ALL
SELECT 'cat_id', cat_id, count(*) FROM (SELECT DISTINCT id, cat_id FROM panel) GROUP BY cat_id
UNION ALL
SELECT 'dept_id', dept_id, count(*) FROM (SELECT DISTINCT id, dept_id FROM panel) GROUP BY dept_id"""))
def q_series_counts(spark, sf_dir):
    """A2: series per store / category / department (one GROUPING SETS pass)."""
    return ex.series_counts(_panel(spark, sf_dir))


# ---- A3-A5 -------------------------------------------------------------------------------------

@register("zero_rate_overall", with_panel(
    "SELECT CAST(sum(CAST(sales = 0 AS INTEGER)) AS BIGINT) AS zero_rows, count(*) AS n_rows, "
    "round(avg(CAST(sales = 0 AS DOUBLE)) * 100, 6) AS zero_pct FROM panel"))
def q_zero_overall(spark, sf_dir):
    """A3: zero rows and share."""
    return rounded(ex.zero_rate(_panel(spark, sf_dir)))


@register("zero_rate_by_category", with_panel(
    "SELECT cat_id, CAST(sum(CAST(sales = 0 AS INTEGER)) AS BIGINT) AS zero_rows, count(*) AS n_rows, "
    "round(avg(CAST(sales = 0 AS DOUBLE)) * 100, 6) AS zero_pct FROM panel GROUP BY cat_id"))
def q_zero_cat(spark, sf_dir):
    """A4: zero share per category."""
    return rounded(ex.zero_rate(_panel(spark, sf_dir), "cat_id"))


@register("zero_rate_by_dept", with_panel(
    "SELECT dept_id, CAST(sum(CAST(sales = 0 AS INTEGER)) AS BIGINT) AS zero_rows, count(*) AS n_rows, "
    "round(avg(CAST(sales = 0 AS DOUBLE)) * 100, 6) AS zero_pct FROM panel GROUP BY dept_id"))
def q_zero_dept(spark, sf_dir):
    """A4: zero share per department."""
    return rounded(ex.zero_rate(_panel(spark, sf_dir), "dept_id"))


@register("intermittency", with_panel("""
SELECT CAST(sum(CAST(zero_rate > 0.5 AS INTEGER)) AS BIGINT) AS n_intermittent, count(*) AS n_series,
       round(avg(CAST(zero_rate > 0.5 AS DOUBLE)) * 100, 6) AS intermittent_pct,
       round(avg(zero_rate) * 100, 6) AS mean_zero_pct
FROM (SELECT id, avg(CAST(sales = 0 AS DOUBLE)) AS zero_rate FROM panel GROUP BY id)"""))
def q_intermittency(spark, sf_dir):
    """A5: share of series with more than half zero days."""
    return rounded(ex.intermittency(_panel(spark, sf_dir)))


# ---- A6-A10, J5, J7 ---------------------------------------------------------------------------

@register("daily_totals", with_panel("SELECT * FROM daily_tot", extra_ctes=DAILY_CTE))
def q_daily(spark, sf_dir):
    """A6 + J5: daily totals with calendar fields and events."""
    return ex.daily_totals(_panel(spark, sf_dir))


@register("weekday_box", with_panel("""
SELECT dow, min(total_sales) AS min,
       round(quantile_cont(CAST(total_sales AS DOUBLE), 0.25), 6) AS q1,
       round(quantile_cont(CAST(total_sales AS DOUBLE), 0.5), 6) AS median,
       round(quantile_cont(CAST(total_sales AS DOUBLE), 0.75), 6) AS q3, max(total_sales) AS max
FROM daily_tot GROUP BY dow""", extra_ctes=DAILY_CTE))
def q_weekday_box(spark, sf_dir):
    """Weekday distribution of daily totals (box statistics)."""
    return rounded(ex.weekday_box(ex.daily_totals(_panel(spark, sf_dir))))


@register("month_mean", with_panel(
    "SELECT month, round(avg(total_sales), 6) AS avg_total_sales FROM daily_tot GROUP BY month",
    extra_ctes=DAILY_CTE))
def q_month_mean(spark, sf_dir):
    """Mean daily total by month."""
    return rounded(ex.month_mean(ex.daily_totals(_panel(spark, sf_dir))))


@register("event_describe", with_panel("""
SELECT has_event, count(*) AS count, round(avg(CAST(total_sales AS DOUBLE)), 6) AS mean,
       round(stddev_samp(CAST(total_sales AS DOUBLE)), 6) AS std, round(min(CAST(total_sales AS DOUBLE)), 6) AS min,
       round(quantile_cont(CAST(total_sales AS DOUBLE), 0.25), 6) AS p25,
       round(quantile_cont(CAST(total_sales AS DOUBLE), 0.5), 6) AS p50,
       round(quantile_cont(CAST(total_sales AS DOUBLE), 0.75), 6) AS p75,
       round(max(CAST(total_sales AS DOUBLE)), 6) AS max
FROM daily_tot GROUP BY has_event""", extra_ctes=DAILY_CTE))
def q_event_describe(spark, sf_dir):
    """Event vs non-event day statistics."""
    return rounded(ex.event_describe(ex.daily_totals(_panel(spark, sf_dir))))


@register("event_lift_top", with_panel("""
SELECT event_name_1, round((avg(total_sales) / (SELECT avg(total_sales) FROM daily_tot WHERE NOT has_event) - 1) * 100, 6) AS lift_pct
FROM daily_tot WHERE has_event GROUP BY event_name_1
ORDER BY lift_pct DESC, event_name_1 LIMIT 20""", extra_ctes=DAILY_CTE))
def q_event_lift(spark, sf_dir):
    """A10 + F15: event lift over the non-event mean, top 20."""
    return rounded(ex.event_lift(ex.daily_totals(_panel(spark, sf_dir))))


@register("event_window_effect", with_panel("""
SELECT e.event_name_1, CAST(o.offset AS INTEGER) AS offset, round(avg(d.total_sales), 6) AS avg_sales, count(*) AS n_days
FROM daily_tot e, (SELECT unnest(generate_series(-7, 7)) AS offset) o, daily_tot d
WHERE e.event_name_1 IS NOT NULL AND d.date = e.date + CAST(o.offset AS INTEGER)
GROUP BY e.event_name_1, o.offset""", extra_ctes=DAILY_CTE))
def q_event_window(spark, sf_dir):
    """Mean daily total at offsets -7..7 around every event."""
    return rounded(ex.event_window_effect(ex.daily_totals(_panel(spark, sf_dir))))


# ---- prices: A11, A12, J6, W7, A20 ------------------------------------------------------------

PRICES_CTE = """prices AS (
  SELECT store_id, item_id, c.wm_yr_wk, sum(price_micros) / count(price_micros) / 1000000.0 AS sell_price
  FROM facts_id f JOIN cal c ON c.date = f.date GROUP BY store_id, item_id, c.wm_yr_wk
),
prices_h AS (
  SELECT p.*, h.dept_id, h.cat_id FROM prices p
  LEFT JOIN (SELECT DISTINCT item_id, store_id, dept_id, cat_id FROM panel) h USING (item_id, store_id)
)"""


def _prices_h(spark, sf_dir):
    _, _, prices = raw_tables(spark, sf_dir, "region")
    # the hierarchy comes from the days with sales: no dense panel for a few distinct rows
    return ex.prices_with_hierarchy(prices, daily_sales(star_facts(spark, sf_dir)))


@register("price_range_by_dept", with_panel("""
SELECT dept_id, min(sell_price) AS min_price, round(avg(sell_price), 6) AS mean_price, max(sell_price) AS max_price
FROM prices_h GROUP BY dept_id""", extra_ctes=PRICES_CTE))
def q_price_range(spark, sf_dir):
    """A11 + J6: weekly price min / mean / max per department."""
    return rounded(ex.price_range_by_dept(_prices_h(spark, sf_dir)), keep=("min_price", "max_price"))


def _hist_sql(src: str, col: str, bins: int, by: str | None) -> str:
    """Equal-width histogram: same bin formula as ``explore.histogram``."""
    inner_by = f"s.{by} AS {by}, " if by else ""
    outer_by = f"{by}, " if by else ""
    bounds = (f"SELECT {by}, min({col}) AS lo, max({col}) AS hi FROM {src} WHERE {col} IS NOT NULL GROUP BY {by}"
              if by else f"SELECT min({col}) AS lo, max({col}) AS hi FROM {src} WHERE {col} IS NOT NULL")
    on = f"b.{by} = s.{by}" if by else "TRUE"
    return f"""
SELECT {outer_by}bin, count(*) AS n, round(min(lo + bin * (hi - lo) / {bins}), 6) AS bin_start FROM (
  SELECT {inner_by}b.lo, b.hi,
         CAST(least(coalesce(floor((s.{col} - b.lo) * {bins} / NULLIF(b.hi - b.lo, 0)), 0), {bins - 1}) AS INTEGER) AS bin
  FROM {src} s JOIN ({bounds}) b ON {on}
  WHERE s.{col} IS NOT NULL
) GROUP BY {outer_by}bin"""


@register("price_histogram_by_category", with_panel(_hist_sql("prices_h", "sell_price", 60, "cat_id"),
                                                    extra_ctes=PRICES_CTE))
def q_price_hist(spark, sf_dir):
    """60-bin histogram of weekly prices per category."""
    return rounded(ex.histogram(_prices_h(spark, sf_dir), "sell_price", 60, "cat_id"))


@register("log_sales_histogram", with_panel(_hist_sql("nz", "v", 60, None),
                                            extra_ctes="nz AS (SELECT ln(1 + sales) AS v FROM panel WHERE sales > 0)"))
def q_log_hist(spark, sf_dir):
    """60-bin histogram of log1p(sales) over non-zero days."""
    p = _panel(spark, sf_dir).filter(F.col("sales") > 0).select(F.log(1 + F.col("sales")).alias("v"))
    return rounded(ex.histogram(p, "v", 60))


@register("zero_rate_histogram", with_panel(_hist_sql("zr", "zero_rate", 50, None),
                                            extra_ctes="zr AS (SELECT id, avg(CAST(sales = 0 AS DOUBLE)) AS zero_rate FROM panel GROUP BY id)"))
def q_zero_hist(spark, sf_dir):
    """50-bin histogram of per-series zero rates."""
    return rounded(ex.histogram(ex.series_zero_rates(_panel(spark, sf_dir)), "zero_rate", 50))


@register("price_sales_correlation", with_panel("""
SELECT cat_id, round(corr(price_change, sales_change), 6) AS elasticity_proxy, count(*) AS n_pairs FROM (
  SELECT cat_id,
         (sell_price - lag(sell_price, 7) OVER w) / NULLIF(lag(sell_price, 7) OVER w, 0) AS price_change,
         (CAST(sales AS DOUBLE) - lag(sales, 7) OVER w) / NULLIF(CAST(lag(sales, 7) OVER w AS DOUBLE), 0) AS sales_change
  FROM panel WINDOW w AS (PARTITION BY id ORDER BY date)
) WHERE price_change IS NOT NULL AND sales_change IS NOT NULL GROUP BY cat_id"""))
def q_price_corr(spark, sf_dir):
    """W7 + P12 + A20: correlation of 7-day price and sales changes per category."""
    return rounded(ex.price_sales_correlation(_panel(spark, sf_dir)))


# ---- benefit days: A13, A14, J8 ------------------------------------------------------------

@register("benefit_lift_by_state_category", with_panel("""
SELECT state_id, cat_id, round(mean_benefit, 6) AS mean_benefit, round(mean_other, 6) AS mean_other,
       round((mean_benefit / NULLIF(mean_other, 0) - 1) * 100, 6) AS lift_pct FROM (
  SELECT state_id, cat_id,
         avg(CASE WHEN flag = 1 THEN sales END) AS mean_benefit, avg(CASE WHEN flag = 0 THEN sales END) AS mean_other
  FROM (SELECT *, CASE state_id WHEN 'CA' THEN snap_CA WHEN 'TX' THEN snap_TX WHEN 'WI' THEN snap_WI ELSE 0 END AS flag FROM panel)
  GROUP BY state_id, cat_id
) WHERE mean_benefit IS NOT NULL AND mean_other IS NOT NULL"""))
def q_benefit_state(spark, sf_dir):
    """A13 + J8: own-state benefit-day lift per (state, category)."""
    return rounded(ex.benefit_lift_own_state(_panel(spark, sf_dir)))


@register("benefit_uplift_by_category", with_panel("""
SELECT cat_id AS Category,
       greatest(0.0, round_even(CASE WHEN no_snap_mean > 0 THEN (snap_mean - no_snap_mean) / no_snap_mean * 100 ELSE 0.0 END, 1)) AS Avg_Uplift_pct
FROM (SELECT cat_id, avg(CASE WHEN greatest(snap_CA, snap_TX, snap_WI) = 1 THEN sales END) AS snap_mean,
             avg(CASE WHEN greatest(snap_CA, snap_TX, snap_WI) = 1 THEN NULL ELSE sales END) AS no_snap_mean
      FROM panel GROUP BY cat_id)"""))
def q_benefit_any(spark, sf_dir):
    """A14 + F10 + P9: dashboard benefit-day uplift per category (any-state flag)."""
    return ex.benefit_uplift_any_state(_panel(spark, sf_dir))


# ---- A15, A16, A17 ------------------------------------------------------------------------------

@register("weekday_pattern", with_panel("""
SELECT CAST(isodow(date) - 1 AS INTEGER) AS dow, strftime(date, '%a') AS Day, round(avg(sales), 6) AS Avg_Sales,
       CAST(sum(sales) AS BIGINT) AS total, count(*) AS n
FROM panel GROUP BY ALL"""))
def q_weekday_pattern(spark, sf_dir):
    """Weekday pattern labelled from the date (trap D8)."""
    return rounded(ex.weekday_pattern(_panel(spark, sf_dir)))


@register("store_ranking", with_panel("""
SELECT store_id, round(avg(sales), 6) AS Avg_Sales, round(stddev_samp(sales), 6) AS Volatility,
       CAST(sum(sales) AS BIGINT) AS total
FROM panel GROUP BY store_id ORDER BY avg(sales) DESC, store_id LIMIT 5"""))
def q_store_ranking(spark, sf_dir):
    """Top 5 stores by mean daily sales."""
    return rounded(ex.store_ranking(_panel(spark, sf_dir)))


@register("store_day_panel", with_panel("""
SELECT date, store_id, CAST(sum(sales) AS BIGINT) AS total_sales, round(avg(sales), 6) AS avg_sales,
       round(stddev_samp(sales), 6) AS std_sales, count(*) AS n_items
FROM panel GROUP BY date, store_id"""))
def q_store_day(spark, sf_dir):
    """Store-day totals, means, std and counts."""
    return rounded(fcst.store_day_panel(_panel(spark, sf_dir)))


@register("display_band", with_panel("""
SELECT store_id, date, actual, predicted,
       round_even(greatest(predicted - 1.28 * sd, 0.0), 0) AS lower_bound,
       round_even(predicted + 1.28 * sd, 0) AS upper_bound
FROM (
  SELECT store_id, date, total_sales AS actual,
         round_even(sum(pow(0.75, -j) * total_sales) OVER w / sum(pow(0.75, -j)) OVER w, 0) AS predicted,
         avg(std_sales) OVER (PARTITION BY store_id) AS sd
  FROM (
    SELECT *, 28 - row_number() OVER (PARTITION BY store_id ORDER BY date DESC) AS j FROM (
      SELECT date, store_id, CAST(sum(sales) AS BIGINT) AS total_sales, stddev_samp(sales) AS std_sales
      FROM panel GROUP BY date, store_id)
  ) WHERE j >= 0
  WINDOW w AS (PARTITION BY store_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""))
def q_display_band(spark, sf_dir):
    """M10 + W9 + W10 + W11: last 28 days per store, smoothed, with a band."""
    return fcst.display_band(_panel(spark, sf_dir))


@register("display_band_coverage", with_panel("""
SELECT store_id, round(avg(CASE WHEN actual >= lower_bound AND actual <= upper_bound THEN 1.0 ELSE 0.0 END), 6) AS "Coverage_80%"
FROM (
  SELECT store_id, total_sales AS actual,
         round_even(greatest(p - 1.28 * sd, 0.0), 0) AS lower_bound, round_even(p + 1.28 * sd, 0) AS upper_bound
  FROM (
    SELECT store_id, total_sales,
           round_even(sum(pow(0.75, -j) * total_sales) OVER w / sum(pow(0.75, -j)) OVER w, 0) AS p,
           avg(std_sales) OVER (PARTITION BY store_id) AS sd
    FROM (
      SELECT *, 28 - row_number() OVER (PARTITION BY store_id ORDER BY date DESC) AS j FROM (
        SELECT date, store_id, CAST(sum(sales) AS BIGINT) AS total_sales, stddev_samp(sales) AS std_sales
        FROM panel GROUP BY date, store_id)
    ) WHERE j >= 0
    WINDOW w AS (PARTITION BY store_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  )
) GROUP BY store_id"""))
def q_band_coverage(spark, sf_dir):
    """E4 on the display band: share of actual days inside [lower, upper] per store."""
    from shelfcast.operators.metrics import coverage
    band = fcst.display_band(_panel(spark, sf_dir))
    return rounded(coverage(band, "store_id", "actual", "lower_bound", "upper_bound"))


@register("naive_mean_by_horizon", with_panel(
    "SELECT s.store_id, f.h, round(avg(f.yhat), 6) AS mean_yhat FROM fc f "
    "JOIN (SELECT DISTINCT id, store_id FROM panel) s USING (id) GROUP BY s.store_id, f.h",
    extra_ctes=NAIVE_CTES))
def q_naive_mean_h(spark, sf_dir):
    """Mean naive forecast per horizon step per store."""
    panel, fc, _, _, _, _ = naive_scored(spark, sf_dir)
    return rounded(fcst.mean_forecast_by_horizon(fc, panel))


# ---- T2, W12, A21, T7, A23 -----------------------------------------------------------------------

@register("top_series", with_panel(
    "SELECT id, CAST(sum(sales) AS BIGINT) AS total FROM panel GROUP BY id ORDER BY total DESC, id LIMIT 1"))
def q_top_series(spark, sf_dir):
    """Highest-volume series."""
    return ex.top_series(_panel(spark, sf_dir))


def _lag_corr_sql() -> str:
    lags = ex.CORR_LAGS
    names = ["sales"] + [f"lag_{k}" for k in lags]
    lag_cols = ", ".join(f"lag(sales, {k}) OVER (ORDER BY date) AS lag_{k}" for k in lags)
    nn = " AND ".join(f"lag_{k} IS NOT NULL" for k in lags)
    union = "\nUNION ALL\n".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM m"
                                 for a in names for b in names)
    ctes = f"""top AS (SELECT id FROM panel GROUP BY id ORDER BY sum(sales) DESC, id LIMIT 1),
m AS (SELECT * FROM (
  SELECT CAST(sales AS DOUBLE) AS sales, {lag_cols} FROM panel WHERE id = (SELECT id FROM top)
) WHERE {nn})"""
    return with_panel(union, extra_ctes=ctes)


@register("lag_correlation_matrix", _lag_corr_sql())
def q_lag_corr(spark, sf_dir):
    """A21 + W12: correlation matrix of sales and lags 1..56 for the top series."""
    return rounded(ex.lag_correlation(_panel(spark, sf_dir)))


@register("sample_composition", with_panel("""
SELECT cat_id, store_id, count(*) AS count FROM (
  SELECT DISTINCT id, item_id, dept_id, cat_id, store_id, state_id FROM panel
  ORDER BY md5(id || '42'), id LIMIT 12
) GROUP BY cat_id, store_id"""))
def q_sample_comp(spark, sf_dir):
    """T7 + A23: reproducible sample of 12 series, category x store counts."""
    return ex.sample_composition(ex.sample_series(_panel(spark, sf_dir), 12, 42))
