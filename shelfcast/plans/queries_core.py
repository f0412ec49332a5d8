"""Registered queries: panel, feature matrix, seasonal naive forecast and its metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators import features as feat
from shelfcast.operators import forecast as fcst
from shelfcast.operators import metrics as met
from shelfcast.plans.catalog import register, rounded
from shelfcast.plans.oracle_sql import with_panel
from shelfcast.plans.panel import build_panel, date_bounds, preprocess, raw_tables
from shelfcast.schemas import PANEL_COLUMNS
from shelfcast.sources.sinks import materialize

H = fcst.HORIZON


def panel_of(spark: SparkSession, sf_dir: str, level: str = "region") -> DataFrame:
    """The dense panel, materialised once (it feeds several aggregates and windows)."""
    return materialize(build_panel(spark, sf_dir, level))


def cutoffs(spark: SparkSession, sf_dir: str, panel: DataFrame | None = None) -> dict:
    """train_end / val_end / last_day as lazy scalar Columns (last day of the line items,
    which is also that of a dense ``panel`` made from them)."""
    hi = date_bounds(spark, sf_dir)[1] if panel is None else panel.agg(F.max("date")).scalar()
    return fcst.split_dates(hi, H)


# ---- SQL fragments shared by the oracles ------------------------------------------------
CUT_CTE = f"cut AS (SELECT hi - {2 * H} AS train_end, hi - {H} AS val_end, hi AS last_day FROM bounds)"

NAIVE_CTES = f"""
{CUT_CTE},
last7 AS (
  SELECT p.id, p.date, p.sales, datediff('day', c.val_end, p.date) + 6 AS phase
  FROM panel p, cut c WHERE p.date > c.val_end - 7 AND p.date <= c.val_end
),
full7 AS (SELECT id FROM last7 GROUP BY id HAVING count(*) = 7),
fc AS (
  SELECT l.id, CAST(s.h AS INTEGER) AS h, CAST(c.val_end + CAST(s.h AS INTEGER) AS DATE) AS date,
         greatest(CAST(l.sales AS DOUBLE), 0.0) AS yhat
  FROM last7 l JOIN full7 USING (id), cut c, generate_series(1, {H}) AS s(h)
  WHERE (s.h - 1) % 7 = l.phase
),
scored AS (
  SELECT f.id, f.h, f.date, f.yhat, CAST(p.sales AS DOUBLE) AS actual, p.store_id, p.cat_id, p.dept_id
  FROM fc f JOIN panel p ON p.id = f.id AND p.date = f.date
),
hist AS (SELECT p.* FROM panel p, cut c WHERE p.date <= c.val_end),
hist_err AS (
  SELECT id, store_id, cat_id,
         abs(sales - lag(sales, 7) OVER (PARTITION BY id ORDER BY date)) AS e
  FROM hist
)"""


# ---- panel ------------------------------------------------------------------------------------

PANEL_SQL = with_panel("SELECT " + ", ".join(PANEL_COLUMNS) + " FROM panel")


@register("panel", PANEL_SQL)
def q_panel(spark, sf_dir):
    """S1-S3/P1/J1/J2/W4/D1 via the fast path: dense item x store x day panel."""
    return rounded(build_panel(spark, sf_dir, "region"))


@register("panel_from_raw", PANEL_SQL)
def q_panel_from_raw(spark, sf_dir):
    """The same panel through the retail-file path: long sales + calendar join on d
    + 3-key price join (J2) + stockout window (W4)."""
    sales, calendar, prices = raw_tables(spark, sf_dir, "region")
    return rounded(preprocess(sales, calendar, prices))


@register("stockout_count", with_panel(
    "SELECT store_id, CAST(sum(CAST(is_stockout AS INTEGER)) AS BIGINT) AS stockout_days, "
    "count(*) AS n_rows FROM panel GROUP BY store_id"))
def q_stockouts(spark, sf_dir):
    """Stockout days per store."""
    p = build_panel(spark, sf_dir, "region")
    return p.groupBy("store_id").agg(F.sum(F.col("is_stockout").cast("int")).cast("long").alias("stockout_days"),
                                     F.count("*").alias("n_rows"))


# ---- feature matrix ---------------------------------------------------------------------------

def _feature_sql() -> str:
    lags = ", ".join(f"lag(sales, {k}) OVER w AS sales_lag_{k}" for k in feat.LAG_DAYS)
    rolls = []
    for k in feat.ROLLING_WINDOWS:
        frame = f"(PARTITION BY id ORDER BY date ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
        rolls.append(f"avg(sales) OVER {frame} AS sales_roll_mean_{k}")
        rolls.append(f"coalesce(stddev_samp(sales) OVER {frame}, 0.0) AS sales_roll_std_{k}")
    base_cols = [c for c in PANEL_COLUMNS if c not in ("month", "year")]
    enc_join = ""
    ctes = f"""
{CUT_CTE},
enc_src AS (SELECT p.* FROM panel p, cut c WHERE p.date <= c.train_end),
e1 AS (SELECT item_id, store_id, avg(sales) AS item_store_enc FROM enc_src GROUP BY item_id, store_id),
e2 AS (SELECT dept_id, store_id, avg(sales) AS dept_store_enc FROM enc_src GROUP BY dept_id, store_id),
e3 AS (SELECT cat_id, store_id, avg(sales) AS cat_store_enc FROM enc_src GROUP BY cat_id, store_id),
dm AS (SELECT store_id, dept_id, date, avg(sell_price) AS dept_mean FROM panel GROUP BY store_id, dept_id, date),
win AS (
  SELECT p.*, {lags}, {", ".join(rolls)}, lag(sell_price, 7) OVER w AS prev_price
  FROM panel p
  WINDOW w AS (PARTITION BY id ORDER BY date)
)"""
    dow = "CAST(isodow(x.date) - 1 AS INTEGER)"
    mon = "CAST(month(x.date) AS INTEGER)"
    feats = [
        f"{dow} AS day_of_week", "CAST(day(x.date) AS INTEGER) AS day_of_month",
        f"{mon} AS month", "CAST(year(x.date) AS INTEGER) AS year",
        f"CAST({dow} >= 5 AS INTEGER) AS is_weekend",
        "CAST(day(x.date) = 1 AS INTEGER) AS is_month_start",
        "CAST(x.date = last_day(x.date) AS INTEGER) AS is_month_end",
        f"round(sin(2 * pi() * {dow} / 7), 6) AS dow_sin", f"round(cos(2 * pi() * {dow} / 7), 6) AS dow_cos",
        f"round(sin(2 * pi() * {mon} / 12), 6) AS month_sin", f"round(cos(2 * pi() * {mon} / 12), 6) AS month_cos",
        "CAST(x.event_name_1 IS NOT NULL AS INTEGER) AS has_event",
        "CAST(x.event_name_2 IS NOT NULL AS INTEGER) AS has_two_events",
    ]
    for slot in (1, 2):
        feats.append(f"CASE x.event_type_{slot} WHEN 'National' THEN 1 WHEN 'Sporting' THEN 2 "
                     f"WHEN 'Religious' THEN 3 WHEN 'Cultural' THEN 4 ELSE 0 END AS event_type_{slot}_enc")
    feats += [
        "CASE x.state_id WHEN 'CA' THEN x.snap_CA WHEN 'TX' THEN x.snap_TX WHEN 'WI' THEN x.snap_WI ELSE 0 END AS is_snap_day",
        "round(ln(1 + coalesce(x.sell_price, 0.0)), 6) AS log_price",
        "round((x.sell_price - x.prev_price) / (x.prev_price + 1e-6), 6) AS price_momentum",
        "round(x.sell_price / (dm.dept_mean + 1e-6), 6) AS price_vs_dept_mean",
        "round(e1.item_store_enc, 6) AS item_store_enc", "round(e2.dept_store_enc, 6) AS dept_store_enc",
        "round(e3.cat_store_enc, 6) AS cat_store_enc",
    ]
    cols = [f"x.{c}" for c in base_cols]
    cols += [f"x.sales_lag_{k}" for k in feat.LAG_DAYS]
    for k in feat.ROLLING_WINDOWS:
        cols += [f"round(x.sales_roll_mean_{k}, 6) AS sales_roll_mean_{k}",
                 f"round(x.sales_roll_std_{k}, 6) AS sales_roll_std_{k}"]
    body = f"""SELECT {", ".join(cols + feats)}
FROM win x
LEFT JOIN dm ON dm.store_id = x.store_id AND dm.dept_id = x.dept_id AND dm.date = x.date
LEFT JOIN e1 ON e1.item_id = x.item_id AND e1.store_id = x.store_id
LEFT JOIN e2 ON e2.dept_id = x.dept_id AND e2.store_id = x.store_id
LEFT JOIN e3 ON e3.cat_id = x.cat_id AND e3.store_id = x.store_id
WHERE x.sales_lag_{max(feat.LAG_DAYS)} IS NOT NULL{enc_join}"""
    return with_panel(body, extra_ctes=ctes)


@register("features", _feature_sql())
def q_features(spark, sf_dir):
    """The 54-column feature matrix (encodings on the
    training span only, trap D3)."""
    panel = panel_of(spark, sf_dir)
    lo, _ = date_bounds(spark, sf_dir)
    df = feat.build_features(panel, until=cutoffs(spark, sf_dir, panel)["train_end"],
                             min_date=feat.burn_in_start(lo))
    return rounded(df)


# ---- seasonal naive + metrics ----------------------------------------------------------------

def naive_scored(spark, sf_dir, season: int = 7, level: str = "region"):
    panel = panel_of(spark, sf_dir, level)
    cut = cutoffs(spark, sf_dir, panel)
    fc, failed = fcst.seasonal_naive(panel, cut["val_end"], H, season)
    history = panel.filter(F.col("date") <= cut["val_end"])
    return panel, fc, failed, fcst.scored_frame(fc, panel, cut["val_end"], H), history, cut


@register("naive_forecast", with_panel(
    "SELECT id, h, date, round(yhat, 6) AS yhat FROM fc", extra_ctes=NAIVE_CTES))
def q_naive(spark, sf_dir):
    """M1: 28-day seasonal naive forecast of the last 28 days, every series."""
    _, fc, _, _, _, _ = naive_scored(spark, sf_dir)
    return rounded(fc)


@register("naive_forecast_wide", with_panel(
    "SELECT id, " + ", ".join(f"round(max(CASE WHEN h = {h} THEN yhat END), 6) AS F{h}" for h in range(1, H + 1))
    + " FROM fc GROUP BY id", extra_ctes=NAIVE_CTES))
def q_naive_wide(spark, sf_dir):
    """The naive forecast as one row per series with F1..F28."""
    _, fc, _, _, _, _ = naive_scored(spark, sf_dir)
    return rounded(fcst.forecast_wide(fc, H))


WRMSSE_CTES = f"""
tail AS (
  SELECT h.id, h.sales, datediff('day', c.val_end - {2 * H - 1}, h.date) AS pos
  FROM hist h, cut c WHERE h.date >= c.val_end - {2 * H - 1}
),
pairs AS (
  SELECT id, pos % {H} AS off,
         sum(CASE WHEN pos >= {H} THEN sales ELSE -sales END) AS block_diff,
         sum(CASE WHEN pos >= {H} THEN sales ELSE 0 END) AS last_units
  FROM tail GROUP BY id, pos % {H}
),
scale AS (
  SELECT id, avg(block_diff * block_diff) + 1e-8 AS scale, CAST(sum(last_units) AS DOUBLE) AS last_units
  FROM pairs GROUP BY id
),
per_series AS (
  SELECT s.id, s.store_id, sc.last_units,
         sqrt(avg((s.actual - s.yhat) * (s.actual - s.yhat)) / sc.scale) AS rmsse
  FROM scored s JOIN scale sc USING (id) GROUP BY s.id, s.store_id, sc.last_units, sc.scale
)"""

SCORECARD_BODY = """
SELECT e.store_id, e.n_series, round(e.MAE, 6) AS MAE, round(e.MAE / (s.naive_mae + 1e-8), 6) AS MASE,
       round(w.WRMSSE, 6) AS WRMSSE
FROM (SELECT store_id, count(DISTINCT id) AS n_series, avg(abs(actual - yhat)) AS MAE FROM scored GROUP BY store_id) e
JOIN (SELECT store_id, avg(e) AS naive_mae FROM hist_err WHERE e IS NOT NULL GROUP BY store_id) s USING (store_id)
JOIN (SELECT store_id, sum(last_units * rmsse) / (sum(last_units) + 1e-8) AS WRMSSE
      FROM per_series GROUP BY store_id) w USING (store_id)"""
SCORECARD_SQL = with_panel(SCORECARD_BODY, extra_ctes=NAIVE_CTES + ",\n" + WRMSSE_CTES)
SCORECARD_NATION_SQL = with_panel(SCORECARD_BODY, level="nation", extra_ctes=NAIVE_CTES + ",\n" + WRMSSE_CTES)


def scorecard(spark: SparkSession, sf_dir: str, level: str = "region") -> DataFrame:
    """Flagship: panel -> lags/rolling (W1, W2 inside the scale) -> seasonal naive (M1) ->
    MAE (E1), MASE (E2) and WRMSSE (E3) per store."""
    panel, fc, _, scored, history, cut = naive_scored(spark, sf_dir, level=level)
    err = scored.groupBy("store_id").agg(F.countDistinct("id").alias("n_series"))
    m = met.mase(scored, history.select("id", "date", "sales", "store_id"), "store_id")
    w = met.wrmsse(scored, history, cut["val_end"], H, by="store_id")
    return rounded(err.join(m, "store_id").join(w, "store_id")
                      .select("store_id", "n_series", "MAE", "MASE", "WRMSSE"))


register("naive_scorecard_by_store", SCORECARD_SQL)(scorecard)


@register("naive_scorecard_by_nation", SCORECARD_NATION_SQL)
def q_scorecard_nation(spark, sf_dir):
    """The flagship on the nation-level panel (25 stores, the benchmark's shape)."""
    return scorecard(spark, sf_dir, level="nation")


@register("naive_mase_by_category", with_panel("""
SELECT e.cat_id, round(e.MAE, 6) AS MAE, round(e.MAE / (s.naive_mae + 1e-8), 6) AS MASE
FROM (SELECT cat_id, avg(abs(actual - yhat)) AS MAE FROM scored GROUP BY cat_id) e
JOIN (SELECT cat_id, avg(e) AS naive_mae FROM hist_err WHERE e IS NOT NULL GROUP BY cat_id) s USING (cat_id)""",
    extra_ctes=NAIVE_CTES))
def q_naive_by_cat(spark, sf_dir):
    """E2 by category (pooled; within-series differences, trap D4)."""
    _, _, _, scored, history, _ = naive_scored(spark, sf_dir)
    return rounded(met.mase(scored, history, "cat_id"))


@register("naive_per_series_mean", with_panel("""
SELECT round(avg(MAE), 6) AS mean_MAE, round(avg(MAE / (naive_mae + 1e-8)), 6) AS mean_MASE, count(*) AS n_series
FROM (SELECT id, avg(abs(actual - yhat)) AS MAE FROM scored GROUP BY id) e
JOIN (SELECT id, avg(e) AS naive_mae FROM hist_err WHERE e IS NOT NULL GROUP BY id) s USING (id)""",
    extra_ctes=NAIVE_CTES))
def q_naive_per_series(spark, sf_dir):
    """Per-series MAE and MASE, then their mean."""
    _, _, _, scored, history, _ = naive_scored(spark, sf_dir)
    return rounded(met.mean_of_series_metrics(scored, history))


@register("naive_wrmsse", with_panel(
    "SELECT round(sum(last_units * rmsse) / (sum(last_units) + 1e-8), 6) AS WRMSSE FROM per_series",
    extra_ctes=NAIVE_CTES + ",\n" + WRMSSE_CTES))
def q_naive_wrmsse(spark, sf_dir):
    """E3 over all series."""
    _, _, _, scored, history, cut = naive_scored(spark, sf_dir)
    return rounded(met.wrmsse(scored, history, cut["val_end"], H))


@register("naive_pinball_median", with_panel(
    "SELECT store_id, round(avg(greatest(0.5 * (actual - yhat), -0.5 * (actual - yhat))), 6) AS pinball_yhat "
    "FROM scored GROUP BY store_id", extra_ctes=NAIVE_CTES))
def q_pinball(spark, sf_dir):
    """Pinball loss of the naive forecast read as a median (q = 0.5) per store."""
    _, _, _, scored, _, _ = naive_scored(spark, sf_dir)
    return rounded(met.pinball_loss(scored, 0.5, "yhat", "store_id"))


@register("naive_leaderboard", with_panel(f"""
SELECT CAST(row_number() OVER (ORDER BY MAE, model) AS INTEGER) AS Rank, model, round_even(MAE, 4) AS MAE,
       round_even(MASE, 4) AS MASE
FROM (
  SELECT 'seasonal_naive_7' AS model, e.MAE, e.MAE / (s.naive_mae + 1e-8) AS MASE
  FROM (SELECT avg(abs(actual - yhat)) AS MAE FROM scored) e, (SELECT avg(e) AS naive_mae FROM hist_err WHERE e IS NOT NULL) s
  UNION ALL
  SELECT 'naive_last_value' AS model, e.MAE, e.MAE / (s.naive_mae + 1e-8) AS MASE
  FROM (SELECT avg(abs(actual - yhat)) AS MAE FROM scored1) e, (SELECT avg(e) AS naive_mae FROM hist_err WHERE e IS NOT NULL) s
)""", extra_ctes=NAIVE_CTES + f""",
fc1 AS (SELECT p.id, CAST(p.sales AS DOUBLE) AS yhat FROM panel p, cut c WHERE p.date = c.val_end),
scored1 AS (
  SELECT p.id, greatest(f.yhat, 0.0) AS yhat, CAST(p.sales AS DOUBLE) AS actual
  FROM fc1 f JOIN panel p ON p.id = f.id, cut c WHERE p.date > c.val_end AND p.date <= c.val_end + {H}
)"""))
def q_leaderboard(spark, sf_dir):
    """E5 + E7 + T5: reports of two naive variants (season 7 and 1) ranked by MAE."""
    panel, _, _, scored7, history, cut = naive_scored(spark, sf_dir)
    fc1, _ = fcst.seasonal_naive(panel, cut["val_end"], H, 1)
    scored1 = fcst.scored_frame(fc1, panel, cut["val_end"], H)
    reports = [met.evaluate(scored7, history, "seasonal_naive_7"),
               met.evaluate(scored1, history, "naive_last_value")]
    board = met.leaderboard(reports)
    return board.withColumn("Rank", F.col("Rank").cast("int"))


@register("naive_best_model", with_panel(f"""
SELECT arg_min(model, MASE) AS best_model, min(MASE) AS best_MASE, (1.0 - min(MASE)) * 100 AS pct_below_naive
FROM (
  SELECT 'seasonal_naive_7' AS model, round_even(e.MAE / (s.naive_mae + 1e-8), 4) AS MASE
  FROM (SELECT avg(abs(actual - yhat)) AS MAE FROM scored) e, (SELECT avg(e) AS naive_mae FROM hist_err WHERE e IS NOT NULL) s
  UNION ALL
  SELECT 'naive_last_value', round_even(e.MAE / (s.naive_mae + 1e-8), 4)
  FROM (SELECT avg(abs(actual - yhat)) AS MAE FROM scored1) e, (SELECT avg(e) AS naive_mae FROM hist_err WHERE e IS NOT NULL) s
)""", extra_ctes=NAIVE_CTES + f""",
fc1 AS (SELECT p.id, CAST(p.sales AS DOUBLE) AS yhat FROM panel p, cut c WHERE p.date = c.val_end),
scored1 AS (
  SELECT p.id, greatest(f.yhat, 0.0) AS yhat, CAST(p.sales AS DOUBLE) AS actual
  FROM fc1 f JOIN panel p ON p.id = f.id, cut c WHERE p.date > c.val_end AND p.date <= c.val_end + {H}
)"""))
def q_best(spark, sf_dir):
    """Best model of the leaderboard by MASE."""
    return met.best_model(q_leaderboard(spark, sf_dir))


@register("naive_failed_series", with_panel(
    "SELECT id, CAST(count(*) FILTER (WHERE date > c.val_end - 7) AS INTEGER) AS n_days FROM panel, cut c "
    "WHERE sales > 0 AND date <= c.val_end GROUP BY id HAVING count(*) FILTER (WHERE date > c.val_end - 7) < 7",
    extra_ctes=CUT_CTE))
def q_naive_failed(spark, sf_dir):
    """M1 failure list on sparse data (days with a sale): series that lack a day of the
    last season, ended ones included."""
    panel = build_panel(spark, sf_dir, "region").filter("sales > 0")
    _, failed = fcst.seasonal_naive(panel, cutoffs(spark, sf_dir)["val_end"], H)
    return failed.select("id", F.col("n_days").cast("int").alias("n_days"))


# ---- splits, filters, indices (P3, P4, P8-P11), encodings (A19), best model (T6) ----------

@register("day_split_counts", with_panel("""
SELECT CASE WHEN CAST(substr(d, 3) AS INTEGER) <= m.n - 28 THEN 'train' ELSE 'test' END AS part,
       count(*) AS n_rows, count(DISTINCT d) AS n_days
FROM panel, (SELECT max(CAST(substr(d, 3) AS INTEGER)) AS n FROM panel) m GROUP BY 1"""))
def q_day_split(spark, sf_dir):
    """Split at the day label 28 days before the end of the span, test = next 28 days."""
    panel = build_panel(spark, sf_dir, "region")
    lo, hi = date_bounds(spark, sf_dir)
    # both spans are cut by the calendar, so the test span has its H days whenever the whole has more
    train, test = fcst.split_by_day(panel, F.datediff(hi, lo) + 1 - H, H)
    return (train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
                 .groupBy("part").agg(F.count("*").alias("n_rows"), F.countDistinct("d").alias("n_days")))


@register("split_counts", with_panel(f"""
SELECT CASE WHEN date <= c.train_end THEN 'train' WHEN date <= c.val_end THEN 'val' ELSE 'test' END AS split,
       count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date
FROM panel, cut c GROUP BY 1""", extra_ctes=CUT_CTE))
def q_split_counts(spark, sf_dir):
    """Three-way date split of the panel."""
    cut = cutoffs(spark, sf_dir)
    df = fcst.assign_split(build_panel(spark, sf_dir, "region"), cut["train_end"], cut["val_end"])
    return df.groupBy("split").agg(F.count("*").alias("n_rows"), F.min("date").alias("first_date"),
                                   F.max("date").alias("last_date"))


@register("benefit_uplift_filtered", with_panel("""
SELECT cat_id AS Category,
       greatest(0.0, round_even(CASE WHEN no_snap_mean > 0 THEN (snap_mean - no_snap_mean) / no_snap_mean * 100 ELSE 0.0 END, 1)) AS Avg_Uplift_pct
FROM (SELECT cat_id, avg(CASE WHEN greatest(snap_CA, snap_TX, snap_WI) = 1 THEN sales END) AS snap_mean,
             avg(CASE WHEN greatest(snap_CA, snap_TX, snap_WI) = 1 THEN NULL ELSE sales END) AS no_snap_mean
      FROM panel WHERE coalesce(contains(id, 'evaluation'), false) AND store_id = 'AMERICA'
                   AND coalesce(contains(cat_id, 'SIZE'), false)
      GROUP BY cat_id)"""))
def q_uplift_filtered(spark, sf_dir):
    """P8 + P9: the dashboard uplift with an id substring test, a store pick and a category
    substring pick."""
    from shelfcast.operators import explore as ex
    panel = ex.filter_panel(build_panel(spark, sf_dir, "region"), id_contains="evaluation")
    return ex.benefit_uplift_any_state(panel, store="AMERICA", category="SIZE")


@register("time_index", with_panel(
    "SELECT id, date, CAST(datediff('day', (SELECT min(date) FROM panel), date) AS INTEGER) AS time_idx FROM panel"))
def q_time_index(spark, sf_dir):
    """P10: integer day index from the first date of the whole panel."""
    from shelfcast.operators.sequences import time_index
    return time_index(build_panel(spark, sf_dir, "region").select("id", "date"))


@register("sarima_input", with_panel(
    "SELECT id, date, CASE WHEN sales = 0 THEN 0.1 ELSE CAST(sales AS DOUBLE) END AS y FROM panel"))
def q_sarima_input(spark, sf_dir):
    """Series values as fitted (zeros floored at 0.1)."""
    from shelfcast.functions.numeric import floor_zeros
    return build_panel(spark, sf_dir, "region").select("id", "date", floor_zeros("sales").alias("y"))


@register("encoding_stats", with_panel("""
SELECT 'item_store_enc' AS level, item_id AS k1, store_id AS k2, round(avg(sales), 6) AS value FROM enc_src GROUP BY item_id, store_id
UNION ALL SELECT 'dept_store_enc', dept_id, store_id, round(avg(sales), 6) FROM enc_src GROUP BY dept_id, store_id
UNION ALL SELECT 'cat_store_enc', cat_id, store_id, round(avg(sales), 6) FROM enc_src GROUP BY cat_id, store_id""",
    extra_ctes=CUT_CTE + ",\nenc_src AS (SELECT p.* FROM panel p, cut c WHERE p.date <= c.train_end)"))
def q_encoding_stats(spark, sf_dir):
    """The three target-encoding tables (training span), stacked."""
    stats = feat.target_encoding_stats(build_panel(spark, sf_dir, "region"), until=cutoffs(spark, sf_dir)["train_end"])
    parts = []
    for name, keys in feat.ENCODING_LEVELS.items():
        parts.append(stats[name].select(F.lit(name).alias("level"), F.col(keys[0]).alias("k1"),
                                        F.col(keys[1]).alias("k2"), F.col(name).alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return rounded(out)


@register("melt_roundtrip", with_panel(
    "SELECT id, item_id, dept_id, cat_id, store_id, state_id, d, sales FROM panel"))
def q_melt(spark, sf_dir):
    """P1 on a real wide table: the panel pivoted to one row per series with d_1..d_2499,
    then melted back to long with one unpivot."""
    from shelfcast.plans.panel import melt_wide, to_wide
    wide = materialize(to_wide(panel_of(spark, sf_dir)))
    return melt_wide(wide)
