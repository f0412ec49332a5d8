"""Registered round trips of sources and sinks (S1-S9): the table is written under the
shared checkpoint folder and read back, and the oracle is what it was written from."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.operators import explore as ex
from shelfcast.operators import features as feat
from shelfcast.operators import forecast as fcst
from shelfcast.plans.catalog import register, rounded
from shelfcast.plans.oracle_sql import with_panel
from shelfcast.plans.panel import date_bounds, preprocess, raw_tables, to_wide
from shelfcast.plans.queries_core import CUT_CTE, H, NAIVE_CTES, PANEL_SQL, _feature_sql, cutoffs, naive_scored, panel_of
from shelfcast.schemas import ID_COLUMNS
from shelfcast.sources import retail, sinks


@register("panel_from_csv", PANEL_SQL)
def q_panel_from_csv(spark, sf_dir):
    """S1-S3 + P1 + J1 + J2 + W4: wide sales, calendar and prices written as CSV files, the
    columns of all three out of order, read back by name and preprocessed."""
    where = sinks.scratch_path(spark, "retail")
    _, calendar, prices = raw_tables(spark, sf_dir)
    wide = to_wide(panel_of(spark, sf_dir))
    days = [c for c in wide.columns if c.startswith("d_")]
    retail.write_csv(wide.select(*days[::-1], *ID_COLUMNS[::-1]), f"{where}/sales")
    retail.write_csv(calendar.select(*calendar.columns[::-1], F.lit("x").alias("remark")), f"{where}/calendar")
    retail.write_csv(prices.select("sell_price", "item_id", "wm_yr_wk", "store_id"), f"{where}/prices")
    return rounded(preprocess(retail.read_sales_csv(spark, f"{where}/sales"), retail.read_calendar_csv(spark, f"{where}/calendar"),
                              retail.read_prices_csv(spark, f"{where}/prices")))


@register("panel_store_roundtrip", with_panel(
    "SELECT id, date, store_id, sales, sell_price, is_stockout FROM panel WHERE store_id IN ('ASIA', 'EUROPE')"))
def q_panel_store(spark, sf_dir):
    """S4 + S6 + S7: the panel written by store, two stores and six columns read back."""
    path = sinks.scratch_path(spark, "panel")
    sinks.write_panel(panel_of(spark, sf_dir), path)
    return rounded(sinks.read_features(spark, path, ["ASIA", "EUROPE"]).select("id", "date", "store_id", "sales", "sell_price", "is_stockout"))


@register("feature_store_resumed", with_panel("""
SELECT store_id, count(*) AS n_rows, CAST(sum(lag7) AS BIGINT) AS lag_7, CAST(sum(lag28) AS BIGINT) AS lag_28, true AS intact
FROM (SELECT id, store_id, lag(sales, 7) OVER w AS lag7, lag(sales, 28) OVER w AS lag28, lag(sales, 56) OVER w AS lag56
      FROM panel WINDOW w AS (PARTITION BY id ORDER BY date))
WHERE lag56 IS NOT NULL GROUP BY store_id"""))
def q_feature_store(spark, sf_dir):
    """S5 + S6: a feature table of one committed store and one whose write broke off (half its
    rows, no commit); the second run builds what is not committed, and the manifest is
    compared with the files."""
    path = sinks.scratch_path(spark, "features")
    features = feat.add_lag_features(panel_of(spark, sf_dir).select("id", "store_id", "date", "sales"))
    features = sinks.materialize(features.dropna(subset=["sales_lag_56"]))
    sinks.write_features_resumable(features, path, stores=["ASIA"])
    half = features.filter("store_id = 'EUROPE' AND dayofmonth(date) < 16")
    half.write.mode("append").partitionBy("store_id").parquet(path)
    sinks.write_features_resumable(features, path)
    back = sinks.read_features(spark, path)
    sums = back.groupBy("store_id").agg(F.count("*").alias("n_rows"), F.sum("sales_lag_7").alias("lag_7"), F.sum("sales_lag_28").alias("lag_28"))
    return sums.join(sinks.verify_features(spark, path).select("store_id", "intact"), "store_id")


@register("features_from_store", _feature_sql())
def q_features_from_store(spark, sf_dir):
    """S4 + S6: the panel stored by store and bucketed by series, the feature matrix built from
    it; the windows find each series in one bucket."""
    path = sinks.scratch_path(spark, "series")
    panel = panel_of(spark, sf_dir)
    sinks.write_series_table(panel, path)
    stored = sinks.read_series_table(spark, path)
    return rounded(feat.build_features(stored, until=cutoffs(spark, sf_dir, panel)["train_end"],
                                       min_date=feat.burn_in_start(date_bounds(spark, sf_dir)[0])))


@register("forecast_csv_roundtrip", with_panel(
    "SELECT id, " + ", ".join(f"round(max(CASE WHEN h = {h} THEN yhat END), 6) AS F{h}" for h in range(1, H + 1))
    + " FROM fc GROUP BY id", extra_ctes=NAIVE_CTES))
def q_forecast_csv(spark, sf_dir):
    """S8 + P2: the wide naive forecast as CSV, read back."""
    path = sinks.scratch_path(spark, "forecast")
    sinks.write_forecast_csv(fcst.forecast_wide(naive_scored(spark, sf_dir)[1], H), path)
    return rounded(sinks.read_forecast_csv(spark, path, H))


@register("encoding_tables_roundtrip", with_panel("""
SELECT 'item_store_enc' AS level, item_id AS k1, store_id AS k2, round(avg(sales), 6) AS value FROM enc_src GROUP BY item_id, store_id
UNION ALL SELECT 'dept_store_enc', dept_id, store_id, round(avg(sales), 6) FROM enc_src GROUP BY dept_id, store_id
UNION ALL SELECT 'cat_store_enc', cat_id, store_id, round(avg(sales), 6) FROM enc_src GROUP BY cat_id, store_id""",
    extra_ctes=CUT_CTE + ",\nenc_src AS (SELECT p.* FROM panel p, cut c WHERE p.date <= c.train_end)"))
def q_encoding_tables(spark, sf_dir):
    """The encoding tables saved, and loaded as at inference."""
    path = sinks.scratch_path(spark, "encodings")
    panel = panel_of(spark, sf_dir)
    sinks.save_encoding_stats(feat.target_encoding_stats(panel, until=cutoffs(spark, sf_dir, panel)["train_end"]), path)
    back = sinks.load_encoding_stats(spark, path)
    parts = [back[name].select(F.lit(name).alias("level"), F.col(keys[0]).alias("k1"), F.col(keys[1]).alias("k2"), F.col(name).alias("value"))
             for name, keys in feat.ENCODING_LEVELS.items()]
    return rounded(parts[0].union(parts[1]).union(parts[2]))


@register("benefit_uplift_by_text", with_panel("""
SELECT cat_id AS Category,
       greatest(0.0, round_even(CASE WHEN no_snap_mean > 0 THEN (snap_mean - no_snap_mean) / no_snap_mean * 100 ELSE 0.0 END, 1)) AS Avg_Uplift_pct
FROM (SELECT cat_id, avg(CASE WHEN greatest(snap_CA, snap_TX, snap_WI) = 1 THEN sales END) AS snap_mean,
             avg(CASE WHEN greatest(snap_CA, snap_TX, snap_WI) = 1 THEN NULL ELSE sales END) AS no_snap_mean
      FROM panel WHERE contains(id, 'O_A') GROUP BY cat_id)"""))
def q_uplift_by_text(spark, sf_dir):
    """P8 with a piece of text that only some ids hold."""
    return ex.benefit_uplift_any_state(ex.filter_panel(panel_of(spark, sf_dir), id_contains="O_A"))


@register("feature_column_list", "SELECT unnest([" + ", ".join(f"'{c}'" for c in (
    [f"sales_lag_{k}" for k in feat.LAG_DAYS] + [f"sales_roll_{s}_{k}" for k in feat.ROLLING_WINDOWS for s in ("mean", "std")]
    + ["day_of_week", "day_of_month", "month", "year", "wday", "is_weekend", "is_month_start", "is_month_end", "dow_sin", "dow_cos", "month_sin",
       "month_cos", "has_event", "has_two_events", "event_type_1_enc", "event_type_2_enc", "is_snap_day", "sell_price", "log_price",
       "price_momentum", "price_vs_dept_mean", "item_store_enc", "dept_store_enc", "cat_store_enc"])) + "]) AS feature")
def q_feature_columns(spark, sf_dir):
    """The model inputs among the columns of the feature matrix."""
    panel = panel_of(spark, sf_dir)
    features = feat.build_features(panel, until=cutoffs(spark, sf_dir, panel)["train_end"])
    return spark.createDataFrame([(c,) for c in feat.feature_columns(features)], "feature string")
