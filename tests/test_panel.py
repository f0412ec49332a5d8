"""Panel construction: densify, stockout rule, wide -> long, preprocessing joins, naive
forecast tiling and failure list, percent change with a zero base."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.functions.numeric import pct_change
from shelfcast.operators import forecast as fcst
from shelfcast.plans import panel as pn
from shelfcast.schemas import CALENDAR, PRICES


def test_densify_fills_gaps(spark):
    daily = spark.createDataFrame(
        [("x", "i", "D_1", "D", "s", "CA", dt.date(2020, 1, 1), 3), ("x", "i", "D_1", "D", "s", "CA", dt.date(2020, 1, 4), 5)],
        "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, date date, sales int")
    out = pn.densify(daily, F.lit(dt.date(2020, 1, 1)), F.lit(dt.date(2020, 1, 5)), ["sales"]).orderBy("date").collect()
    assert [r["sales"] for r in out] == [3, None, None, 5, None]


def test_stockout_rule(spark):
    rows = [("x", dt.date(2020, 1, d), s, p) for d, s, p in
            [(1, 5, 1.0), (2, 0, 1.0), (3, 0, None), (4, 0, 1.0), (5, 0, 1.0), (6, 0, 1.0), (7, 0, 1.0), (8, 0, 1.0), (9, 0, 1.0)]]
    df = spark.createDataFrame(rows, "id string, date date, sales int, sell_price double")
    out = pn.detect_stockouts(df).orderBy("date").collect()
    flags = [r["is_stockout"] for r in out]
    # day 1 sold; day 2 zero + listed + sale within 3 days; day 3 unlisted; day 4 within 3 days;
    # day 5+ no sale within +-3 rows
    assert flags == [False, True, False, True, False, False, False, False, False]


def test_melt_and_preprocess(spark, tmpdir_path):
    ids = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]
    wide = spark.createDataFrame([("A_S1_evaluation", "A", "D_1", "D", "S1", "CA", 1, 0, 2),
                                  ("B_S1_evaluation", "B", "D_1", "D", "S1", "CA", 0, 0, 0)],
                                 ", ".join(f"{c} string" for c in ids) + ", d_1 int, d_2 int, d_3 int")
    path = f"{tmpdir_path}/sales.csv"
    wide.coalesce(1).write.option("header", True).csv(path)
    from shelfcast.schemas import wide_sales
    from shelfcast.sources.retail import read_calendar_csv, read_prices_csv, read_sales_csv
    sales = read_sales_csv(spark, path, n_days=3, sample_stores=["S1"])
    cal = spark.createDataFrame([(dt.date(2020, 1, d), 11101, "x", 1, 1, 2020, f"d_{d}", None, None, None, None, 1, 0, 0)
                                 for d in (1, 2, 3)], CALENDAR)
    prices = spark.createDataFrame([("S1", "A", 11101, 2.5)], PRICES)
    cal.coalesce(1).write.option("header", True).csv(f"{tmpdir_path}/cal.csv")
    prices.coalesce(1).write.option("header", True).csv(f"{tmpdir_path}/prices.csv")
    panel = pn.preprocess(sales, read_calendar_csv(spark, f"{tmpdir_path}/cal.csv"),
                          read_prices_csv(spark, f"{tmpdir_path}/prices.csv"))
    got = {(r["id"], r["d"]): (r["sales"], r["sell_price"], r["is_stockout"]) for r in panel.collect()}
    assert len(got) == 6
    assert got[("A_S1_evaluation", "d_2")] == (0, 2.5, True)
    assert got[("B_S1_evaluation", "d_2")] == (0, None, False)
    assert wide_sales(3).fieldNames()[-1] == "d_3"


def test_naive_tiles_last_week_and_flags_short(spark):
    rows = [("long", dt.date(2020, 1, 1) + dt.timedelta(days=i), i) for i in range(14)]
    rows += [("short", dt.date(2020, 1, 10) + dt.timedelta(days=i), 1) for i in range(5)]
    df = spark.createDataFrame(rows, "id string, date date, sales int")
    fc, failed = fcst.seasonal_naive(df, dt.date(2020, 1, 14), horizon=10)
    vals = [r["yhat"] for r in fc.filter("id = 'long'").orderBy("h").collect()]
    assert vals == [7.0, 8, 9, 10, 11, 12, 13, 7, 8, 9]
    assert [r["id"] for r in failed.collect()] == ["short"]


def test_pct_change_zero_base_is_null(spark):
    df = spark.createDataFrame([(0.0, 5.0), (2.0, 3.0)], "base double, x double")
    out = df.select(pct_change("x", "base").alias("p")).collect()
    assert out[0]["p"] is None and out[1]["p"] == pytest.approx(0.5)


def test_forecast_wide_roundtrip(spark):
    fc = spark.createDataFrame([("a", h, float(h)) for h in range(1, 29)], "id string, h int, yhat double")
    wide = fcst.forecast_wide(fc).first()
    assert wide["F1"] == 1.0 and wide["F28"] == 28.0


def test_to_wide_orders_days_numerically(spark):
    rows = [(f"i_s_evaluation", "i", "D_1", "D", "s", "CA", f"d_{k}", k) for k in (1, 2, 10, 11, 100)]
    df = spark.createDataFrame(rows, "id string, item_id string, dept_id string, cat_id string, "
                                     "store_id string, state_id string, d string, sales int")
    wide = pn.to_wide(df)
    assert [c for c in wide.columns if c.startswith("d_")] == ["d_1", "d_2", "d_10", "d_11", "d_100"]
    back = {r["d"]: r["sales"] for r in pn.melt_wide(wide).collect()}
    assert back == {"d_1": 1, "d_2": 2, "d_10": 10, "d_11": 11, "d_100": 100}


def test_check_horizon_raises_on_short_test_span(spark):
    rows = [("x", f"d_{k}", 1) for k in range(1, 11)]
    df = spark.createDataFrame(rows, "id string, d string, sales int")
    train, test = fcst.split_by_day(df, "d_5", horizon=28)
    assert train.count() == 5
    with pytest.raises(ValueError):
        fcst.check_horizon(test, 28)


def test_panel_is_dense_on_sparse_data(spark):
    """D1 at sf0.001 (most series-days have no sale): one row per (series, day) over the
    whole span, days numbered without gaps."""
    panel = pn.build_panel(spark, "/root/testdata/sf0.001", "region")
    stats = panel.agg(F.count("*").alias("n"), F.countDistinct("id").alias("s"),
                      F.countDistinct("date").alias("d"), F.min("date").alias("lo"),
                      F.max("date").alias("hi")).first()
    assert stats["n"] == stats["s"] * stats["d"]
    assert stats["d"] == (stats["hi"] - stats["lo"]).days + 1
    assert panel.groupBy("id", "date").count().filter("count > 1").count() == 0
    assert panel.filter(F.col("sales") > 0).count() < stats["n"] // 2


def test_seasonal_naive_lists_series_that_ended(spark):
    day = dt.date(2020, 1, 1)
    rows = [("full", day + dt.timedelta(days=i), 1) for i in range(20)] + [("ended", day + dt.timedelta(days=i), 1) for i in range(8)]
    df = spark.createDataFrame(rows, "id string, date date, sales int")
    fc, failed = fcst.seasonal_naive(df, dt.date(2020, 1, 20), horizon=5)
    assert {r["id"] for r in fc.collect()} == {"full"}
    assert [(r["id"], r["n_days"]) for r in failed.collect()] == [("ended", 0)]
