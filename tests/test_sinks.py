"""Sinks and persistence: partitioned panel write with pruned re-read, resumable feature
write, forecast CSV round trip, encoding tables, model save/load."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.sources import sinks
from shelfcast.sources.retail import read_columns


def _frame(spark, stores):
    rows = [(f"i_{s}", s, dt.date(2020, 1, d), d * 1.0) for s in stores for d in range(1, 4)]
    return spark.createDataFrame(rows, "id string, store_id string, date date, sales double")


def test_partitioned_panel_and_pruned_read(spark, tmpdir_path):
    path = f"{tmpdir_path}/panel"
    sinks.write_panel(_frame(spark, ["A", "B"]), path)
    df = sinks.read_features(spark, path, stores=["B"])
    assert {r["store_id"] for r in df.collect()} == {"B"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "store_id" in plan
    assert read_columns(spark, path, ["id", "sales"]).columns == ["id", "sales"]


def test_missing_feature_dir_raises(spark, tmpdir_path):
    with pytest.raises(FileNotFoundError):
        sinks.read_features(spark, f"{tmpdir_path}/nothing")


def test_resumable_feature_write(spark, tmpdir_path):
    path = f"{tmpdir_path}/features"
    first = sinks.write_features_resumable(_frame(spark, ["A"]), path)
    assert [r["store_id"] for r in first.collect()] == ["A"]
    second = sinks.write_features_resumable(_frame(spark, ["A", "B"]).withColumn(
        "sales", F.when(F.col("store_id") == "A", F.lit(-1.0)).otherwise(F.col("sales"))), path)
    assert [r["store_id"] for r in second.collect()] == ["B"]
    back = spark.read.parquet(path)
    assert back.filter("store_id = 'A' AND sales < 0").count() == 0   # A was not rewritten
    assert back.count() == 6


def test_forecast_csv_roundtrip(spark, tmpdir_path):
    from shelfcast.operators.forecast import forecast_wide
    fc = spark.createDataFrame([("a", h, float(h)) for h in range(1, 29)], "id string, h int, yhat double")
    sinks.write_forecast_csv(forecast_wide(fc), f"{tmpdir_path}/fc")
    back = sinks.read_forecast_csv(spark, f"{tmpdir_path}/fc").first()
    assert back["id"] == "a" and back["F28"] == 28.0


def test_encoding_stats_roundtrip(spark, tmpdir_path):
    stats = {"item_store_enc": spark.createDataFrame([("i", "s", 1.5)], "item_id string, store_id string, item_store_enc double")}
    sinks.save_encoding_stats(stats, f"{tmpdir_path}/enc")
    back = sinks.load_encoding_stats(spark, f"{tmpdir_path}/enc", names=("item_store_enc",))
    assert back["item_store_enc"].first()["item_store_enc"] == 1.5


def test_model_save_load(spark, tmpdir_path):
    from shelfcast.operators import models as mdl
    df = spark.createDataFrame([(float(i), float(i % 3), float(2 * i)) for i in range(60)], "a double, b double, sales double")
    model = mdl.fit_point_model(df, ["a", "b"], params={"maxIter": 3, "maxDepth": 2})
    mdl.save_model(model, f"{tmpdir_path}/m")
    again = mdl.load_model(f"{tmpdir_path}/m")
    p1 = [r["yhat"] for r in mdl.predict_point(model, df).orderBy("a").collect()]
    p2 = [r["yhat"] for r in mdl.predict_point(again, df).orderBy("a").collect()]
    assert p1 == p2 and min(p1) >= 0


def test_checkpoint_dir_must_be_shared_on_a_cluster():
    from types import SimpleNamespace

    from shelfcast.session import ensure_checkpoint_dir
    conf = SimpleNamespace(get=lambda *a, **k: None)
    sc = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None, getConf=lambda: conf,
                         setCheckpointDir=lambda d: None)
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))


def test_partition_values_stay_text(spark, tmpdir_path):
    path = f"{tmpdir_path}/panel01"
    sinks.write_panel(_frame(spark, ["01", "1"]), path)
    assert {r["store_id"] for r in sinks.read_features(spark, path).collect()} == {"01", "1"}
    assert {r[0] for r in sinks.existing_partitions(spark, path).collect()} == {"01", "1"}


def test_other_faults_are_raised(spark, tmpdir_path):
    with pytest.raises(Exception) as found:
        sinks.existing_partitions(spark, "nosuchscheme://bucket/panel")
    assert "No FileSystem" in str(found.value) or "UnsupportedFileSystem" in str(found.value)


def _csv(tmpdir_path, name, text):
    path = f"{tmpdir_path}/{name}"
    with open(path, "w") as f:
        f.write(text)
    return path


def test_csv_columns_are_found_by_name(spark, tmpdir_path):
    from shelfcast.sources import retail
    prices = _csv(tmpdir_path, "p.csv", "item_id,note,sell_price,store_id,wm_yr_wk\ni1,x,2.5,S1,11101\ni2,,,S2,11102\n")
    assert [tuple(r) for r in retail.read_prices_csv(spark, prices).orderBy("item_id").collect()] == [("S1", "i1", 11101, 2.5), ("S2", "i2", 11102, None)]
    sales = _csv(tmpdir_path, "s.csv", "d_2,id,item_id,d_10,dept_id,cat_id,store_id,state_id,d_1,d_3,d_4,d_5,d_6,d_7,d_8,d_9\n"
                                       "2,a,i1,10,D,C,S1,CA,1,3,4,5,6,7,8,9\n20,b,i1,100,D,C,S2,CA,10,30,40,50,60,70,80,90\n")
    out = retail.read_sales_csv(spark, sales, sample_stores=["S2"])
    assert out.columns[6:] == [f"d_{i}" for i in range(1, 11)]
    assert [tuple(r) for r in out.collect()] == [("b", "i1", "D", "C", "S2", "CA", *range(10, 101, 10))]
    with pytest.raises(ValueError, match="10 day columns, 2 expected"):
        retail.read_sales_csv(spark, sales, n_days=2)
    with pytest.raises(ValueError, match="missing columns: sell_price"):
        retail.read_prices_csv(spark, _csv(tmpdir_path, "q.csv", "store_id,item_id,wm_yr_wk\nS,i,1\n"))
    with pytest.raises(ValueError, match="not d_1 to d_2"):
        retail.read_sales_csv(spark, _csv(tmpdir_path, "g.csv", "id,item_id,dept_id,cat_id,store_id,state_id,d_1,d_3\n"))


def test_malformed_csv_rows_fail_or_are_kept_apart(spark, tmpdir_path):
    from shelfcast.sources import retail
    text = "store_id,item_id,wm_yr_wk,sell_price\nS1,i1,11101,2.5\nS1,i2,11101\nS1,i3,11101,2.5,9\nS1,i4,week,1.0\nS1,i5,11102,3.5\n"
    path = _csv(tmpdir_path, "m.csv", text)
    for df in (retail.read_prices_csv(spark, path), retail.read_prices_csv(spark, path).select("item_id")):
        with pytest.raises(Exception, match="(?i)malformed"):
            df.collect()
    rows = {r["_malformed"] or r["item_id"]: r for r in retail.read_prices_csv(spark, path, quarantine=True).collect()}
    assert set(rows) == {"i1", "i5", "S1,i2,11101", "S1,i3,11101,2.5,9", "S1,i4,week,1.0"}
    assert rows["i5"]["sell_price"] == 3.5
    # a second file with another header is not read by the first one's order
    import os
    os.makedirs(f"{tmpdir_path}/two")
    _csv(tmpdir_path, "two/a.csv", "store_id,item_id,wm_yr_wk,sell_price\nS1,i1,11101,2.5\n")
    _csv(tmpdir_path, "two/b.csv", "item_id,store_id,wm_yr_wk,sell_price\ni1,S1,11101,2.5\n")
    with pytest.raises(Exception, match="(?i)header"):
        retail.read_prices_csv(spark, f"{tmpdir_path}/two").collect()


def test_half_written_store_is_rebuilt(spark, tmpdir_path):
    path = f"{tmpdir_path}/features"
    frame = _frame(spark, ["A", "B"])
    sinks.write_features_resumable(frame.filter("store_id = 'A'"), path)
    # the files of a broken run: half of B, no commit
    frame.filter("store_id = 'B' AND sales < 2").write.mode("append").partitionBy("store_id").parquet(path)
    assert {r["store_id"] for r in sinks.read_features(spark, path).collect()} == {"A"}
    again = sinks.write_features_resumable(frame, path, stores=["A", "B"])
    assert [r["store_id"] for r in again.collect()] == ["B"]
    assert sinks.read_features(spark, path).count() == 6 and sinks.read_features(spark, path, ["B"]).count() == 3
    assert {(r["store_id"], r["n_rows"], r["intact"]) for r in sinks.verify_features(spark, path).collect()} == {("A", 3, True), ("B", 3, True)}
    assert sinks.write_features_resumable(frame, path).count() == 0
    # files that were changed after the commit are noticed
    frame.filter("store_id = 'B'").withColumn("sales", F.lit(0.0)).write.mode("append").partitionBy("store_id").parquet(path)
    assert {r["store_id"]: r["intact"] for r in sinks.verify_features(spark, path).collect()} == {"A": True, "B": False}


def test_nothing_committed_yet_raises(spark, tmpdir_path):
    path = f"{tmpdir_path}/features"
    sinks.write_features_resumable(_frame(spark, ["A"]).limit(0), path)
    with pytest.raises(FileNotFoundError):
        sinks.read_features(spark, path)


def test_line_items_are_read_once_for_the_panel(spark, tmpdir_path):
    """The panel's bounds come from the scan that also makes the daily aggregate."""
    from shelfcast.plans import panel as pn
    scans = []
    real = pn.read_table

    def counted(spark_, sf_dir, name, columns=None):
        scans.append(name)
        return real(spark_, sf_dir, name, columns)

    pn.read_table = counted
    try:
        out = pn.build_panel(spark, "/root/testdata/sf0.001")
    finally:
        pn.read_table = real
    assert scans.count("lineitem") == 1
    lo, hi = pn.date_bounds(spark, "/root/testdata/sf0.001")
    want = spark.range(1).select(lo.alias("lo"), hi.alias("hi")).first()
    assert tuple(out.agg(F.min("date"), F.max("date")).first()) == (want["lo"], want["hi"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan


def test_series_table_needs_no_exchange_by_series(spark, tmpdir_path):
    from shelfcast.operators import features as feat
    path = f"{tmpdir_path}/it's a series"
    with pytest.raises(FileNotFoundError):
        sinks.read_series_table(spark, path)
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(70)]
    rows = [(f"i{k}_{s}", s, d, float(i * k)) for s in ("01", "1", "B") for k in range(5) for i, d in enumerate(days)]
    frame = spark.createDataFrame(rows, "id string, store_id string, date date, sales double")
    written = sinks.write_series_table(frame, path, buckets=3)
    spark.sql("DROP TABLE " + next(t.name for t in spark.catalog.listTables() if t.name.startswith("series_")))  # as in another session
    read = sinks.read_series_table(spark, path)
    assert sorted(read.select(*frame.columns).collect()) == sorted(frame.collect()) and written.columns == read.columns

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    lags = feat.add_rolling_features(feat.add_lag_features(read))
    assert "Exchange" not in plan(lags) and "Exchange" not in plan(read.groupBy("id").agg(F.sum("sales")))
    assert "Exchange" in plan(feat.add_lag_features(frame))
    want = feat.add_rolling_features(feat.add_lag_features(frame))
    assert sorted(map(str, lags.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    some = sinks.read_series_table(spark, path, ["01"])
    assert some.count() == 350 and "(store_id" in plan(some).split("PartitionFilters: ")[1].split("]")[0]
    # a later version is read, with its own buckets and columns; a broken write is not
    sinks.write_series_table(frame.filter("store_id = 'B'").withColumn("more", F.lit(1)), path, buckets=2)
    frame.write.partitionBy("store_id").parquet(f"{path}/broken")
    again = sinks.read_series_table(spark, path)
    assert again.count() == 350 and "more" in again.columns


def test_feature_statistics_read_the_panel_once(spark, tmpdir_path):
    from shelfcast.operators import features as feat
    from shelfcast.plans.panel import build_panel
    out = feat.build_features(sinks.materialize(build_panel(spark, "/root/testdata/sf0.001")), until="2001-09-09")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange hashpartitioning") == 1
