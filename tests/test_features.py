"""Feature operators on the one-series fixture (70 days from 2012-01-01, seeded) and a
brute-force pandas comparison of the window features on a random multi-series panel."""
import datetime as dt

import numpy as np
import pandas as pd
import pytest

from shelfcast.operators import features as feat


@pytest.fixture()
def sample(spark):
    n = 70
    dates = pd.date_range("2012-01-01", periods=n, freq="D")
    rng = np.random.RandomState(42)
    pdf = pd.DataFrame({
        "id": "FOODS_1_001_CA_1_evaluation", "item_id": "FOODS_1_001", "dept_id": "FOODS_1",
        "cat_id": "FOODS", "store_id": "CA_1", "state_id": "CA",
        "date": [d.date() for d in dates],
        "sales": rng.poisson(5, n).astype(float),
        "sell_price": rng.uniform(1, 10, n),
        "event_name_1": [None] * n, "event_name_2": [None] * n,
        "event_type_1": [None] * n, "event_type_2": [None] * n,
        "snap_CA": rng.randint(0, 2, n), "snap_TX": 0, "snap_WI": 0,
        "weekday": [d.strftime("%A") for d in dates],
    })
    pdf.loc[10, ["event_name_1", "event_type_1"]] = ["SuperBowl", "Sporting"]
    pdf.loc[20, ["event_name_1", "event_type_1", "event_name_2", "event_type_2"]] = \
        ["Easter", "Religious", "OrthodoxEaster", "Religious"]
    schema = ("id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, "
              "date date, sales double, sell_price double, event_name_1 string, event_name_2 string, "
              "event_type_1 string, event_type_2 string, snap_CA long, snap_TX long, snap_WI long, weekday string")
    return pdf, spark.createDataFrame(pdf, schema)


def _sorted(df):
    return df.orderBy("date").toPandas()


def test_lags(sample):
    pdf, df = sample
    out = _sorted(feat.add_lag_features(df))
    for k in feat.LAG_DAYS:
        assert f"sales_lag_{k}" in out.columns
    assert out.loc[10, "sales_lag_7"] == pdf.loc[3, "sales"]


def test_rolling_columns(sample):
    _, df = sample
    out = feat.add_rolling_features(df)
    for k in feat.ROLLING_WINDOWS:
        assert f"sales_roll_mean_{k}" in out.columns and f"sales_roll_std_{k}" in out.columns


def test_calendar_and_weekend(sample):
    _, df = sample
    out = _sorted(feat.add_calendar_features(df))
    for c in ["day_of_week", "month", "year", "is_weekend", "dow_sin", "dow_cos", "month_sin", "month_cos"]:
        assert c in out.columns
    sat = out[out["weekday"] == "Saturday"]
    assert (sat["is_weekend"] == 1).all() and (sat["day_of_week"] == 5).all()


def test_event_flags(sample):
    _, df = sample
    out = _sorted(feat.add_event_features(df))
    assert out.loc[10, "has_event"] == 1 and out.loc[0, "has_event"] == 0
    assert out.loc[20, "has_two_events"] == 1 and out.loc[10, "has_two_events"] == 0
    assert out.loc[10, "event_type_1_enc"] == 2 and out.loc[20, "event_type_2_enc"] == 3


def test_benefit_flag_is_own_state(sample):
    _, df = sample
    out = _sorted(feat.add_benefit_flag(df))
    assert (out["is_snap_day"] == out["snap_CA"]).all()


def test_feature_columns(sample):
    _, df = sample
    out = feat.add_calendar_features(feat.add_rolling_features(feat.add_lag_features(df)))
    cols = feat.feature_columns(out)
    assert "sales_lag_7" in cols and "day_of_week" in cols
    for c in ["id", "item_id", "sales", "date"]:
        assert c not in cols


def test_windows_match_pandas(spark):
    rng = np.random.default_rng(7)
    frames = []
    for s in range(3):
        n = 90
        frames.append(pd.DataFrame({"id": f"s{s}", "date": pd.date_range("2020-01-01", periods=n).date,
                                    "sales": rng.poisson(3, n).astype(int)}))
    pdf = pd.concat(frames, ignore_index=True)
    df = spark.createDataFrame(pdf, "id string, date date, sales int")
    out = feat.add_rolling_features(feat.add_lag_features(df)).toPandas().sort_values(["id", "date"])
    exp = pdf.sort_values(["id", "date"]).copy()
    g = exp.groupby("id")["sales"]
    for k in feat.ROLLING_WINDOWS:
        sh = g.shift(1)
        exp[f"m{k}"] = sh.groupby(exp["id"]).transform(lambda x: x.rolling(k, min_periods=1).mean())
        exp[f"s{k}"] = sh.groupby(exp["id"]).transform(lambda x: x.rolling(k, min_periods=1).std()).fillna(0)
        np.testing.assert_allclose(out[f"sales_roll_mean_{k}"].to_numpy(dtype=float), exp[f"m{k}"].to_numpy(), equal_nan=True)
        np.testing.assert_allclose(out[f"sales_roll_std_{k}"].to_numpy(dtype=float), exp[f"s{k}"].to_numpy(), atol=1e-9)
    np.testing.assert_array_equal(out["sales_lag_28"].to_numpy(dtype=float),
                                  g.shift(28).to_numpy(dtype=float))


def test_target_encoding_until(spark):
    rows = [("a_S", "a", "D_1", "D", "S", dt.date(2020, 1, d), v) for d, v in [(1, 2), (2, 4), (3, 100)]]
    df = spark.createDataFrame(rows, "id string, item_id string, dept_id string, cat_id string, store_id string, date date, sales int")
    stats = feat.target_encoding_stats(df, until=dt.date(2020, 1, 2))
    assert stats["item_store_enc"].first()["item_store_enc"] == 3.0
    all_days = feat.target_encoding_stats(df)
    assert all_days["cat_store_enc"].first()["cat_store_enc"] == pytest.approx(106 / 3)
