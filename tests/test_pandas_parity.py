"""Window operators against pandas' own definitions on random data."""
import datetime as dt

import numpy as np
import pandas as pd

from shelfcast.operators import forecast as fcst
from shelfcast.plans import panel as pn


def test_display_band_matches_pandas_ewm(spark):
    rng = np.random.default_rng(12)
    rows = []
    for store in ("A", "B"):
        for s in range(3):
            for t in range(60):
                rows.append((f"{store}{s}", store, dt.date(2021, 1, 1) + dt.timedelta(days=t), int(rng.poisson(20))))
    df = spark.createDataFrame(rows, "id string, store_id string, date date, sales int")
    got = fcst.display_band(df).toPandas().sort_values(["store_id", "date"])
    pdf = pd.DataFrame(rows, columns=["id", "store_id", "date", "sales"])
    for store, g in pdf.groupby("store_id"):
        daily = g.groupby("date")["sales"].agg(["sum", "std"]).sort_index().tail(28)
        pred = daily["sum"].ewm(span=7).mean().round()
        sd = daily["std"].mean()
        mine = got[got["store_id"] == store]
        np.testing.assert_array_equal(mine["predicted"].to_numpy(), pred.to_numpy())
        np.testing.assert_array_equal(mine["lower_bound"].to_numpy(), (pred - 1.28 * sd).clip(lower=0).round().to_numpy())
        np.testing.assert_array_equal(mine["upper_bound"].to_numpy(), (pred + 1.28 * sd).round().to_numpy())


def test_stockout_matches_pandas_centered_window(spark):
    rng = np.random.default_rng(8)
    rows = []
    for s in range(4):
        for t in range(50):
            sales = int(rng.integers(0, 3) == 0) * int(rng.integers(1, 5))
            price = None if rng.random() < 0.2 else 2.0
            rows.append((f"s{s}", dt.date(2021, 1, 1) + dt.timedelta(days=t), sales, price))
    df = spark.createDataFrame(rows, "id string, date date, sales int, sell_price double")
    got = pn.detect_stockouts(df).toPandas().sort_values(["id", "date"])
    pdf = pd.DataFrame(rows, columns=["id", "date", "sales", "sell_price"]).sort_values(["id", "date"])
    roll = pdf.groupby("id")["sales"].transform(lambda x: x.rolling(7, min_periods=1, center=True).sum())
    exp = (pdf["sales"] == 0) & pdf["sell_price"].notna() & (roll > 0)
    np.testing.assert_array_equal(got["is_stockout"].to_numpy(), exp.to_numpy())
