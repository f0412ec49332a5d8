"""Explicit schemas.  Nothing is inferred from CSV: inference costs a full scan at scale."""

from __future__ import annotations

from pyspark.sql import types as T

ID_COLUMNS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]

CALENDAR = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("wm_yr_wk", T.IntegerType()),
    T.StructField("weekday", T.StringType()),
    T.StructField("wday", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("d", T.StringType()),
    T.StructField("event_name_1", T.StringType()),
    T.StructField("event_type_1", T.StringType()),
    T.StructField("event_name_2", T.StringType()),
    T.StructField("event_type_2", T.StringType()),
    T.StructField("snap_CA", T.IntegerType()),
    T.StructField("snap_TX", T.IntegerType()),
    T.StructField("snap_WI", T.IntegerType()),
])

CALENDAR_COLUMNS = [f.name for f in CALENDAR.fields]

PRICES = T.StructType([
    T.StructField("store_id", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("wm_yr_wk", T.IntegerType()),
    T.StructField("sell_price", T.DoubleType()),
])


def wide_sales(n_days: int) -> T.StructType:
    """Wide sales file: six id columns then ``d_1 .. d_n`` integer day columns."""
    fields = [T.StructField(c, T.StringType()) for c in ID_COLUMNS]
    fields += [T.StructField(f"d_{i}", T.IntegerType()) for i in range(1, n_days + 1)]
    return T.StructType(fields)


PANEL_COLUMNS = [
    "id", "item_id", "dept_id", "cat_id", "store_id", "state_id", "date", "d", "sales",
    "wm_yr_wk", "weekday", "wday", "month", "year",
    "event_name_1", "event_type_1", "event_name_2", "event_type_2",
    "snap_CA", "snap_TX", "snap_WI", "sell_price", "is_stockout",
]
