"""Driver contract and a few oracle comparisons at sf0.001 (DuckDB as the oracle)."""
import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and set(df.columns) == {"store_id", "n_series", "MAE", "MASE", "WRMSSE"}


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)[:10]
    return v


@pytest.mark.parametrize("name", ["panel", "features", "naive_scorecard_by_store", "decomposition",
                                  "event_window_effect", "display_band", "series_acf", "dataset_profile",
                                  "sequence_windows_text", "benefit_uplift_by_category"])
def test_oracle_agrees(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    s = entry.queries()[name](spark, SF).toPandas()
    o = con.execute(entry.oracle_sql()[name]).df()
    cols = sorted(s.columns)
    assert cols == sorted(o.columns)
    srows = sorted((tuple(_norm(x) for x in r) for r in s[cols].itertuples(index=False)), key=str)
    orows = sorted((tuple(_norm(x) for x in r) for r in o[cols].itertuples(index=False)), key=str)
    assert srows == orows


@pytest.mark.parametrize("name,cols", [("panel", ["sell_price"]), ("decomposition", ["trend", "seasonal", "resid"])])
def test_unrounded_columns_are_bit_identical(spark, name, cols):
    """Columns computed from exact integer sums and one IEEE division are compared unrounded."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    s = entry.queries()[name](spark, SF).select("id", "date", *cols).toPandas()
    o = con.execute(entry.oracle_sql()[name]).df()[["id", "date", *cols]]
    s = s.assign(date=s["date"].astype(str)).sort_values(["id", "date"]).reset_index(drop=True)
    o = o.assign(date=o["date"].astype(str).str[:10]).sort_values(["id", "date"]).reset_index(drop=True)
    assert list(s["id"]) == list(o["id"]) and list(s["date"]) == list(o["date"])
    for c in cols:
        a, b = s[c].to_numpy(dtype=float), o[c].to_numpy(dtype=float)
        both_nan = (a != a) & (b != b)
        assert ((a == b) | both_nan).all(), c
