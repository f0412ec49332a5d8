"""The long panel: one row per (series, day), dense over the whole calendar.

Two ways in:

* ``preprocess(sales, calendar, prices)`` — the retail-file path: wide or long sales,
  a calendar and a weekly price table, joined as the preprocessing stage does
  (calendar on ``d``, prices on store/item/week), then the stockout window.
* ``build_panel(spark, sf_dir)`` — derives the same panel from the star-schema tables
  (line items as unit sales, part type as item, supplier region or nation as store).
  ``raw_tables`` gives the three retail-shaped inputs for ``preprocess`` instead.

Plan shape of ``build_panel``:
  lineitem (5 columns read) -> join part / supplier (broadcast if the planner's size check
  admits them, else sort-merge) -> partial agg by (item, store, day) -> exchange -> final
  agg -> exchange by id -> window (row number, next fact day) -> explode the days up to
  the next fact -> broadcast calendar -> windows by id (no further exchange).
Every series has exactly one row per day, so a window partition by ``id`` never holds
more than the number of days: a hot series in the line items cannot form a hot key here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.functions import calendar as cal_fn
from shelfcast.functions import events as ev_fn
from shelfcast.schemas import CALENDAR_COLUMNS, ID_COLUMNS, PANEL_COLUMNS
from shelfcast.sources.sinks import materialize
from shelfcast.sources.tables import read_table

# ---- fixed values of our star-schema mapping (see FIXTURES.md part B) --------------------
STATE_BY_REGION = {"AFRICA": "CA", "AMERICA": "CA", "ASIA": "TX", "EUROPE": "TX", "MIDDLE EAST": "WI"}
DEPT_BY_ITEM = {"SMALL": "SIZE_1", "MEDIUM": "SIZE_1", "LARGE": "SIZE_2", "PROMO": "SIZE_2",
                "ECONOMY": "VALUE_1", "STANDARD": "VALUE_1"}
UNKNOWN_DEPT = "OTHER_1"
FIRST_WEEK = 11101
# -------------------------------------------------------------------------------------------


def series_window():
    """w = partition by series, order by day (the shared window of all W* operators)."""
    return Window.partitionBy("id").orderBy("date")


def _lookup(col: Column, mapping: dict[str, str], default: str | None = None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def store_geography(spark: SparkSession, sf_dir: str, store_level: str = "region") -> DataFrame:
    """nation key -> (store_id, state_id).  Nation and region are fixed-size dimensions."""
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    store = F.col("r_name") if store_level == "region" else F.col("n_name")
    return geo.select("n_nationkey", store.alias("store_id"),
                      _lookup(F.col("r_name"), STATE_BY_REGION).alias("state_id"))


def with_hierarchy(df: DataFrame) -> DataFrame:
    """Adds dept_id, cat_id and the series id from item_id and store_id."""
    dept = _lookup(F.col("item_id"), DEPT_BY_ITEM, UNKNOWN_DEPT)
    return (df.withColumn("dept_id", dept)
              .withColumn("cat_id", F.split(F.col("dept_id"), "_").getItem(0))
              .withColumn("id", F.concat_ws("_", "item_id", "store_id", F.lit("evaluation"))))


def star_facts(spark: SparkSession, sf_dir: str, store_level: str = "region", seen: Observation | None = None) -> DataFrame:
    """One row per line item: date, series hierarchy, quantity and unit price.  ``seen``
    observes the first and last ship day (``lo``, ``hi``) of all line items on the way."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"])
    if seen is not None:
        day = F.to_date("l_shipdate")
        li = li.observe(seen, F.min(day).alias("lo"), F.max(day).alias("hi"))
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_type"])
    supp = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    geo = store_geography(spark, sf_dir, store_level)
    # part and supplier grow with the data: no hint.  Joined as plain scans, they are sized
    # by the planner from file statistics (spark.sql.autoBroadcastJoinThreshold, re-checked
    # at run time by AQE); beyond it the join is a sort-merge join with AQE skew splitting.
    # The nation -> store geography is fixed-size (25 rows) and broadcast explicitly.
    facts = (li.join(part, li.l_partkey == F.col("p_partkey"))
               .join(supp, li.l_suppkey == F.col("s_suppkey"))
               .join(F.broadcast(geo), F.col("s_nationkey") == geo.n_nationkey)
               .select(F.to_date("l_shipdate").alias("date"),
                       F.col("p_type").alias("item_id"), "store_id", "state_id",
                       F.col("l_quantity").alias("qty"),
                       unit_price_micros(F.col("l_extendedprice"), F.col("l_quantity")).alias("price_micros")))
    return facts


def unit_price_micros(amount: Column, quantity: Column) -> Column:
    """Unit price in integer millionths (half up).  Integer sums are exact, so a mean price
    does not depend on the order in which partitions are added up."""
    return F.floor(F.try_divide(amount * F.lit(1_000_000), quantity) + F.lit(0.5)).cast("long")


def mean_price(micros_sum: Column, count: Column) -> Column:
    return F.try_divide(micros_sum, count) / F.lit(1_000_000.0)


def daily_sales(facts: DataFrame) -> DataFrame:
    """(series, day) aggregate with map-side partial aggregation; the hierarchy strings
    (id, dept, cat) are built on the aggregate, not per line item."""
    daily = (facts.groupBy("item_id", "store_id", "state_id", "date")
                  .agg(F.sum("qty").cast("int").alias("sales"),
                       F.sum("price_micros").alias("price_sum"),
                       F.count("price_micros").alias("n_price")))
    return with_hierarchy(daily)


def date_bounds(spark: SparkSession, sf_dir: str) -> tuple[Column, Column]:
    """First and last ship day as scalar subqueries over one column of the line items
    (lazy; nothing goes through the driver, no join is repeated)."""
    li = read_table(spark, sf_dir, "lineitem", ["l_shipdate"])
    lo = li.agg(F.min(F.to_date("l_shipdate"))).scalar()
    hi = li.agg(F.max(F.to_date("l_shipdate"))).scalar()
    return lo, hi


def observed_daily(spark: SparkSession, sf_dir: str, store_level: str = "region") -> tuple[DataFrame, Column, Column]:
    """(daily aggregate, first day, last day) from one scan of the line items."""
    seen = Observation()
    daily = materialize(daily_sales(star_facts(spark, sf_dir, store_level, seen)))
    lo, hi = (F.lit(seen.get[c]).cast("date") for c in ("lo", "hi"))
    return daily, lo, hi


def densify(daily: DataFrame, lo: Column, hi: Column, value_cols: list[str]) -> DataFrame:
    """Dense (series x day) rows from sparse daily rows, in one window pass and no join.

    Over ``partition by id order by date`` each fact row generates its own day and every
    day up to (not including) the series' next fact day, or up to ``hi`` for the last row;
    the first row also generates the days from ``lo``.  Value columns are kept only on the
    fact's own day.  The window's exchange by ``id`` is the only shuffle; ``explode``
    keeps that partitioning, so every later per-series window reuses it.  A window
    partition holds one series' active days (bounded by the calendar), never a hot key's
    raw rows: those were merged by the partial aggregation before.
    """
    w = Window.partitionBy("id").orderBy("date")
    first = F.row_number().over(w) == 1
    nxt = F.lead("date").over(w)
    x = daily.withColumns({"_first": first, "_next": nxt})
    begin = F.when(F.col("_first"), lo).otherwise(F.col("date"))
    finish = F.coalesce(F.date_sub(F.col("_next"), 1), hi)
    x = x.withColumn("_day", F.explode(F.sequence(begin, finish)))
    own = F.col("_day") == F.col("date")
    return x.select(*ID_COLUMNS, F.col("_day").alias("date"),
                    *[F.when(own, F.col(c)).alias(c) for c in value_cols])


def calendar_attributes(day_number: Column, date: Column) -> list[Column]:
    ev1_name, ev1_type = ev_fn.primary_event(date)
    ev2_name, ev2_type = ev_fn.secondary_event(date)
    snaps = ev_fn.snap_flags(date)
    return [
        date.alias("date"),
        cal_fn.retail_week(day_number, FIRST_WEEK).alias("wm_yr_wk"),
        cal_fn.day_name(date).alias("weekday"),
        cal_fn.wday_saturday_first(date).alias("wday"),
        F.month(date).alias("month"),
        F.year(date).alias("year"),
        F.concat(F.lit("d_"), day_number.cast("string")).alias("d"),
        ev1_name.alias("event_name_1"), ev1_type.alias("event_type_1"),
        ev2_name.alias("event_name_2"), ev2_type.alias("event_type_2"),
        snaps["snap_CA"].alias("snap_CA"), snaps["snap_TX"].alias("snap_TX"),
        snaps["snap_WI"].alias("snap_WI"),
    ]


def derive_calendar(spark: SparkSession, lo: Column, hi: Column) -> DataFrame:
    """One row per day between the bounds (bounded by the date span, not by the data)."""
    days = spark.range(1).select(F.posexplode(F.sequence(lo, hi)).alias("pos", "date"))
    return days.select(*calendar_attributes(F.col("pos") + 1, F.col("date")))


def detect_stockouts(df: DataFrame) -> DataFrame:
    """Zero sales, price listed, and any sale in the centred 7-row window."""
    around = F.sum("sales").over(series_window().rowsBetween(-3, 3))
    return df.withColumn("is_stockout",
                         (F.col("sales") == 0) & F.col("sell_price").isNotNull() & (around > 0))


def build_panel(spark: SparkSession, sf_dir: str, store_level: str = "region") -> DataFrame:
    """Dense long panel from the star-schema tables: the line items are read once, two
    exchanges (the (item, store, day) aggregate, then ``id`` for every per-series window).
    The aggregate is written to the checkpoint folder, and the first and last day are
    observed while it is."""
    daily, lo, hi = observed_daily(spark, sf_dir, store_level)
    calendar = derive_calendar(spark, lo, hi)
    week = Window.partitionBy("id", "wm_yr_wk")
    panel = (densify(daily, lo, hi, ["sales", "price_sum", "n_price"])
             .join(F.broadcast(calendar), "date", "left")
             .withColumn("sales", F.coalesce(F.col("sales"), F.lit(0)))
             .withColumn("sell_price",
                         mean_price(F.sum("price_sum").over(week), F.sum("n_price").over(week))))
    return detect_stockouts(panel).select(*PANEL_COLUMNS)


def raw_tables(spark: SparkSession, sf_dir: str, store_level: str = "region"):
    """Retail-shaped inputs derived from the star schema: (long sales, calendar, prices)."""
    facts = star_facts(spark, sf_dir, store_level)
    lo, hi = date_bounds(spark, sf_dir)
    calendar = derive_calendar(spark, lo, hi)
    sales_long = (densify(daily_sales(facts), lo, hi, ["sales"])
                  .join(F.broadcast(calendar.select("date", "d")), "date")
                  .select(*ID_COLUMNS, "d", F.coalesce(F.col("sales"), F.lit(0)).alias("sales")))
    prices = (facts.join(F.broadcast(calendar.select("date", "wm_yr_wk")), "date")
                   .groupBy("store_id", "item_id", "wm_yr_wk")
                   .agg(mean_price(F.sum("price_micros"), F.count("price_micros")).alias("sell_price")))
    return sales_long, calendar, prices


def to_wide(panel: DataFrame, value: str = "sales") -> DataFrame:
    """Long panel -> wide sales table (six ids + ``d_1..d_n`` in day order), the layout of
    the retail sales file.  The pivot values are the calendar's day labels (bounded by the
    span, at most ``spark.sql.pivotMaxValues``)."""
    wide = panel.groupBy(*ID_COLUMNS).pivot("d").agg(F.first(value))
    days = sorted((c for c in wide.columns if c.startswith("d_")), key=lambda c: int(c[2:]))
    return wide.select(*ID_COLUMNS, *days)


def melt_wide(sales_wide: DataFrame) -> DataFrame:
    """Wide ``d_1..d_n`` columns -> long (ids, d, sales) with one unpivot, no chunks."""
    d_cols = [c for c in sales_wide.columns if c.startswith("d_")]
    ids = [c for c in ID_COLUMNS if c in sales_wide.columns]
    long = sales_wide.unpivot(ids, d_cols, "d", "sales")
    return long.withColumn("sales", F.col("sales").cast("int"))


def preprocess(sales: DataFrame, calendar: DataFrame, prices: DataFrame,
               sample_stores: list[str] | None = None) -> DataFrame:
    """Preprocessing stage: (wide or long) sales + calendar + prices -> long panel.

    J1 calendar join on ``d`` is a broadcast (one row per day); J2 is a 3-key left join
    whose strategy AQE picks from the runtime size of the price table.
    """
    if sample_stores:
        sales = sales.filter(F.col("store_id").isin(sample_stores))
    if "d" not in sales.columns:
        sales = melt_wide(sales)
    cal = calendar.select(*CALENDAR_COLUMNS)
    df = (sales.join(F.broadcast(cal), "d", "left")
               .join(prices.select("store_id", "item_id", "wm_yr_wk", "sell_price"),
                     ["store_id", "item_id", "wm_yr_wk"], "left"))
    return detect_stockouts(df).select(*PANEL_COLUMNS)
