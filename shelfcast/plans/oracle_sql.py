"""DuckDB SQL text for the correctness oracle.

``panel_ctes(level)`` is the SQL form of ``plans.panel.build_panel``; every oracle query
for an operator on the panel starts from it.  The SQL is written independently of the
Spark code (plain joins, a cross join of series and days, window functions), so the two
only agree if the DataFrame operators are right.
"""

from __future__ import annotations


def _state_case(col: str) -> str:
    return (f"CASE {col} WHEN 'AFRICA' THEN 'CA' WHEN 'AMERICA' THEN 'CA' WHEN 'ASIA' THEN 'TX' "
            f"WHEN 'EUROPE' THEN 'TX' WHEN 'MIDDLE EAST' THEN 'WI' END")


DEPT_CASE = ("CASE p.p_type WHEN 'SMALL' THEN 'SIZE_1' WHEN 'MEDIUM' THEN 'SIZE_1' "
             "WHEN 'LARGE' THEN 'SIZE_2' WHEN 'PROMO' THEN 'SIZE_2' "
             "WHEN 'ECONOMY' THEN 'VALUE_1' WHEN 'STANDARD' THEN 'VALUE_1' ELSE 'OTHER_1' END")


def panel_ctes(level: str = "region") -> str:
    store = "r.r_name" if level == "region" else "n.n_name"
    return f"""
bounds AS (
  SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem
),
cal_days AS (
  SELECT CAST(b.lo + CAST(t.i AS INTEGER) AS DATE) AS date, CAST(t.i AS INTEGER) + 1 AS dn
  FROM bounds b, (SELECT unnest(generate_series(0, (SELECT datediff('day', lo, hi) FROM bounds))) AS i) t
),
cal AS (
  SELECT date,
         CAST(11101 + (dn - 1) // 7 AS INTEGER) AS wm_yr_wk,
         dayname(date) AS weekday,
         CAST((isodow(date) + 1) % 7 + 1 AS INTEGER) AS wday,
         CAST(month(date) AS INTEGER) AS month,
         CAST(year(date) AS INTEGER) AS year,
         'd_' || CAST(dn AS VARCHAR) AS d,
         CASE WHEN month(date) = 12 AND day(date) = 25 THEN 'Christmas'
              WHEN month(date) = 2 AND isodow(date) = 7 AND day(date) <= 7 THEN 'SuperBowl'
              WHEN month(date) = 11 AND isodow(date) = 4 AND day(date) BETWEEN 22 AND 28 THEN 'Thanksgiving'
              WHEN month(date) = 2 AND day(date) = 14 THEN 'ValentinesDay'
              WHEN month(date) = 1 AND day(date) = 6 THEN 'OrthodoxChristmas' END AS event_name_1,
         CASE WHEN month(date) = 12 AND day(date) = 25 THEN 'National'
              WHEN month(date) = 2 AND isodow(date) = 7 AND day(date) <= 7 THEN 'Sporting'
              WHEN month(date) = 11 AND isodow(date) = 4 AND day(date) BETWEEN 22 AND 28 THEN 'National'
              WHEN month(date) = 2 AND day(date) = 14 THEN 'Cultural'
              WHEN month(date) = 1 AND day(date) = 6 THEN 'Religious' END AS event_type_1,
         CASE WHEN ((month(date) = 12 AND day(date) = 25) OR (month(date) = 2 AND day(date) = 14)
                    OR (month(date) = 1 AND day(date) = 6)) AND isodow(date) >= 6
              THEN 'WeekendHoliday' END AS event_name_2,
         CASE WHEN ((month(date) = 12 AND day(date) = 25) OR (month(date) = 2 AND day(date) = 14)
                    OR (month(date) = 1 AND day(date) = 6)) AND isodow(date) >= 6
              THEN 'Cultural' END AS event_type_2,
         CAST(day(date) <= 10 AS INTEGER) AS snap_CA,
         CAST(day(date) % 2 = 1 AND day(date) <= 15 AS INTEGER) AS snap_TX,
         CAST(day(date) IN (2, 3, 5, 6, 8, 9, 11, 12, 14, 15) AS INTEGER) AS snap_WI
  FROM cal_days
),
facts AS (
  SELECT CAST(l.l_shipdate AS DATE) AS date, p.p_type AS item_id, {store} AS store_id,
         {_state_case('r.r_name')} AS state_id, {DEPT_CASE} AS dept_id,
         l.l_quantity AS qty,
         CAST(floor(l.l_extendedprice * 1000000 / NULLIF(l.l_quantity, 0) + 0.5) AS BIGINT) AS price_micros
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
facts_id AS (
  SELECT *, split_part(dept_id, '_', 1) AS cat_id,
         item_id || '_' || store_id || '_evaluation' AS id
  FROM facts
),
daily AS (
  SELECT id, date, CAST(sum(qty) AS INTEGER) AS sales, sum(price_micros) AS price_sum,
         count(price_micros) AS n_price
  FROM facts_id GROUP BY id, date
),
series AS (SELECT DISTINCT id, item_id, dept_id, cat_id, store_id, state_id FROM facts_id),
grid AS (
  SELECT s.*, c.*, coalesce(dy.sales, 0) AS sales, dy.price_sum, dy.n_price
  FROM series s CROSS JOIN cal c
  LEFT JOIN daily dy ON dy.id = s.id AND dy.date = c.date
),
priced AS (
  SELECT *, sum(price_sum) OVER (PARTITION BY id, wm_yr_wk)
            / NULLIF(sum(n_price) OVER (PARTITION BY id, wm_yr_wk), 0) / 1000000.0 AS sell_price
  FROM grid
),
panel AS (
  SELECT id, item_id, dept_id, cat_id, store_id, state_id, date, d, sales, wm_yr_wk, weekday,
         wday, month, year, event_name_1, event_type_1, event_name_2, event_type_2,
         snap_CA, snap_TX, snap_WI, sell_price,
         (sales = 0 AND sell_price IS NOT NULL
          AND sum(sales) OVER (PARTITION BY id ORDER BY date
                               ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) > 0) AS is_stockout
  FROM priced
)"""


def with_panel(body: str, level: str = "region", extra_ctes: str = "") -> str:
    """``WITH <panel ctes>[, extra] <body>``."""
    ctes = panel_ctes(level)
    if extra_ctes:
        ctes += ",\n" + extra_ctes.strip().rstrip(",")
    return f"WITH {ctes}\n{body}"
