"""Calendar scalar functions (F1-F5).  All are built-in Column expressions, so they
stay inside whole-stage codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def day_of_week(date) -> Column:
    """0 = Monday ... 6 = Sunday (pandas ``dt.dayofweek``; Spark ``weekday``, not ``dayofweek``)."""
    return F.weekday(_c(date))


def day_name(date) -> Column:
    """English day name, e.g. ``Saturday``."""
    return F.date_format(_c(date), "EEEE")


def wday_saturday_first(date) -> Column:
    """Retail-calendar day number: 1 = Saturday, 2 = Sunday, ... 7 = Friday."""
    return ((F.weekday(_c(date)) + 2) % 7 + 1).cast("int")


def is_weekend(date) -> Column:
    return (F.weekday(_c(date)) >= 5).cast("int")


def is_month_start(date) -> Column:
    return (F.dayofmonth(_c(date)) == 1).cast("int")


def is_month_end(date) -> Column:
    d = _c(date)
    return (d == F.last_day(d)).cast("int")


def cyclic_sin(x, period: int) -> Column:
    return F.sin(F.lit(2 * math.pi) * _c(x) / F.lit(period))


def cyclic_cos(x, period: int) -> Column:
    return F.cos(F.lit(2 * math.pi) * _c(x) / F.lit(period))


def retail_week(day_number, first_week: int = 11101) -> Column:
    """Plain increasing week key: ``first_week + (day_number - 1) div 7``."""
    return (F.lit(first_week) + F.floor((_c(day_number) - 1) / 7)).cast("int")
