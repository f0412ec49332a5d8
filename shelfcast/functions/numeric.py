"""Numeric and string scalar helpers.

ANSI mode is on in Spark 4, so a plain ``x / 0`` raises.  Ratios whose base may be zero
use ``try_divide`` (NULL on a zero base); the reference's epsilon-guarded ratios keep
their epsilon so values agree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (guards used by the reference's ratios) ----
PRICE_EPS = 1e-6
SCALE_EPS = 1e-8
# --------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def floor_zeros(x, floor: float = 0.1) -> Column:
    """Zeros replaced by a small positive value before a per-series fit."""
    return F.when(_c(x) == 0, F.lit(floor)).otherwise(_c(x).cast("double"))


def log1p_or_zero(x) -> Column:
    return F.log1p(F.coalesce(_c(x), F.lit(0.0)))


def clip_at_zero(x) -> Column:
    return F.greatest(_c(x), F.lit(0.0))


def guarded_ratio(num, den, eps: float = PRICE_EPS) -> Column:
    return _c(num) / (_c(den) + F.lit(eps))


def pct_change(x, base) -> Column:
    """(x - base) / base with NULL on a zero base (pandas would give +-inf)."""
    return F.try_divide(_c(x) - _c(base), _c(base))


def title_label(x) -> Column:
    """``store_item_enc`` -> ``Store Item Enc``."""
    return F.initcap(F.regexp_replace(_c(x), "_", " "))
