"""Event and benefit-day scalar functions (F6-F8, F10) plus the event calendar rules
used when a calendar has to be derived from a date span."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's encodings) -------------------------------
# Event type integer codes; any other or missing type encodes as 0.
EVENT_TYPE_CODES = {"National": 1, "Sporting": 2, "Religious": 3, "Cultural": 4}
# State -> benefit-day flag column.
STATE_FLAG_COLUMNS = {"CA": "snap_CA", "TX": "snap_TX", "WI": "snap_WI"}
# -----------------------------------------------------------------------------------------

# ---- fixed values of the derived calendar (our mapping of the driver tables) ----------
# event_name_1 / event_type_1:
#   25 Dec -> Christmas / National; first Sunday of Feb -> SuperBowl / Sporting;
#   fourth Thursday of Nov -> Thanksgiving / National; 14 Feb -> ValentinesDay / Cultural;
#   6 Jan -> OrthodoxChristmas / Religious
# event_name_2 / event_type_2: WeekendHoliday / Cultural when 25 Dec, 14 Feb or 6 Jan is a
#   Saturday or Sunday.
# Benefit days: snap_CA day <= 10; snap_TX odd day <= 15; snap_WI day in
#   2,3,5,6,8,9,11,12,14,15.
SNAP_WI_DAYS = [2, 3, 5, 6, 8, 9, 11, 12, 14, 15]
# -----------------------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def has_event(name_col) -> Column:
    return _c(name_col).isNotNull().cast("int")


def event_type_code(type_col) -> Column:
    t = _c(type_col)
    expr = None
    for name, code in EVENT_TYPE_CODES.items():
        expr = F.when(t == name, F.lit(code)) if expr is None else expr.when(t == name, F.lit(code))
    return expr.otherwise(F.lit(0)).cast("int")


def own_state_flag(state_col="state_id") -> Column:
    """Benefit flag of the row's own state (features, notebook); 0 for other states."""
    s = _c(state_col)
    expr = None
    for state, flag in STATE_FLAG_COLUMNS.items():
        expr = F.when(s == state, F.col(flag)) if expr is None else expr.when(s == state, F.col(flag))
    return expr.otherwise(F.lit(0)).cast("int")


def any_state_flag(*flag_cols: str) -> Column:
    """Row-wise max of the state flags (dashboard variant)."""
    cols = flag_cols or tuple(STATE_FLAG_COLUMNS.values())
    return F.greatest(*[F.col(c) for c in cols]).cast("int")


# ---- derived calendar rules ---------------------------------------------------------------

def _md(date, m: int, d: int) -> Column:
    return (F.month(date) == m) & (F.dayofmonth(date) == d)


def primary_event(date) -> tuple[Column, Column]:
    d = _c(date)
    dow = F.weekday(d)  # 0 = Monday
    rules = [
        (_md(d, 12, 25), "Christmas", "National"),
        ((F.month(d) == 2) & (dow == 6) & (F.dayofmonth(d) <= 7), "SuperBowl", "Sporting"),
        ((F.month(d) == 11) & (dow == 3) & F.dayofmonth(d).between(22, 28), "Thanksgiving", "National"),
        (_md(d, 2, 14), "ValentinesDay", "Cultural"),
        (_md(d, 1, 6), "OrthodoxChristmas", "Religious"),
    ]
    name = reduce(lambda acc, r: acc.when(r[0], F.lit(r[1])), rules[1:], F.when(rules[0][0], F.lit(rules[0][1])))
    kind = reduce(lambda acc, r: acc.when(r[0], F.lit(r[2])), rules[1:], F.when(rules[0][0], F.lit(rules[0][2])))
    return name, kind


def secondary_event(date) -> tuple[Column, Column]:
    d = _c(date)
    fixed_holiday = _md(d, 12, 25) | _md(d, 2, 14) | _md(d, 1, 6)
    cond = fixed_holiday & (F.weekday(d) >= 5)
    return F.when(cond, F.lit("WeekendHoliday")), F.when(cond, F.lit("Cultural"))


def snap_flags(date) -> dict[str, Column]:
    dom = F.dayofmonth(_c(date))
    return {
        "snap_CA": (dom <= 10).cast("int"),
        "snap_TX": (((dom % 2) == 1) & (dom <= 15)).cast("int"),
        "snap_WI": dom.isin(SNAP_WI_DAYS).cast("int"),
    }
