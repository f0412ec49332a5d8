"""Catalog of registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)``, reads the driver tables through the library and
returns a lazy DataFrame over the whole tables.  Float outputs are rounded to 6 places
on both sides so that the order of floating additions cannot change a value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}

DIGITS = 6


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# Columns computed with exact integer sums and one IEEE division: bit-identical in both
# engines, so they are compared unrounded (rounding could only add a tie).
EXACT = ("sell_price",)


def rounded(df: DataFrame, digits: int = DIGITS, keep=EXACT) -> DataFrame:
    """Round every float/double column except ``keep`` (the oracle does the same in SQL)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in keep:
            cols.append(F.round(F.col(f"`{f.name}`").cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in REGISTRY.items() if v[1]}


def _load() -> None:
    # importing the modules registers their queries
    from shelfcast.plans import queries_core  # noqa: F401
    from shelfcast.plans import queries_explore  # noqa: F401
    from shelfcast.plans import queries_tsa  # noqa: F401
    from shelfcast.plans import queries_models  # noqa: F401
    from shelfcast.plans import queries_store  # noqa: F401
