"""Readers for the retail files (S1-S3, S7): wide daily sales, calendar, weekly prices.

Columns are found by the names in the header, whatever their order, and read with explicit
types (no inference pass: only the header line is read twice).  A file that lacks a column,
or one of several files with another header, ends with an error that names it.  A row that
does not fit (too few or too many fields, text in a number) fails the read, or, with
``quarantine``, keeps its raw line in ``_malformed`` and NULLs elsewhere.  The store subset is a
filter right after the scan; for a partitioned parquet copy it becomes partition pruning.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.schemas import CALENDAR, PRICES, wide_sales

MALFORMED = "_malformed"


def _header(spark: SparkSession, path: str) -> list[str]:
    names = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"{path}: columns named twice: {', '.join(twice)}")
    return names


def _read_named(spark: SparkSession, path: str, wanted: T.StructType, header: list[str], quarantine: bool) -> DataFrame:
    """``wanted`` columns of a CSV whose header is ``header``; other columns are read past."""
    missing = [c for c in wanted.names if c not in header]
    if missing:
        raise ValueError(f"{path}: missing columns: {', '.join(missing[:10])}{' ...' if len(missing) > 10 else ''}")
    types = {f.name: f.dataType for f in wanted.fields}
    fields = [T.StructField(c, types.get(c, T.StringType())) for c in header]
    reader = spark.read.option("header", True).option("enforceSchema", False).option("dateFormat", "yyyy-MM-dd")
    reader = reader.option("columnPruning", False)  # a pruned parse would not see rows of another length
    if quarantine:
        fields.append(T.StructField(MALFORMED, T.StringType()))
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED)
    else:
        reader = reader.option("mode", "FAILFAST")
    return reader.schema(T.StructType(fields)).csv(path).select(*wanted.names, *([MALFORMED] if quarantine else []))


def read_sales_csv(spark: SparkSession, path: str, n_days: int | None = None, sample_stores: list[str] | None = None,
                   quarantine: bool = False) -> DataFrame:
    """Wide sales CSV (six ids + ``d_1..d_n``, all day columns that the header has),
    optional store subset.  ``n_days``, if given, must be the number of day columns."""
    header = _header(spark, path)
    days = sorted(int(c[2:]) for c in header if re.fullmatch(r"d_[0-9]+", c))
    if days != list(range(1, len(days) + 1)):
        raise ValueError(f"{path}: the day columns are not d_1 to d_{len(days)}")
    if n_days is not None and n_days != len(days):
        raise ValueError(f"{path}: {len(days)} day columns, {n_days} expected")
    df = _read_named(spark, path, wide_sales(len(days)), header, quarantine)
    if not sample_stores:
        return df
    keep = F.col("store_id").isin(sample_stores)
    return df.filter(keep | F.col(MALFORMED).isNotNull()) if quarantine else df.filter(keep)


def read_calendar_csv(spark: SparkSession, path: str, quarantine: bool = False) -> DataFrame:
    """Calendar with a parsed date, pruned to the 14 columns the panel uses."""
    return _read_named(spark, path, CALENDAR, _header(spark, path), quarantine)


def read_prices_csv(spark: SparkSession, path: str, quarantine: bool = False) -> DataFrame:
    """S3: weekly prices (store, item, week) -> price."""
    return _read_named(spark, path, PRICES, _header(spark, path), quarantine)


def write_csv(df: DataFrame, path: str) -> None:
    """A table as CSV with a header, as the readers expect it."""
    df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def read_columns(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Column-pruned parquet scan (the projection reaches the scan's ReadSchema)."""
    return spark.read.parquet(path).select(*columns)
