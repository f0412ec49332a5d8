"""Readers for the star-schema parquet tables, with column pruning at the scan, and the
size-checked broadcast used for dimensions that grow with the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.sources.sinks import materialize

# Bytes we are willing to ship to every executor.  Anything larger is joined by shuffle
# (sort-merge / shuffled hash, AQE decides at runtime).
DEFAULT_BROADCAST_BYTES = 64 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan; selecting columns here puts them in the scan's ReadSchema."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def sized_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES, derived: bool = False) -> DataFrame:
    """Broadcast ``df`` only if its rows times its row width are at most ``max_bytes``.

    Meant for small *derived* tables (aggregates of a big table), whose planner size
    estimates are unreliable.  The rows are counted per partition and the counts added up;
    beyond the bound the frame is returned unhinted and the planner shuffles it instead.
    A ``derived`` frame is checkpointed first, so the count and the join share one
    computation.  Base tables need no call: the planner sizes them from file statistics.
    """
    if derived:
        df = materialize(df)
    width = sum(32 if f.dataType.typeName() == "string" else 16 for f in df.schema.fields)
    if df.count() * width <= max_bytes:
        return F.broadcast(df)
    return df
