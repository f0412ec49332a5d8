"""Helpers shared by the operators: word patterns, lambda bindings, lineage cuts and
connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.sources.sinks import materialize

#: Fixed value: words are runs of characters other than space and U+0009..U+000D.
NOT_WORD = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A lambda that captures a column expression re-evaluates it for every element;
    binding it to a lambda variable first makes it a plain lookup.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words of a text; NULL and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), NOT_WORD, -1), lambda w: w != F.lit(""))


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (NULL ids count as the text 'null')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % n


def row_count(df: DataFrame) -> int:
    """Rows of a frame, counted per partition and then summed."""
    return int(df.agg(F.count(F.lit(1))).first()[0])


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; component = smallest node.

    Alternating large-star and small-star steps: each is one grouped minimum and one
    equi join, so no node's neighbour list is ever collected; a hot centre is split by
    AQE's skew join.  Every round is checkpointed.  Nodes without an edge are absent.
    """
    e = (edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
              .filter("u <> v").distinct())
    e = materialize(e)
    state = None
    for _ in range(max_rounds):
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state or now[0] == 0:
            break
        state = tuple(now)
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.filter("v > u").join(low, "u")
                     .select(F.col("v").alias("u"), F.least("m", "u").alias("v")))
        # nodes that are larger than all their neighbours keep their smallest one
        large = large.distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").filter("v <> m")
                      .select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .union(low2.select("u", F.col("m").alias("v"))))
        e = materialize(small.filter("u <> v").distinct())
    else:
        raise RuntimeError("connected components did not settle")
    pairs = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.union(roots).groupBy("node").agg(F.min("component").alias("component"))
