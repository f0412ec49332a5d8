"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

Every source has a target share of the mixture.  With ``size`` its measure (characters)
and ``total`` the measure wanted, each of its documents is repeated at the mean rate
``share * total / size``.  A document's count is drawn by inverting the Poisson
distribution at a uniform number seeded by its id and a hash of its text, so the draw is
repeatable, needs no state, and is independent of partitioning.  Rows that are equal in both
are found first (only their keys are shuffled) and are also told apart by their place in the
input, so each of them has a draw of its own.  The document is exploded by its count and all
copies are dealt out by a hash: a global shuffle.

Defined results: a NULL source is a source of its own; a NULL text has size 0 (a source
with size 0 keeps rate 1); repeated rows, NULL ids among them, are drawn for one by one; an
empty table gives no rows.  Counts end at ``MAX_COPIES`` terms, where the tail is below 2**-52 for rates up
to ``MAX_RATE``; larger rates are split into equal parts, drawn one by one and added, so no draw is cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import row_count
from shelfcast.sources.sinks import materialize

MAX_RATE = 8.0
MAX_COPIES = 64
#: Rows of the rate table (one per source) that may be broadcast; beyond it, a shuffle join.
BROADCAST_SOURCES = 10_000
#: Keys of repeated rows (id and digest, about 60 bytes each) that may be broadcast.
BROADCAST_REPEATS = 200_000
BITS = 52


def uniform(seed: str, *parts: Column) -> Column:
    """A number in (0, 1) from 52 bits of an md5."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS // 4), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / float(2**BITS)


def poisson_count(rate: Column, u: Column) -> Column:
    """Smallest ``k`` with ``P(Poisson(rate) <= k) >= u``."""
    first = F.exp(-rate)
    start = F.struct(F.lit(0).alias("k"), first.alias("p"), first.alias("cdf"))

    def step(a, i):
        p = a["p"] * rate / i
        more = u > a["cdf"]
        return F.struct(F.when(more, i).otherwise(a["k"]).alias("k"), p.alias("p"),
                        F.when(more, a["cdf"] + p).otherwise(a["cdf"]).alias("cdf"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(MAX_COPIES)), start, step, lambda a: a["k"])


def source_rates(docs: DataFrame, source: str = "source", text: str = "text", weights: dict[str, float] | None = None,
                 power: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """One row per source: (source, n_docs, size, share, rate).

    ``weights`` gives target shares (normalised; sources not named get 0).  Without it the
    share is proportional to ``size ** power``: 1 keeps the proportions, 0 is uniform.
    ``epochs`` is the size of the mixture over the size of the input.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum(F.char_length(text)), F.lit(0)).cast("long").alias("size"))
    if weights is None:
        weight = F.when(F.col("size") > 0, F.pow(F.col("size").cast("double"), F.lit(power))).otherwise(F.lit(0.0))
    else:
        weight = F.lit(0.0)
        for name, value in sorted(weights.items()):
            weight = F.when(F.col("source") == F.lit(name), F.lit(float(value))).otherwise(weight)
    sizes = materialize(sizes.withColumn("weight", weight))
    total = sizes.agg(F.sum("weight").alias("all_weight"), F.sum("size").alias("all_size"))
    share = F.coalesce(F.try_divide(F.col("weight"), F.col("all_weight")), F.lit(0.0))
    rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(
        F.col("share") * F.lit(float(epochs)) * F.col("all_size") / F.col("size"))
    return (sizes.join(F.broadcast(total))  # one row
                 .withColumn("share", share).withColumn("rate", rate)
                 .select("source", "n_docs", "size", "share", "rate"))


def mix(docs: DataFrame, source: str = "source", key: str = "doc_id", text: str = "text",
        weights: dict[str, float] | None = None, power: float = 0.5, epochs: float = 1.0, seed: str = "mix") -> DataFrame:
    """All columns of ``docs`` plus a struct ``mixed(rate, n_copies, copy)`` (an input
    column of that name is replaced), one row per copy, in a globally shuffled order (hash
    partitions, sorted by the hash inside)."""
    spark = docs.sparkSession
    rates = materialize(source_rates(docs, source, text, weights, power, epochs)
                        .select(F.col("source").alias("from"), "rate"))
    if row_count(rates) <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    # the whole row travels as one struct, so no input column can clash with ours
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(source).alias("s"),
                       F.col(key).cast("string").alias("id"), F.md5(F.col(text).cast("binary")).alias("digest"))
    # rows that occur again, by id and text
    again = materialize(rows.groupBy("id", "digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                            .select(F.col("id").alias("id_"), F.col("digest").alias("digest_"), F.lit(True).alias("again")))
    if row_count(again) <= BROADCAST_REPEATS:
        again = F.broadcast(again)
    rows = (rows.withColumn("place", F.monotonically_increasing_id())
                .join(again, F.col("id").eqNullSafe(F.col("id_")) & F.col("digest").eqNullSafe(F.col("digest_")), "left"))
    parts = F.ceil(F.col("rate") / MAX_RATE).cast("int")
    own = [F.col("id"), F.col("digest"), F.when(F.col("again"), F.col("place")).otherwise(F.lit(0))]
    one = lambda i: poisson_count(F.col("rate") / parts, uniform(seed, *own, i))
    count = F.when(F.col("rate") <= 0, F.lit(0)).otherwise(
        F.aggregate(F.sequence(F.lit(1), parts), F.lit(0), lambda a, i: a + one(i)))
    copies = (rows.join(rates, F.col("s").eqNullSafe(F.col("from")))
                  .withColumn("n_copies", count).filter("n_copies > 0")
                  .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies")))))
    deal = F.xxhash64(F.lit(seed), *own, F.col("copy"))
    shuffled = (copies.select("doc", F.struct("rate", "n_copies", "copy").alias("mixed"), deal.alias("deal"))
                      .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "deal")
                      .sortWithinPartitions("deal"))
    return shuffled.select(*[F.col("doc")[c].alias(c) for c in docs.columns if c != "mixed"], "mixed")
