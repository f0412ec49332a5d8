"""Bounded processing of groups: sorted streaming instead of one task per group, chunk
pairs for large groups, and linking without emitting all pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.sources.sinks import materialize


def per_group(df: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str,
              together: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame] | None = None, few: int = 2) -> DataFrame:
    """``fn`` on every group, streamed from key-sorted partitions: many small groups share
    one Arrow batch, and a task holds one batch plus its largest group.  ``together``, if given,
    takes all groups of two to ``few`` rows of a batch at once, one after the other, and their
    numbers of rows, in place of ``fn``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            if not len(frame):
                continue
            edges = _edges(frame, keys)
            rest = frame.iloc[edges[-2]:]
            yield from _apply(frame, edges[:-1], fn, together, few)
        if rest is not None and len(rest):
            yield from _apply(rest.reset_index(drop=True), [0, len(rest)], fn, together, few)

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def _edges(frame: pd.DataFrame, keys: list[str]) -> list[int]:
    new = np.zeros(len(frame) - 1, bool)
    for k in keys:
        v = frame[k].to_numpy()
        new |= v[1:] != v[:-1]
    return [0, *(np.flatnonzero(new) + 1).tolist(), len(frame)]


def _apply(frame: pd.DataFrame, edges: list[int], fn, together=None, few: int = 2) -> Iterator[pd.DataFrame]:
    groups = list(zip(edges, edges[1:], strict=False))
    small = [(a, b) for a, b in groups if together and 2 <= b - a <= few]
    out = [x for a, b in groups if not (together and 2 <= b - a <= few) and (x := fn(frame.iloc[a:b])) is not None and len(x)]
    if small:
        rows = np.array([b - a for a, b in small])
        at = np.concatenate([np.arange(a, b) for a, b in small])
        if len(x := together(frame.iloc[at], rows)):
            out.append(x)
    if out:
        yield pd.concat(out, ignore_index=True)


def chunk_pairs(rows: DataFrame, key: str, node: str, chunk: int) -> DataFrame:
    """Rows with ``lo`` and ``hi``: groups of more than ``chunk`` rows are dealt into
    chunks by a hash of the node, and each pair of chunks is a task of its own that gets
    both, so that every pair of rows meets and no task holds more than about two chunks.
    Smaller groups are one task."""
    return chunk_rows(with_parts(rows, key, chunk), node)


def with_parts(rows: DataFrame, key: str, chunk: int) -> DataFrame:
    """``rows`` with ``__parts``, the chunks of their group."""
    large = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > chunk)
    return rows.join(large, key, "left").withColumn("__parts", F.coalesce(F.ceil(F.col("__n") / chunk).cast("int"), F.lit(1))).drop("__n")


def chunk_rows(rows: DataFrame, node: str, first: int = 0, turns: int | None = None) -> DataFrame:
    """``chunk_pairs`` of rows whose ``__parts`` is known: shuffles nothing.  With ``turns``
    only that many of the pairs of each chunk, from ``first``: in turn t chunk c meets chunk
    t - c (modulo their number), so both sides of a pair have the same turn."""
    last = F.col("__parts") - 1
    mine = F.pmod(F.xxhash64(F.col(node), F.lit("chunk")), F.col("__parts")).cast("int")
    out = (rows.filter(F.col("__parts") > first).withColumn("__mine", mine)
               .withColumn("__turn", F.explode(F.sequence(F.lit(first), last if turns is None else F.least(last, F.lit(first + turns - 1)))))
               .withColumn("__other", F.pmod(F.col("__turn") - F.col("__mine"), F.col("__parts"))))
    # a chunk meets itself inside its tasks with the others, or alone if it has none
    out = out.filter((F.col("__other") != F.col("__mine")) | (F.col("__parts") == 1))
    return (out.withColumn("lo", F.least("__mine", "__other")).withColumn("hi", F.greatest("__mine", "__other"))
               .drop("__parts", "__mine", "__turn", "__other"))


#: The bit table of wanted keys has a fixed size, whatever the input: 1 MB.
FILTER_PARTS = 1024
FILTER_PART_BITS = 8192


def flag_wanted(rows: DataFrame, key: str, wanted: DataFrame, name: str) -> DataFrame:
    """``rows`` with a boolean ``name``: false only if the row's ``key`` is surely not among
    ``wanted`` (one column).  A join with ``wanted`` then needs to shuffle only rows that
    are flagged.  With many times more keys than bits all rows are flagged: nothing is
    saved then, and nothing lost."""

    def merge(frame):
        bits = np.zeros(FILTER_PART_BITS, bool)
        bits[frame["__bit"].to_numpy()] = True
        return pd.DataFrame({"__part": [frame["__part"].iloc[0]], "__bits": [np.packbits(bits).tobytes()]})

    def cell(column):
        at = F.pmod(F.xxhash64(column), F.lit(FILTER_PARTS * FILTER_PART_BITS)).cast("int")
        return F.floor(at / FILTER_PART_BITS).cast("int").alias("__part"), (at % FILTER_PART_BITS).alias("__bit")

    table = (wanted.select(*cell(F.col(wanted.columns[0]))).distinct().groupBy("__part")
                   .applyInPandas(merge, "__part int, __bits binary"))
    byte = F.expr("conv(hex(substring(__bits, (__bit div 8) + 1, 1)), 16, 10)").cast("int")
    flag = F.coalesce(byte.bitwiseAND(F.expr("shiftright(128, __bit % 8)")) != 0, F.lit(False))
    return (rows.select("*", *cell(F.col(key))).join(F.broadcast(materialize(table)), "__part", "left")
                .withColumn(name, flag).drop("__part", "__bit", "__bits"))


class Union:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.find(i), self.find(j)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def link_group(n: int, maybe: Callable[[int, np.ndarray], np.ndarray], sure: Callable[[int, int], bool] | None,
               union: Union | None = None) -> list[tuple[int, int]]:
    """Links that connect a group exactly as all its links would.

    ``maybe(i, others)`` tells in one vectorised call which others may link with ``i``
    (none that links may be missing); ``sure(i, j)`` decides (None: maybe decides).
    Leaders first: an element that is not yet connected is compared with all others, so a
    group around one text costs one comparison each.  Then the clusters that are still
    apart are compared element by element, skipping pairs that are already connected."""
    union, links, led = union or Union(n), [], np.zeros(n, bool)
    everyone = np.arange(n)

    def compare(i: int, others: np.ndarray) -> None:
        for j in others[maybe(i, others)].tolist():
            if union.find(i) != union.find(j) and (sure is None or sure(i, j)):
                union.join(i, j)
                links.append((i, j))

    joined = np.zeros(n, bool)
    for i in range(n):
        if not joined[i]:
            before = len(links)
            led[i] = True
            # earlier leaders have met everyone
            compare(i, everyone[~led])
            for a, b in links[before:]:
                joined[a] = joined[b] = True
    roots = np.array([union.find(i) for i in range(n)])
    if n > 2 and (roots != roots[0]).any():
        for i in np.flatnonzero(~led).tolist():
            mine = union.find(i)
            # leaders have already met everyone
            others = np.flatnonzero((roots != mine) & ~led)
            others = others[others > i]
            if len(others):
                before = len(links)
                compare(i, others)
                if len(links) > before:
                    roots = np.array([union.find(k) for k in range(n)])
    return links


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of the connected component of each of 0..n-1, for edges a[i]-b[i]."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label
