"""What a chain of filters removes, in every order, from decision diagrams of failure masks.

Every document has a mask of the filters it fails.  Spark counts the documents by part and
mask (with how many of them are good or toxic); a part has at most 4 x 2^k such counts,
however many documents it holds.  Per part the counts become a decision diagram: a level per
filter, a pass and a fail edge per node, equal nodes shared, and in every node the weight of
the documents below it.  Filters applied in the order of the levels keep what lies below the
all-pass path: at each level the pass child holds what the step keeps, the fail child what
it removes.  The next order differs by one swap of neighbours, so only two levels of the
diagram are rebuilt; the weights of all nodes above and below stay as they are.

Copies: a document fails the copy filter if its text equals that of a row with a smaller id
anywhere in the table.  Only the smallest id of each text is looked up, by a digest of the
text, after rows of one digest, id, part and mask were merged; a text or an id on a third of
all rows is thus partly aggregated before any shuffle.

Defined results: NULL text is empty (no words; a copy of other empty texts); NULL part is the
empty string, together with an empty part; rows with a NULL id fail no copy filter and make
no other row fail it, and have no labels; repeated rows count each, and a repeated row is no
copy of itself (its id is not smaller); of several label rows of an id the largest value
counts, NULL labels are none; an empty table gives no rows; a table without labels loses
none.  Input columns other than those named are not used, so their names never clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import NOT_WORD
from shelfcast.sources.sinks import materialize

#: Fixed values of the five filters.
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 3
MARKS = r"[#$%&*|]"
FILTERS = "ABCDE"
#: k! orders are listed for k filters.
MAX_FILTERS = 7
WEIGHTS = ("n", "good", "toxic")


class MaskDiagram:
    """Count-weighted decision diagram of failure masks.

    ``levels[i]`` lists the nodes that branch on filter ``order[i]`` as (pass, fail) places
    in the list below; the last list holds the weights of whole masks.  ``weight[i][j]`` is
    the weight of all documents below node j of level i.
    """

    def __init__(self, cells: dict[int, tuple[int, ...]], n_filters: int, n_weights: int):
        zero = (0,) * n_weights
        self.order = list(range(n_filters))
        leaves: dict[tuple, int] = {}
        row = [leaves.setdefault(tuple(cells.get(self._mask(p, n_filters), zero)), len(leaves)) for p in range(1 << n_filters)]
        self.levels: list[list[tuple[int, int]]] = [[] for _ in range(n_filters)]
        self.weight: list[list[tuple]] = [[] for _ in range(n_filters)] + [list(leaves)]
        for i in reversed(range(n_filters)):  # pairs of neighbours share their path down to level i
            nodes: dict[tuple[int, int], int] = {}
            row = [nodes.setdefault((row[j], row[j + 1]), len(nodes)) for j in range(0, len(row), 2)]
            self._set(i, nodes)

    @staticmethod
    def _mask(path: int, n: int) -> int:
        """The mask (bit f: filter f fails) of a path (first level in the highest bit)."""
        return sum(1 << f for f in range(n) if path >> (n - 1 - f) & 1)

    def _set(self, level: int, nodes) -> None:
        self.levels[level] = list(nodes)
        below = self.weight[level + 1]
        self.weight[level] = [tuple(map(int.__add__, below[p], below[f])) for p, f in self.levels[level]]

    def swap(self, i: int) -> None:
        """Exchange the filters of levels i and i + 1; other levels keep their nodes."""
        inner, nodes = self.levels[i + 1], {}
        outer = []
        for p, f in self.levels[i]:
            (pp, pf), (fp, ff) = inner[p], inner[f]
            outer.append((nodes.setdefault((pp, fp), len(nodes)), nodes.setdefault((pf, ff), len(nodes))))
        self._set(i + 1, nodes)
        self.levels[i] = outer  # the same documents lie below each node of level i: its weight stays
        self.order[i], self.order[i + 1] = self.order[i + 1], self.order[i]

    def all_pass(self) -> Iterator[tuple[int, tuple, tuple]]:
        """(filter, weight kept, weight removed) at each level of the all-pass path."""
        node = 0
        for i, f in enumerate(self.order):
            p, q = self.levels[i][node]
            yield f, self.weight[i + 1][p], self.weight[i + 1][q]
            node = p


def neighbour_swaps(n: int) -> Iterator[int]:
    """Places of the swaps (i with i + 1) that lead through all n! orders, one by one."""
    place, step = list(range(n)), [-1] * n  # place of each item, its direction
    items = list(range(n))
    while True:
        for item in reversed(range(n)):  # the largest item that faces a smaller neighbour
            at, to = place[item], place[item] + step[item]
            if 0 <= to < n and items[to] < item:
                break
        else:
            return
        yield min(at, to)
        other = items[to]
        items[at], items[to] = other, item
        place[item], place[other] = to, at
        for larger in range(item + 1, n):
            step[larger] = -step[larger]


def audit_part(cells: dict[int, tuple[int, ...]], names: str | list[str]) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)
    for every order and step; ``cells``: mask -> (documents, good, toxic)."""
    n = len(names)
    diagram = MaskDiagram(cells, n, len(WEIGHTS))
    steps, fails, alone, total = [], [0] * n, [0] * n, [0] * n
    swaps = neighbour_swaps(n)
    while True:
        order = "".join(names[f] for f in diagram.order)
        for step, (f, kept, removed) in enumerate(diagram.all_pass(), 1):
            steps.append((order, step, f, kept[0], *removed))
            total[f] += removed[0]
            if step == 1:
                fails[f] = removed[0]
            if step == n:
                alone[f] = removed[0]
        try:
            diagram.swap(next(swaps))
        except StopIteration:
            break
    return [(order, step, kept, removed, fails[f] - removed, alone[f], good, toxic, total[f])
            for order, step, f, kept, removed, good, toxic in steps]


def failures(text: Column) -> list[Column]:
    """Whether a text fails each of the filters that look at it alone (A to D)."""
    words = F.array_remove(F.split(text, NOT_WORD, -1), "")
    upper = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [F.size(words) < MIN_WORDS,
            100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words),
            100 * upper.cast("long") > MAX_UPPER_PERCENT * F.length(text).cast("long"),
            text.rlike(MARKS)]


def mask_counts(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang",
                quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """part, mask (bit i: filter i fails), n, good, toxic: documents by part and mask."""
    whole = F.coalesce(F.col(text), F.lit(""))
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(failures(F.col("text")))]
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), whole.alias("text"))
    rows = materialize(rows.select("id", "part", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"),
                                   sum(bits[1:], bits[0]).alias("mask")))
    merged = rows.groupBy("digest", "id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    least = rows.groupBy("digest").agg(F.min("id").alias("id")).filter("id IS NOT NULL").withColumn("first", F.lit(True))
    marked = (labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("id"))
                    .agg(F.max(F.col(quality) == 1).alias("is_good"), F.max(F.col(toxic) == 1).alias("is_toxic")))
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    found = merged.join(least, ["digest", "id"], "left").join(marked, "id", "left")
    weight = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0))
    return (found.groupBy("part", (F.col("mask") + F.when(copy, 1 << len(bits)).otherwise(0)).alias("mask"))
                 .agg(F.sum("n").alias("n"), weight("is_good").alias("good"), weight("is_toxic").alias("toxic")))


STEPS = ("filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def audit(counts: DataFrame, names: str | list[str] = FILTERS) -> DataFrame:
    """All orders and steps of each part of ``counts`` (part, mask, n, good, toxic); a group
    holds at most 2^k rows."""
    if len(names) > MAX_FILTERS:
        raise ValueError(f"{len(names)}! orders are too many to list")

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        cells = {int(m): (int(n), int(g), int(t)) for m, n, g, t in zip(frame["mask"], frame["n"], frame["good"], frame["toxic"], strict=True)}
        out = pd.DataFrame(audit_part(cells, names), columns=[c.split()[0] for c in STEPS.split(", ")])
        out.insert(0, "part", frame["part"].iloc[0])
        return out

    return counts.groupBy("part").applyInPandas(one, "part string, " + STEPS)


def audit_documents(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """``audit`` of the five filters over a table of documents."""
    return audit(mask_counts(docs, labels, **columns))
