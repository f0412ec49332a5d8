"""Near-duplicate embeddings by an exact metric range join.

Cosine >= c is an angle of at most ``r = acos(c)``, and angles are a metric.  Pivots (a
hash sample of the distinct vectors) partition the vectors: each belongs to the cell of
its nearest pivot; cells of more than ``cell_rows`` vectors are dealt into several cells
of the same pivot by a hash.  Boundary replication: if ``y`` of cell q is within ``r`` of
``x`` of cell p, then

    angle(x, q) <= angle(x, p) + 2 r    and    angle(x, q) <= radius(q) + r,

so ``x`` is sent to the task of the cell pair (p, q) only if both hold.  Every pair of
cells is joined on its own, with the vectors that may have a partner on the other side;
a task holds at most two cells.  Cosines are taken in double precision.  A task returns
the number of links of each vector and, instead of all links, a star per connected group.

Equal vectors are one node with a count, so a vector that makes up a third of the table
is one row of the join.  How many cells a vector visits depends on the data: unlike
clustered vectors, directions without structure in 64 dimensions lie near every boundary
and meet all cells; nothing is dropped then.

Defined results: a vector that is NULL, empty, zero, or holds NULL or non-finite
components links with nothing (and is its own component); vectors of different lengths
link with nothing; rows with a NULL id have no links and no component (``kept`` false); repeated rows
count as separate vectors; an empty table gives no rows; other columns are not used.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import connected_components
from shelfcast.sources.sinks import materialize

COSINE = 0.9
CELL_ROWS = 4096
MAX_PIVOTS = 1024
BLOCK = 512
#: Added to every angle bound, far above the rounding of acos.
SLACK = 1e-6


def _angles(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    unit = x / np.sqrt((x * x).sum(1, keepdims=True))
    return np.arccos(np.clip(unit @ pivots.T, -1.0, 1.0))


def _matrix(blobs) -> np.ndarray:
    x = np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)
    return x / np.abs(x).max(1, keepdims=True)  # cosines do not change, squares cannot overflow


def _vectors(batch) -> list[bytes]:
    lists = batch.column("vector")
    flat, at = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.asarray(lists.offsets)
    at = at - at[0]
    return [flat[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)]


def distinct_vectors(rows: DataFrame, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """((id, h1, h2) of all rows with an id, (node, copies, dim, vector, h1, h2) of the
    distinct valid vectors); the node is the smallest id, h1 and h2 identify the vector."""
    v = F.col(vector).cast("array<double>")
    ok = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    base = rows.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), v.alias("vector"),
                                                      F.coalesce(ok, F.lit(False)).alias("ok"))
    h1, h2 = F.xxhash64("vector"), F.xxhash64(F.lit("second"), F.col("vector"))
    keyed = base.select("id", F.when(F.col("ok"), h1).alias("h1"), F.when(F.col("ok"), h2).alias("h2"), "vector")
    nodes = (keyed.filter("h1 IS NOT NULL").groupBy("h1", "h2")
                  .agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"), F.any_value("vector").alias("vector")))
    return keyed.select("id", "h1", "h2"), nodes.withColumn("dim", F.size("vector"))


def _located(nodes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Home pivot (index among those of the same length, -1 without any) and its angle."""

    def run(batches):
        for batch in batches:
            blobs, dims = _vectors(batch), batch.column("dim").to_numpy()
            home, angle = np.full(len(dims), -1, np.int32), np.zeros(len(dims))
            for d in np.unique(dims).tolist():
                if d in pivots:
                    at = np.flatnonzero(dims == d)
                    a = _angles(_matrix([blobs[i] for i in at]), pivots[d])
                    home[at], angle[at] = a.argmin(1), a.min(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("copies"), batch.column("dim"), pa.array(blobs, pa.binary()),
                 pa.array(home), pa.array(angle)], ["node", "copies", "dim", "vector", "home", "angle"])

    return nodes.select("node", "copies", "dim", "vector").mapInArrow(
        run, "node long, copies long, dim int, vector binary, home int, angle double")


def _replicated(located: DataFrame, pivots: dict[int, np.ndarray], cells: dict, r: float) -> DataFrame:
    """A row per task: (dim, lo, hi, side, node, copies, vector); lo and hi are cells."""

    def run(batches):
        for batch in batches:
            columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "dim", "home", "angle")}
            blobs = batch.column("vector").to_pylist()
            row, lo, hi, side = [], [], [], []
            for d in np.unique(columns["dim"]).tolist():
                at = np.flatnonzero(columns["dim"] == d)
                first, parts, radius = cells[d]
                home = columns["home"][at]
                deal = (columns["node"][at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                own = first[home] + (deal % parts[home].astype(np.uint64)).astype(np.int64)
                if d in pivots:
                    a = _angles(_matrix([blobs[i] for i in at]), pivots[d])
                    near = (a <= columns["angle"][at][:, None] + 2 * r + SLACK) & (a <= radius + r + SLACK)
                    near[np.arange(len(at)), home] = True
                else:
                    near = np.ones((len(at), 1), bool)
                which, pivot = np.nonzero(near)
                count = parts[pivot]
                which, start = np.repeat(which, count), np.repeat(first[pivot], count)
                cell = start + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                row.append(at[which])
                lo.append(np.minimum(cell, own[which]))
                hi.append(np.maximum(cell, own[which]))
                side.append((own[which] > cell).astype(np.int32))
            take = np.concatenate(row) if row else np.zeros(0, np.int64)
            # a batch of vectors visits many cells: hand the copies on in parts
            lo, hi, side = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (lo, hi, side))
            for s in range(0, len(take), 8192):
                part = slice(s, s + 8192)
                index = pa.array(take[part])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("dim").take(index), pa.array(lo[part].astype(np.int64)), pa.array(hi[part].astype(np.int64)),
                     pa.array(side[part].astype(np.int32)), *(batch.column(c).take(index) for c in ("node", "copies", "vector"))],
                    ["dim", "lo", "hi", "side", "node", "copies", "vector"])

    return located.mapInArrow(run, "dim int, lo long, hi long, side int, node long, copies long, vector binary")


def join_cells(frame: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links between the two sides of one task (within the cell if it meets itself):
    (a, NULL, links of a) per linked vector and (a, b, 0) per edge of its stars."""
    same = frame["lo"].iloc[0] == frame["hi"].iloc[0]
    left = frame if same else frame[frame["side"] == 0]
    right = frame if same else frame[frame["side"] == 1]
    if not len(left) or not len(right):
        return None
    x, y = _matrix(list(left["vector"])), _matrix(list(right["vector"]))
    nx, ny = np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1))
    mask = np.empty((len(x), len(y)), bool)
    for a in range(0, len(x), BLOCK):
        c = x[a:a + BLOCK] @ y.T
        c /= nx[a:a + BLOCK, None]
        c /= ny
        np.greater_equal(c, cosine, out=mask[a:a + BLOCK])
    if same:
        np.fill_diagonal(mask, False)
    rows, columns = np.flatnonzero(mask.any(1)), np.flatnonzero(mask.any(0))
    if not len(rows):
        return None
    mask = mask[np.ix_(rows, columns)]
    lid, rid = left["node"].to_numpy()[rows], right["node"].to_numpy()[columns]
    lw, rw = left["copies"].to_numpy()[rows].astype(np.float64), right["copies"].to_numpy()[columns].astype(np.float64)
    links = [(lid, mask @ rw)] + ([] if same else [(rid, lw @ mask)])
    a, b = _stars(mask, lid, rid)
    return pd.DataFrame({
        "a": np.concatenate([x[0] for x in links] + [a]),
        "b": pd.array(np.concatenate([np.zeros(sum(len(x[0]) for x in links), np.int64), b]), "Int64"),
        "links": np.concatenate([x[1] for x in links] + [np.zeros(len(a))]).astype(np.int64)})


def _stars(mask: np.ndarray, lid: np.ndarray, rid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(root, member) edges of the connected groups of a two-sided link matrix; every row
    and column is visited once."""
    todo_l, todo_r = np.ones(len(lid), bool), np.ones(len(rid), bool)
    a, b = [], []
    while todo_l.any():
        root = int(np.argmax(todo_l))
        todo_l[root] = False
        rows = np.array([root])
        while len(rows):
            new = np.flatnonzero(mask[rows].any(0) & todo_r)
            todo_r[new] = False
            b.append(rid[new])
            rows = np.flatnonzero(mask[:, new].any(1) & todo_l) if len(new) else new
            todo_l[rows] = False
            b.append(lid[rows])
            a.append(np.full(len(new) + len(rows), lid[root]))
    return np.concatenate(a), np.concatenate(b)


def components(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE,
               cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per row: key, n_links, component_id, kept."""
    r = math.acos(cosine)
    ids, nodes = distinct_vectors(rows, key, vector)
    nodes = materialize(nodes)
    wanted = min(MAX_PIVOTS, max(1, -(-nodes.count() // cell_rows)))
    pivots: dict[int, np.ndarray] = {}
    for p in nodes.orderBy("h1", "h2").limit(wanted).select("dim", "vector").collect():  # bounded: MAX_PIVOTS vectors
        pivots.setdefault(p["dim"], []).append(p["vector"])
    for d, v in pivots.items():
        v = np.array(v)
        v /= np.abs(v).max(1, keepdims=True)
        pivots[d] = v / np.sqrt((v * v).sum(1, keepdims=True))
    located = materialize(_located(nodes, pivots))
    cells: dict = {}
    # one row per length and pivot
    for s in located.groupBy("dim", "home").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")).collect():
        n = len(pivots.get(s["dim"], [0]))
        _, parts, radius = cells.setdefault(s["dim"], [None, np.zeros(n, np.int64), np.full(n, -10.0)])
        parts[s["home"]], radius[s["home"]] = -(-s["n"] // cell_rows), s["radius"]
    for c in cells.values():
        c[0] = np.cumsum(c[1]) - c[1]
    tasks = _replicated(located, pivots, cells, r)
    found = materialize(tasks.groupBy("dim", "lo", "hi").applyInPandas(
        lambda f: out if (out := join_cells(f, cosine)) is not None else pd.DataFrame({"a": [], "b": [], "links": []}).astype(
            {"a": "int64", "b": "Int64", "links": "int64"}), "a long, b long, links long"))
    joined = connected_components(found.filter("links = 0").select("a", "b"))
    counts = found.filter("links > 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    named = (nodes.select("node", "copies", "h1", "h2").join(joined, "node", "left").join(counts, "node", "left")
                  .select("h1", "h2", F.coalesce("component", "node").alias("component_id"),
                          (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    out = ids.filter("h1 IS NOT NULL").join(named, ["h1", "h2"]).select("id", "n_links", "component_id")
    rest = ids.filter("h1 IS NULL").select("id", F.lit(0).cast("long"), F.col("id"))
    unnamed = rows.filter(F.col(key).isNull()).select(F.lit(None).cast("long"), F.lit(0).cast("long"), F.lit(None).cast("long"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return out.union(rest).union(unnamed).select(F.col("id").alias(key), "n_links", "component_id", kept.alias("kept"))
