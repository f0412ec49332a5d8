"""Stupid-backoff language-model scores, leave-one-out over the corpus.

A word is scored by ``c(w1 w2 w3) / c(w1 w2)`` if that trigram occurs outside the document,
else by ``ALPHA`` times the bigram score, else by ``ALPHA`` squared times the word's share.
All counts are corpus counts less the document's own, so a text is scored by what the
rest of the corpus contains; a word that occurs nowhere else counts as one more word.

Relational form.  Rows are dealt to blocks by a hash that also takes
the row's place, so repeated rows are spread.  A block counts its distinct
n-grams before anything is shuffled, and sends its part of every
hash bucket as one binary row; a bucket is a partition of the n-gram count table, which
sums the counts of all blocks and joins the totals back to the n-grams that each block
asked for.  Orders are counted one after the other: an n-gram can occur elsewhere only if
both (n-1)-grams inside it do, so a block asks only for those, which loses nothing and
leaves out most of the long tail.  The block explodes its texts into n-grams once more,
takes the totals, and sums the log scores per document.  A frequent n-gram costs a bucket one entry per block,
however often it occurs.  N-grams are 64-bit hashes in a block and 44 bits inside a
bucket; the number of blocks and buckets follows the input, so neither grows.

Defined results: NULL and blank texts have 0 words and NULL scores; repeated rows are
scored one by one, each against the others; a corpus of one document scores every word as
unseen; an empty table gives no rows; other columns than key and text are not used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.text_arrays import U, flat, mix, word_hashes

ORDER = 3
ALPHA = 0.4
BLOCK_BYTES = 6 << 20
BUCKET_BYTES = 6 << 20
_STEP = U(0x9E3779B97F4A7C15)


def _ngrams(texts: pa.Array, order: int):
    """Yields (text of each word, words before each text), then the (hashes, word positions)
    of each order, one at a time."""
    data, offsets = flat(texts)
    h, first = word_hashes(data, offsets)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    place = np.arange(len(h)) - first[text]
    yield text, first
    last = h
    for n in range(1, order + 1):
        at = np.flatnonzero(place >= n - 1)
        if n > 1:  # the n-gram that ends here continues the one that ended before
            joined = np.zeros(len(h), np.uint64)
            joined[1:] = mix(last[:-1] * _STEP + h[1:])
            last = joined
        yield mix(last[at] + U(n)), at


#: Bits that tell n-grams of a bucket apart; two of a bucket's few million coincide with
#: a chance of about 1e-7 each.
BITS = 44


def _edges(distinct: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the high bits, so sorted n-grams are in bucket order."""
    bucket = ((distinct >> U(32)) * U(buckets) >> U(32)).astype(np.int64)
    return np.searchsorted(bucket, np.arange(buckets + 1))


def _identity(distinct: np.ndarray, buckets: int) -> np.ndarray:
    """Ascending numbers of which the low BITS differ inside a bucket."""
    return distinct >> U(max(0, 64 - BITS - (buckets - 1).bit_length()))


def _coded(x: np.ndarray) -> bytes:
    """Ascending numbers as steps of as few bytes as the largest step needs."""
    step = np.diff(x)
    width = max(1, -(-int(step.max(initial=0)).bit_length() // 8))
    return bytes([width]) + x[:1].tobytes() + step.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _decoded(blob: bytes) -> np.ndarray:
    width, n = blob[0], (len(blob) - 9) // blob[0]
    out = np.zeros((n + 1, 8), np.uint8)
    out[0] = np.frombuffer(blob, np.uint8, 8, 1)
    out[1:, :width] = np.frombuffer(blob, np.uint8, offset=9).reshape(n, width)
    return np.cumsum(out.view("<u8").reshape(-1), dtype=np.uint64)


def _packed(x: np.ndarray) -> bytes:
    """Counts as single bytes; 255 stands for the next of the whole numbers that follow."""
    return len(x).to_bytes(8, "little") + np.minimum(x, 255).astype(np.uint8).tobytes() + x[x >= 255].astype("<u8").tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    out = np.frombuffer(blob, np.uint8, n, 8).astype(np.int64)
    out[out == 255] = np.frombuffer(blob, "<u8", offset=8 + n)
    return out


_ASK = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("grams", pa.binary()), ("counts", pa.binary())])
_ANSWER = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("totals", pa.binary())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def outside_counts(at: np.ndarray, index: np.ndarray, totals: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For each word, how often the n-gram that ends there occurs in other documents."""
    _, pair, tf = np.unique(text[at] * np.int64(len(totals) + 1) + index, return_inverse=True, return_counts=True)
    out = np.zeros(len(text), np.int64)
    out[at] = totals[index] - tf[pair]
    return out


def resolve(texts: pa.Array, rows: list[dict], known: int, buckets: int, order: int):
    """Outside counts of the ``known`` orders whose totals are in ``rows``.

    Yields per order the (hashes, word positions) that were asked for.  An n-gram occurs
    in another document only if both (n-1)-grams inside it do, so only positions where
    both are supported are asked for; all other counts are 0 without asking.  Returns by
    the last item (None, (text of each word, words before each text, counts, positions))."""
    found = _ngrams(texts, order)
    text, first = next(found)
    counts, places = [], []
    for n, (grams, at) in enumerate(found):
        if n:
            last = counts[-1]
            keep = (last[at] > 0) & (last[at - 1] > 0)
            places.append(at)
            grams, at = grams[keep], at[keep]
        else:
            places.append(at)
        yield grams, at
        if n == known:
            return
        _, index = np.unique(grams, return_inverse=True)
        own = [_unpacked(r["totals"]) for r in rows if r["bucket"] // buckets == n]
        counts.append(outside_counts(at, index, np.concatenate([*own, np.zeros(0, np.int64)]), text))
    yield None, (text, first, counts, places)


def backoff(score: np.ndarray, count: np.ndarray, before: np.ndarray, at: np.ndarray, alpha: float) -> np.ndarray:
    """Scores of one order from those of the order below (``before``: its counts)."""
    context = np.zeros(len(count), np.int64)
    context[1:] = before[:-1]
    inside = np.zeros(len(count), bool)
    inside[at] = True
    return np.where(count > 0, count / np.maximum(context, 1), np.where(inside, alpha * score, score))


def scores(docs: DataFrame, key: str = "doc_id", text: str = "text", order: int = ORDER, alpha: float = ALPHA) -> DataFrame:
    """One row per row of ``docs``: key, n_words, log_score (sum) and mean_log_score."""
    spark = docs.sparkSession
    size, n_words = docs.agg(F.sum(F.octet_length(text)), F.sum(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")))).first()
    size, n_words = int(size or 0), int(n_words or 0)
    blocks = size // BLOCK_BYTES + 1
    buckets = min(1 << 31, size // BUCKET_BYTES + 1)  # of each order
    source = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    # rows are scored one by one, so repeated rows need not meet: the row number deals them out
    block = F.pmod(F.xxhash64("id", "text", F.monotonically_increasing_id()), F.lit(blocks))
    dealt = source.withColumn("block", block).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "block")

    def asked(name: int, texts: pa.Table, rows: list[dict], n: int) -> pa.Table:
        out = {f: [] for f in _ASK.names}
        for k, (grams, _) in enumerate(resolve(texts.column("text").combine_chunks(), rows, n, buckets, order)):
            if k == n:
                distinct, counts = np.unique(grams, return_counts=True)
                edge, identity = _edges(distinct, buckets), _identity(distinct, buckets)
                for b in np.flatnonzero(np.diff(edge)).tolist():  # only buckets that get something
                    part = slice(edge[b], edge[b + 1])
                    for f, v in zip(_ASK.names, (name, n * buckets + b, _coded(identity[part]), _packed(counts[part])), strict=True):
                        out[f].append(v)
        return pa.Table.from_pydict(out, schema=_ASK)

    def ask_first(texts: pa.Table) -> pa.Table:
        return asked(texts.column("block")[0].as_py(), texts, [], 0)

    def ask_next(n: int):
        def ask(texts: pa.Table, totals: pa.Table) -> pa.Table:
            return asked(texts.column("block")[0].as_py(), texts, sorted(totals.to_pylist(), key=lambda r: r["bucket"]), n)
        return ask

    def total(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        grams = [_decoded(r["grams"]) for r in rows]
        distinct, index = np.unique(np.concatenate(grams), return_inverse=True)
        sums = np.zeros(len(distinct), np.int64)
        np.add.at(sums, index, np.concatenate([_unpacked(r["counts"]) for r in rows]))
        out, begin = {f: [] for f in _ANSWER.names}, 0
        for r, g in zip(rows, grams, strict=True):
            for f, v in zip(_ANSWER.names, (r["block"], r["bucket"], _packed(sums[index[begin:begin + len(g)]])), strict=True):
                out[f].append(v)
            begin += len(g)
        return pa.Table.from_pydict(out, schema=_ANSWER)

    key_type = source.schema["id"].dataType.simpleString()

    def answer(texts: pa.Table, totals: pa.Table) -> pa.Table:
        rows = sorted(totals.to_pylist(), key=lambda r: r["bucket"])
        *_, (_, (text_of, first, counts, places)) = resolve(texts.column("text").combine_chunks(), rows, order, buckets, order)
        rest = (n_words - np.diff(first))[text_of]
        score = np.where(counts[0] > 0, counts[0], 1) / np.where(counts[0] > 0, rest, rest + 1)
        for k in range(1, order):
            score = backoff(score, counts[k], counts[k - 1], places[k], alpha)
        n = np.diff(first)
        sums = np.bincount(text_of, np.log(score), len(n))
        blank = n == 0
        return pa.table({"id": texts.column("id"), "n_words": pa.array(n.astype(np.int64)), "log_score": pa.array(sums, mask=blank),
                         "mean_log_score": pa.array(sums / np.maximum(n, 1), mask=blank)})

    # one plan: the texts are shuffled once, and the exchange is reused by every order
    totals = dealt.groupBy("block").applyInArrow(ask_first, _ddl(_ASK)).groupBy("bucket").applyInArrow(total, _ddl(_ANSWER))
    for n in range(1, order):
        more = dealt.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(ask_next(n), _ddl(_ASK))
        totals = totals.union(more.groupBy("bucket").applyInArrow(total, _ddl(_ANSWER)))
    scored = dealt.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(
        answer, f"id {key_type}, n_words long, log_score double, mean_log_score double")
    return scored.withColumnRenamed("id", key)
