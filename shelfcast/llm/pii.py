"""Personal data by weak-supervision aggregation (DataFrame functions only).

1. Base spans: four patterns with validation (email, ip, card, phone).
2. Candidates: the base spans, and spans of further patterns that validation by whole
   match cannot see: numbers and phone numbers inside a longer failing match, and long
   mixed tokens (secrets).
3. Labelers vote on each candidate: strict format, checksum or plausibility, a gazetteer
   of field words before it, its surrounding characters, and the variety of its
   characters.  A vote is 1, 0 or NULL (abstains).
4. Expectation-maximisation over the counts of all vote patterns of the corpus estimates
   every labeler's reliability and each kind's prior (Beta priors keep an unused labeler
   at its start value).  The table of patterns is bounded by kinds x 3^labelers x
   lengths, whatever the input; it is all that reaches the driver.
5. A logistic span classifier (kind, votes, length class) is trained on the posteriors of
   all patterns and decides which candidates are added; base spans always stay, and an
   added span never overlaps a base span or an earlier added one.

Positions are code points, end exclusive.  A match list and its positions come from one
split and one extract per pattern; running sums are taken in blocks, so that a text with
very many matches stays cheap.  Patterns use possessive forms that match the same spans
as the plain ones without deep recursion on very long digit runs.

Defined results: NULL and empty texts have no spans; a number outside [0-9] digits is no
number; repeated rows get equal results; without any candidate nothing is trained and
only base spans are returned (there are none); an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import let
from shelfcast.sources.sinks import materialize

#: Kinds in their order of listing; the first four have base spans.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
_LOCAL = "A-Za-z0-9._%+-"
BASE_PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Wider patterns whose matches are candidates only.
WIDE_PATTERNS = {
    "card": r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+])\+?(?:[0-9]{1,3}[ -])?(?:\([0-9]{2,4}\)|[0-9]{3})[ -][0-9]{3,4}[ -][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{20,}+",
}
#: Texts without a match of these (cheap) patterns have none of the kind's pattern.
GUARDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]", "phone": r"[0-9]", "secret": r"[A-Za-z0-9_+/-]{20}"}
#: Gazetteers: words that introduce a value of the kind, and endings of host names.
FIELD_WORDS = {
    "email": ("mail", "e-mail", "email", "contact", "contacto", "kontakt", "courriel", "correo"),
    "ip": ("ip", "host", "address", "server", "adresse"),
    "card": ("card", "visa", "mastercard", "amex", "karte", "carte", "tarjeta", "credit"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "telefon", "handy", "appeler", "llame"),
    "secret": ("token", "key", "secret", "password", "passwd", "apikey", "api_key", "auth", "bearer"),
}
HOST_ENDINGS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "it", "nl", "ch", "at")
CONTEXT = 24
LABELERS = ("format", "check", "field", "edges", "variety")
#: Start of each labeler's chance to be right, held by this many pseudo-counts.
START = {"format": 0.8, "check": 0.97, "field": 0.95, "edges": 0.7, "variety": 0.9}
PSEUDO = 50.0
ACCEPT = 0.9
BLOCK = 256


# --- matches with positions -----------------------------------------------------------

def _prefix(x: Column) -> Column:
    """Exclusive running sums of a short array."""
    start = F.struct(F.lit(0).alias("s"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(x, start, lambda a, v: F.struct((a["s"] + v).alias("s"), F.concat(a["out"], F.array(a["s"])).alias("out")),
                       lambda a: a["out"])


def _running(x: Column) -> Column:
    """Exclusive running sums, in two levels of blocks."""
    def over(blocks):
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, v: a + v))
        return let(_prefix(totals), lambda base: F.flatten(F.transform(
            blocks, lambda b, j: F.transform(_prefix(b), lambda v: v + F.get(base, j)))))

    def cut(y):
        return F.transform(F.sequence(F.lit(1), F.size(y), F.lit(BLOCK)), lambda i: F.slice(y, i, F.lit(BLOCK)))

    return let(x, lambda y: let(cut(y), over))


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, value, before, after) of all non-overlapping matches."""
    def located(pieces):
        def both(hits):
            steps = F.transform(hits, lambda h, i: F.char_length(F.get(pieces, i)) + F.char_length(h))
            return let(_running(steps), lambda at: F.transform(hits, lambda h, i: F.struct(
                (F.get(at, i) + F.char_length(F.get(pieces, i))).alias("start"),
                (F.get(at, i) + F.char_length(F.get(pieces, i)) + F.char_length(h)).alias("end"),
                h.alias("value"), F.right(F.get(pieces, i), F.lit(CONTEXT)).alias("before"),
                F.substring(F.get(pieces, i + 1), 1, 1).alias("after"))))
        return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), both)
    return let(F.split(text, pattern, -1), located)


_NONE = "array<struct<start:int,end:int,value:string,before:string,after:string>>"


def _guarded(text: Column, kind: str, pattern: str) -> Column:
    guard = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(GUARDS[kind])
    if kind == "phone" and pattern == BASE_PATTERNS["phone"]:
        guard = F.contains(text, F.lit("+"))
    return F.when(guard & text.rlike(pattern), matches(text, pattern)).otherwise(F.array().cast(_NONE))


# --- validation -------------------------------------------------------------------------

def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn checksum of a short digit string."""
    n = F.char_length(digits)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + let(
        F.substr(digits, i, F.lit(1)).cast("int") * (F.lit(1) + (n - i) % 2), lambda d: F.when(d > 9, d - 9).otherwise(d)))
    return total % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """Whether a whole match of the kind's base pattern is one of its base spans."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: let(F.regexp_replace(p, "^0+", ""), lambda x: F.when(
            F.char_length(x) > 3, F.lit(False)).otherwise(F.when(x == "", F.lit(0)).otherwise(x.cast("int")) <= 255)))
    n = F.char_length(_digits(value))
    if kind == "card":
        return F.when(n.between(14, 19), let(_digits(value), luhn)).otherwise(F.lit(False))
    return n.between(10, 15)


# --- labelers ---------------------------------------------------------------------------

def _one(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def _votes(kind: str, s: Column) -> Column:
    """The labelers' votes on a candidate, in the order of LABELERS."""
    v = s["value"]
    form = {
        "email": v.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@([A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,}$"),
        "ip": v.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"),
        "card": v.rlike(r"^[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}$"),
        "phone": v.rlike(r"^\+?[0-9]{0,3}[ -]?\(?[0-9]{2,4}\)?[ -]?[0-9]{3,4}[ -]?[0-9]{3,4}$"),
        "secret": v.rlike("^[0-9a-fA-F]{32,}$") | v.rlike("^[A-Za-z0-9_+/-]{32,}$"),
    }[kind]
    check = {
        "email": F.lower(F.regexp_extract(v, r"\.([A-Za-z0-9-]+)$", 1)).isin(*HOST_ENDINGS),
        "ip": valid("ip", v) & ~v.rlike(r"^0"),
        "card": valid("card", v),
        "phone": F.char_length(_digits(v)).between(10, 15) & v.contains("+"),
        "secret": v.rlike("[0-9]") & v.rlike("[A-Za-z]") & (F.char_length(_digits(v)) * 8 >= F.char_length(v)),
    }[kind]
    words = "|".join(FIELD_WORDS[kind])
    field = F.when(F.lower(s["before"]).rlike(rf"(^|[^a-z])({words})[^a-z]{{0,8}}$"), F.lit(1))
    edges = (s["before"] == "") | s["before"].rlike(r"[^A-Za-z0-9]$")
    edges = edges & ~s["after"].rlike("^[A-Za-z0-9]")
    kinds_of_chars = F.size(F.array_distinct(F.split(_digits(v) if kind != "email" else v, "")))
    return F.array(_one(form), _one(check), field, _one(edges), F.when(kinds_of_chars < 4, F.lit(0)))


def _length_class(v: Column) -> Column:
    return F.least(F.floor(F.char_length(v) / 8), F.lit(8)).cast("int")


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``base`` spans, and further ``wide`` candidates that do not overlap
    them, each with its votes.  Spans are (kind index, start, end, votes, length class)."""
    t = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(F.col(key).alias("id"), *[_guarded(t, k, p).alias(f"b_{k}") for k, p in BASE_PATTERNS.items()],
                        *[_guarded(t, k, p).alias(f"w_{k}") for k, p in WIDE_PATTERNS.items()])

    def span(kind):
        return lambda s: F.struct(F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                  _votes(kind, s).alias("votes"), _length_class(s["value"]).alias("size"))

    def passes(kind):
        return lambda s: valid(kind, s["value"])

    base = F.concat(*[F.transform(F.filter(f"b_{k}", passes(k)), span(k)) for k in BASE_KINDS])
    wide = F.concat(*[F.transform(f"w_{k}", span(k)) for k in WIDE_PATTERNS])
    out = found.select("id", F.array_sort(base).alias("base"), F.array_sort(wide).alias("wide"))
    # base spans and wide candidates are merged by start; a wide one that overlaps its
    # neighbours among the base spans is dropped here
    return out.select("id", "base", F.when(F.size("wide") == 0, F.col("wide")).otherwise(_free(F.col("wide"), F.col("base"))).alias("wide"))


def _free(wide: Column, base: Column) -> Column:
    """Wide candidates that overlap no base span (each sees the furthest end of the base
    spans before it, and the next base start, in one pass over the merged list)."""
    tagged = F.array_sort(F.concat(
        F.transform(base, lambda s: F.struct(s["start"].alias("at"), F.lit(0).alias("wide"), s.alias("span"))),
        F.transform(wide, lambda s: F.struct(s["start"].alias("at"), F.lit(1).alias("wide"), s.alias("span")))))

    def sweep(merged):
        # furthest base end so far, and (from behind) the nearest base start still to come
        reach = _scan(F.transform(merged, lambda m: F.when(m["wide"] == 0, m["span"]["end"]).otherwise(F.lit(0))))
        ahead = F.reverse(_scan(F.reverse(F.transform(merged, lambda m: F.when(m["wide"] == 0, -m["at"]).otherwise(F.lit(-2**30))))))
        return let(reach, lambda r: let(ahead, lambda a: F.transform(F.filter(merged, lambda m, i: (m["wide"] == 1)
                   & (F.get(r, i) <= m["at"]) & (-F.get(a, i) >= m["span"]["end"])), lambda m: m["span"])))

    return let(tagged, sweep)


def _scan(x: Column) -> Column:
    """Running maxima, in two levels of blocks."""
    def top(b):
        start = F.struct(F.lit(-2**30).alias("m"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(b, start, lambda a, v: let(F.greatest(a["m"], v), lambda m: F.struct(
            m.alias("m"), F.concat(a["out"], F.array(m)).alias("out"))), lambda a: a["out"])

    def over(blocks):
        totals = F.transform(blocks, lambda b: F.array_max(b))
        return let(top(totals), lambda best: F.flatten(F.transform(blocks, lambda b, j: F.transform(
            top(b), lambda v: F.when(j > 0, F.greatest(v, F.get(best, j - 1))).otherwise(v)))))

    def cut(y):
        return F.transform(F.sequence(F.lit(1), F.size(y), F.lit(BLOCK)), lambda i: F.slice(y, i, F.lit(BLOCK)))

    return let(x, lambda y: let(cut(y), over))


# --- aggregation and classifier -----------------------------------------------------------

def expectation_maximisation(patterns: list[tuple[int, tuple, int]], rounds: int = 100) -> tuple[dict, dict]:
    """(posterior of each (kind, votes), reliabilities) from (kind, votes, count) rows.

    Two classes, votes independent given the class; a labeler has one chance to be right
    on either class, shared by all kinds; each kind has its own prior."""
    rel = {(x, c): START[x] for x in LABELERS for c in (0, 1)}
    prior = dict.fromkeys(range(len(KINDS)), 0.5)
    post: dict = {}
    for _ in range(rounds):
        for kind, votes, _n in patterns:
            log = math.log(prior[kind]) - math.log(1 - prior[kind])
            for x, v in zip(LABELERS, votes, strict=True):
                if v is not None:
                    yes = rel[x, 1] if v == 1 else 1 - rel[x, 1]
                    no = 1 - rel[x, 0] if v == 1 else rel[x, 0]
                    log += math.log(yes) - math.log(no)
            post[kind, votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, log))))
        old = dict(rel)
        for i, x in enumerate(LABELERS):
            for c in (0, 1):
                right = all_ = 0.0
                for kind, votes, n in patterns:
                    if votes[i] is not None:
                        w = n * (post[kind, votes] if c else 1 - post[kind, votes])
                        all_ += w
                        right += w * (votes[i] == c)
                rel[x, c] = min(0.999, max(0.5, (right + PSEUDO * START[x]) / (all_ + PSEUDO)))
        for k in prior:
            n = sum(m for kind, _, m in patterns if kind == k)
            s = sum(m * post[kind, votes] for kind, votes, m in patterns if kind == k)
            prior[k] = min(0.98, max(0.02, (s + 1) / (n + 2)))
        if max(abs(rel[k] - old[k]) for k in rel) < 1e-6:
            break
    return post, rel


def _names() -> list[str]:
    return (["one"] + [f"kind{k}" for k in range(len(KINDS))] + [f"{x}{v}" for x in LABELERS for v in (0, 1)]
            + [f"size{s}" for s in range(9)])


def _vector(kind: int, votes: tuple, size: int) -> list[float]:
    return ([1.0] + [float(kind == k) for k in range(len(KINDS))]
            + [float(votes[i] == v) for i in range(len(LABELERS)) for v in (0, 1)] + [float(size == s) for s in range(9)])


def train(spans: DataFrame) -> dict[str, float]:
    """Weights of the span classifier from all candidates (``base`` and ``wide``)."""
    rows = (spans.select(F.explode(F.concat("base", "wide")).alias("s"))
                 .groupBy(F.col("s.kind").alias("kind"), F.col("s.votes").alias("votes"), F.col("s.size").alias("size"))
                 .agg(F.count(F.lit(1)).alias("n")).collect())  # bounded: kinds x 3^labelers x 9 lengths
    cells = sorted(((r["kind"], tuple(r["votes"]), r["size"], r["n"]) for r in rows), key=str)
    if not cells:
        return dict.fromkeys(_names(), 0.0)
    by_votes: dict = {}
    for kind, votes, _, n in cells:
        by_votes[kind, votes] = by_votes.get((kind, votes), 0) + n
    post, _ = expectation_maximisation([(k, v, n) for (k, v), n in by_votes.items()])
    x = np.array([_vector(k, v, s) for k, v, s, _ in cells])
    y = np.array([post[k, v] for k, v, _, _ in cells])
    n = np.array([float(c[3]) for c in cells])
    w = np.zeros(x.shape[1])
    for _ in range(100):  # Newton steps of the weighted logistic loss with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (p - y)) + 0.1 * w
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-7:
            break
    return dict(zip(_names(), w.tolist(), strict=True))


def _probability(s: Column, w: dict[str, float]) -> Column:
    pick = lambda value, names: F.get(F.array(*[F.lit(w[x]) for x in names]), value)
    z = F.lit(w["one"]) + pick(s["kind"], [f"kind{k}" for k in range(len(KINDS))]) + pick(s["size"], [f"size{k}" for k in range(9)])
    for i, x in enumerate(LABELERS):
        z = z + F.coalesce(pick(F.get(s["votes"], F.lit(i)), [f"{x}0", f"{x}1"]), F.lit(0.0))
    return 1 / (1 + F.exp(-z))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """One row per document row: key, ``base`` and ``added`` arrays of (kind, start, end),
    each sorted by start and kind.  Texts are read once; candidates are checkpointed."""
    spans = materialize(candidates(docs, key, text))
    w = train(spans)
    chosen = F.array_sort(F.transform(
        F.filter("wide", lambda s: _probability(s, w) >= accept),
        lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    # of overlapping added spans the first stays
    start = F.struct(F.lit(0).alias("to"), F.array().cast("array<struct<start:int,kind:int,end:int>>").alias("out"))
    apart = F.aggregate(chosen, start, lambda a, s: F.when(s["start"] < a["to"], a).otherwise(
        F.struct(s["end"].alias("to"), F.concat(a["out"], F.array(s)).alias("out"))), lambda a: a["out"])
    base = F.array_sort(F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return spans.select(F.col("id").alias(key), base.alias("base"), apart.alias("added"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of an array of (start, kind, end), comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
