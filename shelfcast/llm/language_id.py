"""Language identification with a string kernel.

The kernel of two texts is the blended-spectrum presence kernel: the number of distinct
byte n-grams (n = 1, 2, 3, of the lower-cased UTF-8 text) that both contain, divided by
the root of the product of their own numbers.  Nyström landmarks, a few texts per
language, span the feature space: with ``L`` the presence rows of the landmarks, the
feature map of a text with presence row ``x`` is ``k(x, L) K_mm^(-1/2)``; one ridge
regression per language (one versus the rest) is fitted on it.  The n-gram domain is what
the landmarks contain, so no n-gram is hashed.  As the kernel is linear in ``x``, the
product ``L' K_mm^(-1/2) W`` is formed once, and a batch of whole texts is scored by one
matrix product ``X V``.

The classifier is fitted on a bounded sample: about ``per_language`` texts of each
language, chosen by a hash of id and text over all learning rows.  Of a sampled text
longer than ``max_chars`` characters the fit takes ``max_chars`` from its first letter on.
Scoring covers whole texts of any length.

Defined results: NULL texts and texts without a letter give ``und`` with score 0; without
any learning row everything is ``und``; with one language that one is predicted with
score 1; rows with a NULL label are not learned from; ties go to the first language in
alphabetical order; repeated rows are scored one by one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDERS = (1, 2, 3)
PER_LANGUAGE = 300
LANDMARKS_PER_LANGUAGE = 64
MAX_CHARS = 20_000
#: Labels that are learned, the most frequent first.
MAX_LANGUAGES = 500
RIDGE = 1e-2
UNKNOWN = "und"
#: Texts and bytes marked in one presence matrix.
SLICE_TEXTS = 256
SLICE_BYTES = 1 << 20


@dataclass
class Model:
    languages: list[str]
    grams: list[np.ndarray] = field(default_factory=list)  # sorted codes of each order
    weights: np.ndarray | None = None  # n-grams x languages
    temperature: float = 1.0
    tables: list[np.ndarray] | None = None  # code -> column, built on each worker

    def __getstate__(self):
        return self.__dict__ | {"tables": None}

    def lookup(self) -> list[np.ndarray]:
        if self.tables is None:
            self.tables, at = [], 0
            for n, codes in zip(ORDERS, self.grams, strict=True):
                table = np.full(1 << (8 * n), -1, np.int32)
                table[codes] = np.arange(at, at + len(codes), dtype=np.int32)
                self.tables.append(table)
                at += len(codes)
        return self.tables


def _codes(data: np.ndarray, text_of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, text) of every n-gram that lies inside one text."""
    if len(data) < n:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    code = data[:len(data) - n + 1].astype(np.int32)
    for k in range(1, n):
        code <<= 8
        code |= data[k:len(data) - n + 1 + k]
    inside = text_of[:len(code)] == text_of[n - 1:]
    return code[inside], text_of[:len(code)][inside]


def _flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(texts), np.uint8)
    return data, np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])


def presence(data: np.ndarray, text_of: np.ndarray, n_texts: int, tables: list[np.ndarray], width: int) -> np.ndarray:
    """0/1 matrix: which n-grams of the domain each text contains."""
    marks = np.zeros((n_texts, width), np.float32)
    flat = marks.reshape(-1)
    for n, table in zip(ORDERS, tables, strict=True):
        code, text = _codes(data, text_of, n)
        column = table[code]
        known = column >= 0
        flat[text[known].astype(np.int64) * width + column[known]] = 1.0
    return marks


def _unit(marks: np.ndarray) -> np.ndarray:
    return marks / np.sqrt(np.maximum(marks.sum(1, keepdims=True), 1.0))


def fit_texts(texts: list[bytes], labels: list[str], per_landmark: int = LANDMARKS_PER_LANGUAGE, ridge: float = RIDGE) -> Model:
    """Kernel ridge regression on the Nyström features of a bounded list of texts."""
    languages = sorted(set(labels))
    model = Model(languages)
    if len(languages) < 2:
        return model
    y = np.array([languages.index(x) for x in labels])
    landmarks = np.concatenate([np.flatnonzero(y == c)[:per_landmark] for c in range(len(languages))])
    data, text_of = _flat([texts[i] for i in landmarks])
    model.grams = [np.unique(_codes(data, text_of, n)[0]) for n in ORDERS]
    width = sum(map(len, model.grams))
    tables = model.lookup()
    rows = np.concatenate([_unit(presence(*_flat(texts[a:a + SLICE_TEXTS]), len(texts[a:a + SLICE_TEXTS]), tables, width))
                           for a in range(0, len(texts), SLICE_TEXTS)])
    marks = rows[landmarks]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    phi = (rows @ marks.T) @ root
    target = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)
    balance = (1.0 / np.bincount(y))[y][:, None]  # every language weighs the same
    w = np.linalg.solve(phi.T @ (phi * balance) + ridge * np.eye(phi.shape[1]), phi.T @ (target * balance))
    model.weights = (marks.T @ (root @ w)).astype(np.float32)
    out = rows @ model.weights
    losses = []
    for t in (1.0, 2.0, 4.0, 8.0, 16.0):
        p = _softmax(out * t)[np.arange(len(y)), y]
        losses.append((-np.log(np.maximum(p, 1e-9)).mean(), t))
    model.temperature = min(losses)[1]
    return model


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(labelled: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id",
        per_language: int = PER_LANGUAGE, max_chars: int = MAX_CHARS, max_languages: int = MAX_LANGUAGES) -> Model:
    """Fit on a sample of ``labelled``: per language a share of its rows, by hash, that
    makes about ``per_language`` of them.  Of more than ``max_languages`` labels the most
    frequent ones are learned (ties by name), so a dirty label column ends nothing; texts of
    the others are given the nearest learned language."""
    rows = labelled.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(label).cast("string").alias("label")).filter(
        F.col("label").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # one row per learned language comes to the driver
    most = rows.groupBy("label").count().orderBy(F.col("count").desc(), "label").limit(max_languages)
    counts = {r["label"]: r["count"] for r in most.collect()}
    if not counts:
        return Model([])
    share = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, per_language / n)])
    draw = F.pmod(F.xxhash64("id", "text", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    window = F.when(F.char_length("text") <= max_chars, F.col("text")).otherwise(
        F.regexp_extract("text", rf"(?s)\p{{L}}.{{0,{max_chars - 1}}}", 0))
    taken = (rows.withColumn("draw", draw).filter(F.col("draw") < share[F.col("label")])
                 .select("label", "draw", F.lower(window).alias("text")).limit(3 * per_language * len(counts)).collect())
    taken = sorted(taken, key=lambda r: (r["draw"], r["label"], r["text"]))
    return fit_texts([r["text"].encode() for r in taken], [r["label"] for r in taken])


def predict(docs: DataFrame, model: Model, text: str = "text", name: str = "language") -> DataFrame:
    """All columns of ``docs`` plus a struct ``name(lang, score)`` (an input column of that
    name is replaced).  Other columns never reach the classifier; no row is shuffled."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c != name]

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, letter in batches:
            ok = letter.to_numpy(zero_copy_only=False)
            best, score = np.full(len(ok), -1), np.zeros(len(ok))
            if len(model.languages) == 1:
                best[ok], score[ok] = 0, 1.0
            elif model.languages:
                tables, width = model.lookup(), len(model.weights)
                for a, b in _slices(texts):
                    rows = np.flatnonzero(ok[a:b]) + a
                    if not len(rows):
                        continue
                    data, text_of = _flat([texts[int(i)].as_buffer().to_pybytes() for i in rows])
                    marks = presence(data, text_of, len(rows), tables, width)
                    out = (marks @ model.weights) / np.sqrt(np.maximum(marks.sum(1, keepdims=True), 1.0))
                    p = _softmax(out.astype(np.float64) * model.temperature)
                    best[rows], score[rows] = p.argmax(1), p.max(1)
            names = np.array([*model.languages, UNKNOWN], dtype=object)
            yield pa.StructArray.from_arrays([pa.array(names[best], pa.string()), pa.array(score)], ["lang", "score"])

    # only the text goes to the Python worker and only the answer comes back: a batch of whole rows,
    # each with its text twice, takes several times the memory.  "Nondeterministic": a filter
    # on the answer does not score the texts once more
    guess = F.arrow_udf(run, "lang string, score double").asNondeterministic()
    letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return docs.select(*kept, guess(F.lower(F.col(text)), letter).alias(name))


def _slices(texts: pa.Array):
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    group = (np.arange(len(size)) // SLICE_TEXTS << 32) + np.cumsum(size) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(size)]
    yield from ((a, b) for a, b in zip(edges, edges[1:], strict=False) if b > a)
