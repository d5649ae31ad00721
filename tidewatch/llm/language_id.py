"""Language identification: sparse multinomial logistic regression on TF-IDF character
n-grams, trained by follow-the-regularised-leader with elastic-net penalties, then
temperature calibration.

Features: the lower-cased text with every run of non-letters as one space; n-grams of 1 to
3 characters hashed into a table; (1 + log count) x idf, scaled to length 1. FTRL-proximal
keeps one step size for each weight, and its L1 part leaves weights of rare n-grams at
exactly zero. The temperature is fitted on a part of the sample that the weights haven't
seen.

Training rows are a bounded sample (``SAMPLE_PER_LANGUAGE`` rows of each language, chosen by
a hash of the id), featurised by Spark tasks and fitted on the driver; only their n-gram
counts go there. Scoring runs over whole texts in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import id_and_text, map_arrow

#: bound on the labelled rows that the classifier is fitted on
SAMPLE_PER_LANGUAGE = 800
BUCKETS = 1 << 15
UNKNOWN = "und"
#: a long text is folded into its counts in parts of so many characters
PART = 1 << 18

_tables: dict[str, np.ndarray] = {}


def letter_codes() -> np.ndarray:
    """For each code point itself if it is a letter, else 0."""
    if "letters" not in _tables:
        t = np.zeros(0x110000, np.uint32)
        letters = [i for i in range(0x110000) if not 0xD800 <= i < 0xE000 and chr(i).isalpha()]
        t[letters] = letters
        _tables["letters"] = t
    return _tables["letters"]


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams of a whole text; None if it has no letter."""
    if not text:
        return None
    table, total, tail = letter_codes(), np.zeros(BUCKETS, np.int64), np.zeros(1, np.uint32)
    text = text.lower()
    seen = False
    for at in range(0, len(text), PART):
        c = table[np.frombuffer(text[at:at + PART].encode("utf-32-le", "replace"), np.uint32)]
        seen = seen or bool(c.any())
        c = np.concatenate([tail, c])
        k = len(tail)  # characters that the last part has counted already
        new = np.arange(len(c)) >= k
        keep = np.ones(len(c), bool)
        keep[1:] = (c[1:] != 0) | (c[:-1] != 0)
        c, new = c[keep], new[keep]
        h = c.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for n in (1, 2, 3):
            if len(c) >= n:
                g = h[n - 1:].copy()
                for j in range(1, n):
                    g = g + h[n - 1 - j:len(h) - j] * np.uint64((0, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)[j])
                g ^= g >> np.uint64(29)
                g = (g * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(49)
                total += np.bincount(g[new[n - 1:]].astype(np.int64), minlength=BUCKETS)
        tail = c[-2:]
    return total if seen else None


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, index: np.ndarray, count: np.ndarray) -> np.ndarray:
        v = (1.0 + np.log(count)) * self.idf[index]
        return v / max(float(np.sqrt(v @ v)), 1e-12)

    def logits(self, index: np.ndarray, count: np.ndarray) -> np.ndarray:
        return self.vector(index, count) @ self.weights[index] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = ngram_counts(text)
        if counts is None or not self.languages:
            return UNKNOWN, 0.0
        index = np.flatnonzero(counts)
        p = softmax(self.logits(index, counts[index]) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_languages: int, idf: np.ndarray, languages: list[str], alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-4, epochs: int = 4, seed: int = 7) -> LanguageModel:
    """FTRL-proximal over (indices, counts, class) rows."""
    z = np.zeros((BUCKETS + 1, n_languages))
    n = np.zeros_like(z)
    m = LanguageModel(languages, idf, np.zeros((BUCKETS, n_languages)), np.zeros(n_languages))

    def solve(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    rng = np.random.default_rng(seed)
    vectors = [(np.r_[i, BUCKETS], np.r_[m.vector(i, c), 1.0], y) for i, c, y in rows]
    for _ in range(epochs):
        for k in rng.permutation(len(vectors)):
            i, v, y = vectors[k]
            zi, ni = z[i], n[i]
            w = solve(zi, ni)
            p = softmax(v @ w)
            p[y] -= 1.0
            g = v[:, None] * p
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[i] = zi + g - sigma * w
            n[i] = ni + g * g
    w = solve(z, n)
    m.weights, m.bias = np.ascontiguousarray(w[:BUCKETS]), w[BUCKETS]
    return m


def fit_temperature(m: LanguageModel, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> float:
    """Temperature with the least negative log likelihood, by a golden-section search on its logarithm."""
    if not rows:
        return 1.0
    z, y = np.array([m.logits(i, c) for i, c, _ in rows]), np.array([k for _, _, k in rows])

    def loss(log_t: float) -> float:
        s = z / np.exp(log_t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    lo, hi, r = -3.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def sampled(labelled: DataFrame, label_col: str, id_col: str, per_label: int) -> DataFrame:
    """About ``per_label`` rows of each label, by a hash of the id (more only where rows share an id). The labels and their
    counts, a row for each, go through the driver."""
    sizes = {r[0]: r[1] for r in labelled.groupBy(label_col).count().collect()}
    share: Column = F.lit(0.0)
    for label, size in sorted(sizes.items()):
        share = F.when(F.col(label_col) == label, F.lit(min(1.0, per_label / size))).otherwise(share)
    u = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    return labelled.filter(u < share)


def fit(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel:
    """Fit on rows with a text and a language. Without any, the model calls every text unknown."""
    labelled = train.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), F.col(lang_col).cast("string").alias("__lang")).filter("__text is not null and __lang is not null")
    rows = sampled(labelled, "__lang", "__id", per_language)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for key, text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                counts = ngram_counts(text)
                if counts is not None:
                    index = np.flatnonzero(counts)
                    out.append((str(key), lang, index.astype(np.int32), np.minimum(counts[index], 2**31 - 1).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.string()), pa.array([x[2] for x in out], pa.list_(pa.int32())), pa.array([x[3] for x in out], pa.list_(pa.int32()))], names=["key", "lang", "index", "n"])

    # the bound for shared ids comes after the features, so that no task gathers texts
    bound = 2 * per_language * max(1, labelled.select("__lang").distinct().count())
    got = sorted(map_arrow(rows, features, "key string, lang string, index array<int>, n array<int>").limit(bound).toArrow().to_pylist(), key=lambda r: (r["key"], r["lang"]))
    languages = sorted({r["lang"] for r in got})
    data = [(np.array(r["index"], np.int64), np.array(r["n"], np.float64), languages.index(r["lang"])) for r in got]
    df = np.zeros(BUCKETS)
    for i, _, _ in data:
        df[i] += 1
    idf = np.log((1.0 + len(data)) / (1.0 + df)) + 1.0
    if not data:
        return LanguageModel([], idf, np.zeros((BUCKETS, 0)), np.zeros(0))
    order = np.random.default_rng(11).permutation(len(data))
    held = [data[k] for k in order[: len(data) // 5]]
    model = fit_ftrl([data[k] for k in order[len(data) // 5:]], len(languages), idf, languages)
    model.temperature = fit_temperature(model, held)
    return model


def predict(df: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Language of every text: ``id_col``, ``lang_pred``, ``score`` (calibrated probability).

    Null texts and texts without a letter get ``und`` and 0.0. Ties go to the first
    language in alphabetical order. Repeated rows each give a row; other columns are left
    out; an empty table gives an empty result. No shuffle.
    """
    src = id_and_text(df, id_col, text_col)
    light = LanguageModel(model.languages, model.idf.astype(np.float32), model.weights.astype(np.float32), model.bias, model.temperature)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [light.predict(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=[id_col, "lang_pred", "score"])

    return map_arrow(src, run, f"`{id_col}` {src.schema['__id'].dataType.simpleString()}, lang_pred string, score double")


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id's text (of none for null), modulo ``modulus``: fixes the folds."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % modulus


def keep_identified(df: DataFrame, model: LanguageModel, min_score: float, text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, whose text has a language at a score of at least ``min_score``. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index(text_col)).to_pylist()
            got = [model.predict(t) for t in texts]
            yield b.filter(pa.array([lang != UNKNOWN and score >= min_score for lang, score in got], pa.bool_()))

    return map_arrow(df, run, df.schema)
