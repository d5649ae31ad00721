"""Toxicity scores: bags of subword embeddings, averaged into a linear softmax.

Every run of a few words of a text is a window. The character n-grams of a window (with the
marks of its words' starts and ends) index a table of hashed embeddings; their mean goes into a
linear softmax of two classes, and a text takes the highest score of its windows, so that
a few words count in a long text as in a short one, wherever they stand. Embeddings and the softmax are trained
together by Adagrad in numpy. Labels belong to whole texts: in each round the best window
of a toxic text counts as toxic, and the best and some other windows of a clean text as
clean. An unseen misspelling shares most n-grams, and so their vectors, with its word.

For two classes only the difference of the softmax rows matters, so the score of a window
is the mean over its n-grams of one number for each bucket; scoring uses that table, adds it
up by word, and takes windows as sums of neighbouring words.

Training rows are a bounded sample (``SAMPLE_TOXIC``, ``SAMPLE_CLEAN``, chosen by a hash of
the id); their n-gram ids go to the driver, where the model is fitted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import id_and_text, map_arrow

#: bounds on the labelled rows that the classifier is fitted on
SAMPLE_TOXIC, SAMPLE_CLEAN = 900, 1300
BUCKETS = 1 << 17
DIM = 16
NGRAMS = (3, 4, 5)
WINDOW_WORDS = 3
#: a long text is worked on in parts of about so many characters
PART = 1 << 18

_tables: dict[str, np.ndarray] = {}


def code_table() -> np.ndarray:
    """0 for what separates words (white space and punctuation), else the code point."""
    if "codes" not in _tables:
        t = np.arange(0x110000, dtype=np.uint32)
        t[[i for i in range(0x110000) if chr(i).isspace()]] = 0
        t[[ord(c) for c in "\0.,;:!?\"'()[]{}<>|#%&=/\\~`^_+-"]] = 0
        _tables["codes"] = t
    return _tables["codes"]


def word_ngrams(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each part of a text: n-gram buckets, and the word that each is in (from 0, in a part). Parts end at the end of a word."""
    text = text.lower()
    at = 0
    while at < len(text):
        end = at + PART
        if end < len(text):
            cut = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
            end = cut + 1 if cut > at else end
        c = code_table()[np.frombuffer((" " + text[at:end] + " ").encode("utf-32-le", "replace"), np.uint32)]
        at = end
        keep = np.ones(len(c), bool)
        keep[1:] = (c[1:] != 0) | (c[:-1] != 0)
        c = c[keep]  # one separator between words, one at each end
        if len(c) < 3:
            continue
        word = np.cumsum(c == 0)  # the number of the word that follows or holds the character, from 1
        h = c.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
        ids, where = [], []
        g = h
        for n in range(2, max(NGRAMS) + 1):
            if len(c) < n:
                break
            g = g[:-1] * np.uint64(0xBF58476D1CE4E5B9) + h[n - 1:]
            if n in NGRAMS:
                # inside one word with its marks: no separator but at the ends
                first = word[: len(c) - n + 1]
                inside = first == word[n - 1:] - (c[n - 1:] == 0)
                x = g[inside]
                x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
                ids.append((x >> np.uint64(64 - 17)).astype(np.int32))
                where.append(first[inside] - 1)
        ids, where = np.concatenate(ids), np.concatenate(where)
        if len(ids):
            yield ids, where


def windows(words: np.ndarray) -> np.ndarray:
    """Sums over every run of ``WINDOW_WORDS`` neighbours; over all of them where there are fewer."""
    n = len(words) - WINDOW_WORDS + 1
    if n < 1:
        return words.sum(keepdims=True) if len(words) else words
    return sum(words[k:k + n] for k in range(1, WINDOW_WORDS)) + words[:n]


@dataclass
class ToxicityModel:
    scores: np.ndarray  # for each bucket, the embedding times the difference of the softmax rows
    bias: float

    def logit(self, text: str | None) -> float | None:
        """Highest logit of the windows; None for a text without n-grams."""
        totals, counts = [], []
        for ids, where in word_ngrams(text or ""):
            total, n = np.bincount(where, weights=self.scores[ids]), np.bincount(where)
            totals.append(total[n > 0])
            counts.append(n[n > 0])
        if not totals:
            return None
        return float((windows(np.concatenate(totals)) / windows(np.concatenate(counts))).max()) + self.bias

    def score(self, text: str | None) -> float:
        z = self.logit(text)
        return 0.0 if z is None else float(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))


def grouped(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram buckets of a whole text by word, and how many each word has (words without any are left out)."""
    ids, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for i, w in word_ngrams(text or ""):
        ids.append(i[np.argsort(w, kind="stable")])
        n = np.bincount(w)
        sizes.append(n[n > 0].astype(np.int32))
    return np.concatenate(ids), np.concatenate(sizes)


def gradient(emb: np.ndarray, soft: np.ndarray, bias: float, own: np.ndarray, row: np.ndarray, n: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Gradient of the windows' weighted cross-entropy: buckets in them with the gradient of their embeddings, of the
    softmax difference and of the bias. ``own`` are the buckets of all windows, ``row`` the window each is in, ``n`` their sizes."""
    logit = np.bincount(row, weights=(emb[own] @ soft), minlength=len(n)) / n + bias
    g = (1.0 / (1.0 + np.exp(-np.clip(logit, -50, 50))) - y) * weight
    touched, inverse = np.unique(own, return_inverse=True)
    coef = np.bincount(inverse, weights=(g / n)[row], minlength=len(touched))
    return touched, coef[:, None] * soft, coef @ emb[touched], float(g.sum())


def fit_windows(texts: list[tuple[np.ndarray, np.ndarray, int]], rounds: int | None = None, rate: float = 0.5, l2: float = 1e-6, others: int = 3, seed: int = 5) -> ToxicityModel:
    """Train on (n-gram buckets by word, size of each word, label) of texts. By default there are as many rounds
    as make about 700 steps, 14 at least and 40 at most."""
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM))
    soft = rng.normal(0, 0.5, DIM)
    bias, emb_sq, soft_sq, bias_sq = 0.0, np.full(BUCKETS, 1e-8), 1e-8, 1e-8
    texts = [t for t in texts if len(t[0])]
    if not texts or len({t[2] for t in texts}) < 2:
        share = float(np.mean([t[2] for t in texts])) if texts else 0.0
        return ToxicityModel(np.zeros(BUCKETS, np.float32), 8.0 if share == 1.0 else -8.0)
    ids = np.concatenate([t[0] for t in texts])
    # a window is a run of neighbouring words of one text, so a run of n-grams; both are kept by their first place
    sizes = np.concatenate([t[1] for t in texts])
    word_at = np.r_[0, np.cumsum(sizes, dtype=np.int64)].astype(np.int32)
    wide = [max(1, len(t[1]) - WINDOW_WORDS + 1) for t in texts]
    starts = np.r_[0, np.cumsum(wide)]
    text_at = np.cumsum([len(t[1]) for t in texts]) - [len(t[1]) for t in texts]
    first = np.concatenate([np.arange(a, a + n, dtype=np.int32) for a, n in zip(text_at, wide, strict=True)])
    last = first + np.repeat([min(WINDOW_WORDS, len(t[1])) for t in texts], wide).astype(np.int32)
    begin, per = word_at[first], word_at[last] - word_at[first]
    label = np.array([t[2] for t in texts])
    if rounds is None:
        steps = (label.sum() + (1 + others) * (1 - label).sum()) / 128
        rounds = int(np.clip(700 / steps, 14, 40))
    for r in range(rounds):
        run = np.r_[0.0, np.cumsum(np.add.reduceat((emb @ soft).astype(np.float32)[ids], word_at[:-1]), dtype=np.float64)]
        z = (run[last] - run[first]) / per
        pick, y = [], []
        for k in range(len(texts)):
            a, b = starts[k], starts[k + 1]
            if r == 0:  # nothing is known yet: some windows of each text, with its label
                got = rng.integers(a, b, 6).tolist()
            elif label[k]:
                got = [a + int(z[a:b].argmax())]
            else:
                got = [a + int(z[a:b].argmax()), *rng.integers(a, b, others)]
            pick += got
            y += [label[k]] * len(got)
        pick, y = np.array(pick), np.array(y, np.float64)
        weight = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y) if r == 0 else np.ones(len(y))
        for part in np.array_split(rng.permutation(len(pick)), max(1, len(pick) // 128)):
            w = pick[part]
            n = per[w].astype(np.int64)
            at = np.repeat(begin[w], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            own, row = ids[at], np.repeat(np.arange(len(w)), n)
            touched, d_emb, d_soft, d_bias = gradient(emb, soft, bias, own, row, n, y[part], weight[part] / len(w))
            d_emb += l2 * emb[touched]
            emb_sq[touched] += (d_emb * d_emb).mean(axis=1)
            emb[touched] -= rate * d_emb / np.sqrt(emb_sq[touched])[:, None] * 0.2
            soft_sq += float((d_soft * d_soft).mean())
            soft -= rate * 0.2 * d_soft / np.sqrt(soft_sq)
            bias_sq += d_bias ** 2
            bias -= rate * d_bias / np.sqrt(bias_sq)
    return ToxicityModel((emb @ soft).astype(np.float32), float(bias))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", n_toxic: int = SAMPLE_TOXIC, n_clean: int = SAMPLE_CLEAN) -> ToxicityModel:
    """Fit on documents whose ids ``labels`` marks 0 or 1. The sample is drawn from the labels, so only a
    bounded table of ids is joined (broadcast) with the texts."""
    marked = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("label")).filter("__id is not null and label in (0, 1)")
    sizes = {r[0]: r[1] for r in marked.groupBy("label").count().collect()}
    u = F.pmod(F.xxhash64(F.col("__id").cast("string"), F.lit("toxic")), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("label") == 1, F.lit(n_toxic / max(1, sizes.get(1, 0)))).otherwise(F.lit(n_clean / max(1, sizes.get(0, 0))))
    marked = marked.filter(u < share).limit(2 * (n_toxic + n_clean))
    rows = id_and_text(docs, id_col, text_col).filter("__text is not null").join(F.broadcast(marked), "__id").select(F.col("__id").cast("string").alias("key"), "__text", "label")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for key, text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                ids, sizes = grouped(text)
                out.append((key, label, ids.tobytes(), sizes.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.binary()), pa.array([x[3] for x in out], pa.binary())], names=["key", "label", "ids", "sizes"])

    got = map_arrow(rows, features, "key string, label int, ids binary, sizes binary").toArrow()
    order = sorted(range(got.num_rows), key=list(zip(got.column("key").to_pylist(), got.column("label").to_pylist(), strict=True)).__getitem__)
    at = lambda name, k, kind: np.frombuffer(got.column(name)[k].as_buffer(), kind)
    return fit_windows([(at("ids", k, np.int32), at("sizes", k, np.int32), got.column("label")[k].as_py()) for k in order])


def score(df: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``score`` and ``predicted`` (1 from 0.5 on) of every whole text.

    Null texts and texts without words score 0.0. Repeated rows each give a row; other
    columns are left out; an empty table gives an empty result. No shuffle.
    """
    src = id_and_text(df, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = np.array([model.score(t) for t in b.column(1).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got), pa.array((got >= 0.5).astype(np.int32))], names=[id_col, "score", "predicted"])

    return map_arrow(src, run, f"`{id_col}` {src.schema['__id'].dataType.simpleString()}, score double, predicted int")
