"""Near-duplicate documents by ProbMinHash, banding and verification.

A document is the set of its shingles of five words with weights (1 + log of how often
each occurs). Every shingle sends points of a Poisson process, at the rate of its weight,
to registers chosen by its hash; a register keeps the earliest point's shingle. A shingle
stops as soon as its next point is later than the latest register, so long texts cost
little more than one point for each shingle. Two documents agree in a register with the
probability Jaccard similarity of their weighted shingles.

Exact copies are collapsed first. Bands of registers make buckets. In a bucket all members
are compared with one pivot, then with a second one, and buckets that still hold different
classes are compared in blocks: a task gets two blocks of a bucket, bounds the similarity
of all their pairs by matrix products, verifies the pairs that the bound leaves, and
returns links only. So a bucket of copies costs a comparison for each member, no pair of
different classes is left out, and pairs are never rows of a table. Candidates are
verified by the exact probability Jaccard similarity of their shingles, and verified
pairs joined to classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import fresh, id_and_text, map_arrow, stage_table

WORDS = 5
SIMILARITY = 0.8
#: 25 bands of 5 registers: a pair at the least similarity is missed with probability 5e-5
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
#: members of an open bucket in a block
BLOCK = 200
#: shingles in a matrix product at once
SLICE = 4096
#: rows of a table of keys (about 30 bytes each) that may be broadcast
BROADCAST_ROWS = 2_000_000

_G = np.uint64(0x9E3779B97F4A7C15)
_PAD = np.uint64(0x5851F42D4C957F2D)
_MIX = tuple(np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * _MIX[0]
    z = (z ^ (z >> np.uint64(27))) * _MIX[1]
    return z ^ (z >> np.uint64(31))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")


def word_hashes(words: Column) -> tuple[Column, Column]:
    """Two halves of the hash of the words."""
    digest = F.md5(F.array_join(words, " "))
    return tuple(F.conv(F.substring(digest, at, 15), 16, 10).cast("long") for at in (1, 16))


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``__id``, two halves of the hash of the words (``k1``, ``k2``), and the words' hashes ``h``."""
    src = id_and_text(df, id_col, text_col).select("__id", words_of(F.coalesce("__text", F.lit(""))).alias("__w"))
    k1, k2 = word_hashes(F.col("__w"))
    return src.select("__id", k1.alias("k1"), k2.alias("k2"), "__w").select("__id", "k1", "k2", F.transform("__w", lambda w: F.xxhash64(w)).alias("h"))


def shingles(flat: np.ndarray, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct shingle hashes (sorted) and their counts for each document, from the hashes of its words.
    A document of fewer words than a shingle, but not none, is one shingle."""
    padded = np.where(sizes > 0, np.maximum(sizes, WORDS), 0)
    if (padded != sizes).any():
        out = np.full(int(padded.sum()), _PAD)
        starts = np.cumsum(padded) - padded
        at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)
        out[at] = flat
        flat = out
    if not len(flat):
        return [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * len(sizes)
    n = len(flat) - WORDS + 1
    g = np.zeros(n, np.uint64)
    for j in range(WORDS):
        g = (g ^ (g >> np.uint64(32))) * _MIX[j] + flat[j:j + n]
    g = _mix(g)
    ends = np.cumsum(padded)
    return [np.unique(g[e - p:e - WORDS + 1], return_counts=True) if p else (np.zeros(0, np.uint64), np.zeros(0, np.int64)) for e, p in zip(ends, padded, strict=True)]


def weights(counts: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(counts)


def signatures(docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Registers (documents x ``REGISTERS``) of weighted shingles; zeros for a document without any."""
    n, m = len(docs), REGISTERS
    time = np.full(n * m, np.inf)
    kept = np.zeros(n * m, np.uint64)
    doc = np.repeat(np.arange(n), [len(h) for h, _ in docs])
    if not len(doc):
        return kept.reshape(n, m)
    key = np.concatenate([h for h, _ in docs])
    gap = 1.0 / weights(np.concatenate([c for _, c in docs]))
    at = np.zeros(len(doc))
    done, block = 0, 1
    while len(doc):
        steps = np.arange(done + 1, done + block + 1, dtype=np.uint64)
        z = _mix(key[:, None] + steps * _G)
        point = at[:, None] + np.cumsum(-np.log(((z >> np.uint64(24)).astype(np.float64) + 0.5) * 2.0**-40), axis=1) * gap[:, None]
        register = ((z & np.uint64(0xFFFFFF)) * np.uint64(m)) >> np.uint64(24)
        place = (doc[:, None] * m + register.astype(np.int64)).ravel()
        x = point.ravel()
        better = x < time[place]
        place, x, who = place[better], x[better], np.repeat(key, block)[better]
        np.minimum.at(time, place, x)
        won = x == time[place]
        kept[place[won]] = who[won]
        latest = time.reshape(n, m).max(axis=1)
        at = point[:, -1]
        on = at <= latest[doc]
        doc, key, gap, at = doc[on], key[on], gap[on], at[on]
        done, block = done + block, 2 if done == 0 else 16
    return kept.reshape(n, m)


def band_keys(registers: np.ndarray) -> np.ndarray:
    parts = registers.reshape(len(registers), BANDS, ROWS)
    g = np.arange(1, BANDS + 1, dtype=np.uint64) * _G
    for j in range(ROWS):
        g = _mix(g ^ parts[:, :, j]) + _MIX[j]
    return g.astype(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard similarity of two documents (sorted hashes, counts), exactly: the sum over common
    shingles d of 1 / sum over all e of max(a[e] / a[d], b[e] / b[d])."""
    every = np.union1d(a[0], b[0])
    wa, wb = np.zeros(len(every)), np.zeros(len(every))
    wa[np.searchsorted(every, a[0])] = weights(a[1])
    wb[np.searchsorted(every, b[0])] = weights(b[1])
    with np.errstate(divide="ignore"):
        ratio = wa / wb
    order = np.argsort(ratio, kind="stable")
    wa, wb, ratio = wa[order], wb[order], ratio[order]
    from_here = wa.sum() - np.r_[0.0, np.cumsum(wa)[:-1]]
    before = np.r_[0.0, np.cumsum(wb)[:-1]]
    both = (wa > 0) & (wb > 0)
    return float((1.0 / (from_here[both] / wa[both] + before[both] / wb[both])).sum())


def _lists(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return col.flatten().to_numpy(zero_copy_only=False), np.diff(col.offsets.to_numpy())


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        flat, sizes = _lists(b.column(3))
        keys = band_keys(signatures(shingles(flat.view(np.uint64), sizes)))
        offsets = np.r_[0, np.cumsum(np.where(sizes > 0, BANDS, 0))].astype(np.int32)
        bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[sizes > 0].ravel()))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), bands], names=["__id", "k1", "k2", "bands"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        flat, sizes = _lists(b.column(1))
        docs = shingles(flat.view(np.uint64), sizes)
        offsets = pa.array(np.r_[0, np.cumsum([len(h) for h, _ in docs])].astype(np.int32))
        h = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([x for x, _ in docs]).view(np.int64)))
        n = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([x for _, x in docs]).astype(np.int32)))
        yield pa.RecordBatch.from_arrays([b.column(0), h, n], names=["r", "s", "n"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cols = [_lists(b.column(k)) for k in (2, 3, 4, 5)]
        ends = [np.cumsum(size) for _, size in cols]
        docs = [[flat[e - s:e] for s, e in zip(size, end, strict=True)] for (flat, size), end in zip(cols, ends, strict=True)]
        ok = np.array([similarity((sa.view(np.uint64), na), (sb.view(np.uint64), nb)) >= SIMILARITY for sa, na, sb, nb in zip(*docs, strict=True)], bool)
        yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(ok)), b.column(1).filter(pa.array(ok))], names=["a", "b"])


def bounds(a: list[tuple[np.ndarray, np.ndarray]], b: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """An upper bound of the similarity of each document of ``a`` to each of ``b``.

    With U and V the shares of two documents' weight on shingles that the other lacks, each
    common shingle adds at most the harmonic mean of its shares over 1 + U and 1 + V, and
    so all of them at most the harmonic mean of (1 - U) / (1 + U) and (1 - V) / (1 + V)."""
    docs = [*a, *b]
    row = np.repeat(np.arange(len(docs)), [len(h) for h, _ in docs])
    share = np.concatenate([weights(c) / weights(c).sum() for _, c in docs])
    _, col, often = np.unique(np.concatenate([h for h, _ in docs]), return_inverse=True, return_counts=True)
    shared = often[col] > 1
    number = np.cumsum(often > 1) - 1
    row, share, col = row[shared], share[shared].astype(np.float32), number[col[shared]]
    order = np.argsort(col, kind="stable")
    row, share, col = row[order], share[order], col[order]
    of_a, of_b = np.zeros((len(a), len(b)), np.float32), np.zeros((len(a), len(b)), np.float32)
    for start in range(0, int(often.size), SLICE):
        at, end = np.searchsorted(col, [start, start + SLICE])
        if at == end:
            break
        p = np.zeros((len(docs), SLICE), np.float32)
        p[row[at:end], col[at:end] - start] = share[at:end]
        has = (p > 0).astype(np.float32)
        of_a += p[:len(a)] @ has[len(a):].T
        of_b += has[:len(a)] @ p[len(a):].T
    x, y = of_a / (2 - of_a), of_b / (2 - of_b)
    return 2 * x * y / np.maximum(x + y, 1e-9)


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between different classes in two blocks of a bucket, one for each pair of classes."""
    first, second = rows.i.iloc[0], rows.j.iloc[0]
    left = rows[rows.own == first]
    right = rows[rows.own == second]
    found: dict[tuple[int, int], tuple[int, int]] = {}
    if left.c.nunique() + right.c.nunique() > 1 and len(left) and len(right):
        docs = [[(np.asarray(s, np.int64).view(np.uint64), np.asarray(n, np.int64)) for s, n in zip(part.s, part.n, strict=True)] for part in (left, right)]
        may = bounds(*docs) >= SIMILARITY - 1e-4
        may &= left.c.to_numpy()[:, None] != right.c.to_numpy()[None, :]
        for x, y in zip(*np.nonzero(may), strict=True):
            key = (left.c.iloc[x], right.c.iloc[y])
            if key not in found and similarity(docs[0][x], docs[1][y]) >= SIMILARITY:
                found[key] = (left.r.iloc[x], right.r.iloc[y])
    return pd.DataFrame({"a": [v[0] for v in found.values()], "b": [v[1] for v in found.values()]}, dtype="int64")


def settled(open_: DataFrame, features: DataFrame) -> DataFrame:
    """Verified links (``a``, ``b``) between all members of open buckets (``band``, ``r``, ``c``) that are in different classes."""
    blocks = open_.groupBy("band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    each = open_.join(blocks, "band").withColumn("own", F.pmod(F.xxhash64("r", F.lit("block")), F.col("blocks")).cast("int"))
    each = each.withColumn("with", F.explode_outer(F.sequence(F.lit(0), F.col("blocks") - 1)))
    each = each.select("band", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "r", "c").join(features, "r")
    return each.groupBy("band", "i", "j").applyInPandas(_block, "a long, b long")


def verified(pairs: DataFrame, features: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) whose documents are similar. A hot document on one side is left to adaptive skew joins."""
    one = features.select(F.col("r").alias("a"), F.col("s").alias("sa"), F.col("n").alias("na"))
    two = features.select(F.col("r").alias("b"), F.col("s").alias("sb"), F.col("n").alias("nb"))
    return map_arrow(pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "na", "sb", "nb"), _verify, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """Least node (``to``) of the component of each node (``c``) of the edges (``a``, ``b``), by spreading least
    labels and following them; every round is written, nothing goes to the driver but a count of changes."""
    both = stage_table(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("c")).agg(F.least(F.min("b"), F.min("a")).alias("to"))
    labels = stage_table(labels, "labels")
    while True:
        near = both.join(labels.select(F.col("c").alias("b"), F.col("to").alias("t")), "b").groupBy(F.col("a").alias("c")).agg(F.min("t").alias("t"))
        step = labels.join(near, "c", "left").select("c", F.col("to").alias("old"), F.least("to", F.coalesce("t", "to")).alias("to"))
        # follow the label of the label
        jump = labels.select(F.col("c").alias("to"), F.col("to").alias("t"))
        step = stage_table(step.join(jump, "to", "left").select("c", "old", F.least("to", F.coalesce("t", "to")).alias("to")), "labels")
        labels = step.select("c", "to")
        if step.filter("old <> to").isEmpty():
            return labels


def _sized(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def stage_sized(df: DataFrame, name: str) -> DataFrame:
    """A table of keys, written, and broadcast if its counted rows stay under the bound."""
    return _sized(stage_table(df, name))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Class of every row of ``docs``: ``id_col``, ``class_id`` (the least id in the class), ``copies`` (rows in the
    class) and ``is_first`` (true for one row of each class).

    Documents are in one class if a chain of links joins them: equal words, or a similarity
    of 0.8 or more. A text without words, or null, is a class of its own. Repeated rows are
    copies of each other; other columns are left out; an empty table gives an empty result.
    """
    return classified(docs, id_col, text_col).drop("k1", "k2")


def classified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """:func:`near_duplicates` with the two hashes of each row's words (null where it has none)."""
    sketched = map_arrow(keyed(docs, id_col, text_col), _sketch, f"__id {docs.schema[id_col].dataType.simpleString()}, k1 long, k2 long, bands array<long>")
    every = stage_table(sketched.withColumn("r", F.monotonically_increasing_id()), "sketches")
    some = every.filter(F.size("bands") > 0)
    texts = stage_table(some.groupBy("k1", "k2").agg(F.min("r").alias("r")), "texts")
    banded = every.select("r", "bands").join(texts.select("r"), "r").select("r", F.explode_outer("bands").alias("band"))
    banded = stage_table(banded, "bands")
    buckets = banded.groupBy("band").agg(F.count("*").alias("n"), F.min("r").alias("first")).filter("n > 1").drop("n")
    members = stage_table(banded.join(buckets, "band"), "members")
    candidates = stage_table(texts.join(members.select("r").distinct(), "r"), "candidates")
    wanted = keyed(docs, id_col, text_col).join(_sized(candidates), ["k1", "k2"]).select("r", "h")
    features = stage_table(map_arrow(wanted, _features, "r long, s array<long>, n array<int>").dropDuplicates(["r"]), "features")

    classes = candidates.select("r", F.col("r").alias("c"))
    for step in ("first", "other", "rest"):
        here = members.join(classes, "r")
        if step == "first":
            pairs = here.filter("r <> first").select(F.col("first").alias("a"), F.col("r").alias("b"))
        else:
            open_ = here.groupBy("band").agg(F.min("c").alias("least"), F.max(F.struct("c", "r")).alias("top")).filter("least <> top.c")
            left = here.select("band", "r", "c").join(open_, "band")
            pairs = left.filter("c <> top.c").select(F.least("r", "top.r").alias("a"), F.greatest("r", "top.r").alias("b"))
        if step == "rest":
            links = settled(stage_table(left.select("band", "r", "c"), "open"), features)
        else:
            links = verified(stage_table(pairs.distinct(), "pairs"), features)
        ends = classes.select(F.col("r").alias("a"), F.col("c").alias("ca")), classes.select(F.col("r").alias("b"), F.col("c").alias("cb"))
        links = stage_table(links.join(ends[0], "a").join(ends[1], "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")).filter("a <> b").distinct(), "links")
        if not links.isEmpty():
            merged = components(links)
            classes = stage_table(classes.join(merged, "c", "left").select("r", F.coalesce("to", "c").alias("c")), "classes")

    of_text = texts.join(classes, "r", "left").select("k1", "k2", F.coalesce("c", "r").alias("c"))
    of_row = stage_table(some.select("__id", "r", "k1", "k2").join(of_text, ["k1", "k2"]).select("__id", "r", "k1", "k2", "c"), "rows")
    heads = of_row.groupBy("c").agg(F.min(F.struct("__id", "r")).alias("head"), F.count("*").alias("copies"))
    out = of_row.join(heads, "c").select(F.col("__id").alias(id_col), F.col("head.__id").alias("class_id"), "copies", (F.col("r") == F.col("head.r")).alias("is_first"), "k1", "k2")
    alone = every.filter(F.size("bands") == 0).select(F.col("__id").alias(id_col), F.col("__id").alias("class_id"), F.lit(1).cast("long").alias("copies"), F.lit(True).alias("is_first"), F.lit(None).cast("long").alias("k1"), F.lit(None).cast("long").alias("k2"))
    return out.unionByName(alone)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each class, all columns. Rows with the same id and the same words are one document;
    rows with the same id and other words are documents of their own."""
    found = classified(docs, id_col, text_col).select(F.col(id_col).alias("id"), "k1", "k2", "is_first")
    found = stage_table(found.groupBy("id", "k1", "k2").agg(F.max("is_first").alias("stays"), F.count("*").alias("n")), "kept")
    name = {c: fresh(f"__{c}", docs) for c in ("id", "k1", "k2")}
    once = found.filter("n > 1").isEmpty() and found.groupBy("id").count().filter("count > 1").isEmpty()
    if once:        # ids name the rows
        gone = _sized(found.filter(~F.col("stays")).select(F.col("id").alias(name["id"])))
        return docs.join(gone, docs[id_col].eqNullSafe(F.col(name["id"])), "left_anti")
    gone = _sized(found.filter(~F.col("stays")).select(*[F.col(c).alias(n) for c, n in name.items()]))
    own = {c: fresh(n + "_own", docs) for c, n in name.items()}
    k1, k2 = word_hashes(words_of(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    marked = docs.withColumn(own["k1"], k1).withColumn(own["k2"], k2)
    same = F.col(id_col).eqNullSafe(F.col(name["id"]))
    for c in ("k1", "k2"):
        same = same & (F.col(own[c]) == F.col(name[c]))
    return marked.join(gone, same, "left_anti").dropDuplicates([id_col, own["k1"], own["k2"]]).drop(own["k1"], own["k2"])
