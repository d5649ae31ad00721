import math
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tidewatch.llm import probminhash as P


def naive(a, b):
    wa = {k: 1 + math.log(v) for k, v in a.items()}
    wb = {k: 1 + math.log(v) for k, v in b.items()}
    every = wa.keys() | wb.keys()
    return sum(1 / sum(max(wa.get(e, 0) / wa[d], wb.get(e, 0) / wb[d]) for e in every) for d in wa.keys() & wb.keys())


def bag(text):
    w = [x for x in re.split("[\x20\x09-\x0D]+", (text or "").lower()) if x]
    return Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def classes(texts):
    bags, parent = [bag(t) for _, t in texts], list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            common = len(bags[i].keys() & bags[j].keys())
            if common and common >= 0.5 * max(len(bags[i]), len(bags[j])) and naive(bags[i], bags[j]) >= 0.8:
                parent[root(i)] = root(j)
    out = defaultdict(list)
    for k in range(len(texts)):
        out[root(k)].append(texts[k][0])
    return sorted(tuple(sorted(v, key=lambda x: (x is not None, x))) for v in out.values())


def test_estimator_and_exact_similarity():
    r = np.random.default_rng(1)
    off = []
    for _ in range(30):
        pool, k = np.sort(r.integers(0, 2**63, 300).astype(np.uint64)), int(r.integers(150, 300))
        a, b = (pool[:k], r.integers(1, 5, k)), (pool[300 - k:], r.integers(1, 5, k))
        exact = P.similarity(a, b)
        assert abs(exact - naive(dict(zip(*a)), dict(zip(*b)))) < 1e-9
        s = P.signatures([a, b])
        assert (s == np.concatenate([P.signatures([a]), P.signatures([b])])).all()
        off.append((s[0] == s[1]).mean() - exact)
    assert abs(np.mean(off)) < 0.03 and np.std(off) < 0.1


def test_bound_is_one():
    r = np.random.default_rng(5)
    pool = np.sort(r.integers(0, 2**63, 300).astype(np.uint64))
    pick = lambda: (lambda i: (pool[i], r.integers(1, 6, len(i))))(np.sort(r.choice(300, int(r.integers(50, 300)), replace=False)))
    a, b = [pick() for _ in range(12)], [pick() for _ in range(9)]
    b[0] = a[0]
    got = P.bounds(a, b)
    exact = np.array([[P.similarity(x, y) for y in b] for x in a])
    assert (got >= exact - 1e-5).all() and abs(got[0, 0] - 1) < 1e-5


def test_classes_equal_brute_force(spark, docs, clashing, empty, texts):
    got = P.near_duplicates(clashing).toPandas()
    by = defaultdict(list)
    ids = got.doc_id.astype("Int64").fillna(-99).tolist()
    for i, c in zip(ids, got.class_id.astype("Int64").fillna(-99).tolist()):
        by[c].append(i)
    alone = [i for i, t in texts if not bag(t)]
    want = classes([(-99 if i is None else i, t) for i, t in texts])
    assert sorted(tuple(sorted(v)) for v in by.values()) == want
    assert got.is_first.sum() == len(want) and len(alone) >= 3
    assert P.near_duplicates(empty).count() == 0


def test_hot_group_and_chain(spark):
    """A large group of near copies, and a chain whose ends aren't similar, each end as one class; others stay alone."""
    base = [f"w{k}" for k in range(300)]
    rows = [(k, " ".join([*base[:k % 290], f"edit{k}", *base[k % 290:]])) for k in range(400)]
    step = [[f"c{j}" for j in range(8 * k, 8 * k + 200)] for k in range(6)]
    rows += [(1000 + k, " ".join(w)) for k, w in enumerate(step)]
    rows += [(2000 + k, " ".join(f"x{k}y{j}" for j in range(60)) + " " + " ".join(base[:20])) for k in range(50)]
    got = {r.doc_id: (r.class_id, r["copies"]) for r in P.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[k] for k in range(400)} == {(0, 400)}
    assert {got[1000 + k] for k in range(6)} == {(1000, 6)}
    assert all(got[2000 + k] == (2000 + k, 1) for k in range(50))


def test_open_buckets_are_settled(spark):
    """Members of one bucket that the pivots don't link are still compared: groups of similar texts in one band's bucket."""
    texts = [(k, f"{' '.join(f'g{k // 4}w{j}' for j in range(50))} tail{k}") for k in range(20)]
    one_bucket = pa_udf(lambda rows: [[7] * P.BANDS for _ in rows])
    original = P._sketch
    try:
        P._sketch = one_bucket
        got = {r.doc_id: r.class_id for r in P.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    finally:
        P._sketch = original
    assert got == {k: k // 4 * 4 for k in range(20)}


def pa_udf(bands):
    import pyarrow as pa

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(bands(b.column(0)), pa.list_(pa.int64()))], names=["__id", "k1", "k2", "bands"])

    return run


def test_keep_first(spark, docs):
    kept = P.keep_first(docs)
    assert kept.columns == docs.columns
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    n = len(classes([(-99 if i is None else i, t) for i, t in texts]))
    assert kept.count() == n
    assert kept.filter(F.col("doc_id") == -4).count() == 1
