"""Embedding near-duplicates and vector codes against brute force, and awkward tables."""

import math

import numpy as np
import pytest

from tidewatch.llm import multi_index, vector_codes
from tidewatch.llm.vector_codes import CellMemo

SCHEMA = "vec_id long, embedding array<float>, label int"


def clusters(rng, n, dim, noise):
    """Random vectors, a third of them near copies of one, some near copies of others, a few exact copies."""
    x = rng.normal(size=(n, dim))
    x[: n // 3] = x[0] + noise * rng.normal(size=(n // 3, dim))
    for k in range(n // 3, n // 2):
        x[k] = x[n - 1 - k % 7] + noise * rng.normal(size=dim)
    x[n // 2: n // 2 + 9] = x[n // 2]
    return x.astype(np.float32)


def brute(rows, least):
    """Number of links and least reachable id of each row, all pairs compared."""
    def usable(r):
        return r[2] is not None and r[1] is not None and len(r[1]) == 12 and all(v is not None and math.isfinite(v) for v in r[1]) and any(r[1])
    ok = [k for k, r in enumerate(rows) if usable(r)]
    near = {k: set() for k in range(len(rows))}
    for a in ok:
        for b in ok:
            if a < b and rows[a][2] == rows[b][2]:
                u, v = (np.array(rows[k][1], np.float32).astype(float) for k in (a, b))
                if u @ v / math.sqrt((u @ u) * (v @ v)) >= least:
                    near[a].add(b)
                    near[b].add(a)
    out = []
    for k, r in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((r[0], len(near[k]), min(ids) if ids else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    x = clusters(rng, 240, 12, 0.08)
    out = [(int(i), [float(v) for v in x[i]], int(i) % 2) for i in range(len(x))]
    same = out[5]
    odd = [(1000, None, 0), (1001, [0.0] * 12, 0), (1002, [float("nan")] * 12, 0), (1003, [None] + same[1][1:], 1), (1004, same[1], None), (1005, same[1], None), (1006, [], 0),
           (1007, [1.0, 2.0], 0), (1008, [1.0, 2.0], 0), (1009, [float("inf")] + same[1][1:], 1), same, same, (None, same[1], same[2]), (None, None, None), (5, out[6][1], 0), (1010, [-v for v in same[1]], 1)]
    return out + odd


@pytest.mark.parametrize("blocks", [False, True])
def test_links_equal_brute_force(spark, rows, monkeypatch, blocks):
    if blocks:      # bins of few vectors, so that the large cells are cut into blocks
        monkeypatch.setattr(multi_index, "packed", lambda arrivals, limit=16, f=multi_index.packed: f(arrivals, limit))
        monkeypatch.setattr(multi_index, "CHUNK", 8)
    got = multi_index.link_vectors(spark.createDataFrame(rows, SCHEMA), target_recall=1.0).collect()
    assert sorted([(r.vec_id, r.n_links, r.component_id) for r in got], key=str) == brute(rows, 0.93)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_links_with_clashing_columns_strings_and_empty(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    more = df.select("*", *(F.lit("x").alias(c) for c in ("id", "vec", "k1", "k2", "size", "cell", "n", "c", "to", "copies", "none", "least_id", "own", "bin")))
    want = sorted(map(tuple, multi_index.link_vectors(df).collect()), key=str)
    assert sorted(map(tuple, multi_index.link_vectors(more).collect()), key=str) == want
    named = df.withColumn("label", F.concat(F.lit("l"), F.col("label").cast("string")))
    assert sorted(map(tuple, multi_index.link_vectors(named).collect()), key=str) == want
    none = multi_index.link_vectors(df.limit(0))
    assert none.columns == ["vec_id", "n_links", "component_id", "kept"] and none.count() == 0
    assert multi_index.link_vectors(df.filter("embedding IS NULL")).count() == 2


def test_traversal_is_nearest_first_and_exact_at_full_reach():
    rng = np.random.default_rng(5)
    x = multi_index.unit(rng.normal(size=(400, 16)))
    index = multi_index.fit(x, np.zeros(400), 6, target_recall=1.0)
    own, row, cell = index.visits(x)
    wide = len(index.books[1])
    (a, la), (b, lb) = index.bounds(x)
    for r in range(0, 400, 37):
        score = la[r][:, None] ** 2 + lb[r][None] ** 2
        want = {i * wide + j for i, j in zip(*np.nonzero(score <= index.reach**2 + 1e-9), strict=True) if i * wide + j >= own[r]}
        visited = cell[row == r]
        assert set(visited) == want
        steps = [score[c // wide, c % wide] for c in visited]
        assert steps == sorted(steps)
    # a bound never exceeds the distance to a point in the cell
    d = ((x[:, None, :8] - x[None, :, :8]) ** 2).sum(axis=2)
    assert (la[:, a].ravel() ** 2 <= d.ravel() + 1e-9).all()


def test_recall_at_the_least_cosine():
    """Partners at exactly the least cosine that the fit has not seen are met at about the target rate."""
    rng = np.random.default_rng(9)
    x = multi_index.unit(rng.normal(size=(6000, 64)))
    index = multi_index.fit(x[:3000], np.zeros(3000), 12)
    q = x[3000:]
    aside = rng.normal(size=q.shape)
    aside -= (aside * q).sum(axis=1, keepdims=True) * q
    y = 0.93 * q + math.sqrt(1 - 0.93**2) * aside / np.linalg.norm(aside, axis=1, keepdims=True)
    assert (index.needed(q, y) <= index.reach).mean() > 0.99
    assert index.reach < math.sqrt(2 - 2 * 0.93)


def test_bins():
    bins, blocks = multi_index.packed(np.array([5, 5, 20, 0, 3, 45, 1]), 10)
    assert bins.tolist() == [0, 0, 1, 1, 2, 3, 4] or bins.tolist() == [0, 0, 1, 2, 2, 3, 4]
    assert blocks[bins[2]] == 2 and blocks[bins[5]] == 5 and blocks[0] == 1


@pytest.mark.parametrize("width", [1, 7, 32, 500])
def test_memo_finds_the_nearest_entry(width):
    rng = np.random.default_rng(width)
    book = rng.integers(-60, 60, size=(40, 5))
    book[7] = book[3]                                   # a tie goes to the lower index
    memo = CellMemo(book, width, limit=50)              # small: starts anew many times
    parts = np.concatenate([rng.integers(-80, 80, size=(300, 5)), book, book])
    best, distance = memo.nearest(parts)
    d = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
    assert (best == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()
    again, _ = memo.nearest(parts)
    assert (again == best).all()


def test_memo_is_used_and_prunes():
    rng = np.random.default_rng(1)
    book = rng.integers(-400, 400, size=(256, 8))
    memo = CellMemo(book)
    parts = np.repeat(rng.integers(-400, 400, size=(50, 8)), 40, axis=0)
    memo.nearest(parts)
    assert memo.entered == 50 and memo.asked == 2000 and memo.compared < 2000 * 256 / 4


def lloyd_by_rows(rows, parts, entries, rounds):
    """The contract, one row and one entry at a time."""
    kept = sorted((r for r in rows if r[1] and all(v is not None and math.isfinite(v) for v in r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    q = [[math.floor(1024 * v) for v in r[1]] for r in kept]
    w = len(q[0]) // parts
    piece = [[v[p * w:(p + 1) * w] for p in range(parts)] for v in q]
    books = [[piece[i][p] for i in range(min(entries, len(q)))] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in piece:
                groups.setdefault(nearest(v[p], books[p])[1], []).append(v[p])
            for e, g in groups.items():
                books[p][e] = [sum(c) // len(g) for c in zip(*g, strict=True)]
    out = []
    for r, v in zip(kept, piece, strict=True):
        found = [nearest(v[p], books[p]) for p in range(parts)]
        out.append([r[0], r[2], "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)])
    totals = {}
    for o in out:
        totals[o[1]] = totals.get(o[1], 0) + o[3]
    return sorted([(*o, totals[o[1]]) for o in out], key=str), books


def test_codes_equal_a_plain_version(spark, rows):
    rows = [r for r in rows if r[1] is None or len(r[1]) == 12]
    coded, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA), parts=3, entries=20, rounds=3)
    want, want_books = lloyd_by_rows([(r[0], None if r[1] is None else [None if v is None else float(np.float32(v)) for v in r[1]], r[2]) for r in rows], 3, 20, 3)
    assert books.tolist() == want_books
    assert sorted(map(tuple, coded.select("id", "label", "code", "error", "label_error").collect()), key=str) == want


def test_codes_of_few_odd_and_no_rows(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    few, books = vector_codes.compress(df.filter("vec_id < 3"))
    assert books.shape == (4, 3, 3) and [r.error for r in few.collect()] == [0, 0, 0]
    none, books = vector_codes.compress(df.limit(0))
    assert none.columns == ["id", "label", "code", "error", "label_error"] and none.count() == 0 and books.shape[1] == 0
    odd, _ = vector_codes.compress(df)           # vectors of another length are dropped
    assert odd.count() == sum(1 for r in rows if r[1] and len(r[1]) == 12 and all(v is not None and math.isfinite(v) for v in r[1]))
    with pytest.raises(ValueError):
        vector_codes.compress(df, parts=5)


def test_codes_with_clashing_columns(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    more = df.select("*", *(F.lit("x").alias(c) for c in ("id", "q", "v", "code", "error", "of", "part", "n", "s0")))
    a, books = vector_codes.compress(df)
    b, other = vector_codes.compress(more)
    assert (books == other).all() and sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
