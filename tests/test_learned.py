"""Learned factors, stored networks, signed hashes and the baseline's own scoring."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.functions.keys import murmur3_32, signed_hashes, stable_hash_bucket, summed_hashes
from tidewatch.operators import factors as fac
from tidewatch.operators import models as mdl
from tidewatch.operators.network import EmbeddingNetwork, load_network, network_from_tables


def murmur(data: bytes, seed: int = 0) -> int:
    """The public algorithm, on Python's integers."""
    m, h = 0xFFFFFFFF, seed

    def mix(k):
        k = k * 0xCC9E2D51 & m
        k = (k << 15 | k >> 17) & m
        return k * 0x1B873593 & m

    for i in range(0, len(data) // 4 * 4, 4):
        h ^= mix(int.from_bytes(data[i:i + 4], "little"))
        h = ((h << 13 | h >> 19) & m) * 5 + 0xE6546B64 & m
    if len(data) % 4:
        h ^= mix(int.from_bytes(data[len(data) // 4 * 4:], "little"))
    h ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ h >> shift) * factor & m
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def test_murmur_and_signed_hashes(spark):
    assert murmur(b"hello") == 613153351                     # a published value
    words = ["", "a", "ab", "abc", "abcd", "日本語", "é" * 9, None] + ["x" * n for n in range(5, 60, 7)]
    d = spark.createDataFrame([(w, words[i - 1]) for i, w in enumerate(words)], "s string, t string")
    for r in d.select("s", murmur3_32("s").alias("h")).collect():
        assert r.h == (None if r.s is None else murmur(r.s.encode()))
    for buckets in (3, 2 ** 18):
        for r in d.select("s", "t", summed_hashes(signed_hashes(["s", "t"], buckets, ["col_0", "col_1"])).alias("e")).collect():
            want = {}
            for name, v in (("col_0", r.s), ("col_1", r.t)):
                if v is not None:
                    h = murmur(f"{name}={v}".encode())
                    want[abs(h) % buckets] = want.get(abs(h) % buckets, 0.0) + (1.0 if h >= 0 else -1.0)
            assert [(x["index"], x.value) for x in r.e] == sorted(want.items())


def test_hashes_are_computed_once_a_row(spark):
    """The work of a row's hashes: whole words go to one built-in hash whatever the key's length, and summing them by index names each key's hash once."""
    d = spark.createDataFrame([("x" * 200, "y")], "s string, t string")
    plan = d.select(summed_hashes(signed_hashes(["s", "t"], 8)).alias("e"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("hash(") == 2 and "sequence(" not in plan


def test_murmur_with_seeds(spark):
    words = ["", "a", "abcd", "abcdefg", "é日", "z" * 64, None]
    d = spark.createDataFrame([(w,) for w in words], "s string")
    for seed in (1, 42, 2 ** 31 + 5):
        assert [r.h for r in d.select(murmur3_32("s", seed).alias("h")).collect()] == [None if w is None else murmur(w.encode(), seed) for w in words]


def _rows(spark, n=1500):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(n):
        e, f, x = int(rng.integers(0, 12)), int(rng.integers(0, 6)), float(rng.normal())
        z = -1.5 + 0.8 * x + (2.0 if e % 3 == f % 3 else -1.0)          # an interaction of the keys
        rows.append((i, f"e{e}", f"f{f}", x, None if i % 50 == 0 else float(rng.normal()), "a" if i % 3 else None, int(rng.random() < 1 / (1 + np.exp(-z)))))
    return spark.createDataFrame(rows, "id long, entity_key string, fingerprint_key string, x double, u double, cat string, y int")


def test_gradient_equals_differences():
    rng = np.random.default_rng(0)
    theta = rng.normal(0, 0.5, size=(1 + 3 + 7, 1 + 4))
    theta[0, 1:] = 0
    x, slots = rng.normal(size=(40, 3)), np.c_[rng.integers(4, 8, 40), rng.integers(8, 11, 40)]
    slots[::5, 1] = -1
    y, w = rng.integers(0, 2, 40).astype(float), rng.uniform(0.5, 3, 40)
    loss, g = fac.gradient(theta, x, slots, y, w)
    for r, c in [(0, 0), (1, 0), (2, 3), (3, 4), (5, 0), (6, 2), (9, 1), (10, 4)]:
        t = theta.copy()
        t[r, c] += 1e-6
        assert (fac.gradient(t, x, slots, y, w)[0] - loss) / 1e-6 == pytest.approx(g[r, c], rel=1e-3, abs=1e-4)


def test_gradient_of_packed_blocks(spark):
    """Packed rows give the sums of the rows themselves, with slots that repeat, are missing, or are all missing in a block; every row is packed once."""
    rng = np.random.default_rng(3)
    n = 2 * fac.BLOCK + 17
    x, slots, y, w = rng.normal(size=(n, 2)), np.c_[rng.integers(-1, 4, n) + 3, rng.integers(7, 9, n)], rng.integers(0, 2, n).astype(float), rng.uniform(1, 2, n)
    slots[slots[:, 0] == 2, 0] = -1
    slots[:fac.BLOCK, 1] = -1
    theta = rng.normal(0, 0.3, size=(9, 3))
    theta[0, 1:] = 0
    rows = pd.DataFrame({"x": [*x], "slots": [*slots], "y": y, "w": w})
    d = spark.createDataFrame(rows, "x array<double>, slots array<int>, y double, w double").coalesce(1)
    blocks = d.mapInArrow(fac._packed, fac._BLOCKS).cache()
    assert [r.n for r in blocks.select("n").collect()] and blocks.agg(F.sum("n")).first()[0] == n and blocks.agg(F.max("n")).first()[0] <= fac.BLOCK
    got = blocks.mapInArrow(fac._partial(theta), "slot int, g0 double, g1 double, g2 double").groupBy("slot").agg(*[F.sum(f"g{k}") for k in range(3)]).collect()
    loss, g = fac.gradient(theta, x, slots, y, w)
    plain = np.zeros_like(theta)
    p = 1 / (1 + np.exp(-fac.forward(theta, x, slots)[0]))
    for i in range(n):
        for s in slots[i][slots[i] >= 0]:
            plain[s, 0] += w[i] * (p[i] - y[i])
    assert g[3:, 0] == pytest.approx(plain[3:, 0])
    for r in got:
        assert (r[1] == pytest.approx(loss)) if r.slot < 0 else ([*r[1:]] == pytest.approx(g[r.slot].tolist(), abs=1e-9))
    assert {r.slot for r in got} == {-1, *range(9)} - set(range(3, 9)).difference(slots.ravel().tolist())


def test_lbfgs_finds_the_minimum():
    a = np.diag([1.0, 10.0, 100.0])
    t, g, steps = fac.lbfgs(lambda v: (float(0.5 * (v.ravel() @ a @ v.ravel()) - v.sum()), (a @ v.ravel()).reshape(v.shape) - 1), np.zeros((3, 1)), fac.FactorConfig(max_iter=100))
    assert t.ravel() == pytest.approx([1, 0.1, 0.01], abs=1e-5) and np.abs(g).max() < 1e-6 and steps < 60


def test_factors_learn_an_interaction_and_stop_early(spark):
    d = _rows(spark)
    train, valid = d.filter("id < 1000"), d.filter("id >= 1000")
    cfg = fac.FactorConfig(factors=4, max_iter=60, penalty=0.01, patience=3, check_every=3, buckets={"entity_key": 1024, "fingerprint_key": 64})
    m = fac.fit_factors(train, valid, "y", ["x", "u"], cfg=cfg)
    best = max(ap for _, ap in m.history)
    assert best > 0.6 and len(m.history) - [ap for _, ap in m.history].index(best) <= 4 + 1 and m.steps <= 60
    scored = m.transform(valid)
    assert scored.columns == [*valid.columns, "logit", "score"] and scored.count() == valid.count()
    from tidewatch.operators.metrics import binary_metrics
    assert binary_metrics(scored, "y", "score").first().avg_precision == pytest.approx(best, abs=1e-6)     # joins and columns equal the tasks' numpy
    linear = mdl.fit_baseline(train, "y", ["x", "u"], keys=["entity_key", "fingerprint_key"]).transform(valid)
    assert binary_metrics(linear, "y", "score").first().avg_precision < best
    odd = spark.createDataFrame([(1, "never seen", None, None, float("nan"), None, 0)], d.schema)
    r = m.transform(odd).first()
    assert np.isfinite(r.logit) and 0 < r.score < 1


def test_baseline_scores_equal_its_definition(spark):
    d = _rows(spark, 400)
    m = mdl.fit_baseline(d, "y", ["x", "u"], ["cat"], ["entity_key", "fingerprint_key"])
    hashed = {r["index"]: r.weight for r in m.hashed.collect()}
    rows = m.prepared(d).collect()
    got = {r.id: r.logit for r in m.transform(d).collect()}
    for r in rows:
        z = m.intercept + float(np.dot(m.weights, r._dense))
        for k in ("entity_key", "fingerprint_key"):
            h = murmur(f"{k}={r[k]}".encode())
            z += (1 if h >= 0 else -1) * hashed.get(abs(h) % 2 ** 18, 0.0)
        assert got[r.id] == pytest.approx(z, abs=1e-9)


def test_network_artefact(spark, tmp_path):
    rng = np.random.default_rng(1)
    ev = {b: rng.normal(size=3).tolist() for b in range(8)}
    fv = {b: rng.normal(size=2).tolist() for b in range(1, 4)}                # bucket 0 has no vector
    dense = [(rng.normal(size=(7, 5)), rng.normal(size=5)), (rng.normal(size=(5, 1)), rng.normal(size=1))]
    table = lambda t: spark.createDataFrame(list(t.items()), "bucket int, vec array<double>")
    net = network_from_tables(["a", "b"], {"a": (1.0, 2.0), "b": (0.0, 0.5)}, {"entity_key": 8, "fingerprint_key": 4}, {"entity_key": table(ev), "fingerprint_key": table(fv)},
                              {"entity_key": 3, "fingerprint_key": 2}, dense)
    net.save(str(tmp_path / "net"))
    again = load_network(spark, str(tmp_path / "net"))
    df = spark.createDataFrame([(i, f"e{i}", None if i == 3 else f"f{i}", "x" if i == 2 else str(i / 2), None if i == 4 else float(i)) for i in range(12)],
                               "id long, entity_key string, fingerprint_key string, a string, b double")
    place = {r.id: (r.e, r.f) for r in df.select("id", stable_hash_bucket("entity_key", 8).alias("e"), stable_hash_bucket("fingerprint_key", 4).alias("f")).collect()}
    rows = {r.id: r for r in again.logits(df, temperature=2.0).collect()}
    for r in df.collect():
        a = 0.0 if r.a == "x" else (float(r.a) - 1) / 2
        v = np.array([a, 0.0 if r.b is None else r.b / 0.5, *ev[place[r.id][0]], *fv.get(place[r.id][1], [0.0, 0.0])])
        z = float((np.maximum(v @ dense[0][0] + dense[0][1], 0) @ dense[1][0] + dense[1][1])[0]) / 2
        assert rows[r.id].logit == pytest.approx(z, abs=1e-9) and rows[r.id].score == pytest.approx(1 / (1 + np.exp(-z)))
    with pytest.raises(ValueError, match="b"):
        again.logits(df.drop("b"))
    with pytest.raises(ValueError, match="layer"):
        EmbeddingNetwork(["a"], {}, {}, {"entity_key": 8}, {"entity_key": 3}, again.embeddings, dense)
    from pyspark.errors import AnalysisException
    with pytest.raises(AnalysisException):
        load_network(spark, str(tmp_path / "missing"))


def test_tree_scores_are_the_models(spark):
    """Boosted trees as a column expression: Spark ML's probability on rows at, below and above every threshold; a missing input goes the way of NaN."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(400, 2)), 1)
    rows = [(float(a), float(b), float(a * b + rng.normal() * 0.2 > 0)) for a, b in x]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    assemble = VectorAssembler(inputCols=["a", "b"], outputCol="features", handleInvalid="keep")
    model = GBTClassifier(featuresCol="features", labelCol="y", maxIter=4, maxDepth=3, seed=1).fit(assemble.transform(df))
    nan = float("nan")
    more = df.unionByName(spark.createDataFrame([(nan, 0.3, 0.0), (0.1, nan, 0.0), (nan, nan, 0.0)], df.schema))
    got = mdl.tree_scores(model.transform(assemble.transform(more)), model, ["a", "b"]).select(vector_to_array("probability")[1].alias("p"), "score").collect()
    assert len(got) == 403 and max(abs(r.p - r.score) for r in got) < 1e-12
    assert len({round(r.p, 6) for r in got}) > 5
    pairs = spark.createDataFrame([(0, nan, 0.3), (0, None, 0.3), (1, nan, nan), (1, None, None)], "k int, a double, b double")
    both = mdl.tree_scores(pairs, model, ["a", "b"]).groupBy("k").agg({"score": "min"}).collect()
    assert sorted(r[1] for r in both) == sorted(r[1] for r in mdl.tree_scores(pairs, model, ["a", "b"]).groupBy("k").agg({"score": "max"}).collect())
    assert mdl.tree_scores(pairs.limit(0), model, ["a", "b"]).count() == 0


def test_valid_rows_are_scored_once_for_each_grid_point(spark, monkeypatch):
    """Average precision reads the scores twice; they are written, so the trees run over the rows once."""
    written = []
    real = mdl.scratch_table
    monkeypatch.setattr(mdl, "scratch_table", lambda df, name, *a: written.append((name, df.columns)) or real(df, name, *a))
    d = _rows(spark, 300)
    _, params, ap, _ = mdl.fit_nonlinear(d.filter("id < 200"), d.filter("id >= 200"), "y", ["x", "u"], grid=({"maxDepth": 2}, {"maxDepth": 3}), rounds=2)
    assert written == [("valid-scores", ["_y", "p"])] * 2 and params and 0 < ap <= 1


def test_median_scaler_of_missing_columns(spark):
    """Deviations of the imputed columns in one pass; a column without any value has no row."""
    from tidewatch.operators import prep

    d = spark.createDataFrame([(1.0, None, 5.0), (3.0, None, 5.0), (None, None, 5.0), (float("nan"), None, None)], "a double, b double, c double")
    got = {r.feature: (r["median"], r.scale) for r in prep.fit_median_scaler(d, ["a", "b", "c"]).collect()}
    assert got == {"a": (2.0, pytest.approx(np.std([1, 3, 2, 2]))), "c": (5.0, 1.0)}
    assert prep.fit_median_scaler(d, ["b"]).count() == 0
