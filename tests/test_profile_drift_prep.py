import random

import pytest
from pyspark.sql import functions as F

from tidewatch.config import DriftConfig
from tidewatch.functions.exprs import coerce_long
from tidewatch.functions.keys import stable_hash_bucket
from tidewatch.operators import drift as drf
from tidewatch.operators import prep
from tidewatch.operators import profile as prof
from tidewatch.operators.schema import split_valid


def test_merge_multiplies_and_coverage(spark):
    tx = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "TransactionID long, amt double")
    idn = spark.createDataFrame([(1, "iOS"), (1, "Mac"), (3, None)], "TransactionID long, DeviceInfo string")
    m = prof.merge_on_transaction_id(tx, idn)
    assert m.count() == 4
    assert prof.identity_coverage(m).first()[0] == pytest.approx(50.0)


def test_duplicates_keep_first(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 5, "c"), (None, 1, "x"), (None, 2, "y")],
                               "TransactionID long, o int, v string")
    assert prof.duplicate_count(df).first()[0] == 2
    out = {r.TransactionID: r.v for r in prof.drop_duplicates_keep_first(df, "TransactionID", ["o"]).collect()}
    assert out == {1: "a", 2: "c", None: "x"}


def test_coercion(spark):
    df = spark.createDataFrame([("86400",), ("86400.0",), ("x",), (None,), ("1.5",)], "s string")
    assert [r[0] for r in df.select(coerce_long(F.col("s"))).collect()] == [86400, 86400, None, None, None]


def test_md5_bucket_matches_python(spark):
    import hashlib
    keys = ["", "A||B||C||D||1", "x" * 100]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for b in (2 ** 20, 2 ** 18, 1000003):
        got = [r[0] for r in df.select(stable_hash_bucket("k", b)).collect()]
        assert got == [int(hashlib.md5(k.encode()).hexdigest(), 16) % b for k in keys]


def test_constraints_quarantine(spark):
    df = spark.createDataFrame([(10.0, 1.0, "k", "f"), (-1.0, 1.0, "k", "f"), (5.0, -2.0, None, "f")],
                               "TransactionAmt double, cnt_1h double, entity_key string, fingerprint_key string")
    ok, bad = split_valid(df, {"TransactionAmt": "gt0", "cnt_1h": "ge0", "entity_key": "required"})
    assert ok.count() == 1 and bad.count() == 2
    assert sorted(bad.orderBy(F.desc("TransactionAmt")).first().violations) == ["cnt_1h:ge0", "entity_key:required"]


def test_top_categories_and_missing(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "ProductCD string")
    t = {(r.value, r["count"]) for r in prof.top_categories(df, ["ProductCD"], 2).collect()}
    assert t == {("b", 2), ("<NA>", 1)}
    assert prof.missing_pct(df).first().missing_pct == 25.0


def _ks_brute(a, b):
    vals = sorted(set(a) | set(b))
    return max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in vals)


def test_ks_no_drift_vs_drift(spark):
    rng = random.Random(1)
    a = [rng.random() for _ in range(800)]
    b = [rng.random() for _ in range(700)]
    c = [rng.random() + 0.2 for _ in range(700)]
    ref = spark.createDataFrame([(x,) for x in a], "f double")
    same = drf.ks_drift(ref, spark.createDataFrame([(x,) for x in b], "f double"), DriftConfig(features=("f",))).first()
    shift = drf.ks_drift(ref, spark.createDataFrame([(x,) for x in c], "f double"), DriftConfig(features=("f",))).first()
    assert same.ks_statistic == pytest.approx(round(_ks_brute(a, b), 4)) and not same.drift_detected
    assert shift.drift_detected and shift.p_value < 0.05
    w = drf.wasserstein(ref, spark.createDataFrame([(x,) for x in c], "f double"), ["f"]).first()
    assert 0.15 < w.wasserstein < 0.25


def test_standardizer_and_weights(spark):
    df = spark.createDataFrame([(1.0, 1), (3.0, 0), (None, 0), (5.0, 0)], "x double, y int")
    st = prep.fit_standardizer(df, ["x"]).first()
    assert st.x__mean == 3.0 and st.x__std == pytest.approx((8 / 3) ** 0.5)
    t = [r.x for r in prep.transform_numeric(df, prep.fit_standardizer(df, ["x"]), ["x"]).collect()]
    assert t[2] == 0.0
    w = prep.class_weights(df, "y").first()
    assert w.pos_weight == 3.0 and w.w_pos == 2.0
    const = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert prep.fit_standardizer(const, ["x"]).first().x__std == 1.0


def test_psi_js_and_quality(spark):
    rng = random.Random(2)
    ref = spark.createDataFrame([(rng.random(),) for _ in range(2000)], "f double")
    same = spark.createDataFrame([(rng.random(),) for _ in range(2000)], "f double")
    moved = spark.createDataFrame([(rng.random() * 0.5,) for _ in range(2000)], "f double")
    p0 = drf.psi_js(ref, same, ["f"]).first()
    p1 = drf.psi_js(ref, moved, ["f"]).first()
    assert p0.psi < 0.05 < p1.psi and 0 <= p0.js_divergence < p1.js_divergence
    dq = {r.side: r for r in drf.data_quality(ref, moved, ["f"]).collect()}
    assert dq["reference"]["count"] == 2000 and dq["current"].max <= 0.5 and dq["reference"].p50 == pytest.approx(0.5, abs=0.05)
