import math
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.config import FeatureConfig
from tidewatch.operators import features as feat
from tidewatch.operators import frames as fr

STRATEGIES = [FeatureConfig(), FeatureConfig(hot_key_rows=1), FeatureConfig(strategy="frame")]


def _build(df, cfg):
    return feat.build_features(df, cfg).orderBy("TransactionID").collect()


@pytest.mark.parametrize("cfg", STRATEGIES, ids=["delta", "delta-chunked", "frame"])
def test_simple_transactions_by_hand(simple_tx, cfg):
    r = _build(simple_tx, cfg)
    assert [x.cnt_1h for x in r] == [1, 1, 1]            # half-open (t-1h, t]
    assert [x.cnt_24h for x in r] == [1, 2, 3]
    assert [x.mean_amt_7d_hist for x in r] == [0.0, 100.0, 150.0]
    assert [x.std_amt_7d_hist for x in r] == [0.0, 0.0, 50.0]
    assert r[0].z_amt_vs_7d is None and r[1].z_amt_vs_7d is None and r[2].z_amt_vs_7d == 0.0
    assert [x.fp_growth_ratio_24h_over_72h for x in r] == [1.0, 1.0, 1.0]


def test_keys_deterministic_and_distinct(multi_tx):
    k = feat.add_keys(multi_tx).select("TransactionID", "entity_key", "fingerprint_key").orderBy("TransactionID").collect()
    assert k[0].entity_key == k[1].entity_key == "A||||||||1"
    assert k[0].entity_key != k[2].entity_key
    assert k[0].fingerprint_key == "iOS||g.com||W"


def test_missing_key_columns(spark):
    df = spark.createDataFrame([(1, 0, 100.0)], "TransactionID long, TransactionDT long, TransactionAmt double")
    r = feat.add_keys(df).first()
    assert r.entity_key == "||||||||" and r.fingerprint_key == "||||"


def test_key_nulls_and_numeric_types(spark):
    df = spark.createDataFrame([(7, None, 361.0, None, None)], "card1 long, card2 double, card3 double, card5 double, addr1 double")
    assert feat.add_keys(df).first().entity_key == "7||||361.0||||"


def test_bad_schema_raises(spark):
    with pytest.raises(ValueError, match="Missing required column"):
        feat.build_features(spark.createDataFrame([(1,)], "foo int"))


@pytest.mark.parametrize("cfg", STRATEGIES, ids=["delta", "delta-chunked", "frame"])
def test_constant_amounts_give_null_z_never_inf(spark, simple_tx, cfg):
    df = simple_tx.withColumn("TransactionAmt", F.lit(100.0))
    for r in _build(df, cfg):
        assert r.z_amt_vs_7d is None or math.isfinite(r.z_amt_vs_7d)
        assert r.std_amt_7d_hist == 0.0


def test_rows_preserved_and_multi_entity(multi_tx):
    r = _build(multi_tx, FeatureConfig())
    assert len(r) == 4
    assert [x.cnt_24h for x in r] == [1, 2, 1, 2]
    assert all(0.0 <= x.fp_growth_ratio_24h_over_72h <= 1.0 for x in r)


@pytest.mark.parametrize("cfg", STRATEGIES, ids=["delta", "delta-chunked", "frame"])
def test_ties_fixture(spark, cfg):
    rows = [(i + 1, t, a) for i, (t, a) in enumerate([(0, 1.0), (3600, 2.0), (3600, 4.0), (3600, 8.0), (7199, 16.0), (7200, None)])]
    df = spark.createDataFrame([(i, t, a, 0, "k") for i, t, a in rows],
                               "TransactionID long, TransactionDT long, TransactionAmt double, isFraud int, card1 string")
    r = _build(df, cfg)
    assert [x.cnt_1h for x in r] == [1, 1, 2, 3, 4, 1]   # null amount counts 0; (3600, 7200] for the last row
    assert [x.sum_amt_1h for x in r] == [1.0, 2.0, 6.0, 14.0, 30.0, 16.0]


@pytest.mark.parametrize("cfg", STRATEGIES, ids=["delta", "delta-chunked", "frame"])
def test_old_history_uses_previous_amount(spark, cfg):
    d = 86400
    df = spark.createDataFrame([(1, 0, 10.0, 0, "k"), (2, 30 * d, 20.0, 0, "k"), (3, 31 * d, 40.0, 0, "k")],
                               "TransactionID long, TransactionDT long, TransactionAmt double, isFraud int, card1 string")
    r = _build(df, cfg)
    assert [x.mean_amt_7d_hist for x in r] == [0.0, 10.0, 15.0]
    assert [x.std_amt_7d_hist for x in r] == [0.0, 0.0, 5.0]


def _brute(rows, w, lagged=True):
    """Reference semantics by brute force: stable sort by (key, t, id); (t-w, t] up to own position."""
    out = {}
    by = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        by.setdefault(r[1], []).append(r)
    for k, seq in by.items():
        for i, r in enumerate(seq):
            win = [s for s in seq[: i + 1] if s[2] > r[2] - w]
            amts = [s[3] for s in win if s[3] is not None]
            prev = [seq[j - 1][3] if j > 0 else None for j in range(len(seq))]
            hist = [prev[j] for j in range(i + 1) if seq[j][2] > r[2] - 7 * 86400 and prev[j] is not None]
            mean = sum(hist) / len(hist) if hist else 0.0
            std = (sum((h - mean) ** 2 for h in hist) / len(hist)) ** 0.5 if hist else 0.0
            out[r[0]] = (len(amts), sum(amts), mean, std)
    return out


def test_random_tie_heavy_all_strategies_equal_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        key = rng.choice(["a", "b", "c"])
        t = rng.choice([0, 1800, 3600, 3601, 7200, 86400, 90000, 200000, 604800, 700000])
        amt = None if rng.random() < 0.1 else float(rng.randint(1, 50))
        rows.append((i, key, t, amt))
    df = spark.createDataFrame([(i, t, a, 0, k) for i, k, t, a in rows],
                               "TransactionID long, TransactionDT long, TransactionAmt double, isFraud int, card1 string")
    bf = _brute([(i, k, t, a) for i, k, t, a in rows], 3600)
    for cfg in STRATEGIES:
        got = {r.TransactionID: r for r in feat.build_features(df, cfg).collect()}
        for i, (c, s, m, sd) in bf.items():
            g = got[i]
            assert g.cnt_1h == c and abs(g.sum_amt_1h - s) < 1e-9, (cfg, i)
            assert abs(g.mean_amt_7d_hist - m) < 1e-9 and abs(g.std_amt_7d_hist - sd) < 1e-9, (cfg, i)


def test_hot_key_is_split_into_chunks(spark):
    # one key holds 90% of rows: with a small target it is chunked, results equal the plain frame
    rows = [(i, i * 37 % 50000, float(i % 13), "hot" if i % 10 else f"k{i % 7}") for i in range(2000)]
    df = spark.createDataFrame([(i, t, a, 0, k) for i, t, a, k in rows],
                               "TransactionID long, TransactionDT long, TransactionAmt double, isFraud int, card1 string")
    keyed = feat.add_keys(df)
    d, chunked = fr.with_order(keyed, "entity_key", "TransactionDT", ["TransactionID"], target_rows=100)
    assert chunked
    assert d.filter(F.col("entity_key").startswith("hot")).select("_chunk").distinct().count() > 5
    a = {r.TransactionID: r for r in feat.add_entity_time_features(keyed, FeatureConfig(hot_key_rows=100)).collect()}
    b = {r.TransactionID: r for r in feat.add_entity_time_features(keyed, FeatureConfig(strategy="frame")).collect()}
    for i in a:
        assert a[i].cnt_24h == b[i].cnt_24h and abs(a[i].std_amt_7d_hist - b[i].std_amt_7d_hist) < 1e-9


def test_strict_history_option(spark, simple_tx):
    r = feat.build_features(simple_tx, FeatureConfig(history="strict")).orderBy("TransactionID").collect()
    f = feat.build_features(simple_tx, FeatureConfig(history="strict", strategy="frame")).orderBy("TransactionID").collect()
    assert [x.mean_amt_7d_hist for x in r] == [x.mean_amt_7d_hist for x in f] == [0.0, 100.0, 150.0]


def test_feature_report(simple_tx):
    rep = {r.column: r.missing_pct for r in feat.feature_report(feat.build_features(simple_tx)).collect()}
    assert rep["z_amt_vs_7d"] == pytest.approx(200.0 / 3)
    assert rep["cnt_1h"] == 0.0


def test_burst_and_heavy_ties_are_cut_finely(spark):
    """A key whose rows fall in one burst, and one with many rows in a second: no chunk that can be cut stays crowded, and the
    features are those of the uncut series."""
    from tidewatch.operators import frames as fr
    rows = [(i, 40_000_000 if i == 0 else 1000 + i // 4, float(i % 9), "burst") for i in range(900)] + [(1000 + i, 7 * 3600, float(i), "ties") for i in range(300)]
    df = spark.createDataFrame(rows, "TransactionID long, TransactionDT long, TransactionAmt double, entity_key string")
    d, chunked = fr.with_order(df, "entity_key", "TransactionDT", ["TransactionID"], target_rows=32)
    most = {r.entity_key: r["m"] for r in d.groupBy("entity_key", fr.CHUNK).count().groupBy("entity_key").agg(F.max("count").alias("m")).collect()}
    assert chunked and most["burst"] <= 64 and most["ties"] <= 64      # a crowded second is sliced, too
    cut = feat.add_entity_time_features(df, FeatureConfig(hot_key_rows=32)).orderBy("TransactionID").collect()
    whole = feat.add_entity_time_features(df, FeatureConfig(hot_key_rows=None)).orderBy("TransactionID").collect()
    assert [r.asDict() for r in cut] == [r.asDict() for r in whole]


def _crowded(spark):
    """One key with most rows in one second, some rows around it, another key, and rows without a time."""
    rows = [(i, 1000, float(i % 7), i % 3 == 0, "a") for i in range(500)]
    rows += [(500 + i, 1000 + (i - 20) * 1800, 2.0, i % 4 == 0, "a") for i in range(60)]
    rows += [(600 + i, 990 + i, 1.0, 0, "b") for i in range(30)] + [(700, None, 5.0, 1, "a"), (701, None, 5.0, 0, "c")]
    return spark.createDataFrame([(i, t, a, int(f), k) for i, t, a, f, k in rows], "TransactionID long, TransactionDT long, TransactionAmt double, isFraud int, entity_key string")


def test_hot_second_is_cut_into_slices(spark):
    from pyspark.sql import functions as F

    from tidewatch.operators import frames as fr
    d, chunked = fr.with_order(_crowded(spark), "entity_key", "TransactionDT", ["TransactionID"], target_rows=20)
    assert chunked
    sizes = {r.n for r in d.groupBy("entity_key", fr.CHUNK).agg(F.count("*").alias("n")).collect()}
    assert max(sizes) <= 40
    rows = d.filter("entity_key = 'a'").select(fr.ORD, fr.CHUNK, "TransactionDT", "TransactionID").orderBy(fr.ORD).collect()
    assert [tuple(r[2:]) for r in rows] == sorted(tuple(r[2:]) for r in rows)       # the order is (time, id)
    assert [r[1] for r in rows] == sorted(r[1] for r in rows) and len({r[0] for r in rows}) == len(rows)


@pytest.mark.parametrize("mode", ["any_in_horizon", "next_event"])
def test_hot_second_equals_plain_frames(spark, mode):
    from tidewatch.config import LabelConfig
    from tidewatch.operators.labels import make_early_warning_label
    df = _crowded(spark)
    key = lambda r: r["TransactionID"]
    a = sorted(map(lambda r: r.asDict(), feat.add_entity_time_features(df, FeatureConfig(hot_key_rows=20)).collect()), key=key)
    b = sorted(map(lambda r: r.asDict(), feat.add_entity_time_features(df, FeatureConfig(strategy="frame")).collect()), key=key)
    assert len(a) == len(b) == 592
    for x, y in zip(a, b, strict=True):
        assert x.keys() == y.keys()
        for c in x:
            assert x[c] == pytest.approx(y[c], abs=1e-6) if isinstance(x[c], float) else x[c] == y[c], (c, x, y)
    la = {r.TransactionID: r.y_ew_72h for r in make_early_warning_label(df, LabelConfig(mode=mode, hot_key_rows=20)).collect()}
    lb = {r.TransactionID: r.y_ew_72h for r in make_early_warning_label(df, LabelConfig(mode=mode), strategy="frame").collect()}
    assert la == lb and la[700] is None and la[701] is None


def test_rows_without_a_time_come_out(spark):
    df = spark.createDataFrame([(1, 10, 5.0, "a"), (2, None, 6.0, "a"), (3, 20, 7.0, "a")], "TransactionID long, TransactionDT long, TransactionAmt double, entity_key string")
    got = {r.TransactionID: r for r in feat.add_entity_time_features(df).collect()}
    assert len(got) == 3 and got[2].cnt_1h is None and got[2].z_amt_vs_7d is None and got[2].TransactionAmt == 6.0
    assert got[3].cnt_1h == 2 and got[3].mean_amt_7d_hist == 5.0


def _midnights(spark, seconds, rows):
    """One key with ``rows`` rows in each of ``seconds`` midnights."""
    data = [(s * rows + i, s * 86400, float(s + i), "a") for s in range(seconds) for i in range(rows)]
    return spark.createDataFrame(data, "TransactionID long, TransactionDT long, TransactionAmt double, entity_key string")


def test_rows_carry_hot_seconds_of_their_own_chunk_only(spark):
    df = _midnights(spark, 60, 5)
    d, chunked = fr.with_order(df, "entity_key", "TransactionDT", ["TransactionID"], 2)
    sizes = d.agg(F.max(F.size(fr.HOTS)), F.count(F.lit(1))).first()
    assert chunked and sizes[0] <= fr.HOTS_IN_CHUNK and sizes[1] == 300
    got, plain = ({r.TransactionID: r for r in feat.add_entity_time_features(df, cfg).collect()} for cfg in (FeatureConfig(hot_key_rows=2), FeatureConfig(strategy="frame")))
    for i, r in plain.items():
        assert (got[i].cnt_24h, got[i].sum_amt_1h, got[i].mean_amt_7d_hist) == (r.cnt_24h, r.sum_amt_1h, r.mean_amt_7d_hist)
        assert got[i].std_amt_7d_hist == r.std_amt_7d_hist


def test_plain_frames_grow_only(spark):
    """Spark adds up a frame whose lower end moves anew for every row."""
    for history in ("lagged", "strict"):
        d = feat.add_entity_time_features(_midnights(spark, 2, 2), FeatureConfig(strategy="frame", history=history))
        plan = d._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "rangeframe, unboundedpreceding" in plan and "rangeframe, -" not in plan


def test_rows_of_a_second_expire_as_one_event(spark, monkeypatch):
    d, chunked = fr.with_order(_midnights(spark, 3, 20), "entity_key", "TransactionDT", ["TransactionID"], 20)
    dealt, repartition = [], type(d).repartition
    monkeypatch.setattr(type(d), "repartition", lambda self, *a: (dealt.append(self), repartition(self, *a))[1])
    out = fr.sliding_sums(d, "entity_key", "TransactionDT", [("n", 86400, F.lit(1).cast("bigint")), ("m", 259200, F.lit(1).cast("bigint"))], chunked=chunked)
    assert {(r.TransactionID, r.n, r.m) for r in out.collect()} == {(s * 20 + i, i + 1, s * 20 + i + 1) for s in range(3) for i in range(20)}
    assert chunked and [e.count() for e in dealt] == [60 + 2 * 3]
