import random

import pytest

from tidewatch.operators import metrics as met

S = "id long, y int, p double"


def _df(spark, ys, ps):
    return spark.createDataFrame([(i, int(y), float(p)) for i, (y, p) in enumerate(zip(ys, ps))], S)


def _auc_ap_brute(ys, ps):
    pos = [p for y, p in zip(ys, ps) if y == 1]
    neg = [p for y, p in zip(ys, ps) if y != 1]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap, prev_r = 0.0, 0.0
    for s in sorted(set(ps), reverse=True):
        tp = sum(1 for y, p in zip(ys, ps) if p >= s and y == 1)
        fp = sum(1 for y, p in zip(ys, ps) if p >= s and y != 1)
        r = tp / len(pos)
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    return auc, ap


def test_separable_keys_and_perfect(spark):
    m = met.binary_metrics(_df(spark, [0, 0, 1, 1], [.1, .2, .8, .9])).first().asDict()
    assert set(m) == {"auc_roc", "avg_precision", "brier"}
    m = met.binary_metrics(_df(spark, [0, 0, 0, 1, 1, 1], [0, 0, 0, 1, 1, 1])).first()
    assert m.auc_roc == 1.0 and m.brier == 0.0 and m.avg_precision == 1.0


def test_inverted_and_random(spark):
    assert met.binary_metrics(_df(spark, [0, 0, 1, 1], [.9, .9, .1, .1])).first().auc_roc < 0.5
    rng = random.Random(42)
    ys = [int(rng.random() < 0.3) for _ in range(10000)]
    ps = [rng.random() for _ in range(10000)]
    m = met.binary_metrics(_df(spark, ys, ps)).first()
    assert 0.4 <= m.auc_roc <= 0.6 and 0.0 <= m.brier <= 1.0


def test_tied_scores_match_brute_force(spark):
    rng = random.Random(3)
    ys = [int(rng.random() < 0.4) for _ in range(300)]
    ps = [rng.choice([0.1, 0.2, 0.2, 0.5, 0.7, 0.9]) for _ in range(300)]
    auc, ap = _auc_ap_brute(ys, ps)
    m = met.binary_metrics(_df(spark, ys, ps)).first()
    assert m.auc_roc == pytest.approx(auc, abs=1e-12) and m.avg_precision == pytest.approx(ap, abs=1e-12)


def test_best_f1_ranges_and_compat(spark):
    rng = random.Random(1)
    ys = [int(rng.random() < 0.5) for _ in range(200)]
    ps = [rng.random() for _ in range(200)]
    b = met.best_f1_threshold(_df(spark, ys, ps)).first()
    for v in (b.best_threshold, b.best_f1, b.precision_at_best, b.recall_at_best):
        assert 0.0 <= v <= 1.0
    c = met.best_f1_threshold(_df(spark, [0, 1, 0, 1, 1], [.1, .2, .3, .7, .9]), compat=True).first()
    t = met.best_f1_threshold(_df(spark, [0, 1, 0, 1, 1], [.1, .2, .3, .7, .9])).first()
    assert c.best_threshold <= t.best_threshold and c.best_f1 == t.best_f1


def test_lift_perfect_and_random(spark):
    ys = [1] * 100 + [0] * 900
    ps = [1.0 - i / 1000 for i in range(1000)]
    r = {x.top_pct: x for x in met.lift_at_k(_df(spark, ys, ps), (10,)).collect()}
    assert r[10.0].precision == 1.0 and r[10.0].lift == pytest.approx(10.0)
    rng = random.Random(99)
    ys = [int(rng.random() < 0.05) for _ in range(50000)]
    ps = [rng.random() for _ in range(50000)]
    r = met.lift_at_k(_df(spark, ys, ps), (10,)).first()
    assert 0.7 <= r.lift <= 1.3


def test_lift_tie_group_resolved_by_id(spark):
    # 10 rows all tied: top 30% = the 3 smallest ids
    ys = [1, 1, 0, 1, 0, 0, 0, 0, 0, 0]
    r = met.lift_at_k(_df(spark, ys, [0.5] * 10), (30,)).first()
    assert r.k == 3 and r.precision == pytest.approx(2 / 3)


def test_log_loss_and_reliability(spark):
    ll = met.log_loss(_df(spark, [0, 1], [0.0, 1.0])).first().log_loss
    assert ll < 1e-10
    rng = random.Random(5)
    ps = [rng.random() for _ in range(1000)]
    ys = [int(rng.random() < p) for p in ps]
    rc = met.reliability_curve(_df(spark, ys, ps)).collect()
    assert len(rc) == 10 and sum(r["count"] for r in rc) == 1000


def test_linear_attributions(spark):
    df = spark.createDataFrame([(1.0, 10.0), (3.0, 10.0)], "a double, b double")
    r = met.linear_attributions(df, df, {"a": 2.0, "b": 5.0}).collect()
    assert r[0].feature == "a" and r[0].mean_abs_attribution == pytest.approx(2.0) and r[1].mean_abs_attribution == 0.0
