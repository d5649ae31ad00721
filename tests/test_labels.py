import random

import pytest
from pyspark.sql import functions as F

from tidewatch.config import LabelConfig
from tidewatch.operators.labels import label_metrics, make_early_warning_label

SCHEMA = "TransactionID long, TransactionDT long, isFraud int, entity_key string"
MODES = [("any_in_horizon", "chunked"), ("any_in_horizon", "frame"), ("next_event", "chunked"), ("next_event", "frame")]


def _lab(spark, rows, h, mode="any_in_horizon", strategy="chunked", hot=1 << 21):
    df = spark.createDataFrame(rows, SCHEMA)
    cfg = LabelConfig(horizon_seconds=h, mode=mode, hot_key_rows=hot)
    return [r.y_ew_72h for r in make_early_warning_label(df, cfg, strategy=strategy).orderBy("TransactionID").collect()]


@pytest.mark.parametrize("mode,strategy", MODES)
def test_no_fraud(spark, mode, strategy):
    rows = [(i, t, 0, "A") for i, t in enumerate([0, 3600, 7200, 10800, 14400])]
    assert _lab(spark, rows, 3600, mode, strategy) == [0] * 5


@pytest.mark.parametrize("mode,strategy", MODES)
def test_outside_and_inside_horizon(spark, mode, strategy):
    assert _lab(spark, [(0, 0, 0, "A"), (1, 7201, 1, "A")], 7200, mode, strategy) == [0, 0]
    assert _lab(spark, [(0, 0, 0, "A"), (1, 3600, 1, "A")], 7200, mode, strategy) == [1, 0]


def test_simple_entity_modes_differ(spark):
    rows = [(i, t, f, "A") for i, (t, f) in enumerate([(0, 0), (1800, 0), (3600, 1), (3601, 0), (7200, 0)])]
    assert _lab(spark, rows, 3600, "any_in_horizon") == [1, 1, 0, 0, 0]
    assert _lab(spark, rows, 3600, "next_event") == [0, 1, 0, 0, 0]


def test_isolation_between_entities(spark):
    rows = [(0, 0, 0, "A"), (1, 1800, 1, "A"), (2, 0, 0, "B"), (3, 1800, 0, "B")]
    assert _lab(spark, rows, 7200) == [1, 0, 0, 0]


def test_tied_next_fraud(spark):
    rows = [(1, 0, 0, "A"), (2, 0, 1, "A"), (3, 10, 1, "A")]
    assert _lab(spark, rows, 100, "any_in_horizon")[0] == 1
    assert _lab(spark, rows, 100, "next_event")[0] == 0


def test_label_dtype_and_alignment(spark):
    df = spark.createDataFrame([(2, 3600, 1, "A"), (0, 0, 0, "A"), (1, 7200, 0, "A")], SCHEMA)
    out = make_early_warning_label(df, LabelConfig(horizon_seconds=7200))
    assert dict(out.dtypes)["y_ew_72h"] == "tinyint"
    assert {r.TransactionID: r.y_ew_72h for r in out.collect()} == {0: 1, 1: 0, 2: 0}
    assert out.count() == 3


def test_missing_columns_raise(spark):
    with pytest.raises(ValueError, match="Missing required columns"):
        make_early_warning_label(spark.createDataFrame([(1,)], "foo int"))


def test_metrics_keys(spark):
    df = spark.createDataFrame([(0, 0, 0, "A"), (1, 3600, 1, "A")], SCHEMA)
    m = label_metrics(make_early_warning_label(df)).first().asDict()
    assert m["horizon_seconds"] == 259200 and m["label_name"] == "y_ew_72h"
    assert m["positive_count"] == 1 and m["total_rows"] == 2 and m["positive_rate_pct"] == 50.0


def test_random_positive_rate_and_chunked_equal(spark):
    rng = random.Random(42)
    rows = sorted((rng.randint(0, 30 * 86400), rng.choice("ABCD")) for _ in range(1000))
    data = [(i, t, int(rng.random() < 0.03), k) for i, (t, k) in enumerate(rows)]
    a = _lab(spark, data, 259200)
    b = _lab(spark, data, 259200, hot=50)          # every key chunked by time
    c = _lab(spark, data, 259200, strategy="frame")
    assert a == b == c
    assert sum(a) / len(a) >= sum(r[2] for r in data) / len(data)
    n1 = _lab(spark, data, 259200, "next_event")
    assert n1 == _lab(spark, data, 259200, "next_event", hot=50)


@pytest.mark.parametrize("mode", ["any_in_horizon", "next_event"])
def test_label_fused_into_feature_pass(spark, mode):
    from tidewatch.config import FeatureConfig
    from tidewatch.operators.features import add_entity_time_features
    rng = random.Random(9)
    rows = [(i, rng.randint(0, 10 * 86400), float(rng.randint(1, 9)), int(rng.random() < 0.2), rng.choice("AB"))
            for i in range(300)]
    df = spark.createDataFrame(rows, "TransactionID long, TransactionDT long, TransactionAmt double, isFraud int, "
                                     "entity_key string")
    for hot in (1 << 21, 20):
        cfg = LabelConfig(mode=mode, hot_key_rows=hot)
        fused = add_entity_time_features(df, FeatureConfig(hot_key_rows=hot), label=cfg)
        alone = make_early_warning_label(df, cfg)
        a = {r.TransactionID: r.y_ew_72h for r in fused.collect()}
        b = {r.TransactionID: r.y_ew_72h for r in alone.collect()}
        assert a == b
