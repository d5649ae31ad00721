import pytest
from pyspark.sql import functions as F

from tidewatch.config import BandPolicy, DriftConfig
from tidewatch.functions.exprs import safe_div, sigmoid
from tidewatch.operators import bands as bnd
from tidewatch.operators import drift as drf
from tidewatch.operators import prep, profile as prof
from tidewatch.operators import schema as sch
from tidewatch.session import cut_lineage


def test_audit_report_pieces(spark, simple_tx):
    rep = prof.build_audit_report(simple_tx)
    assert rep["shape"]["rows"] == 3 and "R_emaildomain" in rep["shape"]["missing_key_columns"]
    assert rep["time"].first().transaction_dt_max == 7200
    summary, counts = rep["label"]
    assert summary.first().isFraud_rate_pct == pytest.approx(100 / 3)
    assert {r.value: r["count"] for r in counts.collect()} == {0: 2, 1: 1}
    ns = {r.column: r for r in rep["numeric_sanity"].collect()}
    assert ns["TransactionAmt"].p50 == 150.0 and ns["TransactionAmt"].max == 200.0
    assert prof.dtypes_frame(simple_tx, ["TransactionID"]).first().dtype == "bigint"


def test_score_batch_review_queue_and_sample(spark):
    df = spark.createDataFrame([(i, i / 100.0) for i in range(100)], "id long, x double")
    scored = bnd.score_batch(df, lambda d: d.withColumn("score", F.col("x")), BandPolicy(), "id")
    q = bnd.review_queue(scored).limit(3).collect()
    assert [r.id for r in q] == [99, 98, 97] and q[0].risk_band == "critical"
    ex = bnd.score_batch(df, lambda d: d.withColumn("score", F.lit(0.5)), BandPolicy(policy="exact_k"), "id")
    assert {r.id for r in ex.filter(F.col("risk_band") == "critical").collect()} == {0}
    assert [r.id for r in bnd.head_sample(df, 2, ["id"]).collect()] == [0, 1]


def test_lineage_cut_and_helpers(spark):
    df = spark.range(10).withColumn("y", (F.col("id") % 2).cast("int"))
    assert cut_lineage(df).count() == 10
    r = df.select(safe_div(F.lit(1.0), F.lit(0.0)).alias("a"), sigmoid(F.lit(0.0)).alias("b")).first()
    assert r.a is None and r.b == 0.5
    assert sch.split_filter(df.withColumn("split", F.lit("train")), "train", "valid").count() == 10
    with pytest.raises(ValueError):
        sch.require_nonempty(df.filter("id < 0"), "test")
    assert prep.feature_schema(spark.createDataFrame([(1.0, "k")], "cnt_1h double, entity_key string")) == \
        {"numeric_cols": ["cnt_1h"], "key_cols": ["entity_key"]}


def test_score_shift_parameter(spark):
    cur = spark.createDataFrame([(0.3,), (0.5,)], "score double")
    r = drf.score_shift(cur, None, DriftConfig(reference_score_mean=0.028)).first()
    assert r.reference_mean_score == 0.028 and r.alert and r.absolute_shift == pytest.approx(0.372)
