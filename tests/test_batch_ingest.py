"""Batch score job, ingest order and corrupt rows, thinned curve, grouped metrics, sketches."""

import pytest
from pyspark.sql import functions as F

from tidewatch.config import BandPolicy
from tidewatch.operators import bands as bnd
from tidewatch.operators import metrics as met
from tidewatch.operators import profile as prof
from tidewatch.operators.schema import split_valid
from tidewatch.sources import io


def test_batch_job_scores_once_and_counts(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("TransactionID"), (F.col("id") / 1000).alias("x"))
    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def score(x):
        calls.add(1)
        return None if x == 0.5 else (float("nan") if x == 0.25 else x)

    report = bnd.run_batch(df, lambda d: d.withColumn("score", score("x")), str(tmp_path / "out"), ["TransactionID", "x"])
    assert calls.value == 1000                                       # cutoffs, bands and counts read the written scores
    assert report.counts == {"rows": 1000, "without_score": 2, "critical": 10, "high": 20, "medium": 50, "low": 920}
    got = spark.read.parquet(report.path)
    assert got.count() == 1000 and got.filter("risk_band = 'critical'").agg(F.min("score")).first()[0] >= report.cutoffs["critical"]
    assert {r.risk_band for r in got.filter("score IS NULL OR isnan(score)").select("risk_band").distinct().collect()} == {"low"}


def test_batch_job_checks_columns_first_and_takes_odd_batches(spark, tmp_path):
    df = spark.range(10).select(F.col("id").alias("TransactionID"))
    with pytest.raises(ValueError, match="entity_key"):
        bnd.run_batch(df, lambda d: 1 / 0, str(tmp_path / "no"), ["entity_key"])
    empty = bnd.run_batch(df.limit(0), lambda d: d.withColumn("score", F.lit(0.1)), str(tmp_path / "e"))
    assert empty.counts["rows"] == 0 and empty.counts["low"] == 0
    none = bnd.run_batch(df, lambda d: d.withColumn("score", F.lit(None).cast("double")), str(tmp_path / "n"))
    assert none.counts["low"] == 10 and none.cutoffs["critical"] is None
    k = bnd.run_batch(df, lambda d: d.withColumn("score", F.lit(0.5)), str(tmp_path / "k"), policy=BandPolicy(10, 30, 80, policy="exact_k"))
    assert (k.counts["critical"], k.counts["high"], k.counts["medium"], k.counts["low"]) == (1, 2, 5, 2)


def _files(tmp_path, files):
    d = tmp_path / "csv"
    d.mkdir()
    for name, text in files.items():
        (d / name).write_text(text)
    return str(d)


def test_first_row_in_file_order(spark, tmp_path):
    path = _files(tmp_path, {"b.csv": "TransactionID,v\n1,30\n2,40\n", "a.csv": "TransactionID,v\n1,9\n3,5\n1,1\n3,4\n", "c.csv": "TransactionID,v\n2,1\n4,1\n"})
    rows = io.read_csv(spark, path, spark.createDataFrame([], "TransactionID long, v long").schema, ingest_order=True)
    got = {r.TransactionID: r.v for r in prof.drop_duplicates_keep_first(rows).collect()}
    assert got == {1: 9, 3: 5, 2: 40, 4: 1}
    assert {r.TransactionID: r.v for r in prof.drop_duplicates_keep_first(rows.repartition(7)).collect()} == got      # whatever came between
    with pytest.raises(ValueError, match="first"):
        prof.drop_duplicates_keep_first(rows.drop("_ingest"))


def test_corrupt_lines_go_to_quarantine(spark, tmp_path):
    from tidewatch.plans.pipeline import clean_and_quarantine
    header = "TransactionID,TransactionDT,TransactionAmt,isFraud\n"
    path = _files(tmp_path, {"a.csv": header + '1,100,5.5,0\n2,x,1.0,0\n,7,1.0,1\n"3",200,"1.5",1\n4,5\n1,300,9.0,1\n'})
    schema = spark.createDataFrame([], "TransactionID long, TransactionDT long, TransactionAmt double, isFraud int").schema
    rows = io.read_csv(spark, path, schema, ingest_order=True, keep_corrupt=True)
    good, bad = split_valid(rows, {})
    assert sorted(r._corrupt_record for r in bad.collect()) == ["2,x,1.0,0", "4,5"]
    clean, away = clean_and_quarantine(rows)
    assert "_corrupt_record" not in clean.columns
    assert sorted((r.TransactionID, r.TransactionDT) for r in clean.collect()) == [(1, 100), (3, 200)]
    assert sorted(",".join(r.violations) for r in away.collect()) == ["TransactionID:required", "row:corrupt", "row:corrupt,TransactionDT:required"] or away.count() == 3


def test_thinned_curve(spark):
    rows = [(i, int((i * 7919) % 13 < 3 + i // 400), (i * 37 % 1000) / 1000) for i in range(2000)]
    s = spark.createDataFrame(rows, "id long, y int, p double")
    whole = met.binary_metrics(s).first().avg_precision
    for n in (2, 10, 100, 5000):
        t = met.pr_curve_thinned(s, n).collect()
        assert len(t) <= n and abs(sum(r.area for r in t) - whole) <= sum(r.area_slack for r in t) + 1e-12
    assert sum(r.area_slack for r in met.pr_curve_thinned(s, 100).collect()) < sum(r.area_slack for r in met.pr_curve_thinned(s, 10).collect())
    with pytest.raises(ValueError):
        met.pr_curve_thinned(s, 1)


def test_comparison_equals_single_metrics(spark):
    rows = [(i, int(i % 7 == 0), (i * 31 % 50) / 50 if i % 11 else None) for i in range(500)]
    s = spark.createDataFrame(rows, "id long, y int, p double")
    got = {(r.model, r.metric): r.value for r in met.model_comparison({"m": {"t": s}, "n": {"t": s.withColumn("p", 1 - F.col("p"))}}, top_pcts=(1, 10)).collect()}
    m, f = met.binary_metrics(s).first(), met.best_f1_threshold(s).first()
    assert got["m", "auc_roc"] == pytest.approx(m.auc_roc) and got["m", "avg_precision"] == pytest.approx(m.avg_precision) and got["m", "brier"] == pytest.approx(m.brier)
    assert got["m", "best_threshold"] == f.best_threshold and got["m", "best_f1"] == pytest.approx(f.best_f1)
    for r in met.lift_at_k(s, (1, 10)).collect():
        assert got["m", f"lift_at_{r.top_pct}pct"] == pytest.approx(r.lift) and got["m", f"recall_at_{r.top_pct}pct"] == pytest.approx(r.recall)
    assert got["n", "auc_roc"] == pytest.approx(1 - m.auc_roc)


def test_sketched_quantiles(spark):
    from tidewatch.operators.quantiles import approx_quantiles
    d = spark.range(10000).select((F.col("id") % 2).alias("g"), F.when(F.col("id") % 10 < 8, F.col("id").cast("double")).when(F.col("id") % 10 == 8, F.lit(float("nan"))).alias("v"))
    for r in approx_quantiles(d, "v", [0.5, 0.9], ["g"]).collect():
        assert abs(r.value / 10000 - r.q) < 0.002
    assert {r.value for r in approx_quantiles(d.filter("v IS NULL"), "v", [0.5]).collect()} <= {None}


def test_lines_are_sorted_by_more_tasks_than_parts(spark, tmp_path):
    """The files of one part of the lines are as many as the shuffle has partitions for it, and the first line of an event stays the first."""
    import glob
    import os

    from tidewatch.plans.queries import REGISTRY
    from tidewatch.session import checkpoint_dir
    e = spark.range(400).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("user_id"), F.lit("x").alias("event_type"), F.col("id").cast("double").alias("value"))
    e.write.parquet(str(tmp_path / "events.parquet"))
    at = os.path.join(checkpoint_dir(spark), "tables", "lines-*").removeprefix("file:")
    old = set(glob.glob(at))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r.event_id: r.value for r in REGISTRY["csv_first_in_file"][0](spark, str(tmp_path)).filter("part = 'kept'").collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    (base,) = set(glob.glob(at)) - old
    assert len(glob.glob(os.path.join(base, "part-*"))) > 4
    first = {i: 1 if i % 50 == 0 or (i * 7 % 4, 3 * i + 1) < (i % 4, 3 * i) else 0 for i in range(400)}
    assert got == {i: i + 1000.0 * first[i] for i in range(400)}
