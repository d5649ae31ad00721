import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.config import SplitConfig
from tidewatch.operators import quantiles as q
from tidewatch.operators import split as spl


def test_higher_vs_linear_vs_disc(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4]], "v double")
    assert q.quantile_dict(df, "v", [0.5], "higher")[0.5] == 3.0
    assert q.quantile_dict(df, "v", [0.5], "lower")[0.5] == 2.0
    assert q.quantile_dict(df, "v", [0.5], "linear")[0.5] == 2.5


@pytest.mark.parametrize("nb", [1, 3, 1024])
def test_exact_quantiles_match_numpy(spark, nb):
    rng = random.Random(11)
    xs = [float(rng.randint(0, 200)) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    qs = [0.0, 0.1, 0.5, 0.7, 0.85, 0.99, 1.0]
    lin = {r.q: r.value for r in q.exact_quantiles(df, "v", qs, "linear", n_buckets=nb).collect()}
    hi = {r.q: r.value for r in q.exact_quantiles(df, "v", qs, "higher", n_buckets=nb).collect()}
    for x in qs:
        assert lin[x] == pytest.approx(np.quantile(xs, x, method="linear"))
        assert hi[x] == pytest.approx(np.quantile(xs, x, method="higher"))


def test_prefix_sums_grouped_descending(spark):
    rows = [(g, v, 1) for g in ("a", "b") for v in range(100)]
    df = spark.createDataFrame(rows, "g string, v long, w long")
    out = q.prefix_sums(df, ["v"], ["w"], ["g"], n_buckets=7, descending=True).collect()
    for r in out:
        assert r.w_cum == 100 - r.v and r.w_total == 100


def test_split_cutoffs_and_assignment(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(list(range(100)) + [99] * 10)], "id long, TransactionDT long")
    te, ve = spl.compute_cutoffs(df, SplitConfig())
    ts = sorted(list(range(100)) + [99] * 10)
    assert te == int(np.quantile(ts, 0.7, method="higher")) and ve == int(np.quantile(ts, 0.85, method="higher"))
    s = spl.time_split(df).groupBy("split").count().collect()
    assert sum(r["count"] for r in s) == 110
    with pytest.raises(ValueError):
        spl.compute_cutoffs(spark.createDataFrame([("x",)], "TransactionDT string"))


def test_split_report(spark):
    df = spark.createDataFrame([("train", 1), ("train", None), ("test", 0)], "split string, y_ew_72h int")
    r = {x.split: x for x in spl.split_report(df).collect()}
    assert r["train"]["count"] == 2 and r["train"].positive == 1 and r["train"].positive_rate_pct == 50.0


def test_next_value_across_bucket_edges(spark):
    rng = random.Random(4)
    rows = [(g, float(rng.randint(0, 300))) for g in ("a", "b") for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, v double").groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    cum = q.prefix_sums(df, ["v"], ["n"], ["g"], n_buckets=6, keep_bucket=True)
    assert cum.select("_bucket").distinct().count() > 3
    got = {(r.g, r.v): r._next for r in q.next_value(cum, "v", ["g"]).collect()}
    for g in ("a", "b"):
        vals = sorted({v for gg, v in rows if gg == g})
        for i, v in enumerate(vals):
            assert got[(g, v)] == (vals[i + 1] if i + 1 < len(vals) else None)


def test_many_groups_and_missing_values(spark):
    """More columns than any former limit, with NaN and null values, over forced partitions."""
    from tidewatch.operators.profile import numeric_sanity
    cols = [f"c{i}" for i in range(70)]
    rows = [tuple(float("nan") if (i + k) % 7 == 0 else None if (i + k) % 11 == 0 else float(i * k % 31) for k in range(70)) for i in range(60)]
    got = {r.column: r for r in numeric_sanity(spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)), cols).collect()}
    assert len(got) == 70
    for k in (0, 5, 69):
        vals = [r[k] for r in rows if r[k] is not None and r[k] == r[k]]
        assert got[f"c{k}"].p50 == pytest.approx(np.quantile(vals, 0.5)) and got[f"c{k}"].p99 == pytest.approx(np.quantile(vals, 0.99))


def test_scratch_tables_can_be_dropped(spark):
    from tidewatch.session import drop_scratch, scratch_table
    d = scratch_table(spark.range(5).toDF("x"), "t")
    assert d.count() == 5 and drop_scratch(spark) >= 1 and drop_scratch(spark) == 0
