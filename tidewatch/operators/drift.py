"""Drift monitoring between a reference and a current population (DR1-DR8).

All features are handled in one plan: both sides are unpivoted to long form
``(feature, value, side)``, collapsed per distinct value (map-side combined),
and the empirical CDFs come from one grouped distributed prefix sum.
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.config import DriftConfig
from tidewatch.functions.exprs import nan_to_null
from tidewatch.operators.quantiles import assign_bin, exact_quantiles, next_value, prefix_sums


def _long(df: DataFrame, features: Sequence[str], side: int) -> DataFrame:
    """Long form ``(feature, value, side)``; ``feature`` is a small int id while
    the data is grouped (cheaper keys), mapped back to names at the end."""
    arr = F.array(*[F.struct(F.lit(i).alias("feature"), nan_to_null(F.col(c)).alias("value"))
                    for i, c in enumerate(features)])
    return df.select(F.inline(arr)).withColumn("side", F.lit(side))


def _name(features: Sequence[str], col: str = "feature"):
    return F.element_at(F.array(*[F.lit(c) for c in features]), F.col(col) + 1)


def _present(ref: DataFrame, cur: DataFrame, features: Sequence[str]) -> list[str]:
    return [c for c in features if c in ref.columns and c in cur.columns]


def ecdf_table(ref: DataFrame, cur: DataFrame, features: Sequence[str], keep_bucket: bool = False,
               n_buckets: int | None = None) -> DataFrame:
    """Per (feature, distinct value): counts and inclusive cumulative counts of each side."""
    long = _long(ref, features, 0).unionByName(_long(cur, features, 1)).filter(F.col("value").isNotNull())
    c = long.groupBy("feature", "value").agg(F.sum((F.col("side") == 0).cast("bigint")).alias("r"),
                                             F.sum((F.col("side") == 1).cast("bigint")).alias("c"))
    return prefix_sums(c, ["value"], ["r", "c"], group_cols=["feature"], n_buckets=n_buckets, keep_bucket=keep_bucket)


def _ks_pvalue(d, n, m):
    """Two-sided asymptotic p-value: Kolmogorov series at (sqrt(en)+0.12+0.11/sqrt(en))*D."""
    en = F.sqrt(n * m / (n + m))
    lam = (en + F.lit(0.12) + F.lit(0.11) / en) * d
    terms = F.transform(F.sequence(F.lit(1), F.lit(100)),
                        lambda k: F.pow(F.lit(-1.0), k - 1) * F.exp(F.lit(-2.0) * k * k * lam * lam))
    s = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    p = F.when(lam < F.lit(1e-3), F.lit(1.0)).otherwise(F.lit(2.0) * s)
    return F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))


def ks_outside(n: int, m: int, d: float) -> float:
    """Exact P(D >= d) of the two-sample statistic under equal distributions, all orders of the n + m values equally likely.

    Such an order is a random lattice path from (0, 0) to (n, m); D >= d if it leaves the band
    ``|i / n - j / m| < d``. The probabilities of the points i + j = s that are reached inside the band follow from those
    of s - 1, and what steps out of it adds up to the result: n + m vectorised steps over the band, no
    differences of large numbers.
    """
    lattice = n * m // math.gcd(n, m)                    # D is a multiple of 1 / lattice
    least = round(d * lattice)
    if least <= 0:
        return 1.0
    edge, slope = (least - 0.5) / lattice, 1 / n + 1 / m
    q, first, out = np.ones(1), 0, 0.0                   # q[k]: the point (first + k, s - first - k)
    for s in range(1, n + m + 1):
        i = np.arange(first, first + len(q) + 1)
        left = n + m - s + 1
        q = (np.r_[q, 0.0] * np.maximum(m - (s - 1 - i), 0) + np.r_[0.0, q] * (n - i + 1)) / left
        lo, hi = math.ceil((s / m - edge) / slope), math.floor((s / m + edge) / slope)
        inside = (i >= max(0, s - m, lo)) & (i <= min(n, s, hi))
        out += float(q[~inside].sum())
        if not inside.any():
            return 1.0
        q, first = q[inside], int(i[inside][0])
    return min(1.0, out)


def ks_series(n: float, d: float) -> float:
    """P(D >= d) of the one-sample statistic for ``n`` values, by the limiting distribution and its expansion to n^(-3/2)."""
    z = math.sqrt(n) * d
    if z <= 0.04:
        return 1.0
    if z > 6:
        return min(1.0, 2.0 * math.exp(-2.0 * z * z))
    k = np.arange(0, 60)
    h2 = (math.pi * (k + 0.5)) ** 2
    eh = np.exp(-h2 / (2 * z * z))
    k2 = (math.pi * np.arange(1, 60)) ** 2
    ek = np.exp(-k2 / (2 * z * z))
    c, z2 = 2 * math.sqrt(math.pi / 2), z * z            # twice: sums over all integers are symmetric
    k0 = c / z * eh.sum()
    k1 = c / (6 * z**4) * ((h2 - z2) * eh).sum()
    k2_ = c / (72 * z**7) * (((6 * z2**3 + 2 * z2**2) + (2 * z2**2 - 5 * z2) * h2 + (1 - 2 * z2) * h2**2) * eh).sum() - c / (36 * z**3) * (k2 * ek).sum()
    k3 = (c / (6480 * z**10) * (((5 - 30 * z2) * h2**3 + (-60 * z2 + 212 * z2**2) * h2**2 + (135 * z2**2 - 96 * z2**3) * h2 - 30 * z2**3 - 90 * z2**4) * eh).sum()
          + c / (108 * z**6) * ((-(k2**2) + 3 * k2 * z2) * ek).sum())
    return float(min(1.0, max(0.0, 1.0 - (k0 + k1 / math.sqrt(n) + k2_ / n + k3 / n**1.5))))


def _ks_auto(exact_rows: int):
    @F.pandas_udf("double")
    def p(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:      # a row for each feature
        one = lambda x, a, b: ks_outside(int(a), int(b), x) if max(a, b) <= exact_rows else ks_series(float(round(a * b / (a + b))), x)
        return pd.Series([one(x, a, b) for x, a, b in zip(d, n, m, strict=True)], dtype="float64")
    return p


def ks_drift(ref: DataFrame, cur: DataFrame, cfg: DriftConfig = DriftConfig(), n_buckets: int | None = None) -> DataFrame:
    """DR1 + DR2: per feature KS D, p-value, drift flag, means and mean change %.

    Features with fewer than ``min_rows`` non-null values on either side are absent. The p-value is exact up to
    ``p_exact_rows`` rows on both sides and a series of the effective size beyond (``p_method="auto"``), or the
    limiting distribution with a small-sample correction (``"limiting"``).
    """
    feats = _present(ref, cur, cfg.features)
    e = ecdf_table(ref, cur, feats, n_buckets=n_buckets)
    gap = F.abs(F.col("r_cum") / F.col("r_total") - F.col("c_cum") / F.col("c_total"))
    ks = e.groupBy("feature").agg(F.max(gap).alias("_d"), F.first("r_total").alias("n_ref"),
                                  F.first("c_total").alias("n_cur"),
                                  (F.sum(F.col("value") * F.col("r")) / F.first("r_total")).alias("_rm"),
                                  (F.sum(F.col("value") * F.col("c")) / F.first("c_total")).alias("_cm"))
    ks = ks.filter((F.col("n_ref") >= cfg.min_rows) & (F.col("n_cur") >= cfg.min_rows))
    # unrounded inputs carry private names: a select-list alias must never shadow them
    n, m = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")
    ks = ks.withColumn("_p", _ks_pvalue(F.col("_d"), n, m) if cfg.p_method == "limiting" else _ks_auto(cfg.p_exact_rows)("_d", n, m))
    p = F.col("_p")
    change = F.abs(F.col("_cm") - F.col("_rm")) / (F.abs(F.col("_rm")) + F.lit(1e-9)) * 100.0
    return ks.select(_name(feats).alias("feature"), F.round("_d", 4).alias("ks_statistic"), F.round(p, 4).alias("p_value"),
                     (p < cfg.p_threshold).alias("drift_detected"), F.round("_rm", 4).alias("ref_mean"),
                     F.round("_cm", 4).alias("current_mean"), F.round(change, 2).alias("mean_change_pct"),
                     "n_ref", "n_cur")


def _side_means(ref: DataFrame, cur: DataFrame, col) -> DataFrame:
    """Mean of ``col`` on each side in one aggregate over the tagged union."""
    both = ref.select(col.alias("_x"), F.lit(0).alias("_s")).unionByName(cur.select(col.alias("_x"), F.lit(1).alias("_s")))
    return both.agg(F.avg(F.when(F.col("_s") == 0, F.col("_x"))).alias("_ref"),
                    F.avg(F.when(F.col("_s") == 1, F.col("_x"))).alias("_cur"))


def score_shift(cur: DataFrame, ref: DataFrame | None = None, cfg: DriftConfig = DriftConfig(),
                score: str = "score", rounded: bool = True) -> DataFrame:
    """DR3: reference mean (parameter, else the reference score mean) vs current mean."""
    x = nan_to_null(F.col(score))
    if cfg.reference_score_mean is not None:
        m = cur.agg(F.avg(x).alias("_cur")).withColumn("_ref", F.lit(float(cfg.reference_score_mean)))
    else:
        m = _side_means(ref, cur, x)
    r = (lambda c, n: F.round(c, n)) if rounded else (lambda c, n: c)
    shift = F.abs(F.col("_cur") - F.col("_ref"))
    return m.select(F.col("_ref").alias("reference_mean_score"), r(F.col("_cur"), 4).alias("current_mean_score"),
                    r(shift, 4).alias("absolute_shift"), (shift > cfg.score_mean_change_alert).alias("alert"))


def wasserstein(ref: DataFrame, cur: DataFrame, features: Sequence[str], n_buckets: int | None = None) -> DataFrame:
    """DR4: 1-Wasserstein distance ``sum |F_ref - F_cur| * (next_value - value)`` per feature,
    raw and normalised by the reference population std."""
    feats = _present(ref, cur, features)
    e = next_value(ecdf_table(ref, cur, feats, keep_bucket=True, n_buckets=n_buckets), "value", ["feature"])
    gap = F.abs(F.col("r_cum") / F.col("r_total") - F.col("c_cum") / F.col("c_total"))
    dist = e.groupBy("feature").agg(F.sum(F.coalesce(gap * (F.col("_next") - F.col("value")), F.lit(0.0))).alias("wasserstein"))
    std = _long(ref, feats, 0).groupBy("feature").agg(F.stddev_pop("value").alias("_sd"))
    return dist.join(std, "feature", "left").select(
        _name(feats).alias("feature"), "wasserstein", (F.col("wasserstein") / F.nullif(F.col("_sd"), F.lit(0.0))).alias("wasserstein_norm"))


def label_drift(ref: DataFrame, cur: DataFrame, label: str = "y_ew_72h", rounded: bool = True) -> DataFrame:
    """DR5: positive-rate shift (one aggregate over both sides)."""
    m = _side_means(ref, cur, F.col(label).cast("double"))
    r = (lambda c, n: F.round(c, n)) if rounded else (lambda c, n: c)
    return m.select(r(F.col("_ref"), 4).alias("reference_positive_rate"), r(F.col("_cur"), 4).alias("current_positive_rate"),
                    r(F.abs(F.col("_cur") - F.col("_ref")), 4).alias("absolute_shift"))


def drift_summary(ks: DataFrame, ref: DataFrame, cfg: DriftConfig = DriftConfig()) -> DataFrame:
    """DR6: share of drifted features among those present in the reference; global alert."""
    n_mon = len([c for c in cfg.features if c in ref.columns])
    s = ks.agg(F.sum(F.col("drift_detected").cast("int")).alias("n_features_drifted"),
               F.sort_array(F.collect_list(F.when(F.col("drift_detected"), F.col("feature")))).alias("drifted_features"))
    share = F.coalesce(F.col("n_features_drifted"), F.lit(0)) / F.lit(max(n_mon, 1))
    return s.select(F.lit(n_mon).alias("n_features_monitored"),
                    F.coalesce(F.col("n_features_drifted"), F.lit(0)).alias("n_features_drifted"),
                    F.round(share, 3).alias("drift_share"), "drifted_features",
                    F.lit(cfg.drift_share_alert).alias("alert_drift_threshold"),
                    (share > cfg.drift_share_alert).alias("global_alert"))


def psi_js(ref: DataFrame, cur: DataFrame, features: Sequence[str], n_bins: int = 10,
           eps: float = 1e-6) -> DataFrame:
    """DR7: PSI and Jensen-Shannon divergence on reference-quantile bins."""
    feats = _present(ref, cur, features)
    qs = [i / n_bins for i in range(1, n_bins)]
    rl = _long(ref, feats, 0).filter(F.col("value").isNotNull())
    cl = _long(cur, feats, 1).filter(F.col("value").isNotNull())
    eq = exact_quantiles(rl, "value", qs, "linear", group_cols=["feature"])
    eq = eq.groupBy(F.col("feature").alias("_f")).agg(*[F.max(F.when(F.col("q") == F.lit(q), F.col("value"))).alias(f"_e{i}") for i, q in enumerate(qs)])
    # one row of edges per feature of the call; features without a reference value have none
    both = rl.unionByName(cl).join(F.broadcast(eq), F.col("feature") == F.col("_f"))
    both = assign_bin(both, F.col("value"), [F.col(f"_e{i}") for i in range(len(qs))], "bin")
    h = both.groupBy("feature", "bin").agg(F.sum((F.col("side") == 0).cast("double")).alias("r"),
                                                     F.sum((F.col("side") == 1).cast("double")).alias("c"))
    wf = Window.partitionBy("feature")
    h = h.select("feature", "bin", (F.col("r") / F.sum("r").over(wf) + eps).alias("pr"),
                 (F.col("c") / F.sum("c").over(wf) + eps).alias("pc"))
    m = (F.col("pr") + F.col("pc")) / 2
    return h.groupBy(_name(feats).alias("feature")).agg(
        F.sum((F.col("pc") - F.col("pr")) * F.log(F.col("pc") / F.col("pr"))).alias("psi"),
        (0.5 * F.sum(F.col("pr") * F.log(F.col("pr") / m)) + 0.5 * F.sum(F.col("pc") * F.log(F.col("pc") / m)))
        .alias("js_divergence"))


def data_quality(ref: DataFrame, cur: DataFrame, features: Sequence[str]) -> DataFrame:
    """DR8: per feature and side: count, missing, min, max, mean, std, p25/p50/p75."""
    feats = _present(ref, cur, features)
    both = _long(ref, feats, 0).unionByName(_long(cur, feats, 1))
    base = both.groupBy("feature", "side").agg(
        F.count(F.lit(1)).alias("count"), F.sum(F.col("value").isNull().cast("bigint")).alias("missing"),
        F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"))
    q = exact_quantiles(both, "value", [0.25, 0.5, 0.75], "linear", group_cols=["feature", "side"])
    piv = q.groupBy("feature", "side").agg(*[F.max(F.when(F.col("q") == x, F.col("value"))).alias(n)
                                            for x, n in [(0.25, "p25"), (0.5, "p50"), (0.75, "p75")]])
    return base.join(piv, ["feature", "side"], "left") \
        .withColumn("side", F.when(F.col("side") == 0, "reference").otherwise("current")) \
        .withColumn("feature", _name(feats))
