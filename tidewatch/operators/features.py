"""Velocity, baseline-deviation and campaign features.

Two evaluation strategies with identical results:

* ``delta`` (default, for scale): chunked event-delta running sums
  (:func:`tidewatch.operators.frames.sliding_sums`). Amounts are carried as
  fixed-point integers (``amount_scale`` decimals), so window sums cancel
  exactly and the population variance ``(n*S2 - S1^2) / n^2`` is exact
  (constant amounts give exactly 0, hence a null z-score).
* ``frame``: plain Spark RANGE frames on the composite order, one partition
  per key; kept as the readable statement of the semantics and for checks.
  The entity features take differences of growing frames, O(rows) of a key.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.config import ENGINEERED_COLUMNS, FEATURE_KEEP_COLUMNS, FeatureConfig
from tidewatch.functions.keys import entity_key, fingerprint_key
from tidewatch.operators import frames as fr
from tidewatch.operators.schema import require_columns

ENTITY_FEATURES = ENGINEERED_COLUMNS[:7]
FINGERPRINT_FEATURES = ENGINEERED_COLUMNS[7:]


def _exact_std(n, s1, s2, scale: int):
    """Population std from exact integer sums (n, sum u, sum u^2), u = amount * scale."""
    dn = n.cast("decimal(38,0)")
    ds1 = s1.cast("decimal(38,0)")
    num = F.try_subtract(F.try_multiply(dn, s2), F.try_multiply(ds1, ds1))
    nd = n.cast("double")
    approx = s2.cast("double") / nd - F.pow(s1.cast("double") / nd, 2)   # only on 38-digit overflow
    var_units = F.coalesce(num.cast("double") / (nd * nd), F.greatest(approx, F.lit(0.0)))
    return F.when(n > 0, F.sqrt(var_units) / F.lit(float(scale))).otherwise(F.lit(0.0))


def add_entity_time_features(df: DataFrame, cfg: FeatureConfig = FeatureConfig(), *,
                             key: str = "entity_key", time: str = "TransactionDT",
                             amount: str = "TransactionAmt",
                             tiebreak: Sequence[str] = ("TransactionID",),
                             label=None, fraud_col: str = "isFraud", untimed: bool = True) -> DataFrame:
    """W1-W8 (+W14): cnt_1h, sum_amt_1h, cnt_24h, avg_amt_24h, mean/std_amt_7d_hist, z.

    Rows without a time are in no window and come out with null features and label
    (``untimed=False``: the caller has none, or adds them itself).
    With ``label`` (a :class:`LabelConfig`) the early-warning label is computed
    in the same ordered pass (same key, same order): no second shuffle.
    """
    require_columns(df, [key, time, amount, *tiebreak], "entity features")
    if cfg.strategy == "frame":
        out = _entity_frame(df, cfg, key, time, amount, tiebreak)
        if label is not None:
            from tidewatch.operators.labels import make_early_warning_label
            out = make_early_warning_label(out, label, entity_col=key, time_col=time, fraud_col=fraud_col,
                                           tiebreak=tiebreak, strategy="frame", untimed=False)
        return fr.with_untimed(out, df, time) if untimed else out
    scale = 10 ** cfg.amount_scale
    d, chunked = fr.with_order(df, key, time, tiebreak, cfg.hot_key_rows)
    if label is not None:
        from tidewatch.operators.labels import label_ordered
        d = label_ordered(d, label, key, time, fraud_col, chunked)
    units = F.round(F.col(amount) * F.lit(scale)).cast("bigint")
    present = F.col(amount).isNotNull().cast("bigint")
    if cfg.history == "lagged":
        d = fr.previous_values(d, key, [amount], chunked=chunked)
        hv = F.col("_prev_" + amount)
    else:
        hv = F.col(amount)
    hunits = F.round(hv * F.lit(scale)).cast("decimal(38,0)")
    specs = [
        ("_c1", cfg.win_1h, present),
        ("_s1", cfg.win_1h, units),
        ("_c24", cfg.win_24h, present),
        ("_s24", cfg.win_24h, units),
        ("_ch", cfg.win_7d, hv.isNotNull().cast("bigint")),
        ("_sh", cfg.win_7d, hunits.cast("bigint")),
        ("_qh", cfg.win_7d, hunits * hunits),
    ]
    d = fr.sliding_sums(d, key, time, specs, chunked=chunked)
    if cfg.history == "strict":   # drop my own contribution: rows strictly before me
        own = F.coalesce(units, F.lit(0))
        d = (d.withColumn("_ch", F.col("_ch") - present)
             .withColumn("_sh", F.col("_sh") - own)
             .withColumn("_qh", F.col("_qh") - own.cast("decimal(38,0)") * own.cast("decimal(38,0)")))
    mean_h = F.when(F.col("_ch") > 0, F.col("_sh") / F.col("_ch") / F.lit(float(scale))).otherwise(0.0)
    std_h = _exact_std(F.col("_ch"), F.col("_sh"), F.col("_qh"), scale)
    d = (d.withColumn("cnt_1h", F.col("_c1").cast("int"))
         .withColumn("sum_amt_1h", F.col("_s1") / F.lit(float(scale)))
         .withColumn("cnt_24h", F.col("_c24").cast("int"))
         .withColumn("avg_amt_24h", F.when(F.col("_c24") > 0,
                                           F.col("_s24") / F.col("_c24") / F.lit(float(scale))).otherwise(0.0))
         .withColumn("mean_amt_7d_hist", mean_h)
         .withColumn("std_amt_7d_hist", std_h))
    d = d.withColumn("z_amt_vs_7d", (F.col(amount) - F.col("mean_amt_7d_hist"))
                     / F.nullif(F.col("std_amt_7d_hist"), F.lit(0.0)))
    d = d.drop("_c1", "_s1", "_c24", "_s24", "_ch", "_sh", "_qh", "_prev_" + amount, *fr.INTERNAL)
    return fr.with_untimed(d, df, time) if untimed else d


def _entity_frame(df, cfg, key, time, amount, tiebreak):
    d, _ = fr.with_order(df, key, time, tiebreak, target_rows=None, repartition=False)
    w = Window.partitionBy(key).orderBy(fr.ORD)
    scale = 10 ** cfg.amount_scale
    lagged = cfg.history == "lagged"
    d = d.withColumn("_hist", F.lag(amount).over(w) if lagged else F.col(amount))
    units, hunits = [F.round(F.col(c) * F.lit(scale)).cast("decimal(38,0)") for c in (amount, "_hist")]
    # a frame's sum is the sum up to its upper end less the sum up to its lower end: both frames grow, so each row
    # enters each once (Spark adds up a sliding frame anew for every row); on integers the difference is exact
    sums = {"_n": F.col(amount).isNotNull().cast("bigint"), "_s": units, "_hn": F.col("_hist").isNotNull().cast("bigint"), "_hs": hunits, "_hq": hunits * hunits}
    sums = {c: F.coalesce(v, F.lit(0)) for c, v in sums.items()}

    def upto(c, upper):
        return F.coalesce(F.sum(sums[c]).over(w.rangeBetween(Window.unboundedPreceding, upper)), F.lit(0))

    def frame(c, sec, upper=0):
        return upto(c, upper) - upto(c, -fr.frame_lower(sec) - 1)

    top = 0 if lagged else -1
    d = d.select("*", frame("_n", cfg.win_1h).alias("_c1"), frame("_s", cfg.win_1h).alias("_s1"),
                 frame("_n", cfg.win_24h).alias("_c24"), frame("_s", cfg.win_24h).alias("_s24"),
                 *[frame(c, cfg.win_7d, top).alias(c) for c in ("_hn", "_hs", "_hq")])
    unit = F.lit(float(scale))
    d = (d.withColumn("cnt_1h", F.col("_c1").cast("int"))
         .withColumn("sum_amt_1h", F.col("_s1").cast("double") / unit)
         .withColumn("cnt_24h", F.col("_c24").cast("int"))
         .withColumn("avg_amt_24h", F.when(F.col("_c24") > 0, F.col("_s24").cast("double") / F.col("_c24") / unit).otherwise(F.lit(0.0)))
         .withColumn("mean_amt_7d_hist", F.when(F.col("_hn") > 0, F.col("_hs").cast("double") / F.col("_hn") / unit).otherwise(F.lit(0.0)))
         .withColumn("std_amt_7d_hist", _exact_std(F.col("_hn"), F.col("_hs"), F.col("_hq"), scale)))
    d = d.withColumn("z_amt_vs_7d", (F.col(amount) - F.col("mean_amt_7d_hist"))
                     / F.nullif(F.col("std_amt_7d_hist"), F.lit(0.0)))
    return d.drop("_hist", "_c1", "_s1", "_c24", "_s24", "_hn", "_hs", "_hq", *fr.INTERNAL)


def add_fingerprint_time_features(df: DataFrame, cfg: FeatureConfig = FeatureConfig(), *,
                                  key: str = "fingerprint_key", time: str = "TransactionDT",
                                  id_col: str = "TransactionID",
                                  tiebreak: Sequence[str] = ("entity_key", "TransactionID"), untimed: bool = True) -> DataFrame:
    """fp_cnt_24h, fp_cnt_72h (non-null ids), fp_growth_ratio_24h_over_72h (float); null for rows without a time."""
    tiebreak = [c for c in tiebreak if c in df.columns]
    require_columns(df, [key, time, id_col], "fingerprint features")
    present = F.col(id_col).isNotNull().cast("bigint")
    if cfg.strategy == "frame":
        d, _ = fr.with_order(df, key, time, tiebreak, target_rows=None, repartition=False)
        w = Window.partitionBy(key).orderBy(fr.ORD)
        d = (d.withColumn("fp_cnt_24h", F.count(id_col).over(
                w.rangeBetween(-fr.frame_lower(cfg.win_24h), 0)).cast("int"))
             .withColumn("fp_cnt_72h", F.count(id_col).over(
                 w.rangeBetween(-fr.frame_lower(cfg.win_72h), 0)).cast("int")))
    else:
        d, chunked = fr.with_order(df, key, time, tiebreak, cfg.hot_key_rows)
        d = fr.sliding_sums(d, key, time, [("_f24", cfg.win_24h, present),
                                           ("_f72", cfg.win_72h, present)], chunked=chunked)
        d = (d.withColumn("fp_cnt_24h", F.col("_f24").cast("int"))
             .withColumn("fp_cnt_72h", F.col("_f72").cast("int")).drop("_f24", "_f72"))
    d = d.withColumn("fp_growth_ratio_24h_over_72h",
                     (F.col("fp_cnt_24h").cast("double")
                      / F.nullif(F.col("fp_cnt_72h").cast("double"), F.lit(0.0))).cast("float"))
    d = d.drop(*fr.INTERNAL)
    return fr.with_untimed(d, df, time) if untimed else d


def add_keys(df: DataFrame) -> DataFrame:
    """K1 + K2 columns (missing components / columns -> empty string)."""
    return df.withColumn("entity_key", entity_key(df)).withColumn("fingerprint_key", fingerprint_key(df))


def keep_feature_columns(df: DataFrame) -> DataFrame:
    """The reference keep-list, intersected with what is present, order preserved."""
    return df.select(*[c for c in FEATURE_KEEP_COLUMNS if c in df.columns])


def build_features(df: DataFrame, cfg: FeatureConfig = FeatureConfig(),
                   keep_chunking: bool = False, label=None, untimed: bool = True) -> DataFrame:
    """Keys -> keep-list -> entity features (+ label in the same pass) -> fingerprint features.

    Rows without a time come out with null features and label (``untimed=False``: there are none).

    ``keep_chunking`` keeps the per-key chunk-length columns for downstream
    operators on the same keys (the label); drop them with :func:`drop_internal`.
    """
    require_columns(df, ["TransactionID", "TransactionDT", "TransactionAmt"], "features",
                    message="Missing required column for features")
    every = work = keep_feature_columns(add_keys(df))
    if cfg.strategy == "delta":
        work = fr.prepare_hot_keys(work, ["entity_key", "fingerprint_key"], "TransactionDT",
                                   cfg.hot_key_rows)
    work = add_entity_time_features(work, cfg, label=label, untimed=False)
    work = add_fingerprint_time_features(work, cfg, untimed=False)
    if untimed:
        work = fr.with_untimed(work, every, "TransactionDT")
    return work if keep_chunking else drop_internal(work)


def drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_clen__")])


def feature_report(features: DataFrame) -> DataFrame:
    """Rows, columns and missing % of each engineered column, in one aggregate pass."""
    present = [c for c in ENGINEERED_COLUMNS if c in features.columns]
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [(F.avg(F.col(c).isNull().cast("double")) * 100.0).alias(c) for c in present]
    out = features.agg(*aggs)
    stacked = ", ".join(f"'{c}', `{c}`" for c in present)
    return out.select(F.col("rows"), F.lit(len(features.columns)).alias("cols"),
                      F.expr(f"stack({len(present)}, {stacked}) as (column, missing_pct)"))
