"""Forward-looking early-warning label.

``any_in_horizon`` (documented contract, default): 1 iff a fraud of the same
entity happens at ``t_f`` with ``0 < t_f - t <= H``.

``next_event`` (what the reference code computes): 1 iff the *immediately
next* row of the entity (time, tiebreak order) is a fraud and ``0 < dt <= H``;
a tied next row gives dt = 0, hence 0.

Both are computed without a per-key partition: the key series is chunked by
time (see :mod:`tidewatch.operators.frames`).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.config import LabelConfig
from tidewatch.functions.exprs import coerce_long
from tidewatch.operators import frames as fr
from tidewatch.operators.schema import require_columns


def make_early_warning_label(df: DataFrame, cfg: LabelConfig = LabelConfig(), *,
                             entity_col: str = "entity_key", time_col: str = "TransactionDT",
                             fraud_col: str = "isFraud",
                             tiebreak: Sequence[str] = ("TransactionID",),
                             strategy: str = "chunked", untimed: bool = True) -> DataFrame:
    """Append ``cfg.label_name`` (ByteType) to every row; no row is dropped. A row without a time has a null label
    (``untimed=False``: the caller has none, or adds them itself)."""
    require_columns(df, [entity_col, time_col, fraud_col], "labeling",
                    message="Missing required columns for labeling")
    tiebreak = [c for c in tiebreak if c in df.columns]
    H = cfg.horizon_seconds
    fraud = F.coalesce(coerce_long(F.col(fraud_col)), F.lit(0)) == 1
    name = cfg.label_name
    if strategy == "frame":
        d, _ = fr.with_order(df, entity_col, time_col, tiebreak, target_rows=None, repartition=False)
        if cfg.mode == "any_in_horizon":
            w = Window.partitionBy(entity_col).orderBy(time_col).rangeBetween(1, H)
            y = F.coalesce(F.max(fraud.cast("int")).over(w), F.lit(0))
        else:
            w = Window.partitionBy(entity_col).orderBy(fr.ORD)
            dt = F.lead(time_col).over(w) - F.col(time_col)
            y = F.when(F.lead(fraud).over(w) & (dt > 0) & (dt <= H), 1).otherwise(0)
        d = d.withColumn(name, y.cast("byte")).drop(*fr.INTERNAL)
        return fr.with_untimed(d, df, time_col) if untimed else d
    d, chunked = fr.with_order(df, entity_col, time_col, tiebreak, cfg.hot_key_rows)
    d = label_ordered(d, cfg, entity_col, time_col, fraud_col, chunked)
    d = d.drop(*fr.INTERNAL)
    return fr.with_untimed(d, df, time_col) if untimed else d


def label_ordered(d: DataFrame, cfg: LabelConfig, entity_col: str, time_col: str, fraud_col: str,
                  chunked: bool) -> DataFrame:
    """The label on a series already ordered by :func:`frames.with_order` (lets the
    entity-feature pass compute it without another shuffle)."""
    H = cfg.horizon_seconds
    fraud = F.coalesce(coerce_long(F.col(fraud_col)), F.lit(0)) == 1
    name = cfg.label_name
    if cfg.mode == "any_in_horizon":
        d = fr.next_time_where(d, entity_col, time_col, fraud, "_next_fraud_t", chunked=chunked)
        dt = F.col("_next_fraud_t") - F.col(time_col)
        return d.withColumn(name, F.when(dt <= H, 1).otherwise(0).cast("byte")).drop("_next_fraud_t")
    if cfg.mode == "next_event":
        d = d.withColumn("_is_fraud", fraud)
        d = fr.next_values(d, entity_col, [time_col, "_is_fraud"], chunked=chunked)
        dt = F.col("_next_" + time_col) - F.col(time_col)
        y = F.when(F.col("_next__is_fraud") & (dt > 0) & (dt <= H), 1).otherwise(0)
        return d.withColumn(name, y.cast("byte")).drop("_is_fraud", "_next__is_fraud", "_next_" + time_col)
    raise ValueError(f"unknown label mode {cfg.mode!r}")


def label_metrics(labeled: DataFrame, cfg: LabelConfig = LabelConfig()) -> DataFrame:
    """L3: horizon, name, positive pct / count / total (one aggregate)."""
    y = F.col(cfg.label_name)
    return labeled.agg(
        F.lit(cfg.horizon_seconds).cast("bigint").alias("horizon_seconds"),
        F.lit(cfg.label_name).alias("label_name"),
        (F.avg(y.cast("double")) * 100.0).alias("positive_rate_pct"),
        F.sum(y.cast("bigint")).alias("positive_count"),
        F.count(F.lit(1)).alias("total_rows"))
