"""Time-quantile split (SP1, SP2, A13)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import SplitConfig
from tidewatch.functions.exprs import coerce_long
from tidewatch.operators.quantiles import exact_quantiles


def cutoffs_frame(df: DataFrame, cfg: SplitConfig = SplitConfig()) -> DataFrame:
    """SP1 as a one-row DataFrame ``(train_end, valid_end)`` ("higher" quantiles)."""
    t = df.select(coerce_long(F.col(cfg.time_col)).alias("_t"))
    q = exact_quantiles(t, "_t", [cfg.train_quantile, cfg.valid_quantile], "higher")
    return q.agg(F.max(F.when(F.col("q") == cfg.train_quantile, F.col("value"))).cast("bigint").alias("train_end"),
                 F.max(F.when(F.col("q") == cfg.valid_quantile, F.col("value"))).cast("bigint").alias("valid_end"))


def compute_cutoffs(df: DataFrame, cfg: SplitConfig = SplitConfig()) -> tuple[int, int]:
    """SP1: driver values; raises on no valid times or inverted cutoffs."""
    row = cutoffs_frame(df, cfg).first()
    if row is None or row["train_end"] is None:
        raise ValueError(f"no row has a readable {cfg.time_col}, so there are no cutoffs")
    train_end, valid_end = int(row["train_end"]), int(row["valid_end"])
    if valid_end < train_end:
        raise ValueError(f"cutoffs out of order: valid_end {valid_end} < train_end {train_end} at quantiles {cfg.train_quantile}, {cfg.valid_quantile}")
    return train_end, valid_end


def assign_split(df: DataFrame, train_end, valid_end, time_col: str = "TransactionDT",
                 out: str = "split") -> DataFrame:
    """SP2: ``<= train_end`` train, ``<= valid_end`` valid, else test (ties stay together)."""
    t = F.col(time_col)
    te = train_end if hasattr(train_end, "alias") else F.lit(train_end)
    ve = valid_end if hasattr(valid_end, "alias") else F.lit(valid_end)
    return df.withColumn(out, F.when(t <= te, "train").when(t <= ve, "valid").otherwise("test"))


def time_split(df: DataFrame, cfg: SplitConfig = SplitConfig(), out: str = "split") -> DataFrame:
    """SP1 + SP2 without a driver round trip: the one-row cutoff table is broadcast."""
    cut = F.broadcast(cutoffs_frame(df, cfg))
    d = df.crossJoin(cut)
    return assign_split(d, F.col("train_end"), F.col("valid_end"), cfg.time_col, out) \
        .drop("train_end", "valid_end")


def split_report(df: DataFrame, split_col: str = "split", label_col: str = "y_ew_72h") -> DataFrame:
    """Per split count, positives and positive rate % (label null -> 0)."""
    y = F.coalesce(coerce_long(F.col(label_col)), F.lit(0)) if label_col in df.columns else F.lit(0)
    return df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("count"),
        F.sum(y).cast("bigint").alias("positive"),
        (F.avg(y.cast("double")) * 100.0).alias("positive_rate_pct"))
