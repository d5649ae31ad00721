"""Train-only preprocessing (M1, M2, M4, M5, M9).

Fitted statistics are one-row DataFrames (cross-joined with a broadcast, so
transforms never need a driver round trip) and can be written as Parquet/JSON.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.exprs import nan_to_null
from tidewatch.operators.quantiles import exact_quantiles


def freeze(fitted: DataFrame) -> DataFrame:
    """Fitted statistics are tiny (one row, or one row per feature): compute them
    once and keep them as a local table, so transforms never re-run the fit."""
    return fitted.sparkSession.createDataFrame(fitted.collect(), fitted.schema)


def fit_standardizer(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M1: mean and population std per column (missing skipped); std 0 / undefined -> 1."""
    aggs = []
    for c in cols:
        x = nan_to_null(F.col(c))
        aggs += [F.avg(x).alias(f"{c}__mean"),
                 F.coalesce(F.nullif(F.stddev_pop(x), F.lit(0.0)), F.lit(1.0)).alias(f"{c}__std")]
    return freeze(train.agg(*aggs))


def transform_numeric(df: DataFrame, stats: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """M2: ``(x - mean) / std``; missing -> 0 after scaling; float32."""
    d = df.crossJoin(F.broadcast(stats))
    # with a suffix the raw columns are kept next to the scaled ones, else replaced
    out = [F.col(c) for c in df.columns if suffix or c not in cols]
    scaled = [F.coalesce((nan_to_null(F.col(c)) - F.col(f"{c}__mean")) / F.col(f"{c}__std"), F.lit(0.0))
              .cast("float").alias(c + suffix) for c in cols]
    return d.select(*out, *scaled)


def fit_median_scaler(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M4 fit: exact median per column (imputation) and population std of the imputed column."""
    long = train.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), nan_to_null(F.col(c)).alias("value"))
                                           for c in cols])))
    med = exact_quantiles(long, "value", [0.5], "linear", group_cols=["feature"]) \
        .select("feature", F.col("value").alias("median"))
    med = freeze(med)
    # one row in, no row for each of its columns: the deviations are aggregates of the imputed columns
    at = {r["feature"]: F.lit(r["median"]) for r in med.collect()}
    wide = train.agg(*[F.coalesce(F.nullif(F.stddev_pop(F.coalesce(nan_to_null(F.col(c)), at[c])), F.lit(0.0)), F.lit(1.0)).alias(c) for c in at], F.count(F.lit(1)).alias("_n"))
    sd = wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("scale")) for c in at]))) if at else med.select("feature", F.lit(1.0).alias("scale"))
    return freeze(med.join(sd, "feature"))


def apply_median_scaler(df: DataFrame, fitted: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M4 transform: impute median, divide by std (no centring, like ``with_mean=False``)."""
    wide = fitted.agg(*[F.max(F.when(F.col("feature") == c, F.struct("median", "scale"))).alias(f"_{i}")
                        for i, c in enumerate(cols)])
    d = df.crossJoin(F.broadcast(wide))
    return d.select(*[c for c in df.columns if c not in cols],
                    *[(F.coalesce(nan_to_null(F.col(c)), F.col(f"_{i}.median")) / F.col(f"_{i}.scale")).alias(c)
                      for i, c in enumerate(cols)])


def fit_modes(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M5 fit: most frequent non-null value per column (ties: smallest value).

    Two aggregates (max count, then min value at that count): no per-column
    window, so a column with many distinct values is never gathered in one task.
    """
    long = train.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
                                           for c in cols]))).filter(F.col("value").isNotNull())
    cnt = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    top = cnt.groupBy("feature").agg(F.max("n").alias("_max"))
    return freeze(cnt.join(F.broadcast(top), "feature").filter(F.col("n") == F.col("_max"))
                  .groupBy("feature").agg(F.min("value").alias("mode")))


def one_hot_pipeline(cols: Sequence[str]):
    """M5 transform stages: StringIndexer(keep) + OneHotEncoder(dropLast) -> unknown maps to zeros."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    idx = StringIndexer(inputCols=list(cols), outputCols=[f"{c}__idx" for c in cols], handleInvalid="keep",
                        stringOrderType="frequencyDesc")
    ohe = OneHotEncoder(inputCols=[f"{c}__idx" for c in cols], outputCols=[f"{c}__oh" for c in cols], dropLast=True)
    return [idx, ohe]


def impute_modes(df: DataFrame, modes: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M5 impute: null -> the column's training mode."""
    wide = modes.agg(*[F.max(F.when(F.col("feature") == c, F.col("mode"))).alias(f"_m{i}") for i, c in enumerate(cols)])
    d = df.crossJoin(F.broadcast(wide))
    return d.select(*[c for c in df.columns if c not in cols],
                    *[F.coalesce(F.col(c).cast("string"), F.col(f"_m{i}")).alias(c) for i, c in enumerate(cols)])


def class_weights(train: DataFrame, y: str) -> DataFrame:
    """M9: ``pos_weight = neg / max(pos, 1)`` and balanced weights ``n / (2 n_c)``."""
    return freeze(train.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col(y) == 1).cast("bigint")).alias("pos"),
        F.sum((F.col(y) != 1).cast("bigint")).alias("neg"),
    ).select("*", (F.col("neg") / F.greatest(F.col("pos"), F.lit(1))).alias("pos_weight"),
             (F.col("n") / (2.0 * F.col("pos"))).alias("w_pos"), (F.col("n") / (2.0 * F.col("neg"))).alias("w_neg")))


def with_balanced_weight(df: DataFrame, weights: DataFrame, y: str, out: str = "w") -> DataFrame:
    """M9 apply: per-row class weight column."""
    d = df.crossJoin(F.broadcast(weights.select("w_pos", "w_neg")))
    return d.withColumn(out, F.when(F.col(y) == 1, F.col("w_pos")).otherwise(F.col("w_neg"))).drop("w_pos", "w_neg")


def feature_schema(df: DataFrame, numeric=None, keys=("entity_key", "fingerprint_key")) -> dict:
    """M3: the model's input contract = fixed numeric list + key columns, filtered by presence."""
    from tidewatch.config import NUMERIC_FEATURES
    numeric = NUMERIC_FEATURES if numeric is None else numeric
    return {"numeric_cols": [c for c in numeric if c in df.columns],
            "key_cols": [c for c in keys if c in df.columns]}
