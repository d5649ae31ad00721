"""Temperature scaling.

The fit minimises mean BCE(sigmoid(logit / T), y) on the validation split. It is
1-D and convex in log T near the optimum, so instead of a driver-side
optimiser loop over the data, each pass evaluates a whole grid of T values in a
single aggregate (rows x grid, combined map-side) and the next pass zooms in.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.metrics import LOGLOSS_EPS


def _bce(z: Column, y: Column) -> Column:
    # numerically stable BCE with logits: max(z,0) - z*y + log(1 + exp(-|z|))
    return F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))


def fit_temperature(valid: DataFrame, logit: str = "logit", y: str = "y", passes: int = 4,
                    grid: int = 33, lo: float = 0.05, hi: float = 20.0) -> float:
    """argmin_T mean BCE on ``valid`` (driver gets one float)."""
    if valid.isEmpty():
        raise ValueError("validation split is empty")
    a, b = math.log(lo), math.log(hi)
    best = 1.0
    base = valid.select(F.col(logit).cast("double").alias("_z"), F.col(y).cast("double").alias("_y"))
    for _ in range(passes):
        ts = [math.exp(a + (b - a) * i / (grid - 1)) for i in range(grid)]
        # one aggregate column for each temperature: a pass reads every row once
        r = base.agg(*[F.avg(_bce(F.col("_z") / F.lit(t), F.col("_y"))).alias(f"t{i}") for i, t in enumerate(ts)]).first()
        best = min((r[f"t{i}"], t) for i, t in enumerate(ts))[1]
        step = (b - a) / (grid - 1)
        a, b = math.log(best) - 2 * step, math.log(best) + 2 * step
    return best


def apply_temperature(df: DataFrame, temperature: float | None, logit: str = "logit", out: str = "score") -> DataFrame:
    """``sigmoid(logit / T)``; T missing or <= 0 -> uncalibrated sigmoid."""
    z = F.col(logit).cast("double")
    if temperature is not None and temperature > 0:
        z = z / F.lit(float(temperature))
    return df.withColumn(out, F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))


def calibration_report(valid: DataFrame, temperature: float, logit: str = "logit", y: str = "y") -> DataFrame:
    """Brier and log-loss before / after scaling, one aggregate pass."""
    yy = F.col(y).cast("double")

    def probs(t):
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col(logit).cast("double") / F.lit(t)))

    def ll(p):
        q = F.least(F.greatest(p, F.lit(LOGLOSS_EPS)), F.lit(1 - LOGLOSS_EPS))
        return F.avg(-(yy * F.log(q) + (1 - yy) * F.log(1 - q)))

    p0, p1 = probs(1.0), probs(temperature)
    return valid.agg(F.lit(float(temperature)).alias("temperature"),
                     F.avg(F.pow(p0 - yy, 2)).alias("brier_before"), F.avg(F.pow(p1 - yy, 2)).alias("brier_after"),
                     ll(p0).alias("logloss_before"), ll(p1).alias("logloss_after"))
