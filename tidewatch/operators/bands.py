"""Capacity-based risk bands, band summaries and batch scoring.

NaN rule: a NaN score compares as *greater* than any cutoff in Spark, so it is
mapped to ``low`` explicitly (numpy semantics of the original).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidewatch.config import BAND_ACTIONS, BAND_ORDER, SERVING_CUTOFFS, BandPolicy
from tidewatch.functions.exprs import nan_to_null
from tidewatch.operators.metrics import boundaries
from tidewatch.operators.quantiles import exact_quantiles, prefix_sums
from tidewatch.operators.schema import require_columns
from tidewatch.session import scratch_table


def band_cutoffs(scored: DataFrame, policy: BandPolicy = BandPolicy(), score: str = "score",
                 n_buckets: int | None = None) -> DataFrame:
    """B1: one-row ``(critical, high, medium)``: exact linear quantiles at 1 - top% of the scores that are
    neither null nor NaN."""
    qs = {"critical": 1 - policy.critical_top_pct / 100.0, "high": 1 - policy.high_top_pct / 100.0,
          "medium": 1 - policy.medium_top_pct / 100.0}
    q = exact_quantiles(scored.select(F.col(score).cast("double").alias("_s")), "_s", list(qs.values()), "linear", n_buckets=n_buckets)
    return q.agg(*[F.max(F.when(F.abs(F.col("q") - F.lit(v)) < 1e-12, F.col("value"))).alias(k)
                   for k, v in qs.items()])


def band_expr(s: Column, critical, high, medium) -> Column:
    """B2 as an expression; cutoffs are columns or floats."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(float(x))
    missing = s.isNull() | F.isnan(s)
    return (F.when(missing, "low").when(s >= lit(critical), "critical").when(s >= lit(high), "high")
            .when(s >= lit(medium), "medium").otherwise("low"))


def assign_risk_band(df: DataFrame, cutoffs, score: str = "score", out: str = "risk_band") -> DataFrame:
    """B2: cutoffs as a dict of floats or a one-row DataFrame (broadcast)."""
    s = F.col(score).cast("double")
    if isinstance(cutoffs, Mapping):
        return df.withColumn(out, band_expr(s, cutoffs["critical"], cutoffs["high"], cutoffs["medium"]))
    c = cutoffs.select(F.col("critical").alias("_cc"), F.col("high").alias("_ch"), F.col("medium").alias("_cm"))
    d = df.crossJoin(F.broadcast(c))
    return d.withColumn(out, band_expr(s, F.col("_cc"), F.col("_ch"), F.col("_cm"))).drop("_cc", "_ch", "_cm")


def exact_capacity_bands(df: DataFrame, policy: BandPolicy = BandPolicy(), score: str = "score",
                         id_col: str = "id", out: str = "risk_band", n_buckets: int | None = None) -> DataFrame:
    """Exactly ``int(n*pct/100)`` rows in the cumulative top bands, of the ``n`` rows with a score.

    Order: score descending, then id ascending; ids are unique. Rows whose score is null or NaN
    are ``low`` and don't count. The boundary of each band is a score and, where a tie group
    straddles it, the last id inside: found on the collapsed scores and on the ids of the
    boundary groups only. The rows themselves are not shuffled.
    """
    names = ("critical", "high", "medium")
    s = df.select(nan_to_null(F.col(score).cast("double")).alias("s"), F.col(id_col).alias("id")).filter(F.col("s").isNotNull())
    counts = prefix_sums(s.groupBy("s").agg(F.count(F.lit(1)).alias("cnt")), ["s"], ["cnt"], n_buckets=n_buckets, descending=True)
    n = int(counts.agg(F.first("cnt_total")).first()[0] or 0)
    ks = [int(n * pct / 100) for pct in (policy.critical_top_pct, policy.high_top_pct, policy.medium_top_pct)]
    at = boundaries(counts, ks, "cnt_cum", ["s", "cnt"]) if n else [None] * 3
    rest = [k - (b["cnt_cum"] - b["cnt"]) if b is not None else 0 for b, k in zip(at, ks)]
    split = [i for i, (b, r) in enumerate(zip(at, rest)) if b is not None and 0 < r < b["cnt"]]
    last = {}
    if split:
        tie = s.filter(F.col("s").isin([at[i]["s"] for i in split])).withColumn("c", F.lit(1))
        ranked = prefix_sums(tie, ["id"], ["c"], ["s"], n_buckets=n_buckets)
        last = ranked.agg(*[F.max(F.when((F.col("s") == F.lit(at[i]["s"])) & (F.col("c_cum") <= rest[i]), F.col("id"))).alias(names[i])
                            for i in split]).first().asDict()
    x = nan_to_null(F.col(score).cast("double"))
    band = F.when(x.isNull(), F.lit("low"))
    for i, name in enumerate(names):
        if at[i] is None or ks[i] == 0:
            continue
        inside = x > F.lit(at[i]["s"])
        if rest[i] == at[i]["cnt"]:
            inside = inside | (x == F.lit(at[i]["s"]))
        elif i in split:
            inside = inside | ((x == F.lit(at[i]["s"])) & (F.col(id_col) <= F.lit(last[name])))
        band = band.when(inside, F.lit(name))
    return df.withColumn(out, band.otherwise("low"))


def band_summary(scored: DataFrame, label_col: str = "y_ew_72h", band_col: str = "risk_band") -> DataFrame:
    """B4 = A14 + A15: per-band count / positives / precision and the cumulative funnel.

    Output: one row per band in risk order (bands without rows are absent from
    the per-band columns but present in the funnel with zero counts).
    """
    spark = scored.sparkSession
    per = scored.groupBy(band_col).agg(F.count(F.lit(1)).alias("count"),
                                       F.sum(F.col(label_col).cast("bigint")).alias("positives"))
    order = spark.createDataFrame([(b, i) for i, b in enumerate(BAND_ORDER)], f"{band_col} string, band_rank int")
    d = order.join(per, band_col, "left")   # 4 rows
    w = Window.orderBy("band_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wa = Window.partitionBy(F.lit(1))       # 4-row table: one partition is the right plan
    rows, pos = F.coalesce(F.col("count"), F.lit(0)), F.coalesce(F.col("positives"), F.lit(0))
    d = d.select(band_col, "band_rank", "count", "positives",
                 (F.col("positives") / F.col("count")).alias("precision"),
                 F.sum(rows).over(w).alias("cum_rows"), F.sum(pos).over(w).alias("cum_captured_pos"),
                 F.sum(rows).over(wa).alias("total_rows"), F.sum(pos).over(wa).alias("total_positives"))
    return d.select("*",
                    (100.0 * F.col("cum_rows") / F.nullif(F.col("total_rows"), F.lit(0))).alias("cum_rows_pct"),
                    (F.col("cum_captured_pos") / F.nullif(F.col("total_positives"), F.lit(0))).alias("cum_recall"),
                    (F.col("cum_captured_pos") / F.nullif(F.col("cum_rows"), F.lit(0))).alias("cum_precision"),
                    (F.col("total_positives") / F.nullif(F.col("total_rows"), F.lit(0))).alias("base_rate"))


def band_action(band: Column) -> Column:
    """Band -> recommended action (4-entry literal map)."""
    m = F.create_map(*[x for b in BAND_ORDER for x in (F.lit(b), F.lit(BAND_ACTIONS[b]))])
    return m[band]


def score_batch(df: DataFrame, scorer: Callable[[DataFrame], DataFrame], policy: BandPolicy = BandPolicy(),
                id_col: str = "TransactionID") -> DataFrame:
    """Score -> cutoffs from *this* batch -> bands (``scorer`` appends ``score``)."""
    scored = scorer(df)
    if policy.policy == "exact_k":
        return exact_capacity_bands(scored, policy, "score", id_col)
    return assign_risk_band(scored, band_cutoffs(scored, policy))


@dataclass(frozen=True)
class BatchReport:
    """What a batch score job did: where the rows are, the cutoffs it used, and the counts."""

    path: str
    cutoffs: dict
    counts: dict


def run_batch(df: DataFrame, scorer: Callable[[DataFrame], DataFrame], path: str, required: Sequence[str] = (), policy: BandPolicy = BandPolicy(),
              id_col: str = "TransactionID", partition_by: Sequence[str] = ("risk_band",)) -> BatchReport:
    """The batch score job: required columns (raises before any work) -> score -> cutoffs of *this* batch -> bands ->
    partitioned Parquet at ``path`` -> counts.

    The scorer runs once (its output is written, as the cutoffs read it before the bands can be set); the counts of rows, of
    rows without a score and of each band are observed while the table is written, without another pass.
    """
    require_columns(df, required, "batch scoring")
    scored = scratch_table(scorer(df), "batch-scores")
    cutoffs = {}
    if policy.policy == "exact_k":
        banded = exact_capacity_bands(scored, policy, "score", id_col)
    else:
        cut = band_cutoffs(scored, policy)
        cutoffs = cut.first().asDict()        # one row
        # of a batch without any score the cutoffs are null, and all rows are low
        banded = assign_risk_band(scored, {k: F.lit(v).cast("double") for k, v in cutoffs.items()})
    seen = Observation("batch")
    number = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0).cast("bigint"))
    banded = banded.observe(seen, F.count(F.lit(1)).alias("rows"), number(nan_to_null(F.col("score").cast("double")).isNull()).alias("without_score"),
                            *[number(F.col("risk_band") == b).alias(b) for b in BAND_ORDER])
    banded.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return BatchReport(path, cutoffs, dict(seen.get))


def serving_bands(df: DataFrame, raw: str = "raw_score", calibrated: str = "score",
                  cutoffs: Mapping[str, float] = SERVING_CUTOFFS) -> DataFrame:
    """Frozen cutoffs, probabilities rounded to 6, band and action per row."""
    d = df.withColumn("raw_fraud_probability", F.round(F.col(raw), 6)) \
          .withColumn("calibrated_fraud_probability", F.round(F.col(calibrated), 6))
    d = d.withColumn("risk_band", band_expr(F.col(calibrated), cutoffs["critical"], cutoffs["high"],
                                            cutoffs["medium"]))
    return d.withColumn("recommended_action", band_action(F.col("risk_band")))


def review_queue(scored: DataFrame, band_col: str = "risk_band", score: str = "score", id_col: str = "id") -> DataFrame:
    """O2: rows in review order: band rank (critical first), score desc, id (global sort)."""
    rank = F.array_position(F.array(*[F.lit(b) for b in BAND_ORDER]), F.col(band_col))
    return scored.orderBy(rank, F.desc(score), F.asc(id_col))


def top_k(scored: DataFrame, k: int, score: str = "score", id_col: str = "id") -> DataFrame:
    """O3: the k highest scores (ties by id); a top-k report, planned as a per-partition
    top-k merged in one task (k rows), never a global sort."""
    return scored.orderBy(F.desc(score), F.asc(id_col)).limit(k)


def head_sample(df: DataFrame, n: int, order_cols, seed: int | None = None, fraction: float | None = None) -> DataFrame:
    """The first n rows by an explicit order, or a seeded Bernoulli sample."""
    if fraction is not None:
        return df.sample(fraction=fraction, seed=seed)
    return df.orderBy(*order_cols).limit(n)
