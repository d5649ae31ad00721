"""Distributed prefix sums (X1) and exact quantiles (A11 linear, A12 "higher").

A global running sum written as an unpartitioned window runs in one task. The
prefix sum here instead:

1. range-partitions the rows on (groups, order columns) and writes them once to
   the shared checkpoint folder with their partition number as a column;
2. totals per (group, partition), prefix-summed over a group's partitions (the
   table has at most one row per partition and group);
3. runs the running sum inside each (group, partition) and adds the offset.

Any number of groups and partitions works, nothing is collected, and the input
is computed once (the sample that finds the ranges reuses its shuffle). A row's
partition is stored, so later steps and lost executors see the same one. Equal
order keys share a partition, so callers collapse ties first
(``groupBy(value)``) or order by an id as well.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.exprs import nan_to_null
from tidewatch.session import scratch_table


def _as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, str):
        return [x]
    return list(x)


def assign_bin(d: DataFrame, value: Column, edges: Sequence[Column], out: str) -> DataFrame:
    """Add ``out`` = number of ``edges`` (columns or literals, any order) strictly below ``value``; 0 for null."""
    below = [F.coalesce((value > e).cast("int"), F.lit(0)) for e in edges]
    total = below[0] if below else F.lit(0)
    for b in below[1:]:
        total = total + b
    return d.withColumn(out, total)


def prefix_sums(df: DataFrame, order_cols, sum_cols, group_cols=(), n_buckets: int | None = None,
                suffix: str = "_cum", descending: bool = False, keep_bucket: bool = False) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` in (``order_cols``) order within each group.

    Adds ``<c><suffix>`` (sum over rows at or before this row) and ``<c>_total``.
    ``descending`` orders by the leading column descending (others ascending).
    The number of partitions follows the data's size (adaptive execution merges
    small ones); ``n_buckets`` forces one. Runs the write of the partitioned rows
    at once; what it returns is lazy.
    """
    order_cols, sum_cols, groups = _as_list(order_cols), _as_list(sum_cols), _as_list(group_cols)
    first = F.col(order_cols[0]).desc() if descending else F.col(order_cols[0]).asc()
    order = [first, *[F.col(c).asc() for c in order_cols[1:]]]
    keys = [*[F.col(c).asc() for c in groups], *order]
    d = df.repartitionByRange(n_buckets, *keys) if n_buckets else df.repartitionByRange(*keys)
    d = scratch_table(d.withColumn("_bucket", F.spark_partition_id()), "prefix")
    tot = d.groupBy(*groups, "_bucket").agg(*[F.sum(c).alias(c) for c in sum_cols])
    wb = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    wt = Window.partitionBy(*groups)
    # groups may be null: join on null-safe copies of the keys
    gk = ["_g%d" % i for i in range(len(groups))]
    tot = tot.select(*[F.col(c).alias(k) for c, k in zip(groups, gk)], F.col("_bucket").alias("_b"),
                     *[F.coalesce(F.sum(c).over(wb), F.lit(0)).alias("_off_" + c) for c in sum_cols],
                     *[F.sum(c).over(wt).alias(c + "_total") for c in sum_cols])
    wr = (Window.partitionBy(*groups, "_bucket").orderBy(*order)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.select("*", *[F.sum(c).over(wr).alias("_run_" + c) for c in sum_cols])
    on = F.col("_bucket") == F.col("_b")
    for c, k in zip(groups, gk):
        on = on & F.col(c).eqNullSafe(F.col(k))
    d = d.join(tot, on, "left")
    out = [F.col(c) for c in df.columns]
    out += [(F.col("_run_" + c) + F.col("_off_" + c)).alias(c + suffix) for c in sum_cols]
    out += [F.col(c + "_total") for c in sum_cols]
    if keep_bucket:
        out.append(F.col("_bucket"))
    return d.select(*out)


def next_value(cum: DataFrame, value: str, group_cols=(), out: str = "_next") -> DataFrame:
    """Next larger distinct ``value`` per group, for a :func:`prefix_sums` output with
    ``keep_bucket=True`` over distinct values: lead inside the bucket, and across
    a bucket edge the smallest value of the next non-empty bucket (tiny table)."""
    groups = _as_list(group_cols)
    w = Window.partitionBy(*groups, "_bucket").orderBy(value)
    d = cum.withColumn(out, F.lead(value).over(w))
    first = cum.groupBy(*groups, "_bucket").agg(F.min(value).alias("_bmin"))
    wb = Window.partitionBy(*groups).orderBy("_bucket")
    first = first.select(*groups, "_bucket", F.lead("_bmin").over(wb).alias("_bnext"))
    d = d.join(first, [*groups, "_bucket"], "left")
    return d.withColumn(out, F.coalesce(F.col(out), F.col("_bnext"))).drop("_bnext")


def value_counts_cum(df: DataFrame, col: str, group_cols=(), weight: Column | None = None,
                     n_buckets: int | None = None) -> DataFrame:
    """Distinct values (neither null nor NaN) with count and inclusive cumulative count (ascending)."""
    groups = _as_list(group_cols)
    w = weight if weight is not None else F.lit(1)
    if dict(df.dtypes)[col] in ("double", "float"):
        df = df.withColumn(col, nan_to_null(F.col(col)))
    c = (df.filter(F.col(col).isNotNull()).groupBy(*groups, col)
         .agg(F.sum(w.cast("bigint")).alias("n")))
    return prefix_sums(c, [col], ["n"], groups, n_buckets)


def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float], interpolation: str = "linear",
                    group_cols=(), n_buckets: int | None = None) -> DataFrame:
    """Exact quantiles of ``col`` (without nulls and NaN) per group, one row per (group, q).

    ``linear``: pandas / numpy default, position ``q*(n-1)`` interpolated.
    ``higher``: element at 0-based ``ceil(q*(n-1))`` (not ``percentile_disc``).
    ``lower``: element at ``floor(q*(n-1))``.
    One aggregate with two conditional minima per q over the cumulative counts.
    """
    if interpolation not in ("linear", "higher", "lower"):
        raise ValueError(interpolation)
    groups = _as_list(group_cols)
    cum = value_counts_cum(df, col, groups, n_buckets=n_buckets)
    v, cells = F.col(col), []
    aggs = [F.first("n_total").alias("_n")]
    for i, q in enumerate(qs):
        pos = F.lit(float(q)) * (F.col("n_total") - 1)
        aggs += [F.min(F.when(F.col("n_cum") >= F.floor(pos) + 1, v)).alias(f"_lo{i}"),
                 F.min(F.when(F.col("n_cum") >= F.ceil(pos) + 1, v)).alias(f"_hi{i}")]
        at = F.lit(float(q)) * (F.col("_n") - 1)
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        if interpolation == "linear":
            lo, hi = lo.cast("double"), hi.cast("double")
            value = F.when(hi == lo, lo).otherwise(lo + (hi - lo) * (at - F.floor(at)))
        else:
            value = hi if interpolation == "higher" else lo
        cells.append(F.struct(F.lit(float(q)).alias("q"), value.alias("value")))
    agg = cum.groupBy(*groups).agg(*aggs) if groups else cum.agg(*aggs)
    return agg.select(*groups, F.inline(F.array(*cells)))


def approx_quantiles(df: DataFrame, col: str, qs: Sequence[float], group_cols=(), accuracy: int = 10_000) -> DataFrame:
    """A6 / A11 from mergeable sketches: one row per (group, q), in one aggregate of bounded state, without a sort or a
    shuffle of values. The answer is a value of the column (neither null nor NaN) whose rank is within
    ``n / accuracy`` of ``q * n``."""
    groups = _as_list(group_cols)
    d = df.select(*groups, nan_to_null(F.col(col).cast("double")).alias("_v")).filter(F.col("_v").isNotNull())
    agg = F.percentile_approx("_v", [float(q) for q in qs], accuracy).alias("_q")
    got = d.groupBy(*groups).agg(agg) if groups else d.agg(agg)
    return got.select(*groups, F.inline(F.arrays_zip(F.array(*[F.lit(float(q)) for q in qs]).alias("q"), F.col("_q").alias("value"))))


def quantile_dict(df: DataFrame, col: str, qs: Sequence[float], interpolation: str = "linear") -> dict:
    """Driver-side ``{q: value}`` for a handful of quantiles (the result is tiny)."""
    return {r["q"]: r["value"] for r in exact_quantiles(df, col, qs, interpolation).collect()}
