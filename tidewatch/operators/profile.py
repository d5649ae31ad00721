"""Audit, cleaning, de-duplication and the identity join.

Reports are small long-form DataFrames computed in as few passes as possible
(one ``agg`` for all per-column statistics); nothing row-level is collected.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.config import INGEST, AuditConfig, CleaningConfig
from tidewatch.functions.exprs import coerce_double, coerce_long, nan_to_null
from tidewatch.functions.keys import na_token
from tidewatch.operators.quantiles import exact_quantiles
from tidewatch.operators.schema import coerce_core_types, require_columns


def _stack(pairs: list[tuple[str, object]], key: str, value: str) -> str:
    body = ", ".join(f"'{k}', {v}" for k, v in pairs)
    return f"stack({len(pairs)}, {body}) as ({key}, {value})"


def missing_pct(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A1: ``(column, missing_pct)``, one aggregate pass over all requested columns.

    NaN counts as missing (pandas ``isna``) for floating columns.
    """
    cols = list(cols) if cols is not None else list(df.columns)
    types = dict(df.dtypes)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        miss = x.isNull() | F.isnan(x) if types[c] in ("double", "float") else x.isNull()
        aggs.append((F.avg(miss.cast("double")) * 100.0).alias(f"m{i}"))
    one = df.agg(*aggs)
    return one.select(F.expr(_stack([(c.replace("'", "\\'"), f"m{i}") for i, c in enumerate(cols)],
                                     "column", "missing_pct")))


def top_missing_columns(df: DataFrame, n: int = 15) -> DataFrame:
    """A2: top-n columns by missing %, rounded to 4 (ties by name); a top-n report."""
    m = missing_pct(df)
    return (m.select("column", F.round("missing_pct", 4).alias("missing_pct"))
            .orderBy(F.desc("missing_pct"), "column").limit(n))


def shape(df: DataFrame, key_columns: Sequence[str] = ()) -> dict:
    """A3: rows (one count job), columns, present / missing key columns."""
    return {"rows": df.count(), "columns": len(df.columns),
            "present_key_columns": [c for c in key_columns if c in df.columns],
            "missing_key_columns": [c for c in key_columns if c not in df.columns]}


def shape_frame(df: DataFrame, key_columns: Sequence[str] = ()) -> DataFrame:
    """A3 as one lazy row: rows, columns, key columns that are present and that are missing."""
    present = [c for c in key_columns if c in df.columns]
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"), F.lit(len(present)).alias("present_keys"),
                  F.lit(len(key_columns) - len(present)).alias("missing_keys"))


def time_coverage(df: DataFrame, time_col: str = "TransactionDT") -> DataFrame:
    """A4: min / max / missing % of the coerced time column."""
    t = coerce_long(F.col(time_col))
    return df.agg(F.min(t).alias("transaction_dt_min"), F.max(t).alias("transaction_dt_max"),
                  (F.avg(t.isNull().cast("double")) * 100.0).alias("transaction_dt_missing_pct"))


def label_distribution(df: DataFrame, label_col: str = "isFraud") -> tuple[DataFrame, DataFrame]:
    """A5: (missing %, rate % ignoring missing) and value counts including null."""
    y = coerce_double(F.col(label_col))
    summary = df.agg((F.avg(y.isNull().cast("double")) * 100.0).alias(f"{label_col}_missing_pct"),
                     (F.avg(y) * 100.0).alias(f"{label_col}_rate_pct"))
    counts = df.groupBy(F.col(label_col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return summary, counts


def _unpivot(df: DataFrame, cols: Sequence[str], value_type: str, value_expr=None) -> DataFrame:
    """Long form ``(column, value)`` via one ``inline`` (a single pass)."""
    expr = value_expr or (lambda c: F.col(f"`{c}`").cast(value_type))
    arr = F.array(*[F.struct(F.lit(c).alias("column"), expr(c).alias("value")) for c in cols])
    return df.select(F.inline(arr))


def numeric_sanity(df: DataFrame, cols: Sequence[str] = ("TransactionAmt", "card1", "card2", "addr1", "addr2"),
                   qs: Sequence[float] = (0.5, 0.95, 0.99), exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """Per column missing %, min, max and p50 / p95 / p99: exact (linear), or with ``exact=False`` values whose rank is
    within a part in ``accuracy`` of the rows (one aggregate for everything, no sort)."""
    cols = [c for c in cols if c in df.columns]
    long = _unpivot(df, cols, "double", lambda c: coerce_double(F.col(f"`{c}`")))
    base = long.groupBy("column").agg(
        (F.avg(F.col("value").isNull().cast("double")) * 100.0).alias("missing_pct"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    if not exact:
        sketch = F.percentile_approx(nan_to_null(F.col("value")), [float(x) for x in qs], accuracy)
        both = long.groupBy("column").agg((F.avg(F.col("value").isNull().cast("double")) * 100.0).alias("missing_pct"),
                                          F.min("value").alias("min"), F.max("value").alias("max"), sketch.alias("_q"))
        return both.select("column", "missing_pct", "min", "max", *[F.col("_q")[i].alias(f"p{int(round(x * 100))}") for i, x in enumerate(qs)])
    q = exact_quantiles(long, "value", list(qs), "linear", group_cols=["column"])
    piv = q.groupBy("column").agg(*[F.max(F.when(F.col("q") == x, F.col("value"))).alias(
        f"p{int(round(x * 100))}") for x in qs])
    return base.join(piv, "column", "left")


def top_categories(df: DataFrame, cols: Sequence[str] = ("ProductCD", "P_emaildomain", "R_emaildomain", "DeviceType"),
                   top_n: int = 10) -> DataFrame:
    """Top-n values per column incl. ``<NA>``; ties broken by value (ours, deterministic)."""
    cols = [c for c in cols if c in df.columns]
    long = _unpivot(df, cols, "string", lambda c: na_token(F.col(f"`{c}`")))
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    # row_number() <= n: each task keeps its own first n per column before the shuffle
    w = Window.partitionBy("column").orderBy(F.desc("count"), F.asc("value"))
    return counts.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= top_n).select("column", "value", "count", "rank")


def dtypes_frame(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Dtype snapshot as a small DataFrame."""
    types = dict(df.dtypes)
    rows = [(c, types[c]) for c in (cols or df.columns) if c in types]
    return df.sparkSession.createDataFrame(rows, "column string, dtype string")


def identity_coverage(df: DataFrame, cols: Sequence[str] = ("DeviceInfo", "DeviceType")) -> DataFrame | None:
    """% of rows with any identity column present; None if no such column."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return None
    anyp = F.coalesce(*[F.col(c) for c in present]).isNotNull() if len(present) > 1 else F.col(present[0]).isNotNull()
    return df.agg((F.avg(anyp.cast("double")) * 100.0).alias("rows_with_any_identity_pct"))


def build_audit_report(df: DataFrame, cfg: AuditConfig = AuditConfig()) -> dict:
    """Dict of small report DataFrames (lazy) plus the shape facts."""
    rep = {"shape": shape(df, cfg.key_columns)}
    present = [c for c in cfg.key_columns if c in df.columns]
    rep["time"] = time_coverage(df) if "TransactionDT" in df.columns else None
    rep["label"] = label_distribution(df) if "isFraud" in df.columns else None
    rep["missingness_pct"] = missing_pct(df, present)
    rep["identity_coverage"] = identity_coverage(df)
    rep["numeric_sanity"] = numeric_sanity(df)
    rep["top_categories"] = top_categories(df, top_n=cfg.top_n)
    return rep


def audit_table(df: DataFrame, cfg: AuditConfig = AuditConfig()) -> DataFrame:
    """A9 as one result: ``(section, item, metric, value, text)`` rows of the shape, dtypes (A8), event time, label counts,
    missingness, coverage, numeric sanity and top categories, all lazy in one plan."""
    present = [c for c in cfg.key_columns if c in df.columns]
    summary, counts = label_distribution(df) if "isFraud" in df.columns else (None, None)

    def rows(section: str, frame: DataFrame | None, item: str | None = None, text: str | None = None) -> DataFrame | None:
        if frame is None:
            return None
        cells = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in frame.columns if m not in (item, text)]
        return frame.select(F.lit(section).alias("section"), (F.col(item).cast("string") if item else F.lit("")).alias("item"),
                            (F.col(text).cast("string") if text else F.lit(None).cast("string")).alias("text"), F.inline(F.array(*cells)))

    parts = [rows("shape", shape_frame(df, cfg.key_columns)), rows("dtypes", dtypes_frame(df).withColumn("present", F.lit(1)), "column", "dtype"),
             rows("time", time_coverage(df) if "TransactionDT" in df.columns else None), rows("label", summary), rows("label_counts", counts, "value"),
             rows("missingness", missing_pct(df, present), "column"), rows("coverage", identity_coverage(df)), rows("numeric", numeric_sanity(df), "column"),
             rows("categories", top_categories(df, top_n=cfg.top_n), "column", "value")]
    out = None
    for p in parts:
        if p is not None:
            out = p if out is None else out.unionByName(p)
    return out.select("section", "item", "metric", "value", "text")


def duplicate_count(df: DataFrame, key: str = "TransactionID") -> DataFrame:
    """Rows beyond the first per key (null is one key value)."""
    return df.agg((F.count(F.lit(1)) - F.count_distinct(F.col(key))
                   - F.max(F.col(key).isNull().cast("int"))).alias("duplicate_rows"))


def drop_duplicates_keep_first(df: DataFrame, key: str = "TransactionID",
                               order_cols: Sequence[str] = ()) -> DataFrame:
    """One row per key, the first by an explicit order, or in ingest order where the rows carry it
    (``_ingest``, see :func:`tidewatch.sources.io.read_csv`); raises where there is neither.

    Written as an aggregate (``min_by`` of the row struct), so map-side partial
    aggregation collapses a key with huge numbers of copies before the shuffle;
    a ``row_number`` window would send all copies of a hot key to one task.
    """
    order_cols = list(order_cols) or [c for c in (INGEST,) if c in df.columns]
    if not order_cols:
        raise ValueError(f"which row of a repeated {key} is first? Give order_cols, or read the rows with their ingest order")
    others = [c for c in df.columns if c != key]
    if not others:
        return df.select(key).distinct()
    order = F.struct(*[F.col(f"`{c}`") for c in order_cols])
    row = F.struct(*[F.col(f"`{c}`") for c in others])
    g = df.groupBy(key).agg(F.min_by(row, order).alias("_row"))
    return g.select(*[F.col(key) if c == key else F.col("_row")[c].alias(c) for c in df.columns])


def clean_merged_dataset(df: DataFrame, cfg: CleaningConfig = CleaningConfig()) -> DataFrame:
    """A10: D2 (keep first) -> P4 type coercion. No imputation on purpose."""
    require_columns(df, ["TransactionID", "TransactionDT", "TransactionAmt", "isFraud"], "cleaning")
    out = df
    if cfg.enforce_transaction_id_unique:
        out = drop_duplicates_keep_first(out, "TransactionID", cfg.order_cols)
    if cfg.cast_types:
        out = coerce_core_types(out)
    return out


def cleaning_metrics(before: DataFrame, after: DataFrame) -> DataFrame:
    """A10 metrics: rows/cols before and after, core missing %, label rate, time range, J2."""
    core = ["TransactionID", "TransactionDT", "TransactionAmt", "isFraud"]
    a = after.agg(F.count(F.lit(1)).alias("rows_after"),
                  *[(F.avg(F.col(c).isNull().cast("double")) * 100.0).alias(f"missing_{c}_pct") for c in core],
                  (F.avg(F.col("isFraud").cast("double")) * 100.0).alias("label_rate_pct"),
                  F.min("TransactionDT").alias("transaction_dt_min"),
                  F.max("TransactionDT").alias("transaction_dt_max"))
    b = before.agg(F.count(F.lit(1)).alias("rows_before"))
    return b.crossJoin(a).select("rows_before", F.lit(len(before.columns)).alias("cols_before"),
                                 "rows_after", F.lit(len(after.columns)).alias("cols_after"), *a.columns[1:])


def merge_on_transaction_id(transactions: DataFrame, identities: DataFrame, key: str = "TransactionID",
                            assert_unique_right: bool = False) -> DataFrame:
    """Left outer join; right duplicates multiply rows; colliding names get ``_x``/``_y``.

    Join strategy is left to AQE (broadcast if the identity side is small at
    runtime, else sort-merge with skew splitting).
    """
    require_columns(transactions, [key], "merge")
    require_columns(identities, [key], "merge")
    if assert_unique_right:
        dup = identities.groupBy(key).count().filter("count > 1").limit(1).count()
        if dup:
            raise ValueError(f"identity table has duplicate {key}")
    common = (set(transactions.columns) & set(identities.columns)) - {key}
    lt = transactions.select(*[F.col(f"`{c}`").alias(c + "_x" if c in common else c) for c in transactions.columns])
    rt = identities.select(*[F.col(f"`{c}`").alias(c + "_y" if c in common else c) for c in identities.columns])
    return lt.join(rt, key, "left")
