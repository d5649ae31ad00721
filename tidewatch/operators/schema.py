"""Contracts, projections, coercion and filters.

Presence checks read ``df.columns`` only (no Spark job). Value constraints are
evaluated lazily into a ``violations`` array so bad rows can be quarantined
instead of failing a 100 TB job on one row.
"""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.config import CORRUPT
from tidewatch.functions.exprs import coerce_double, coerce_long


def require_columns(df: DataFrame, required: Iterable[str], what: str = "",
                    message: str = "Missing required columns") -> None:
    """V1: raise ``ValueError("Missing required columns: [...]")`` (sorted)."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{message}: {missing}")


# Fixed constraint set of the scoring request contract (reference API schema).
SCORING_CONSTRAINTS: dict[str, str] = {
    "TransactionAmt": "gt0",
    "cnt_1h": "ge0", "sum_amt_1h": "ge0", "cnt_24h": "ge0", "avg_amt_24h": "ge0",
    "std_amt_7d_hist": "ge0", "fp_cnt_24h": "ge0", "fp_cnt_72h": "ge0",
    "fp_growth_ratio_24h_over_72h": "ge0_nullable", "z_amt_vs_7d": "nullable",
    "mean_amt_7d_hist": "any", "entity_key": "required", "fingerprint_key": "required",
}


def _rule(c: str, rule: str) -> Column:
    x = F.col(c)
    if rule == "gt0":
        bad = x.isNull() | ~(x.cast("double") > 0)
    elif rule == "ge0":
        bad = x.isNull() | ~(x.cast("double") >= 0)
    elif rule == "ge0_nullable":
        bad = x.isNotNull() & ~(x.cast("double") >= 0)
    elif rule == "required":
        bad = x.isNull()
    else:
        bad = F.lit(False)
    return F.when(bad, F.lit(f"{c}:{rule}"))


def check_constraints(df: DataFrame, rules: Mapping[str, str] = SCORING_CONSTRAINTS) -> DataFrame:
    """V2: add ``violations array<string>`` (missing column -> ``col:missing``; a row that its reader could not parse -> ``row:corrupt``)."""
    items = [F.when(F.col(CORRUPT).isNotNull(), F.lit("row:corrupt"))] if CORRUPT in df.columns else []
    for c, rule in rules.items():
        if c in df.columns:
            items.append(_rule(c, rule))
        elif rule not in ("nullable", "any", "ge0_nullable"):
            items.append(F.lit(f"{c}:missing"))
    arr = F.array_compact(F.array(*items)) if items else F.array().cast("array<string>")
    return df.withColumn("violations", arr)


def split_valid(df: DataFrame, rules: Mapping[str, str] = SCORING_CONSTRAINTS) -> tuple[DataFrame, DataFrame]:
    """V2: (valid rows, quarantined rows with their violations)."""
    checked = check_constraints(df, rules)
    ok = checked.filter(F.size("violations") == 0).drop("violations")
    bad = checked.filter(F.size("violations") > 0)
    return ok, bad


def project_present(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Keep-list intersected with present columns, order preserved."""
    return df.select(*[c for c in keep if c in df.columns])


def feature_columns(df: DataFrame, exclude: Iterable[str] = ("isFraud", "y_ew_72h", "split")) -> list[str]:
    """All columns except target/split."""
    ex = set(exclude)
    return [c for c in df.columns if c not in ex]


def coerce_core_types(df: DataFrame, longs: Iterable[str] = ("TransactionDT",),
                      doubles: Iterable[str] = ("TransactionAmt",),
                      ints: Iterable[str] = ("isFraud",)) -> DataFrame:
    """``to_numeric(errors='coerce')`` via ``try_cast``; bad text -> null."""
    for c in longs:
        if c in df.columns:
            df = df.withColumn(c, coerce_long(F.col(c)))
    for c in doubles:
        if c in df.columns:
            df = df.withColumn(c, coerce_double(F.col(c)))
    for c in ints:
        if c in df.columns:
            df = df.withColumn(c, coerce_long(F.col(c)).cast("int"))
    return df


def fill_zero(c) -> Column:
    """P5."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0))


def zero_to_null(c) -> Column:
    """P6."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(c, F.lit(0))


def split_filter(df: DataFrame, *splits: str, split_col: str = "split") -> DataFrame:
    """rows of the given split(s)."""
    return df.filter(F.col(split_col).isin(list(splits)))


def require_nonempty(df: DataFrame, what: str) -> None:
    """F1 guard: the reference raises on an empty valid/test split."""
    if df.isEmpty():
        raise ValueError(f"the {what} part of the split is empty")
