"""Scalar expressions: coercion (P4), null/NaN rules, guarded division, rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """Missing is always null inside the engine: NaN -> null at ingress."""
    c = col(c).cast("double")
    return F.nanvl(c, F.lit(None).cast("double"))


def coerce_double(c) -> Column:
    """``pd.to_numeric(errors='coerce')`` for floats: bad text -> null, NaN -> null."""
    return nan_to_null(col(c).try_cast("double"))


def coerce_long(c) -> Column:
    """Integer coercion: ``"86400"`` and ``"86400.0"`` parse; fractions and junk -> null."""
    d = coerce_double(c)
    return F.when(d == F.floor(d), d.try_cast("bigint"))


def safe_div(num, den) -> Column:
    """num / den with a zero (or null) denominator giving null."""
    return col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))


def sigmoid(c) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(c)))


def fixed4(c) -> Column:
    """Round half-up to 4 decimals the same way on Spark and DuckDB.

    ``round`` differs between engines on decimal ties; ``floor(x*1e4+0.50001)/1e4``
    is bit-identical on both sides (the oracle SQL uses the same expression).
    """
    return (F.floor(col(c) * F.lit(10000.0) + F.lit(0.50001)).cast("double") / F.lit(10000.0))


def fixed4_sql(expr: str) -> str:
    """The DuckDB/ANSI text of :func:`fixed4`."""
    return f"CAST(floor(({expr}) * 10000.0 + 0.50001) AS DOUBLE) / 10000.0"
