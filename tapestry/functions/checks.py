"""Eager schema and parameter checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


class ParameterError(ValueError):
    """A parameter or input schema an operator cannot work with."""


def need_columns(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ParameterError(f"missing column(s) {missing}; have {df.columns}")


def need_period(value, minimum: int = 1, name: str = "period") -> None:
    if isinstance(value, bool) or not isinstance(value, int) or value < minimum:
        raise ParameterError(f"{name} must be an int >= {minimum}, got {value!r}")


def need_positive(value, name: str) -> None:
    if not value > 0:
        raise ParameterError(f"{name} must be > 0, got {value!r}")


def need_less(a, b, names: str) -> None:
    if not a < b:
        raise ParameterError(f"{names}: first must be below second, got {a!r}, {b!r}")


def short_groups(df: DataFrame, by, minimum: int) -> DataFrame:
    """Groups with fewer than ``minimum`` rows, and how many they have."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") < minimum)


def need_rows(df: DataFrame, by, minimum: int) -> None:
    """Strict mode: every group must hold ``minimum`` rows (costs one aggregation)."""
    if not short_groups(df, by, minimum).isEmpty():
        raise ParameterError(f"a group has fewer than {minimum} rows")
