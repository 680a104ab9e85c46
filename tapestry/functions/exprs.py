"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_div(n: Column, d: Column, default: float = 0.0) -> Column:
    """``n/d``; ``default`` where the divisor is zero or null."""
    return F.when(d != 0, F.try_divide(n, d)).otherwise(F.lit(default))


def positive_zero(x: Column) -> Column:
    return x + F.lit(0.0)


def typical_price(high="high", low="low", close="close") -> Column:
    return (F.col(high) + F.col(low) + F.col(close)) / 3.0


def total_order(order) -> Column:
    return F.struct(*[F.col(c) for c in order])


def classify(price: Column, bid: Column, ask: Column) -> Column:
    """Aggressor side of a trade given the quotes; unknown inside the spread or without quotes."""
    return F.when(price >= ask, "buy").when(price <= bid, "sell").otherwise("unknown")
