"""One summary row per contract over book, trades and hidden-order candidates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.history import names
from ..operators import book as B, flow as W, icebergs as X
from ..session import settle


def market_report(depth: DataFrame, *, asof, by="contract", order=("ts", "seq"), **params) -> DataFrame:
    """:func:`market_metrics` straight from depth updates; the routed updates and the book are written out once."""
    routed = settle(B.route_depth(depth, by=by, order=order), "routed")
    book = settle(B.book_asof(routed, by=by, order=order), "book")
    return market_metrics(book, B.routed_trades(routed), asof=asof, by=by, **params)


def market_metrics(book: DataFrame, trades: DataFrame, *, asof, flow_minutes: float = 5, delta_minutes: float = 30, iceberg_minutes: float = 10,
                   bucket_size: float = 0.25, price_tolerance: float = 0.25, iceberg_volume: int = 500, by="contract") -> DataFrame:
    """Liquidity, clusters, icebergs, delta, imbalance, profile, support and resistance, and flow in one row per contract."""
    by = names(by)
    # One pass over the trades for everything but the profile, which is written out for its three readers.
    recent = W.in_last(delta_minutes, asof)
    tape = W._with_ratios(trades.groupBy(*by).agg(
        *W._flow_columns(W.in_last(flow_minutes, asof)), F.count(F.lit(1)).alias("trades"),
        F.sum(F.when(recent, W.signed_volume())).alias("cumulative_delta"), F.count_if(recent).alias("__recent"),
    ))
    traded = F.col("trade_count") > 0
    tape = tape.withColumns({
        "vwap": F.when(traded, F.col("vwap")), "delta_trend": F.when(F.col("__recent") > 0, W.delta_trend(F.col("cumulative_delta"))),
    })
    profile = settle(W.volume_profile(trades, bucket_size, by=by), "profile")
    count = lambda d, name, *more: d.groupBy(*by).agg(F.count(F.lit(1)).alias(name), *more)
    side = lambda s: F.count_if(F.col("kind") == s)
    parts = [
        count(B.liquidity_levels(book, by=by), "liquid_levels"),
        count(B.order_clusters(book, price_tolerance, by=by), "clusters"),
        count(X.iceberg_heuristic(book, iceberg_minutes, asof=asof, by=by, volume_threshold=iceberg_volume), "icebergs"),
        tape.select(*by, "total_volume", "trade_count", "buy_volume", "sell_volume", "vwap", "trades", "cumulative_delta", "delta_trend"),
        B.market_imbalance(book, tape, by=by).select(*by, "imbalance_ratio", "direction", "confidence"),
        W.point_of_control(profile, by=by),
        W.value_area(profile, by=by).select(*by, "value_area_high", "value_area_low"),
        B.support_resistance(profile, book, by=by).groupBy(*by).agg(side("support").alias("supports"), side("resistance").alias("resistances")),
    ]
    base = B.book_snapshot(book, by=by)
    out = reduce(lambda a, b: a.join(b, by, "left"), parts, base)
    zeros = ["liquid_levels", "clusters", "icebergs", "supports", "resistances", "total_volume", "trade_count", "buy_volume", "sell_volume", "trades", "cumulative_delta"]
    out = out.na.fill(0, zeros)
    return out.withColumns({
        "data_quality": F.when(F.col("trades") > 100, "high").otherwise("medium"),
        "market_activity": F.when(F.col("trades") > 50, "active").otherwise("quiet"),
    })
