"""Partial quote updates to full quotes and to ticks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.history import running

ORDER = ["ts", "seq"]


def forward_fill_quotes(quotes: DataFrame, *, by="contract", order=ORDER, chunk="auto") -> DataFrame:
    """Carry the last known bid and ask across partial updates."""
    return running(quotes, by=by, order=order, lasts={"bid": F.col("bid"), "ask": F.col("ask")}, chunk=chunk)


def quotes_to_ticks(filled: DataFrame) -> DataFrame:
    """Price updates from full quotes: the trade price if a trade is reported, else the mid, else the one known side."""
    bid, ask, last, volume = (F.col(c) for c in ("bid", "ask", "last", "volume"))
    trade = last.isNotNull() & volume.isNotNull()
    price = F.when(trade, last).when(bid.isNotNull() & ask.isNotNull(), (bid + ask) / 2.0).otherwise(F.coalesce(bid, ask))
    rest = [c for c in filled.columns if c not in ("bid", "ask", "last", "volume")]
    return filled.select(
        *rest, price.alias("price"), F.when(trade, volume).otherwise(0).alias("volume"), F.when(trade, "trade").otherwise("quote").alias("type")
    ).filter(F.col("price").isNotNull())
