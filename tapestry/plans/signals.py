"""From bars to trading signals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.history import newest
from ..operators.registry import with_indicators

SPECS = [
    ("sma", {"period": 20}), ("sma", {"period": 50}), ("rsi", {"period": 14}), ("macd", {}), ("atr", {"period": 14}), ("adx", {"period": 14}),
]


def signals(bars: DataFrame, *, by="contract", order="ts", chunk="auto") -> DataFrame:
    """Every bar with its indicators and a ``signal`` (bullish, bearish, none), stop (2 ATR) and target (3 ATR)."""
    d = with_indicators(bars, SPECS, by=by, order=order, chunk=chunk)
    up, strong = F.col("sma_20") > F.col("sma_50"), F.col("adx_14") > 25
    lively = (F.col("rsi_14") > 50) & (F.col("macd_histogram") > 0)
    signal = F.when(up & lively & strong, "bullish").when(~up & ~lively & strong, "bearish").otherwise("none")
    d = d.withColumn("signal", signal)
    sign = F.when(F.col("signal") == "bullish", 1.0).when(F.col("signal") == "bearish", -1.0)
    return d.withColumns({"stop": F.col("close") - sign * 2.0 * F.col("atr_14"), "target": F.col("close") + sign * 3.0 * F.col("atr_14")})


def reversal_signals(bars: DataFrame, *, by="contract", order="ts", chunk="auto") -> DataFrame:
    """Oversold in an uptrend is a buy, overbought in a downtrend a sell."""
    d = with_indicators(bars, [("rsi", {}), ("sma", {"period": 20}), ("sma", {"period": 50})], by=by, order=order, chunk=chunk)
    c, a, b, r = F.col("close"), F.col("sma_20"), F.col("sma_50"), F.col("rsi_14")
    return d.withColumn("signal", F.when((r < 30) & (c > a) & (a > b), "buy").when((r > 70) & (c < a) & (a < b), "sell").otherwise("none"))


def latest_signals(bars: DataFrame, *, by="contract", order="ts", chunk="auto") -> DataFrame:
    """The newest bar of each contract with its signal."""
    return newest(signals(bars, by=by, order=order, chunk=chunk), 1, by=by, order=order)
