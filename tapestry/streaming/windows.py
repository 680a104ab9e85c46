"""Windowed operators on streaming tables (state is kept by Spark and bounded by the watermark)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.history import names
from ..operators.bars import _bar_columns, bar_end, bar_start, calendar_name, timeframe_seconds
from ..operators.flow import _flow_columns, _with_ratios
from ..schemas import EXCHANGE_TZ


def stream_bars(ticks: DataFrame, timeframe: str = "1min", *, by, order=("ts", "seq"), delay: str = "0 seconds", floor_volume: bool = True,
                tz: str = EXCHANGE_TZ) -> DataFrame:
    """Bars of a tick stream: ``update`` output mode gives the live bar, ``append`` each finished bar once.

    ``delay``: how far ticks may lag the newest event time before they no longer count.  Bars of 4 hours, days, weeks and
    months follow the local clock of ``tz``: each tick opens a session that lasts until its bar ends, and sessions that
    overlap are one.  Spark gives session windows in ``append`` mode only.
    """
    by, order = names(by), names(order)
    timed = ticks.withWatermark(order[0], delay)
    if calendar_name(timeframe):
        ts = F.col(order[0])
        # One microsecond short of the end, so that a bar never touches the next one.
        rest = F.unix_micros(bar_end(ts, timeframe, tz)) - F.unix_micros(ts) - 1
        window, start = F.session_window(ts, F.concat(rest.cast("string"), F.lit(" microseconds"))), bar_start(F.col("w.start"), timeframe, tz)
    else:
        window, start = F.window(order[0], f"{timeframe_seconds(timeframe)} seconds"), F.col("w.start")
    grouped = timed.groupBy(*by, window.alias("w")).agg(*_bar_columns(ticks, order, F.col("price"), F.col("volume"), floor_volume))
    return grouped.select(*by, start.alias("ts"), "open", "high", "low", "close", "volume")


def stream_flow(trades: DataFrame, minutes: int = 5, slide_minutes: int = 1, *, by="contract", ts="ts", delay: str = "0 seconds") -> DataFrame:
    """Trade flow over sliding windows."""
    by = names(by)
    w = F.window(ts, f"{minutes} minutes", f"{slide_minutes} minutes")
    flow = trades.withWatermark(ts, delay).groupBy(*by, w.alias("w")).agg(*_flow_columns())
    return _with_ratios(flow).select(
        *by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "total_volume", "trade_count", "buy_volume", "sell_volume",
        "buy_trades", "sell_trades", "avg_trade_size", "vwap", "buy_sell_ratio",
    )


def stream_feed_rates(events: DataFrame, minutes: int = 5, *, by="contract", kind="kind", ts="ts", delay: str = "0 seconds") -> DataFrame:
    """Messages per kind and window."""
    by = names(by)
    rates = events.withWatermark(ts, delay).groupBy(*by, F.window(ts, f"{minutes} minutes").alias("w"), kind).agg(F.count(F.lit(1)).alias("messages"))
    return rates.select(*by, F.col("w.start").alias("window_start"), kind, "messages")


def stream_activity(events: DataFrame, gap: str = "5 minutes", *, by="contract", ts="ts", delay: str = "0 seconds") -> DataFrame:
    """Bursts of activity: stretches without a pause of ``gap``."""
    by = names(by)
    bursts = events.withWatermark(ts, delay).groupBy(*by, F.session_window(ts, gap).alias("s")).agg(F.count(F.lit(1)).alias("messages"))
    return bursts.select(*by, F.col("s.start").alias("burst_start"), F.col("s.end").alias("burst_end"), "messages")
