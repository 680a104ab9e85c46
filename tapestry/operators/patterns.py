"""Candlestick and chart patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.checks import need_columns, need_period
from ..functions.history import RN, names, over_history


def candlestick_patterns(df: DataFrame, open="open", high="high", low="low", close="close") -> DataFrame:
    """Flags per bar: doji, hammer, shooting_star, bullish_candle, bearish_candle, long_body."""
    need_columns(df, open, high, low, close)
    o, h, lo, c = (F.col(x) for x in (open, high, low, close))
    body, span = F.abs(c - o), h - lo
    above, below = h - F.greatest(o, c), F.least(o, c) - lo
    small = body <= 0.3 * span
    return df.withColumns({
        "doji": body <= 0.1 * span,
        "hammer": small & (below >= 2 * body) & (above <= 0.1 * span),
        "shooting_star": small & (above >= 2 * body) & (below <= 0.1 * span),
        "bullish_candle": c > o,
        "bearish_candle": c < o,
        "long_body": body >= 0.7 * span,
    })


def chart_patterns(df: DataFrame, column: str = "close", window: int = 20, *, by="contract", order="ts", chunk="auto") -> DataFrame:
    """Double tops and bottoms.

    A row that is the extreme of ``window`` rows on both sides pairs with the first row between half a window and a
    window later whose price is within 2 %.  Output: one row per pattern with both positions.
    """
    need_period(window, 2, "window")
    need_columns(df, column)
    by = names(by)

    def body(d, t):
        x = F.col(column)
        around, ahead = t.frame(-window, window), t.frame(window // 2, window - 1)
        return d.withColumns({
            "__top": F.max(x).over(around), "__low": F.min(x).over(around), "__rows": F.count(F.lit(1)).over(around),
            "__next": F.collect_list(F.struct(F.col(RN).alias("at"), x.alias("p"))).over(ahead), "__i": F.col(RN),
        })

    d = over_history(df.select(*by, *names(order), column), body, by=by, order=order, lookback=window, lookahead=window, chunk=chunk, positions=True)
    price = F.col(column)
    match = F.get(F.filter("__next", lambda n: F.abs(n["p"] - price) / price < 0.02), F.lit(0))
    top, bottom = price == F.col("__top"), price == F.col("__low")
    kinds = F.array_compact(F.array(F.when(top, F.lit("double_top")), F.when(bottom, F.lit("double_bottom"))))
    d = d.filter((F.col("__rows") == 2 * window + 1) & (top | bottom) & (price != 0)).withColumn("__m", match).filter(F.col("__m").isNotNull())
    return d.select(
        *by, *names(order), F.explode(kinds).alias("pattern"), F.col("__i").cast("long").alias("index1"), F.col("__m.at").cast("long").alias("index2"),
        price.alias("price"), (F.col("__top") - F.col("__low")).alias("strength"),
    )


def bollinger_position(df: DataFrame, period: int = 20, column: str = "close") -> DataFrame:
    """Where the price lies between the bands, in percent."""
    lo, hi = F.col(f"bb_lower_{period}"), F.col(f"bb_upper_{period}")
    return df.withColumn("bb_position", F.try_divide(F.col(column) - lo, hi - lo) * 100.0)
