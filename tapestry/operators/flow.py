"""Trade flow: classification, rolling and cumulative volume, profiles, spreads and feed rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import classify
from ..functions.history import names, newest, running, same_keys
from ..functions.joins import asof_join

ORDER = ["ts", "seq"]


def classify_trades(trades: DataFrame, quotes: DataFrame, *, by="contract", bid="best_bid", ask="best_ask", chunk="auto") -> DataFrame:
    """Add ``side`` to trades from the newest quote at or before each trade."""
    joined = asof_join(trades, quotes, by=by, values=[bid, ask], chunk=chunk)
    return joined.withColumn("side", classify(F.col("price"), F.col(bid), F.col(ask)))


def in_last(minutes: float, asof, ts="ts") -> Column:
    """Whether a row is of the last ``minutes`` before ``asof`` (inclusive)."""
    end = F.lit(asof).cast("timestamp")
    start = F.timestamp_micros(F.unix_micros(end) - F.lit(int(minutes * 60_000_000)))
    return (F.col(ts) >= start) & (F.col(ts) <= end)


def within(df: DataFrame, minutes: float, asof, ts="ts") -> DataFrame:
    """Rows of the last ``minutes`` before ``asof`` (inclusive)."""
    return df.filter(in_last(minutes, asof, ts))


def _flow_columns(where: Column | None = None) -> list[Column]:
    """Aggregates of the trades (``where`` given: of those), for one pass with others."""
    where = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    v, buy, sell = F.when(where, F.col("volume")), where & (F.col("side") == "buy"), where & (F.col("side") == "sell")
    zero = F.lit(0)
    return [
        F.coalesce(F.sum(v), zero).alias("total_volume"), F.count_if(where).alias("trade_count"),
        F.coalesce(F.sum(F.when(buy, v)), zero).alias("buy_volume"), F.coalesce(F.sum(F.when(sell, v)), zero).alias("sell_volume"),
        F.count_if(buy).alias("buy_trades"), F.count_if(sell).alias("sell_trades"), F.sum(F.col("price") * v).alias("__pv"),
    ]


_FLOW = ["total_volume", "trade_count", "buy_volume", "sell_volume", "buy_trades", "sell_trades"]


def _with_ratios(df: DataFrame) -> DataFrame:
    total, n, buy, sell = (F.col(c) for c in ("total_volume", "trade_count", "buy_volume", "sell_volume"))
    return df.withColumns({
        "avg_trade_size": F.when(n > 0, total / n).otherwise(0.0),
        "vwap": F.when(total > 0, F.col("__pv") / total).otherwise(0.0),
        "buy_sell_ratio": F.when(sell > 0, buy / sell).when(buy > 0, F.lit(float("inf"))).otherwise(0.0),
    }).drop("__pv")


def trade_flow(trades: DataFrame, minutes: float = 5, *, asof, by="contract", contracts: DataFrame | None = None) -> DataFrame:
    """Volume and counts by aggressor over the last ``minutes``; listed ``contracts`` without trades get zeros."""
    by = names(by)
    out = within(trades, minutes, asof).groupBy(*by).agg(*_flow_columns())
    if contracts is not None:
        out = contracts.select(*by).distinct().join(out, by, "left").na.fill(0, _FLOW)
    return _with_ratios(out)


def flow_since(trades: DataFrame, start, asof, *, by="contract", high_rate: float = 500.0) -> DataFrame:
    """Flow from an explicit start, with rates per second and a flag for implausibly high ones."""
    lo, hi = F.lit(start).cast("timestamp"), F.lit(asof).cast("timestamp")
    seconds = (F.unix_micros(hi) - F.unix_micros(lo)) / 1e6
    out = _with_ratios(trades.filter((F.col("ts") >= lo) & (F.col("ts") <= hi)).groupBy(*names(by)).agg(*_flow_columns()))
    return out.withColumns({
        "volume_per_second": F.try_divide(F.col("total_volume").cast("double"), seconds),
        "trades_per_second": F.try_divide(F.col("trade_count").cast("double"), seconds),
    }).withColumn("high_rate", F.col("volume_per_second") > high_rate)


def signed_volume() -> Column:
    return F.when(F.col("side") == "buy", F.col("volume")).when(F.col("side") == "sell", -F.col("volume")).otherwise(0)


def cumulative_delta(trades: DataFrame, minutes: float = 30, *, asof, by="contract", order=ORDER, chunk="auto") -> DataFrame:
    """Running buy minus sell volume of the trades in the window, as column ``delta``."""
    return running(within(trades, minutes, asof), by=by, order=order, sums={"delta": signed_volume()}, chunk=chunk)


def delta_trend(x: Column) -> Column:
    # Limits of the trend names.
    return (
        F.when(x > 500, "strongly_bullish").when(x > 100, "bullish").when(x < -500, "strongly_bearish")
        .when(x < -100, "bearish").otherwise("neutral")
    )


def delta_summary(trades: DataFrame, minutes: float = 30, *, asof, by="contract") -> DataFrame:
    """Final delta, its trend and pace."""
    v = F.col("volume")
    d = within(trades, minutes, asof).groupBy(*names(by)).agg(
        F.sum(signed_volume()).alias("cumulative_delta"),
        F.coalesce(F.sum(F.when(F.col("side") == "buy", v)), F.lit(0)).alias("total_buy_volume"),
        F.coalesce(F.sum(F.when(F.col("side") == "sell", v)), F.lit(0)).alias("total_sell_volume"),
        F.count(F.lit(1)).alias("trade_count"),
    )
    x = F.col("cumulative_delta")
    return d.withColumns({"delta_trend": delta_trend(x), "delta_per_minute": x / F.lit(float(minutes)) if minutes > 0 else F.lit(0.0)})


def volume_profile(trades: DataFrame, bucket_size: float = 0.25, *, by="contract") -> DataFrame:
    """Volume, mean price and counts per price bucket."""
    v = F.col("volume")
    return trades.withColumn("bucket", F.floor(F.col("price") / F.lit(bucket_size))).groupBy(*names(by), "bucket").agg(
        F.sum(v).alias("total_volume"), F.avg("price").alias("avg_price"), F.count(v).alias("trade_count"),
        F.coalesce(F.sum(F.when(F.col("side") == "buy", v)), F.lit(0)).alias("buy_volume"),
        F.coalesce(F.sum(F.when(F.col("side") == "sell", v)), F.lit(0)).alias("sell_volume"),
    )


def point_of_control(profile: DataFrame, *, by="contract") -> DataFrame:
    """Bucket with most volume (lowest one among equals)."""
    best = F.max_by(F.struct("avg_price", "total_volume"), F.struct(F.col("total_volume"), -F.col("bucket")))
    return profile.groupBy(*names(by)).agg(best.alias("b")).select(
        *names(by), F.col("b.avg_price").alias("poc_price"), F.col("b.total_volume").alias("poc_volume")
    )


def value_area(profile: DataFrame, share: float = 0.7, *, by="contract") -> DataFrame:
    """Price range of the fullest buckets that together hold ``share`` of the volume."""
    by = names(by)
    # Ranks over even ranges of all buckets, so that a contract with very many of them is no single task.
    d = running(profile.withColumn("__least", -F.col("total_volume")), by=by, order=["__least", "bucket"], sums={"__cum": F.col("total_volume")})
    d = same_keys(d, profile.groupBy(*by).agg(F.sum("total_volume").alias("__total")), by, True)
    taken = d.filter(F.col("__cum") - F.col("total_volume") < share * F.col("__total"))
    return taken.groupBy(*by).agg(
        F.max("avg_price").alias("value_area_high"), F.min("avg_price").alias("value_area_low"),
        F.max("__cum").alias("value_area_volume"), F.max("__total").alias("total_volume"), F.count(F.lit(1)).alias("buckets"),
    ).withColumn("volume_percentage", F.when(F.col("total_volume") > 0, F.col("value_area_volume") / F.col("total_volume") * 100.0).otherwise(0.0))


def volume_profile_bins(df: DataFrame, num_bins: int = 50, *, by="contract", price="close", volume="volume") -> DataFrame:
    """Profile over ``num_bins`` equal bins between the lowest and highest price; buy/sell split if there is a side."""
    by = names(by)
    side = F.col("side") if "side" in df.columns else F.lit(None).cast("string")
    p, v = F.col(price), F.col(volume)
    ends = df.groupBy(*by).agg(F.min(price).alias("__lo"), F.max(price).alias("__hi"))
    # Reduce to distinct prices first, so that the join with the price range works on few rows.
    levels = df.groupBy(*by, p.alias("__p")).agg(
        F.sum(v).alias("__v"), F.count(v).alias("__n"), F.sum(F.when(side == "buy", v)).alias("__buy"), F.sum(F.when(side == "sell", v)).alias("__sell")
    )
    width = (F.col("__hi") - F.col("__lo")) / F.lit(num_bins)
    index = F.when(width == 0, 0).otherwise(F.least(F.floor(F.try_divide(F.col("__p") - F.col("__lo"), width)), F.lit(num_bins - 1)))
    return levels.join(ends, by).withColumn("bucket", index.cast("long")).groupBy(*by, "bucket").agg(
        F.sum("__v").alias("total_volume"), (F.sum(F.col("__p") * F.col("__n")) / F.sum("__n")).alias("avg_price"),
        F.sum("__n").alias("trade_count"), F.coalesce(F.sum("__buy"), F.lit(0)).alias("buy_volume"), F.coalesce(F.sum("__sell"), F.lit(0)).alias("sell_volume"),
    )


def recent_trades(trades: DataFrame, n: int = 100, *, by="contract", order=ORDER) -> DataFrame:
    """Newest ``n`` trades per contract."""
    return newest(trades, n, by=by, order=order)


def spread_stats(quotes: DataFrame, *, by="contract", bid="bid", ask="ask", mid: str | None = None) -> DataFrame:
    """Mean, median, range and deviation of the spread, and its mean relative to the mid."""
    m = F.col(mid) if mid else (F.col(bid) + F.col(ask)) / 2.0
    d = quotes.select(*names(by), (F.col(ask) - F.col(bid)).alias("spread"), F.try_divide(F.col(ask) - F.col(bid), m).alias("rel")).dropna()
    # Exact median by counting distinct spreads, ranked in even ranges: no list and no window over a contract's values.
    by = names(by)
    values = d.groupBy(*by, "spread").agg(F.count(F.lit(1)).alias("n"), F.sum("rel").alias("rel"))
    ranked = running(values, by=by, order=["spread"], sums={"upto": F.col("n")})
    ranked = same_keys(ranked, d.groupBy(*by).agg(F.count(F.lit(1)).alias("total")), by, True)
    s, n, upto, total = F.col("spread"), F.col("n"), F.col("upto"), F.col("total")
    lower, upper = F.floor((total + 1) / 2), F.floor(total / 2) + 1
    holds = lambda k: (upto - n < k) & (k <= upto)
    mean = F.sum(s * n) / F.sum(n)
    out = ranked.groupBy(*by).agg(
        mean.alias("avg_spread"), ((F.max(F.when(holds(lower), s)) + F.max(F.when(holds(upper), s))) / 2.0).alias("median_spread"),
        F.min("spread").alias("min_spread"), F.max("spread").alias("max_spread"), (F.sum("rel") / F.sum("n")).alias("avg_relative_spread"),
        F.sum(n).alias("quotes"), F.sum(s * s * n).alias("__ss"),
    )
    variance = F.try_divide(F.col("__ss") - F.col("quotes") * F.col("avg_spread") * F.col("avg_spread"), F.col("quotes") - 1)
    return out.withColumn("spread_volatility", F.coalesce(F.sqrt(F.greatest(variance, F.lit(0.0))), F.lit(0.0))).drop("__ss")


def feed_rates(events: DataFrame, minutes: int = 5, *, by="contract", kind="kind", ts="ts") -> DataFrame:
    """Messages per kind and window."""
    w = F.window(ts, f"{minutes} minutes")
    return events.groupBy(*names(by), w.alias("w"), kind).agg(F.count(F.lit(1)).alias("messages")).select(
        *names(by), F.col("w.start").alias("window_start"), kind, "messages"
    )
