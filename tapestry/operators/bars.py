"""Ticks to bars, bars to coarser bars, and reports on bar tables."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.checks import ParameterError, need_columns
from ..functions.clock import DAY, HOUR, from_wall, wall, wall_date, whole
from ..functions.history import names, newest, order_key
from ..schemas import EXCHANGE_TZ

# Named bar widths in seconds (week and month are nominal).
TIMEFRAMES = {
    "1sec": 1, "5sec": 5, "10sec": 10, "15sec": 15, "30sec": 30,
    "1min": 60, "5min": 300, "15min": 900, "30min": 1800,
    "1hr": 3600, "4hr": 14400, "1day": 86400, "1week": 604800, "1month": 2592000,
}
# Unit names and their seconds.
_UNITS = {
    "s": 1, "sec": 1, "second": 1, "seconds": 1,
    "m": 60, "min": 60, "minute": 60, "minutes": 60,
    "h": 3600, "hr": 3600, "hour": 3600, "hours": 3600,
    "d": 86400, "day": 86400, "days": 86400,
    "w": 604800, "wk": 604800, "week": 604800, "weeks": 604800,
    "month": 2592000, "months": 2592000, "mo": 2592000,
}
_CALENDAR = {"4hr", "1day", "1week", "1month"}


def timeframe_seconds(timeframe: str) -> int:
    """Nominal length of a named timeframe or of any ``'N unit'`` string."""
    if timeframe in TIMEFRAMES:
        return TIMEFRAMES[timeframe]
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+)\s*", timeframe.lower())
    if not m or m.group(2) not in _UNITS or int(m.group(1)) < 1:
        raise ParameterError(f"unknown timeframe {timeframe!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]


def calendar_name(timeframe: str) -> str | None:
    """``4hr``, ``1day``, ``1week`` or ``1month`` if ``timeframe`` means one of them in any spelling."""
    if timeframe in TIMEFRAMES:
        return timeframe if timeframe in _CALENDAR else None
    seconds = timeframe_seconds(timeframe)
    return next((name for name in sorted(_CALENDAR) if TIMEFRAMES[name] == seconds), None)


def bar_start(ts: Column, timeframe: str, tz: str = EXCHANGE_TZ) -> Column:
    """Start of the bar holding ``ts``; day, week, month and 4-hour bars follow the exchange's local clock."""
    name = calendar_name(timeframe)
    if name:
        return from_wall(_calendar_start(wall(ts, tz), name), tz)
    return F.window(ts, f"{timeframe_seconds(timeframe)} seconds")["start"]


def _calendar_start(local: Column, name: str) -> Column:
    """Wall microseconds at which the bar of the wall reading ``local`` starts."""
    if name in ("4hr", "1day"):
        return whole(local, 4 * HOUR if name == "4hr" else DAY)
    return F.unix_date(F.trunc(wall_date(local), name[1:])).cast("long") * DAY


def bar_end(ts: Column, timeframe: str, tz: str = EXCHANGE_TZ) -> Column:
    """End of the calendar bar holding ``ts`` (4 hours, day, week or month of the exchange's local clock)."""
    name = calendar_name(timeframe)
    start = _calendar_start(wall(ts, tz), name)
    if name == "1month":
        return from_wall(F.unix_date(F.add_months(wall_date(start), 1)).cast("long") * DAY, tz)
    return from_wall(start + {"4hr": 4 * HOUR, "1day": DAY, "1week": 7 * DAY}[name], tz)


def _ends(df: DataFrame, order, price: Column, volume: Column) -> tuple[Column, Column, Column]:
    """First price, last price and first volume of a group.

    An order that fits one number aggregates by hash.  Otherwise one smallest and one largest record hold all three.
    """
    key = order_key(df, order)
    if key is not None:
        return F.min_by(price, key), F.max_by(price, key), F.min_by(volume, key)
    first = F.min(F.struct(*order, price.alias("__p"), volume.alias("__v")))
    last = F.max(F.struct(*order, price.alias("__p")))
    return first["__p"], last["__p"], first["__v"]


def _floored(total: Column, first: Column, floor_volume: bool) -> Column:
    """Bar volume; with the floor the first tick counts at least 1, and so does the bar."""
    if floor_volume:
        total = F.greatest(total + F.when(first <= 0, 1 - first).otherwise(0), F.lit(1))
    return total.cast("long").alias("volume")


def _bar_columns(df: DataFrame, order, price, volume, floor_volume: bool) -> list[Column]:
    opening, closing, first = _ends(df, order, price, volume)
    return [
        opening.alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), closing.alias("close"),
        _floored(F.sum(volume), first, floor_volume),
    ]


def bars(ticks: DataFrame, timeframe: str = "1min", *, by, order, price="price", volume="volume", floor_volume: bool = True,
         tz: str = EXCHANGE_TZ) -> DataFrame:
    """OHLCV bars from ticks; no bar where no tick.

    One partially aggregated exchange on (by, bar); a hot contract spreads over its bars.
    """
    by, order = names(by), names(order)
    need_columns(ticks, *by, *order, price, volume)
    start = bar_start(F.col(order[0]).cast("timestamp"), timeframe, tz)
    return (
        ticks.withColumn("__bar", start)
        .groupBy(*by, "__bar")
        .agg(*_bar_columns(ticks, order, F.col(price), F.col(volume), floor_volume))
        .withColumnRenamed("__bar", "ts")
        .select(*by, "ts", "open", "high", "low", "close", "volume")
    )


def multi_timeframe(ticks: DataFrame, timeframes, *, by, order, price="price", volume="volume", floor_volume: bool = True,
                    tz: str = EXCHANGE_TZ) -> DataFrame:
    """Bars of several timeframes from one pass over the ticks, as a long table with a ``timeframe`` column.

    Ticks are first reduced to the finest fixed width when every other width is a multiple of it, so that the
    expansion by timeframe multiplies bars instead of ticks.
    """
    by, order, timeframes = names(by), names(order), list(timeframes)
    base = min(timeframe_seconds(tf) for tf in timeframes)
    if any(map(calendar_name, timeframes)):
        base = math.gcd(base, 900)  # local clocks differ from UTC by quarter hours
    nested = base <= 3600 and 3600 % base == 0 and all(timeframe_seconds(tf) % base == 0 for tf in timeframes)
    if not nested:
        starts = [F.struct(F.lit(tf).alias("timeframe"), _floor(F.col(order[0]).cast("timestamp"), tf, tz).alias("ts")) for tf in timeframes]
        return (
            ticks.withColumn("__tf", F.explode(F.array(*starts)))
            .groupBy(*by, F.col("__tf.timeframe").alias("timeframe"), F.col("__tf.ts").alias("__bar"))
            .agg(*_bar_columns(ticks, order, F.col(price), F.col(volume), floor_volume))
            .withColumnRenamed("__bar", "ts")
        )
    p, v = F.col(price), F.col(volume)
    opening, closing, first = _ends(ticks, order, p, v)
    fine = (
        ticks.withColumn("__bar", _floor(F.col(order[0]).cast("timestamp"), f"{base} sec", tz))
        .groupBy(*by, "__bar")
        .agg(
            opening.alias("open"), F.max(p).alias("high"), F.min(p).alias("low"), closing.alias("close"),
            F.sum(v).alias("__v"), first.alias("__first"),
        )
    )
    fine = fine.withColumn("__wall", wall(F.col("__bar"), tz))  # looked up once, not per timeframe
    starts = [F.struct(F.lit(tf).alias("timeframe"), _fine_start(tf, tz).alias("ts")) for tf in timeframes]
    return (
        fine.withColumn("__tf", F.explode(F.array(*starts)))
        .groupBy(*by, F.col("__tf.timeframe").alias("timeframe"), F.col("__tf.ts").alias("ts"))
        .agg(
            F.min_by("open", "__bar").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
            F.max_by("close", "__bar").alias("close"), _floored(F.sum("__v"), F.min_by("__first", "__bar"), floor_volume),
        )
    )


def _floor(ts: Column, timeframe: str, tz: str) -> Column:
    """Like :func:`bar_start` but a plain expression, usable several times in one projection."""
    if calendar_name(timeframe):
        return bar_start(ts, timeframe, tz)
    width = timeframe_seconds(timeframe) * 1_000_000
    return F.timestamp_micros(F.floor(F.unix_micros(ts) / F.lit(width)) * F.lit(width))


def _fine_start(timeframe: str, tz: str) -> Column:
    """Start of the bar that holds a finer bar (``__bar``, ``__wall``)."""
    name = calendar_name(timeframe)
    return from_wall(_calendar_start(F.col("__wall"), name), tz) if name else _floor(F.col("__bar"), timeframe, tz)


def rollup_bars(df: DataFrame, timeframe: str, *, by, ts: str = "ts", tz: str = EXCHANGE_TZ) -> DataFrame:
    """Coarser bars from finer bars."""
    by = names(by)
    return (
        df.withColumn("__bar", bar_start(F.col(ts), timeframe, tz))
        .groupBy(*by, "__bar")
        .agg(
            F.min_by("open", ts).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
            F.max_by("close", ts).alias("close"), F.sum("volume").alias("volume"),
        )
        .withColumnRenamed("__bar", "ts")
        .select(*by, "ts", "open", "high", "low", "close", "volume")
    )


def keep_last(df: DataFrame, n: int = 1000, *, by, order="ts") -> DataFrame:
    """Newest ``n`` bars per group."""
    return newest(df, n, by=by, order=order)


def _seconds_of(timeframe: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in TIMEFRAMES.items() for x in kv])
    return table[timeframe]


def last_price(df: DataFrame, *, by="contract", ts="ts") -> DataFrame:
    """Close of the newest bar of the finest timeframe present."""
    best = F.max_by(F.struct("timeframe", ts, "close"), F.struct(-_seconds_of(F.col("timeframe")), F.col(ts)))
    return df.groupBy(*names(by)).agg(best.alias("b")).select(
        *names(by), F.col("b.timeframe").alias("timeframe"), F.col(f"b.{ts}").alias("ts"), F.col("b.close").alias("last_price")
    )


def bar_stats(df: DataFrame, *, by="contract", ts="ts") -> DataFrame:
    """Per timeframe: number of bars, newest time and price."""
    return df.groupBy(*names(by), "timeframe").agg(
        F.count(F.lit(1)).alias("bars"), F.max(ts).alias("latest_ts"), F.max_by("close", ts).alias("latest_price")
    )


def staleness(df: DataFrame, asof, *, by="contract", ts="ts", expected=()) -> DataFrame:
    """Age of the newest bar against what its timeframe allows.

    Second bars may be 4 intervals old; longer ones 1.2 intervals plus 3 minutes.  ``expected`` timeframes without
    any bar are reported as unhealthy.
    """
    by = names(by)
    asof = F.lit(asof).cast("timestamp")
    seen = df.groupBy(*by, "timeframe").agg(F.max(ts).alias("latest_ts"))
    if expected:
        wanted = df.select(*by).distinct().withColumn("timeframe", F.explode(F.array(*[F.lit(x) for x in expected])))
        seen = wanted.join(seen, by + ["timeframe"], "left")
    width = _seconds_of(F.col("timeframe"))
    age = (F.unix_micros(asof) - F.unix_micros("latest_ts")) / 1e6
    limit = F.when(width < 60, width * 4.0).otherwise(width * 1.2 + 180.0)
    return seen.select(
        *by, "timeframe", "latest_ts", age.alias("age_seconds"), limit.alias("limit_seconds"),
        F.coalesce(age <= limit, F.lit(False)).alias("healthy"),
    )


def mtf_summary(df: DataFrame, *, by="contract", ts="ts") -> DataFrame:
    """Per timeframe: trend of the close, its spread, and the trend of the volume."""
    def ends(c):
        return F.max_by(c, ts), F.min_by(c, ts)

    (c1, c0), (v1, v0) = ends("close"), ends("volume")
    return df.groupBy(*names(by), "timeframe").agg(
        F.count(F.lit(1)).alias("bars"),
        F.when(c1 > c0, "up").otherwise("down").alias("trend"),
        F.stddev_samp("close").alias("volatility"),
        F.when(v1 > v0, "increasing").otherwise("decreasing").alias("volume_trend"),
    )
