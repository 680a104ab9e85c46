"""Exchange sessions and local calendar columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.clock import DAY, HOUR, clock, from_wall, wall, wall_date, wall_hour, wall_weekday, whole
from ..schemas import EXCHANGE_TZ


def to_exchange_tz(df: DataFrame, ts: str = "ts", tz: str = EXCHANGE_TZ, name: str = "local_ts") -> DataFrame:
    """Add what a wall clock at the exchange shows."""
    return df.withColumn(name, clock(F.col(ts), tz))


def calendar_columns(df: DataFrame, ts: str = "ts", tz: str = EXCHANGE_TZ) -> DataFrame:
    """Exchange-local date, weekday (0 is Monday), hour and minute."""
    w = wall(F.col(ts).cast("timestamp"), tz)
    minute = F.floor(F.pmod(w, F.lit(HOUR)) / F.lit(HOUR // 60)).cast("int")
    return df.withColumns({"local_date": wall_date(w), "local_weekday": wall_weekday(w), "local_hour": wall_hour(w), "local_minute": minute})


def session_flags(df: DataFrame, ts: str = "ts", tz: str = EXCHANGE_TZ) -> DataFrame:
    """``is_open``, and the next close of an open or the next open of a closed session (UTC).

    Open from Sunday 17:00 to Friday 16:00 local time, with a break from 16:00 to 17:00 every day.
    """
    rows, w = df.withColumn("__wall", wall(F.col(ts).cast("timestamp"), tz)), F.col("__wall")
    day, wd, hour = whole(w, DAY), wall_weekday(w), wall_hour(w)
    friday_late, saturday, sunday_early, pause = (wd == 4) & (hour >= 16), wd == 5, (wd == 6) & (hour < 17), hour == 16
    closed = friday_late | saturday | sunday_early | pause
    opens = day + 17 * HOUR + F.when(friday_late, 2 * DAY).when(saturday, DAY).otherwise(0)
    closes = day + 16 * HOUR + F.when(hour >= 16, DAY).otherwise(0)
    rows = rows.withColumns({"is_open": ~closed, "__next": F.when(closed, opens).otherwise(closes)})
    rows = rows.withColumn("__next", from_wall(F.col("__next"), tz))
    return rows.withColumns({
        "next_open": F.when(~F.col("is_open"), F.col("__next")), "next_close": F.when(F.col("is_open"), F.col("__next")),
    }).drop("__wall", "__next")
