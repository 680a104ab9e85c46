"""Wall-clock arithmetic of a named zone that never reads the session's time zone.

A *clock* is a ``timestamp_ntz``: what a wall clock in the zone shows.  *Wall* microseconds are the same reading as a number,
counted from its own 1970: whole days, hours and weekdays then are integer arithmetic, and only the way to the wall and back
looks up the zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def clock(ts: Column, tz: str) -> Column:
    """Wall clock of zone ``tz`` at the instant ``ts``."""
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr(EPOCH))
    return utc if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def instant(local: Column, tz: str) -> Column:
    """Instant at which a clock of zone ``tz`` shows ``local``."""
    utc = local if tz == "UTC" else F.convert_timezone(F.lit(tz), F.lit("UTC"), local)
    # Field by field: the difference of two clocks would be taken in the session's zone.
    seconds = F.unix_date(F.to_date(utc)).cast("long") * 86400 + F.hour(utc) * 3600 + F.minute(utc) * 60
    return F.timestamp_micros(seconds * 1_000_000 + (F.extract(F.lit("SECOND"), utc) * 1_000_000).cast("long"))


def midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz")


HOUR = 3_600_000_000
DAY = 24 * HOUR


def wall(ts: Column, tz: str) -> Column:
    """Wall microseconds of zone ``tz`` at the instant ``ts``."""
    return F.unix_micros(ts if tz == "UTC" else F.from_utc_timestamp(ts, tz))


def from_wall(micros: Column, tz: str) -> Column:
    """Instant at which the wall of zone ``tz`` shows ``micros``."""
    utc = F.timestamp_micros(micros.cast("long"))
    return utc if tz == "UTC" else F.to_utc_timestamp(utc, tz)


def whole(micros: Column, unit: int) -> Column:
    """``micros`` without what exceeds a multiple of ``unit``."""
    return micros - F.pmod(micros, F.lit(unit))


def day_number(micros: Column) -> Column:
    """Days since 1970."""
    return (whole(micros, DAY) / F.lit(DAY)).cast("int")


def wall_date(micros: Column) -> Column:
    return F.date_from_unix_date(day_number(micros))


def wall_hour(micros: Column) -> Column:
    return F.floor(F.pmod(micros, F.lit(DAY)) / F.lit(HOUR)).cast("int")


def wall_weekday(micros: Column) -> Column:
    """0 is Monday."""
    return F.pmod(day_number(micros) + 3, F.lit(7))
