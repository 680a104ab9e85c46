"""Nothing reads the session's time zone, and spellings of a timeframe mean the same."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapestry.operators import bars as B, positions as P, sessions as C
from tapestry.sources.envelopes import depth_time

START = dt.datetime(2024, 3, 8, 3, tzinfo=dt.timezone.utc)  # two days before the clocks change


@pytest.fixture
def in_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda zone: spark.conf.set("spark.sql.session.timeZone", zone)
    spark.conf.set("spark.sql.session.timeZone", before)


def ticks(spark):
    first = int(START.timestamp()) * 1_000_000
    return spark.range(240).select(
        F.lit("A").alias("contract"), F.timestamp_micros(F.lit(first) + F.col("id") * 3_600_000_000).alias("ts"), F.col("id").alias("seq"),
        F.col("id").cast("double").alias("price"), F.lit(1).cast("long").alias("volume"))


def seen(spark):
    t = ticks(spark)
    micros = lambda c: F.unix_micros(c).alias(c)
    flags = C.calendar_columns(C.session_flags(t))
    loss = P.daily_loss(t.withColumns({"accountId": F.lit(1), "profitAndLoss": F.col("price")}), 1.0, ts="ts", tz="America/Chicago")
    texts = ["2024-07-01T09:30:00", "2024-07-01T09:30:00Z", "2024-01-05 09:30:00.5", "junk", "0001-01-01T00:00:00+00:00", "2024-07-01T09:30:00-05:00"]
    times = spark.createDataFrame([(x,) for x in texts], "x string").select("x", F.unix_micros(depth_time(F.col("x"), F.timestamp_micros(F.lit(0)))))
    out = [
        [tuple(r) for r in B.bars(t, tf, by="contract", order=["ts", "seq"]).select(micros("ts"), "open", "close", "volume").orderBy("ts").collect()]
        for tf in ("1day", "4hr", "1week", "1month", "1hr")
    ]
    out.append([tuple(r) for r in flags.orderBy("seq").select("is_open", micros("next_open"), micros("next_close"), "local_date", "local_weekday", "local_hour").collect()])
    out.append(sorted(tuple(r) for r in loss.select("day", "realized_pnl").collect()))
    out.append([tuple(r) for r in times.collect()])
    return out


def test_session_zone_has_no_effect(spark, in_zone):
    in_zone("UTC")
    want = seen(spark)
    for zone in ("Asia/Tokyo", "America/New_York", "Asia/Kolkata"):
        in_zone(zone)
        assert seen(spark) == want
    day = lambda h: dt.datetime(2024, 7, 1, h, 30, tzinfo=dt.timezone.utc).timestamp() * 1e6
    assert [t for _, t in want[-1]] == [day(14), day(9), dt.datetime(2024, 1, 5, 15, 30, 0, 500_000, tzinfo=dt.timezone.utc).timestamp() * 1e6, 0, 0, day(14)]
    lengths = {b[0] - a[0] for a, b in zip(want[0], want[0][1:])}
    assert lengths == {23 * 3_600_000_000, 24 * 3_600_000_000}, "the day of the change is an hour short"


@pytest.mark.parametrize("name,other", [("1week", "1 week"), ("1day", "1 d"), ("4hr", "4 hours"), ("1month", "1 month"), ("1min", "60 sec")])
def test_spellings(spark, name, other):
    run = lambda tf: sorted(map(tuple, B.bars(ticks(spark), tf, by="contract", order=["ts", "seq"]).collect()))
    assert run(name) == run(other)


def test_half_hour_zones_in_multi_timeframe(spark):
    got = B.multi_timeframe(ticks(spark), ["1hr", "1day"], by="contract", order=["ts", "seq"], tz="Asia/Kolkata").filter("timeframe = '1day'")
    want = B.bars(ticks(spark), "1day", by="contract", order=["ts", "seq"], tz="Asia/Kolkata")
    cols = ["ts", "open", "close", "volume"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


def test_bars_need_no_sort(spark):
    plan = B.bars(ticks(spark), "1hr", by="contract", order=["ts", "seq"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
