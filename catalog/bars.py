"""Queries and oracles of bar building, over event ticks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapestry.operators import bars as B
from tapestry.sources import readers

from .tables import HOUR_BARS_SQL, TICK_ORDER, TICKS_SQL, bars_sql, hour_bars, r6, ticks, tidy, with_sql

QUERIES, ORACLES = {}, {}
ASOF = "2024-01-31 00:00:00"
_OHLCV = "contract, ts, open, high, low, close, volume"


def add(name, query, sql):
    QUERIES[name] = lambda spark, sf: tidy(query(spark, sf))
    ORACLES[name] = sql


def _user_ticks(s, d):
    """Many thin contracts, with some zero volumes."""
    t = ticks(s, d).drop("contract").withColumn("volume", F.when(F.col("volume") % 4 == 0, 0).otherwise(F.col("volume")))
    return t.withColumn("contract", F.col("seq") % 97)


_USER_SQL = TICKS_SQL + ", ut AS (SELECT seq % 97 AS contract, ts, seq, price, CASE WHEN volume % 4 = 0 THEN 0 ELSE volume END AS volume FROM ticks)"

add("bars", lambda s, d: hour_bars(s, d), with_sql(HOUR_BARS_SQL) + f"SELECT {_OHLCV} FROM bars")
add("bars_plain_volume", lambda s, d: B.bars(_user_ticks(s, d), "30min", by="contract", order=TICK_ORDER, floor_volume=False),
    with_sql(_USER_SQL, bars_sql("b", "ut", "time_bucket(INTERVAL 30 MINUTE, ts)", "ts, seq")) + """
SELECT contract, time_bucket(INTERVAL 30 MINUTE, ts) AS ts, first(price ORDER BY ts, seq) AS open, max(price) AS high, min(price) AS low,
  last(price ORDER BY ts, seq) AS close, CAST(sum(volume) AS BIGINT) AS volume FROM ut GROUP BY contract, time_bucket(INTERVAL 30 MINUTE, ts)""")
add("bars_floor_volume", lambda s, d: B.bars(_user_ticks(s, d), "4 hours", by="contract", order=TICK_ORDER),
    with_sql(_USER_SQL, bars_sql("b", "ut", "time_bucket(INTERVAL 4 HOUR, ts - INTERVAL 6 HOUR, TIMESTAMP '2000-01-01') + INTERVAL 6 HOUR", "ts, seq")) + f"SELECT {_OHLCV} FROM b")
add("bars_custom_width", lambda s, d: B.bars(ticks(s, d), "90 min", by="contract", order=TICK_ORDER),
    with_sql(TICKS_SQL, bars_sql("b", "ticks", "time_bucket(INTERVAL 90 MINUTE, ts, TIMESTAMP '1970-01-01')", "ts, seq")) + f"SELECT {_OHLCV} FROM b")

# January lies wholly in standard time, so Chicago is UTC-6 in these rows.
_LOCAL = {
    "4hr": "time_bucket(INTERVAL 4 HOUR, ts - INTERVAL 6 HOUR, TIMESTAMP '2000-01-01') + INTERVAL 6 HOUR",
    "1day": "CAST(date_trunc('day', ts - INTERVAL 6 HOUR) AS TIMESTAMP) + INTERVAL 6 HOUR",
    "1week": "CAST(date_trunc('week', ts - INTERVAL 6 HOUR) AS TIMESTAMP) + INTERVAL 6 HOUR",
    "1month": "CAST(date_trunc('month', ts - INTERVAL 6 HOUR) AS TIMESTAMP) + INTERVAL 6 HOUR",
}
for _tf, _start in _LOCAL.items():
    add(f"bars_{_tf}", lambda s, d, tf=_tf: B.bars(ticks(s, d), tf, by="contract", order=TICK_ORDER),
        with_sql(TICKS_SQL, bars_sql("b", "ticks", _start, "ts, seq")) + f"SELECT {_OHLCV} FROM b")

_TFS = ["1sec", "5sec", "10sec", "15sec", "30sec", "1min", "5min", "15min", "30min", "1hr", "4hr", "1day", "1week", "1month"]
_FIXED = {tf: f"time_bucket(INTERVAL {B.timeframe_seconds(tf)} SECOND, ts, TIMESTAMP '2000-01-01')" for tf in _TFS if tf not in _LOCAL}
_MTF_SQL = ",\n".join(bars_sql(f"b_{tf}", "ticks", {**_FIXED, **_LOCAL}[tf], "ts, seq") for tf in _TFS) + ",\nmtf AS (" + " UNION ALL ".join(
    f"SELECT '{tf}' AS timeframe, {_OHLCV} FROM b_{tf}" for tf in _TFS) + ")"


def mtf(s, d):
    return B.multi_timeframe(ticks(s, d), _TFS, by="contract", order=TICK_ORDER)


_MTF = with_sql(TICKS_SQL, _MTF_SQL)
add("multi_timeframe", mtf, _MTF + f"SELECT timeframe, {_OHLCV} FROM mtf")
add("multi_timeframe_mixed", lambda s, d: B.multi_timeframe(ticks(s, d), ["45 min", "1hr", "1day"], by="contract", order=TICK_ORDER),
    with_sql(TICKS_SQL, bars_sql("a", "ticks", "time_bucket(INTERVAL 45 MINUTE, ts, TIMESTAMP '1970-01-01')", "ts, seq"),
             bars_sql("b", "ticks", _FIXED["1hr"], "ts, seq"), bars_sql("c", "ticks", _LOCAL["1day"], "ts, seq")) + f"""
SELECT '45 min' AS timeframe, {_OHLCV} FROM a UNION ALL SELECT '1hr', {_OHLCV} FROM b UNION ALL SELECT '1day', {_OHLCV} FROM c""")
add("rollup_bars", lambda s, d: B.rollup_bars(hour_bars(s, d), "1day", by="contract"),
    with_sql(HOUR_BARS_SQL) + f"""SELECT contract, {_LOCAL['1day']} AS ts, first(open ORDER BY ts) AS open, max(high) AS high, min(low) AS low,
  last(close ORDER BY ts) AS close, CAST(sum(volume) AS BIGINT) AS volume FROM bars GROUP BY contract, {_LOCAL['1day']}""")
add("keep_last", lambda s, d: B.keep_last(mtf(s, d), 100, by=["contract", "timeframe"]), _MTF + f"""
SELECT timeframe, {_OHLCV} FROM mtf QUALIFY row_number() OVER (PARTITION BY contract, timeframe ORDER BY ts DESC) <= 100""")
add("last_price", lambda s, d: B.last_price(mtf(s, d)), _MTF + """
SELECT contract, timeframe, ts, close AS last_price FROM mtf WHERE timeframe = '1sec'
QUALIFY row_number() OVER (PARTITION BY contract ORDER BY ts DESC) = 1""")
add("bar_stats", lambda s, d: B.bar_stats(mtf(s, d)), _MTF + """
SELECT contract, timeframe, count(*) AS bars, max(ts) AS latest_ts, last(close ORDER BY ts) AS latest_price FROM mtf GROUP BY contract, timeframe""")
_SECONDS = "CASE timeframe " + " ".join(f"WHEN '{tf}' THEN {B.timeframe_seconds(tf)}" for tf in _TFS) + " END"
add("staleness", lambda s, d: B.staleness(mtf(s, d), ASOF), _MTF + f"""
SELECT contract, timeframe, latest_ts, {r6('age')} AS age_seconds, {r6('lim')} AS limit_seconds, age <= lim AS healthy FROM (
  SELECT contract, timeframe, max(ts) AS latest_ts, (epoch_us(TIMESTAMP '{ASOF}') - epoch_us(max(ts))) / 1e6 AS age,
    CASE WHEN {_SECONDS} < 60 THEN {_SECONDS} * 4.0 ELSE {_SECONDS} * 1.2 + 180.0 END AS lim FROM mtf GROUP BY contract, timeframe)""")
add("mtf_summary", lambda s, d: B.mtf_summary(mtf(s, d)), _MTF + f"""
SELECT contract, timeframe, count(*) AS bars, CASE WHEN last(close ORDER BY ts) > first(close ORDER BY ts) THEN 'up' ELSE 'down' END AS trend,
  {r6('stddev_samp(close)')} AS volatility,
  CASE WHEN last(volume ORDER BY ts) > first(volume ORDER BY ts) THEN 'increasing' ELSE 'decreasing' END AS volume_trend
FROM mtf GROUP BY contract, timeframe""")
add("date_range", lambda s, d: readers.date_range(hour_bars(s, d), ASOF, 20, limit=readers.row_limit(20, 1, 3)), with_sql(HOUR_BARS_SQL) + f"""
SELECT {_OHLCV} FROM bars WHERE ts >= TIMESTAMP '{ASOF}' - INTERVAL 20 DAY AND ts <= TIMESTAMP '{ASOF}'
QUALIFY row_number() OVER (PARTITION BY contract ORDER BY ts DESC) <= 480""")
