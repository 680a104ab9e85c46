"""Queries and oracles of trade flow, over executions per supplier and partial quotes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapestry.operators import flow as W
from tapestry.sources.quotes import forward_fill_quotes, quotes_to_ticks

from .tables import cut, DEPTH_SQL, LOTS_SQL, TRADE_ORDER, WEEK_BARS_SQL, depth, lots, r6, ticks, tidy, week_bars, with_sql, TICKS_SQL

QUERIES, ORACLES = {}, {}
ASOF, MINUTES = "2006-01-01 00:00:00", 60 * 24 * 365 * 20


def add(name, query, sql, digits=6):
    QUERIES[name] = lambda spark, sf: tidy(query(spark, sf), digits)
    ORACLES[name] = sql


def sided(s, d):
    flag = F.col("l_returnflag")
    return lots(s, d).withColumn("side", F.when(flag == "A", "buy").when(flag == "R", "sell").otherwise("unknown"))


_SIDED = LOTS_SQL + """,
sided AS (SELECT *, CASE l_returnflag WHEN 'A' THEN 'buy' WHEN 'R' THEN 'sell' ELSE 'unknown' END AS side FROM lots)"""
_V = "CAST(coalesce(sum(volume), 0) AS BIGINT)"


def _v(side):
    return f"CAST(coalesce(sum(volume) FILTER (side = '{side}'), 0) AS BIGINT)"


_FLOW = f"""contract, {_V} AS total_volume, count(*) AS trade_count, {_v('buy')} AS buy_volume, {_v('sell')} AS sell_volume,
  count(*) FILTER (side = 'buy') AS buy_trades, count(*) FILTER (side = 'sell') AS sell_trades, {r6(_V + ' / count(*)', 4)} AS avg_trade_size,
  {r6('sum(price * volume) / sum(volume)', 4)} AS vwap,
  {r6(f"CASE WHEN {_v('sell')} > 0 THEN {_v('buy')} / {_v('sell')} WHEN {_v('buy')} > 0 THEN CAST('inf' AS DOUBLE) ELSE 0.0 END", 4)} AS buy_sell_ratio"""


def _contracts(s, d):
    """All suppliers and some contracts that never traded."""
    return lots(s, d).select("contract").distinct().withColumn("contract", F.explode(F.array("contract", -F.col("contract") - 1)))


add("trade_flow", lambda s, d: W.trade_flow(sided(s, d), MINUTES, asof=ASOF, contracts=_contracts(s, d)), with_sql(_SIDED) + f"""
SELECT {_FLOW} FROM sided GROUP BY contract
UNION ALL SELECT DISTINCT -contract - 1, 0, 0, 0, 0, 0, 0, 0.0, 0.0, 0.0 FROM sided""", 4)
_START = "1997-01-01 00:00:00"
_SECS = f"((epoch_us(TIMESTAMP '{ASOF}') - epoch_us(TIMESTAMP '{_START}')) / 1e6)"
add("flow_since", lambda s, d: W.flow_since(sided(s, d), _START, ASOF), with_sql(_SIDED) + f"""
SELECT {_FLOW}, {r6(f'{_V} / {_SECS}', 4)} AS volume_per_second, {r6(f'count(*) / {_SECS}', 4)} AS trades_per_second,
  {_V} / {_SECS} > 500 AS high_rate FROM sided WHERE ts >= TIMESTAMP '{_START}' GROUP BY contract""", 4)
_SIGNED = "CASE side WHEN 'buy' THEN volume WHEN 'sell' THEN -volume ELSE 0 END"
_K = "contract, ts, seq, l_extendedprice"
_DELTA = with_sql(_SIDED) + f"""SELECT {_K}, side, volume, CAST(sum({_SIGNED}) OVER (PARTITION BY contract ORDER BY {', '.join(TRADE_ORDER)}
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS delta FROM sided"""


def _delta(chunk):
    return lambda s, d: W.cumulative_delta(sided(s, d), MINUTES, asof=ASOF, order=TRADE_ORDER, chunk=chunk).select(
        *_K.split(", "), "side", "volume", F.col("delta").cast("long").alias("delta"))


add("cumulative_delta", _delta("auto"), _DELTA)
add("cumulative_delta_split", _delta(cut(80)), _DELTA)
add("delta_summary", lambda s, d: W.delta_summary(sided(s, d), MINUTES, asof=ASOF), with_sql(_SIDED) + f"""
SELECT *, CASE WHEN cumulative_delta > 500 THEN 'strongly_bullish' WHEN cumulative_delta > 100 THEN 'bullish'
  WHEN cumulative_delta < -500 THEN 'strongly_bearish' WHEN cumulative_delta < -100 THEN 'bearish' ELSE 'neutral' END AS delta_trend,
  {r6(f'cumulative_delta / {MINUTES}.0')} AS delta_per_minute FROM (
  SELECT contract, CAST(sum({_SIGNED}) AS BIGINT) AS cumulative_delta, {_v('buy')} AS total_buy_volume, {_v('sell')} AS total_sell_volume,
    count(*) AS trade_count FROM sided GROUP BY contract)""")
_BUCKET = 250.0
_PROFILE = _SIDED + f""",
vp AS (SELECT contract, CAST(floor(price / {_BUCKET}) AS BIGINT) AS bucket, {_V} AS total_volume, avg(price) AS avg_price, count(volume) AS trade_count,
  {_v('buy')} AS buy_volume, {_v('sell')} AS sell_volume FROM sided GROUP BY 1, 2)"""
_AREA = """, cum AS (SELECT *, sum(total_volume) OVER (PARTITION BY contract ORDER BY total_volume DESC, bucket ROWS UNBOUNDED PRECEDING) AS cum,
  sum(total_volume) OVER (PARTITION BY contract) AS total FROM vp),
area AS (SELECT contract, max(avg_price) AS value_area_high, min(avg_price) AS value_area_low, CAST(max(cum) AS BIGINT) AS value_area_volume,
  CAST(max(total) AS BIGINT) AS total_volume, count(*) AS buckets FROM cum WHERE cum - total_volume < CAST(0.7 AS DOUBLE) * total GROUP BY contract)"""
_AREA_OUT = f"""SELECT contract, {r6('value_area_high', 4)} AS value_area_high, {r6('value_area_low', 4)} AS value_area_low, value_area_volume, total_volume,
  buckets, {r6('value_area_volume / total_volume * 100.0', 4)} AS volume_percentage FROM area"""
profile = lambda s, d: W.volume_profile(sided(s, d), _BUCKET)
add("volume_profile", profile, with_sql(_PROFILE) + f"""
SELECT contract, bucket, total_volume, {r6('avg_price', 4)} AS avg_price, trade_count, buy_volume, sell_volume FROM vp""", 4)
add("point_of_control", lambda s, d: W.point_of_control(profile(s, d)), with_sql(_PROFILE) + f"""
SELECT contract, {r6('avg_price', 4)} AS poc_price, total_volume AS poc_volume FROM vp
QUALIFY row_number() OVER (PARTITION BY contract ORDER BY total_volume DESC, bucket) = 1""", 4)
add("value_area", lambda s, d: W.value_area(profile(s, d)), with_sql(_PROFILE) + _AREA + _AREA_OUT, 4)
_BINS = WEEK_BARS_SQL + f""", e AS (SELECT contract, min(close) AS lo, max(close) AS hi FROM bars GROUP BY contract),
vp AS (SELECT contract, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((close - lo) / ((hi - lo) / 50)), 49) END AS BIGINT) AS bucket, {_V} AS total_volume,
  avg(close) AS avg_price, count(volume) AS trade_count FROM bars JOIN e USING (contract) GROUP BY 1, 2)"""
bins = lambda s, d: W.volume_profile_bins(week_bars(s, d))
add("volume_profile_bins", bins, with_sql(_BINS) + f"""SELECT contract, bucket, total_volume, {r6('avg_price', 4)} AS avg_price, trade_count,
  CAST(0 AS BIGINT) AS buy_volume, CAST(0 AS BIGINT) AS sell_volume FROM vp""", 4)
add("value_area_bins", lambda s, d: W.value_area(bins(s, d)), with_sql(_BINS) + _AREA + _AREA_OUT, 4)
add("recent_trades", lambda s, d: W.recent_trades(sided(s, d), 100, order=TRADE_ORDER).select(*_K.split(", "), "volume", "side"), with_sql(_SIDED) + f"""
SELECT {_K}, volume, side FROM sided QUALIFY row_number() OVER (PARTITION BY contract ORDER BY {', '.join(c + ' DESC' for c in TRADE_ORDER)}) <= 100""")

# --- quotes -------------------------------------------------------------------------------------------------


def partial(s, d):
    """Quote updates that each carry only some fields."""
    price, t = F.col("price"), F.col("type")
    return depth(s, d).select(
        "contract", "ts", "seq", F.when(t == 2, price).alias("bid"), F.when(t == 1, price).alias("ask"), F.when(t.isin(5, 9), price).alias("last"),
        F.when(t == 5, F.col("volume")).alias("volume"),
    )


_QUOTES = DEPTH_SQL + """,
pq AS (SELECT contract, ts, seq, CASE WHEN type = 2 THEN price END AS bid, CASE WHEN type = 1 THEN price END AS ask,
  CASE WHEN type IN (5, 9) THEN price END AS last, CASE WHEN type = 5 THEN volume END AS volume FROM depth),
fq AS MATERIALIZED (SELECT contract, ts, seq, last_value(bid IGNORE NULLS) OVER w AS bid, last_value(ask IGNORE NULLS) OVER w AS ask, last, volume
  FROM pq WINDOW w AS (PARTITION BY contract ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""
filled = lambda s, d: forward_fill_quotes(partial(s, d))
add("forward_fill_quotes", filled, with_sql(_QUOTES) + "SELECT contract, ts, seq, bid, ask, last, volume FROM fq")
add("forward_fill_quotes_split", lambda s, d: forward_fill_quotes(partial(s, d), chunk=cut(50)), with_sql(_QUOTES) + "SELECT contract, ts, seq, bid, ask, last, volume FROM fq")
add("quotes_to_ticks", lambda s, d: quotes_to_ticks(filled(s, d)), with_sql(_QUOTES) + f"""
SELECT * FROM (SELECT contract, ts, seq, CASE WHEN last IS NOT NULL AND volume IS NOT NULL THEN last WHEN bid IS NOT NULL AND ask IS NOT NULL THEN (bid + ask) / 2
  ELSE coalesce(bid, ask) END AS price, CASE WHEN last IS NOT NULL AND volume IS NOT NULL THEN volume ELSE 0 END AS volume,
  CASE WHEN last IS NOT NULL AND volume IS NOT NULL THEN 'trade' ELSE 'quote' END AS type FROM fq) WHERE price IS NOT NULL""")
add("spread_stats", lambda s, d: W.spread_stats(filled(s, d)), with_sql(_QUOTES) + f"""
SELECT contract, {r6('avg(s)')} AS avg_spread, {r6('median(s)')} AS median_spread, min(s) AS min_spread, max(s) AS max_spread, {r6('avg(r)')} AS avg_relative_spread,
  count(*) AS quotes, {r6('coalesce(stddev_samp(s), 0.0)')} AS spread_volatility FROM (
  SELECT contract, ask - bid AS s, CASE WHEN ask + bid <> 0 THEN (ask - bid) / ((ask + bid) / 2) END AS r FROM fq) WHERE s IS NOT NULL AND r IS NOT NULL GROUP BY contract""")


def _kinds(s, d):
    t = F.col("type")
    return depth(s, d).withColumn("kind", F.when(t.isin(1, 2), "quote").when(t == 5, "trade").otherwise("depth"))


add("feed_rates", lambda s, d: W.feed_rates(_kinds(s, d), 60), with_sql(DEPTH_SQL) + """
SELECT contract, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, CASE WHEN type IN (1, 2) THEN 'quote' WHEN type = 5 THEN 'trade' ELSE 'depth' END AS kind,
  count(*) AS messages FROM depth GROUP BY 1, 2, 3""")
