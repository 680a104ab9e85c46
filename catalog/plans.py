"""Queries and oracles of the combined plans: signals, market summary, wire messages, custom indicators, tables on disk."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapestry.functions.checks import short_groups
from tapestry.functions.history import newest
from tapestry.operators.registry import register_custom, with_indicators
from tapestry.plans import market, signals as G
from tapestry.session import scratch_dir
from tapestry.sources import envelopes as E, readers

from .accounts import EVENTS_SQL, ORDERS_SQL, accounts, order_events, position_events
from .book import ASOF, BEST_SQL, BOOK_SQL, BBO_SQL, MINUTES, ROUTED_SQL, TRADES_SQL, _CLUSTERS_SQL, _FLOW_SQL, _IMBALANCE_SQL, _SR_SQL, _liq
from .indicators import _trange, div, inputs, lag, recursion, roll, span
from .tables import cut, DEPTH_SQL, HOUR_BARS_SQL, TICKS_SQL, WEEK_BARS_SQL, depth, hour_bars, hour_split, r6, ticks, tidy, week_bars, week_split, with_sql

QUERIES, ORACLES = {}, {}


def add(name, query, sql, digits=6):
    QUERIES[name] = lambda spark, sf: tidy(query(spark, sf), digits)
    if sql is not None:
        ORACLES[name] = sql


# --- signals ------------------------------------------------------------------------------------------------


def _signal_states():
    a, q = 1 / 14, 1 - 1 / 14
    qf, qs, qg = (1 - span(p) for p in (12, 26, 9))
    f, fd, s, sd = f"(x.close + {qf!r} * p.fn)", f"(1.0 + {qf!r} * p.fd)", f"(x.close + {qs!r} * p.sn)", f"(1.0 + {qs!r} * p.sd)"
    m = f"({f} / {fd} - {s} / {sd})"
    w = {c: f"({a!r} * x.{c} + {q!r} * p.{c}_s)" for c in ("gain", "loss", "tr", "up", "dn")}

    def dx(u, d, t):
        return f"100.0 * {div(f'abs({div(f'100.0 * {u}', t)} - {div(f'100.0 * {d}', t)})', f'{div(f'100.0 * {u}', t)} + {div(f'100.0 * {d}', t)}')}"

    return recursion(
        {"fn": "x.close", "fd": "1.0", "sn": "x.close", "sd": "1.0", "m": "0.0", "gn": "0.0", "gd": "1.0", **{f"{c}_s": f"x.{c}" for c in w}, "adx": dx("x.up", "x.dn", "x.tr")},
        {"fn": f, "fd": fd, "sn": s, "sd": sd, "m": m, "gn": f"({m} + {qg!r} * p.gn)", "gd": f"(1.0 + {qg!r} * p.gd)", **{f"{c}_s": e for c, e in w.items()},
         "adx": f"({a!r} * ({dx(w['up'], w['dn'], w['tr'])}) + {q!r} * p.adx)"})


_up, _dn = f"(high - {lag('high')})", f"({lag('low')} - low)"
_SIGNALS = with_sql(HOUR_BARS_SQL, inputs(
    gain=f"CASE WHEN close > {lag('close')} THEN close - {lag('close')} ELSE 0.0 END", loss=f"CASE WHEN close < {lag('close')} THEN {lag('close')} - close ELSE 0.0 END",
    tr=_trange, up=f"CASE WHEN {_up} > {_dn} AND {_up} > 0 THEN {_up} ELSE 0.0 END", dn=f"CASE WHEN {_dn} > {_up} AND {_dn} > 0 THEN {_dn} ELSE 0.0 END"),
    _signal_states(), f"""sg0 AS (SELECT x.contract, x.ts, x.close, {roll('avg', 'close', 20).replace('contract', 'x.contract').replace('ORDER BY ts', 'ORDER BY x.ts')} AS sma_20,
  {roll('avg', 'close', 50).replace('contract', 'x.contract').replace('ORDER BY ts', 'ORDER BY x.ts')} AS sma_50, 100.0 - 100.0 / (1.0 + {div('gain_s', 'loss_s')}) AS rsi_14,
  m - gn / gd AS macd_histogram, tr_s AS atr_14, adx AS adx_14 FROM x JOIN r ON x.contract = r.contract AND x.rn = r.rn),
sg AS MATERIALIZED (SELECT *, CASE WHEN sma_20 > sma_50 AND rsi_14 > 50 AND macd_histogram > 0 AND adx_14 > 25 THEN 'bullish'
  WHEN NOT (sma_20 > sma_50) AND NOT (rsi_14 > 50 AND macd_histogram > 0) AND adx_14 > 25 THEN 'bearish' ELSE 'none' END AS signal FROM sg0)""")
_SIGNAL_COLS = ["sma_20", "sma_50", "rsi_14", "macd_histogram", "atr_14", "adx_14"]
_SIGNAL_OUT = f"SELECT contract, ts, close, {', '.join(f'{r6(c)} AS {c}' for c in _SIGNAL_COLS)}, signal, " + ", ".join(
    f"{r6(f'''close {a} CASE signal WHEN 'bullish' THEN 1.0 WHEN 'bearish' THEN -1.0 END * {k} * atr_14''')} AS {n}" for n, a, k in (("stop", "-", "2.0"), ("target", "+", "3.0"))) + " FROM sg"
_cols = ["contract", "ts", "close", *_SIGNAL_COLS, "signal", "stop", "target"]
add("signals", lambda s, d: G.latest_signals(hour_bars(s, d), chunk=hour_split(s, d)).select(*_cols),
    _SIGNALS + _SIGNAL_OUT + " QUALIFY row_number() OVER (PARTITION BY contract ORDER BY ts DESC) = 1")
add("signals_history", lambda s, d: G.signals(hour_bars(s, d), chunk=hour_split(s, d)).select(*_cols), _SIGNALS + _SIGNAL_OUT)
add("signals_history_split", lambda s, d: G.signals(hour_bars(s, d), chunk=cut(200)).select(*_cols), _SIGNALS + _SIGNAL_OUT)
add("reversal_signals", lambda s, d: G.reversal_signals(hour_bars(s, d), chunk=hour_split(s, d)).select("contract", "ts", "signal"), _SIGNALS + """
SELECT contract, ts, CASE WHEN rsi_14 < 30 AND close > sma_20 AND sma_20 > sma_50 THEN 'buy' WHEN rsi_14 > 70 AND close < sma_20 AND sma_20 < sma_50 THEN 'sell' ELSE 'none' END AS signal FROM sg""")
add("latest", lambda s, d: newest(week_bars(s, d), 3, by="contract", order="ts").select("contract", "ts", "volume"), with_sql(WEEK_BARS_SQL) + """
SELECT contract, ts, volume FROM bars QUALIFY row_number() OVER (PARTITION BY contract ORDER BY ts DESC) <= 3""")
add("latest_many", lambda s, d: newest(ticks(s, d), 1500, by="contract", order=["ts", "seq"]), with_sql(TICKS_SQL) + """
SELECT contract, ts, seq, price, volume FROM ticks QUALIFY row_number() OVER (PARTITION BY contract ORDER BY ts DESC, seq DESC) <= 1500""")


def range_share(df, *, by, order, period=10):
    """A custom indicator: where the close lies in the range of the last bars."""
    from tapestry.functions.exprs import safe_div
    from tapestry.functions.history import over_history

    def body(d, t):
        lo, hi = t.low("low", period), t.high("high", period)
        return d.withColumn(f"range_share_{period}", safe_div(F.col("close") - lo, hi - lo))

    return over_history(df, body, by=by, order=order, lookback=period - 1)


register_custom("range_share", range_share)
add("custom_indicator", lambda s, d: with_indicators(hour_bars(s, d), [("sma", {"period": 5}), ("range_share", {"period": 10})], by="contract", order="ts").select(
    "contract", "ts", "sma_5", "range_share_10"), with_sql(HOUR_BARS_SQL) + f"""SELECT contract, ts, {r6(roll('avg', 'close', 5))} AS sma_5,
  {r6(div(f"close - {roll('min', 'low', 10)}", f"{roll('max', 'high', 10)} - {roll('min', 'low', 10)}"))} AS range_share_10 FROM bars""")

# --- market summary -------------------------------------------------------------------------------------------

_METRICS = with_sql(DEPTH_SQL, BBO_SQL, ROUTED_SQL, BOOK_SQL, BEST_SQL, TRADES_SQL, _FLOW_SQL, _IMBALANCE_SQL, _SR_SQL.replace("liq AS", "liq200 AS").replace("FROM liq JOIN", "FROM liq200 JOIN"),
    _liq("liq", 100, 20), _CLUSTERS_SQL, """poc AS (SELECT contract, avg_price AS poc_price, total_volume AS poc_volume FROM vp QUALIFY row_number() OVER (PARTITION BY contract ORDER BY total_volume DESC, bucket) = 1),
cm AS (SELECT *, sum(total_volume) OVER (PARTITION BY contract ORDER BY total_volume DESC, bucket ROWS UNBOUNDED PRECEDING) AS cum, sum(total_volume) OVER (PARTITION BY contract) AS total FROM vp),
va AS (SELECT contract, max(avg_price) AS value_area_high, min(avg_price) AS value_area_low FROM cm WHERE cum - total_volume < CAST(0.7 AS DOUBLE) * total GROUP BY contract),
snap AS (SELECT contract, CAST(coalesce(sum(volume) FILTER (side = 'bid'), 0) AS BIGINT) AS total_bid_volume, CAST(coalesce(sum(volume) FILTER (side = 'ask'), 0) AS BIGINT) AS total_ask_volume FROM book WHERE lvl <= 10 GROUP BY contract)""")
add("market_metrics", lambda s, d: market.market_report(depth(s, d), asof=ASOF, flow_minutes=MINUTES, delta_minutes=MINUTES, iceberg_minutes=MINUTES, bucket_size=5.0, price_tolerance=1.0, iceberg_volume=40).select(
    "contract", "best_bid", "best_ask", "spread", "mid", "icebergs", "delta_trend", "buy_volume", "sell_volume", "total_bid_volume", "total_ask_volume", "liquid_levels", "clusters", "cumulative_delta", "imbalance_ratio", "direction", "confidence", "poc_price", "poc_volume",
    "value_area_high", "value_area_low", "supports", "resistances", "total_volume", "trade_count", "vwap", "data_quality", "market_activity"), _METRICS + f"""
SELECT contract, best_bid, best_ask, spread, mid, (SELECT count(*) FROM book WHERE book.contract = best.contract AND ts >= TIMESTAMP '2024-01-01 00:00:00' AND volume > 40 AND CAST(round(price * 100) AS BIGINT) % 50 = 0) AS icebergs,
  CASE WHEN buy_volume - sell_volume > 500 THEN 'strongly_bullish' WHEN buy_volume - sell_volume > 100 THEN 'bullish' WHEN buy_volume - sell_volume < -500 THEN 'strongly_bearish'
    WHEN buy_volume - sell_volume < -100 THEN 'bearish' ELSE 'neutral' END AS delta_trend, buy_volume, sell_volume, total_bid_volume, total_ask_volume, (SELECT count(*) FROM liq WHERE liq.contract = best.contract) AS liquid_levels,
  (SELECT count(*) FROM clusters WHERE clusters.contract = best.contract) AS clusters, buy_volume - sell_volume AS cumulative_delta, {r6('imbalance_ratio')} AS imbalance_ratio, direction, confidence,
  {r6('poc_price')} AS poc_price, poc_volume, {r6('value_area_high')} AS value_area_high, {r6('value_area_low')} AS value_area_low,
  (SELECT count(*) FROM sr WHERE sr.contract = best.contract AND kind = 'support') AS supports, (SELECT count(*) FROM sr WHERE sr.contract = best.contract AND kind = 'resistance') AS resistances,
  tf.total_volume, trade_count, {r6('vwap')} AS vwap, CASE WHEN trade_count > 100 THEN 'high' ELSE 'medium' END AS data_quality, CASE WHEN trade_count > 50 THEN 'active' ELSE 'quiet' END AS market_activity
FROM best JOIN snap USING (contract) JOIN tf USING (contract) JOIN imb USING (contract) JOIN poc USING (contract) JOIN va USING (contract)""")

# --- wire messages -------------------------------------------------------------------------------------------------


def _order_messages(s, d):
    """Order updates in the three wire forms: enveloped list, bare list, bare record."""
    o = order_events(s, d)
    data = F.struct("id", "accountId", "contractId", "status", "type", "side", "size", "fillVolume", "limitPrice", "stopPrice")
    form = F.col("seq") % 3
    text = F.when(form == 0, F.to_json(F.array(F.struct(F.lit(1).alias("action"), data.alias("data"))))).when(form == 1, F.to_json(F.array(data))).otherwise(F.to_json(data))
    return o.select("seq", text.alias("payload"))


add("order_envelopes", lambda s, d: E.unwrap(_order_messages(s, d), E.ORDER_FIELDS).select(
    "seq", "action", "id", "accountId", "contractId", "status", "type", "side", "size", "fillVolume", "limitPrice", "stopPrice"), with_sql(ORDERS_SQL) + """
SELECT seq, CASE WHEN seq % 3 = 0 THEN 1 END AS action, id, "accountId", "contractId", status, type, side, size, "fillVolume", "limitPrice", "stopPrice" FROM oe""")


def _quote_messages(s, d):
    """Quotes under their alternative field names, as pairs or records."""
    q, price = depth(s, d), F.col("price")
    t, alt = F.col("type"), F.col("seq") % 2 == 0
    f = lambda cond, name: F.when(cond, price).alias(name)
    body = F.struct(f((t == 2) & alt, "bestBid"), f((t == 2) & ~alt, "bid"), f((t == 1) & alt, "bestAsk"), f((t == 1) & ~alt, "ask"), f((t == 5) & alt, "lastPrice"),
                    f((t == 5) & ~alt, "last"), f(t == 9, "price"), F.when(t == 5, F.col("volume")).alias("volume"), F.col("contract").cast("string").alias("contractId"))
    js = F.to_json(body)
    pair = F.concat(F.lit('["'), F.col("contract").cast("string"), F.lit('", '), js, F.lit("]"))
    return q.select("seq", F.when(F.col("seq") % 3 == 0, js).otherwise(pair).alias("payload"))


add("quote_messages", lambda s, d: E.parse_quotes(_quote_messages(s, d)), with_sql(DEPTH_SQL) + """
SELECT seq, CAST(contract AS VARCHAR) AS contract, CASE WHEN type = 2 THEN p0 END AS bid, CASE WHEN type = 1 THEN p0 END AS ask,
  CASE WHEN type = 5 THEN nullif(price, 0) WHEN type = 9 THEN price END AS last, CASE WHEN type = 5 THEN volume END AS volume
FROM (SELECT *, CASE WHEN seq % 2 = 0 THEN nullif(price, 0) ELSE price END AS p0 FROM depth)""")


def _trade_messages(s, d):
    """Trades as pairs, records and lists; some without a price, a volume or a readable time."""
    q, k = depth(s, d), F.col("seq") % 5
    local = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    when = F.when(k == 0, F.concat(local, F.lit("+00:00"))).when(k == 1, local).when(k == 2, "0001-01-01T00:00:00+00:00")
    entry = F.struct(F.when(k != 4, F.col("price")).alias("price"), F.when(k != 3, F.col("volume")).alias("volume"), when.alias("timestamp"), F.col("contract").cast("string").alias("contractId"))
    js = F.to_json(entry)
    pair = lambda x: F.concat(F.lit('["'), F.col("contract").cast("string"), F.lit('", '), x, F.lit("]"))
    text = F.when(F.col("seq") % 3 == 0, js).when(F.col("seq") % 3 == 1, pair(js)).otherwise(pair(F.to_json(F.array(entry, entry))))
    return q.select("seq", F.timestamp_micros(F.unix_micros("ts") + 5_000_000).alias("arrival_ts"), text.alias("payload"))


# January lies in standard time: a time without offset is six hours behind UTC.
add("trade_messages", lambda s, d: E.parse_trades(_trade_messages(s, d)).drop("arrival_ts"), with_sql(DEPTH_SQL) + """
SELECT seq, CAST(contract AS VARCHAR) AS contract, nth, price, CASE WHEN seq % 5 = 3 THEN 0 ELSE volume END AS volume, 'trade' AS type,
  CASE seq % 5 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts) + INTERVAL 6 HOUR ELSE ts + INTERVAL 5 SECOND END AS ts
FROM depth, (SELECT unnest([0, 1]) AS nth) WHERE seq % 5 <> 4 AND (nth = 0 OR seq % 3 = 2)""")


def _records(rows, *fields):
    """Records as an enveloped list, a bare list and a bare record."""
    data, form = F.struct(*fields), F.col("nr") % 3
    text = F.when(form == 0, F.to_json(F.array(F.struct(F.lit(1).alias("action"), data.alias("data"))))).when(form == 1, F.to_json(F.array(data))).otherwise(F.to_json(data))
    return rows.select("nr", text.alias("payload"))


def _position_messages(s, d):
    rows = position_events(s, d).withColumns({"nr": F.col("id"), "contractId": F.col("contractId").cast("string"), "averagePrice": F.floor("averagePrice").cast("double")})
    return _records(rows, "id", "accountId", "contractId", "type", "size", "averagePrice")


add("position_messages", lambda s, d: E.unwrap(_position_messages(s, d), E.POSITION_FIELDS).drop("creationTimestamp"), with_sql(EVENTS_SQL) + """
SELECT id AS nr, CASE WHEN id % 3 = 0 THEN 1 END AS action, id, "accountId", CAST("contractId" AS VARCHAR) AS "contractId", type, size, CAST(floor("averagePrice") AS DOUBLE) AS "averagePrice" FROM pe""")


def _account_messages(s, d):
    rows = accounts(s, d).withColumns({"nr": F.col("id"), "canTrade": F.col("balance") > 0, "isVisible": F.lit(True)})
    return _records(rows, "id", "name", "balance", "canTrade", "isVisible")


add("account_messages", lambda s, d: E.unwrap(_account_messages(s, d), E.ACCOUNT_FIELDS).drop("simulated"), """
SELECT c_custkey AS nr, CASE WHEN c_custkey % 3 = 0 THEN 1 END AS action, c_custkey AS id, c_name AS name, round(c_acctbal + 3e-9, 6) AS balance, c_acctbal > 0 AS "canTrade", true AS "isVisible" FROM customer""")
add("strict_rows", lambda s, d: short_groups(week_bars(s, d), ["contract"], 300), with_sql(WEEK_BARS_SQL) + "SELECT contract, count(*) AS rows FROM bars GROUP BY contract HAVING count(*) < 300")


def _depth_messages(s, d):
    """Two level updates per message; some times are missing, unreadable or the empty-date sentinel."""
    q, k = depth(s, d), F.col("seq") % 4
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    when = F.when(k == 0, iso).when(k == 1, "0001-01-01T00:00:00+00:00").when(k == 2, "not a time")
    entry = lambda p: F.struct(p.alias("price"), F.col("volume"), F.col("type"), when.alias("timestamp"))
    js = F.to_json(F.array(entry(F.col("price")), entry(F.col("price") + 1)))
    return q.select(F.col("seq").alias("message"), F.timestamp_micros(F.unix_micros("ts") + 5_000_000).alias("arrival_ts"),
                    F.concat(F.lit('["'), F.col("contract").cast("string"), F.lit('", '), js, F.lit("]")).alias("payload"))


add("depth_messages", lambda s, d: E.parse_depth(_depth_messages(s, d)).drop("arrival_ts"), with_sql(DEPTH_SQL) + " UNION ALL ".join(
    f"""SELECT seq AS message, CAST(contract AS VARCHAR) AS contract, CAST({i} AS BIGINT) AS seq, price + {i} AS price, volume, type,
  CASE WHEN seq % 4 = 0 THEN date_trunc('second', ts) ELSE ts + INTERVAL 5 SECOND END AS ts FROM depth""" for i in (0, 1)))

# --- tables on disk -------------------------------------------------------------------------------------------------


def _bars_round_trip(s, d):
    """Bars written in the daily layout and read back for a range of days (pruned by folder)."""
    path = scratch_dir(s, "bars")
    readers.write_bars(hour_bars(s, d), path)
    return readers.read_bars(s, path, "parquet", wire=False).drop("date")


add("write_read_bars", _bars_round_trip, with_sql(HOUR_BARS_SQL) + "SELECT contract, ts, open, high, low, close, volume FROM bars")


def _bucketed(s, d):
    """Indicators over hourly bars that were written as a bucketed table, which they read without an exchange."""
    path = scratch_dir(s, "series")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    readers.write_series(hour_bars(s, d), name, path=path)
    return with_indicators(readers.read_series(s, name), [("sma", {"period": 5}), "trange"], by="contract", order="ts", chunk=None).select("contract", "ts", "sma_5", "trange")


add("series_indicators", _bucketed, with_sql(HOUR_BARS_SQL) + f"""SELECT contract, ts, {r6(roll('avg', 'close', 5))} AS sma_5,
  {r6("greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w))")} AS trange FROM bars WINDOW w AS (PARTITION BY contract ORDER BY ts)""")


def _wire_bars(s, d):
    """Bars in wire form through JSON files."""
    path = scratch_dir(s, "wire")
    b = hour_bars(s, d)
    wire = b.select("contract", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("t"), F.col("open").alias("o"), F.col("high").alias("h"), F.col("low").alias("l"),
                    F.col("close").alias("c"), F.col("volume").alias("v"))
    readers.write_table(wire, path, fmt="json")
    return readers.read_bars(s, path)


add("read_bars", _wire_bars, with_sql(HOUR_BARS_SQL) + "SELECT contract, ts, open, high, low, close, volume FROM bars")


def _wire_ticks(s, d):
    path = scratch_dir(s, "ticks")
    wire = ticks(s, d).select("contract", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("timestamp"), "price", "volume", F.lit("unknown").alias("side"))
    readers.write_table(wire, path, fmt="json")
    return readers.read_ticks(s, path)


add("read_ticks", _wire_ticks, with_sql(TICKS_SQL) + "SELECT contract, ts, price, volume, 'unknown' AS side FROM ticks")
