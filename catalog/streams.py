"""Streaming queries over the event file, each compared with the batch result on the same rows."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tapestry.functions.joins import latest_state
from tapestry.operators.book import book_asof
from tapestry.session import scratch_dir
from tapestry.streaming import book as K, fold, sinks, state as S, windows as W

from .accounts import ORDERS_SQL, _OC, _ocols
from .book import BOOK_SQL, ORACLES as BOOK_ORACLES
from .tables import bars_sql, DEPTH_SQL, DEPTH_TYPES, HOUR_BARS_SQL, TICKS_SQL, r6, table, tidy, with_sql
from .flow import _QUOTES

QUERIES, ORACLES = {}, {}


def add(name, query, sql, digits=6):
    QUERIES[name] = lambda spark, sf: tidy(query(spark, sf), digits)
    if sql is not None:
        ORACLES[name] = sql


PARTS = 4
FILE_ROWS = 2_000_000  # rows of a file, at most on average


def stream(spark, sf, name, ts):
    """The given table as a stream in time order, so that every query runs over several micro-batches.

    Each of the PARTS spans of time is one micro-batch at every size: it is written as the same number of files, empty ones where
    rows lack, and a trigger takes that many.  Were a span cut over batches, the first would move the watermark past the rest.
    """
    rows = table(spark, sf, name).withColumn("__us", F.unix_micros(F.col(ts).cast("timestamp")))
    low, high = rows.agg(F.min("__us"), F.max("__us")).first()
    part = F.least(F.floor((F.col("__us") - low) / ((high - low) / PARTS + 1)), F.lit(PARTS - 1))
    most = rows.groupBy(part.alias("part")).count().agg(F.max("count")).first()[0]
    files, path, schema = math.ceil(most / FILE_ROWS), scratch_dir(spark, "arrivals"), rows.drop("__us").schema
    for i in range(PARTS):
        span = rows.filter(part == i).drop("__us").repartition(files)
        span.write.mode("append").option("maxRecordsPerFile", 0).parquet(path)
        written = len(spark.read.schema(schema).parquet(path).inputFiles())
        for _ in range(files * (i + 1) - written):
            spark.createDataFrame([], schema).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def tick_stream(s, d):
    return stream(s, d, "events", "ts").select(
        F.col("event_type").alias("contract"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"), F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("long").alias("volume"))


def depth_stream(s, d):
    code = F.create_map(*[F.lit(x) for kv in DEPTH_TYPES.items() for x in kv])
    return stream(s, d, "events", "ts").select(
        (F.col("user_id") % 10).alias("contract"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"),
        (F.round(F.col("value") * 4) / 4).alias("price"), F.get_json_object("props", "$.k").cast("long").alias("volume"), code[F.col("event_type")].alias("type"))


_CLOSED = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM ticks)"
add("stream_bars", lambda s, d: sinks.drain(W.stream_bars(tick_stream(s, d), "1hr", by="contract", delay="10 minutes"), "bars"),
    with_sql(HOUR_BARS_SQL) + f"SELECT contract, ts, open, high, low, close, volume FROM bars WHERE ts + INTERVAL 1 HOUR <= {_CLOSED}")
# Days and weeks of the exchange's clock, which is six hours behind UTC in these rows.
for _tf, _unit in (("1day", "day"), ("1week", "week")):
    add(f"stream_bars_{_tf}", lambda s, d, tf=_tf: sinks.drain(W.stream_bars(tick_stream(s, d), tf, by="contract", delay="10 minutes"), f"bars-{tf}"),
        with_sql(TICKS_SQL, bars_sql("b", "ticks", f"CAST(date_trunc('{_unit}', ts - INTERVAL 6 HOUR) AS TIMESTAMP) + INTERVAL 6 HOUR", "ts, seq")) + f"""
SELECT contract, ts, open, high, low, close, volume FROM b WHERE ts + INTERVAL 1 {_unit} <= {_CLOSED}""")
_SIDE = "CASE WHEN volume % 3 = 0 THEN 'buy' WHEN volume % 3 = 1 THEN 'sell' ELSE 'unknown' END"


def _trades(s, d):
    v = F.col("volume")
    return tick_stream(s, d).withColumn("side", F.when(v % 3 == 0, "buy").when(v % 3 == 1, "sell").otherwise("unknown"))


_V = "CAST(coalesce(sum(volume), 0) AS BIGINT)"


def _v(side):
    return f"CAST(coalesce(sum(volume) FILTER (side = '{side}'), 0) AS BIGINT)"


add("stream_flow", lambda s, d: sinks.drain(W.stream_flow(_trades(s, d), 60, 20, delay="10 minutes"), "flow"),
    with_sql(TICKS_SQL, f"sd AS (SELECT *, {_SIDE} AS side, time_bucket(INTERVAL 20 MINUTE, ts) AS b FROM ticks)",
             "wn AS (SELECT sd.*, b - INTERVAL 1 MINUTE * k AS window_start FROM sd, (SELECT unnest([0, 20, 40]) AS k))") + f"""
SELECT contract, window_start, window_start + INTERVAL 1 HOUR AS window_end, {_V} AS total_volume, count(*) AS trade_count, {_v('buy')} AS buy_volume,
  {_v('sell')} AS sell_volume, count(*) FILTER (side = 'buy') AS buy_trades, count(*) FILTER (side = 'sell') AS sell_trades,
  {r6(_V + ' / count(*)')} AS avg_trade_size, {r6('CASE WHEN sum(volume) > 0 THEN sum(price * volume) / sum(volume) ELSE 0.0 END')} AS vwap,
  {r6(f"CASE WHEN {_v('sell')} > 0 THEN {_v('buy')} / {_v('sell')} WHEN {_v('buy')} > 0 THEN CAST('inf' AS DOUBLE) ELSE 0.0 END")} AS buy_sell_ratio
FROM wn GROUP BY contract, window_start HAVING window_start + INTERVAL 1 HOUR <= {_CLOSED}""")


def _kinds(s, d):
    t = F.col("type")
    return depth_stream(s, d).withColumn("kind", F.when(t.isin(1, 2), "quote").when(t == 5, "trade").otherwise("depth"))


add("stream_feed_rates", lambda s, d: sinks.drain(W.stream_feed_rates(_kinds(s, d), 60, delay="10 minutes"), "rates"),
    with_sql(TICKS_SQL, DEPTH_SQL) + f"""SELECT contract, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
  CASE WHEN type IN (1, 2) THEN 'quote' WHEN type = 5 THEN 'trade' ELSE 'depth' END AS kind, count(*) AS messages FROM depth GROUP BY 1, 2, 3
HAVING time_bucket(INTERVAL 1 HOUR, any_value(ts)) + INTERVAL 1 HOUR <= {_CLOSED}""")
add("stream_activity", lambda s, d: sinks.drain(W.stream_activity(tick_stream(s, d), "15 minutes", delay="10 minutes"), "activity"),
    with_sql(TICKS_SQL, """g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY contract ORDER BY ts, seq) < INTERVAL 15 MINUTE THEN 0 ELSE 1 END AS fresh FROM ticks),
h AS (SELECT *, sum(fresh) OVER (PARTITION BY contract ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS k FROM g)""") + f"""
SELECT contract, min(ts) AS burst_start, max(ts) + INTERVAL 15 MINUTE AS burst_end, count(*) AS messages FROM h GROUP BY contract, k
HAVING max(ts) + INTERVAL 15 MINUTE <= {_CLOSED}""")


def _partial(s, d):
    price, t = F.col("price"), F.col("type")
    return depth_stream(s, d).select(
        "contract", "ts", "seq", F.when(t == 2, price).alias("bid"), F.when(t == 1, price).alias("ask"), F.when(t.isin(5, 9), price).alias("last"),
        F.when(t == 5, F.col("volume")).alias("volume"))


add("stream_quotes", lambda s, d: sinks.drain(S.fill_quotes(_partial(s, d)), "quotes"), with_sql(_QUOTES) + "SELECT contract, ts, seq, bid, ask, last, volume FROM fq")


def _plain_updates(s, d):
    side = F.when(F.col("type").isin(2, 9), "bid").when(F.col("type").isin(1, 10), "ask").otherwise("trade")
    return depth_stream(s, d).select("contract", "ts", "seq", side.alias("side"), "price", "volume", side.alias("type"))


_LEVEL = ["contract", "side", "price"]
add("stream_book", lambda s, d: book_asof(S.drain_changes(S.newest(_plain_updates(s, d).filter("side <> 'trade'"), key=_LEVEL, order=["ts", "seq"]), "book", key=_LEVEL, order=["ts", "seq"])),
    with_sql(DEPTH_SQL, """routed AS (SELECT contract, ts, seq, price, volume, CASE WHEN type IN (2, 9) THEN 'bid' WHEN type IN (1, 10) THEN 'ask' ELSE 'trade' END AS side,
  CASE WHEN type IN (2, 9) THEN 'bid' WHEN type IN (1, 10) THEN 'ask' ELSE 'trade' END AS type FROM depth)""", BOOK_SQL) + "SELECT contract, side, price, volume, ts, type FROM book")


def _routed_stream(s, d):
    """Placed by a book that lives on from batch to batch: without its state every batch would begin with an empty one."""
    with K.map_state(s):
        return sinks.drain(K.route_depth_stream(depth_stream(s, d)), "routed")


add("stream_route_depth", _routed_stream, BOOK_ORACLES["route_depth_exact"])


def _orders(s, d):
    """Order updates as a stream of the orders file."""
    st, k = F.col("o_orderstatus"), F.col("o_orderkey")
    return stream(s, d, "orders", "o_orderdate").select(
        F.floor(k / 3).alias("id"), F.col("o_custkey").alias("accountId"), F.col("o_orderdate").cast("timestamp").alias("updateTimestamp"), k.alias("seq"),
        F.when(st == "O", 1).when(st == "F", 2).otherwise(0).alias("status"))


add("stream_latest_orders", lambda s, d: S.drain_changes(S.newest(_orders(s, d), key="id", order=["updateTimestamp", "seq"]), "orders", key="id", order=["updateTimestamp", "seq"]),
    with_sql(ORDERS_SQL) + 'SELECT id, "accountId", "updateTimestamp", seq, status FROM ord')


def _position_stream(s, d):
    k = F.get_json_object("props", "$.k").cast("int")
    return stream(s, d, "events", "ts").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("contractId"), F.col("ts").cast("timestamp").alias("creationTimestamp"),
        F.when(F.col("event_type") == "view", 2).otherwise(1).alias("type"), (F.floor(k / 90) + 1).cast("int").alias("size"), F.lit(60.0).alias("averagePrice"), F.col("value").alias("price"))


def _alerts(s, d):
    rules = table(s, d, "events").select(F.col("user_id").alias("contractId")).distinct().select(
        "contractId", F.lit(59.0).alias("max_loss"), F.lit(150.0).alias("max_gain"), F.lit(None).cast("double").alias("pnl_threshold"))
    return sinks.drain(S.alerts(_position_stream(s, d), rules), "alerts").select("contractId", "id", "reason", "size", "size_change", "pnl")


add("stream_alerts", _alerts, with_sql(r"""pe AS (SELECT event_id AS id, user_id AS "contractId", ts, CASE WHEN event_type = 'view' THEN 2 ELSE 1 END AS type,
  CAST(floor(CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) / 90) + 1 AS INTEGER) AS size, value AS price FROM events),
ch AS (SELECT *, size - lag(size) OVER (PARTITION BY "contractId" ORDER BY ts, id) AS change, CASE WHEN type = 1 THEN price - 60.0 ELSE 60.0 - price END * size AS pnl FROM pe),
rs AS (SELECT *, CASE WHEN change <> 0 THEN 'size_change' WHEN pnl <= -59.0 THEN 'max_loss' WHEN pnl >= 150.0 THEN 'max_gain' END AS reason FROM ch)""") + f"""
SELECT "contractId", id, reason, size, coalesce(change, 0) AS size_change, {r6('pnl')} AS pnl FROM rs WHERE reason IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY "contractId" ORDER BY ts, id) = 1""")


def _hooked(s, d):
    """Finished bars handed to a hook that appends them to a table."""
    base = sinks.scratch_dir(s, "hook")
    bars = W.stream_bars(tick_stream(s, d), "1hr", by="contract", delay="10 minutes")
    sinks.on_event(bars, lambda rows, n: rows.write.mode("overwrite").parquet(f"{base}/rows/batch={n}"), f"{base}/checkpoint").awaitTermination()
    return s.read.schema(bars.schema).parquet(f"{base}/rows/batch=*")


add("stream_new_bar_hook", _hooked, ORACLES["stream_bars"])

_POSITION = dict(key="contractId", order=["creationTimestamp", "id"])
add("stream_latest_positions", lambda s, d: S.drain_changes(S.newest(_position_stream(s, d), **_POSITION), "positions", **_POSITION).select("contractId", "id", "type", "size", "price"),
    r"""SELECT user_id AS "contractId", event_id AS id, CASE WHEN event_type = 'view' THEN 2 ELSE 1 END AS type, CAST(floor(CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) / 90) + 1 AS INTEGER) AS size,
  round(value + 3e-9, 6) AS price FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
_TTL = 36 * 3600


def _live(s, d):
    """Contracts that still have an update within the time to live at the end of the stream."""
    changes = S.tracked(_position_stream(s, d).select("contractId", "creationTimestamp", "id"), ttl_seconds=_TTL, delay="10 minutes", **_POSITION)
    newest = S.drain_changes(changes, "tracked", key="contractId", order=["creationTimestamp", "expired"])
    return newest.filter("not expired").select("contractId", "id")


add("stream_expiry", _live, f"""SELECT user_id AS "contractId", event_id AS id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
  AND epoch_ms(ts) + {_TTL * 1000} >= (SELECT epoch_ms(max(ts) - INTERVAL 10 MINUTE) FROM events)""")


def _live_bars(s, d):
    """Bars as they stand at the end of the stream, the open one included."""
    key = ["contract", "ts"]
    bars = W.stream_bars(tick_stream(s, d), "1hr", by="contract", delay="10 minutes")
    return S.drain_changes(bars, "live-bars", key=key, order=["volume"])


add("stream_live_bars", _live_bars, with_sql(HOUR_BARS_SQL) + "SELECT contract, ts, open, high, low, close, volume FROM bars")


def _late(s, d):
    """Ticks that arrive in the order of their ids, far from the order of their times: most come too late for their bar."""
    t = tick_stream(s, d).withColumn("ts", F.col("ts") - F.when(F.col("seq") % 50 == 0, F.expr("INTERVAL 40 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS")))
    return fold.run_to_end(t, fold.late_step("1hr", delay_seconds=600), "late")[0].select("contract", "seq")


add("stream_late_ticks", _late, with_sql(TICKS_SQL, f"""p AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM ticks),
a AS (SELECT contract, seq, seq % 50 = 0 AS old, ts, least(floor((epoch_us(ts) - lo) / ((hi - lo) / {PARTS} + 1)), {PARTS - 1}) AS part FROM ticks, p)""") + """
SELECT contract, seq FROM a WHERE old AND part > 0""")
