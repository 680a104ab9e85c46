"""Queries and oracles of the order book and of hidden-order detection, over depth updates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapestry.functions.joins import asof_join, price_range_join
from tapestry.operators import book as B, flow as W, icebergs as X
from tapestry.session import settle

from .tables import cut, DEPTH_SQL, depth, r6, tidy, with_sql

QUERIES, ORACLES = {}, {}
ASOF, MINUTES = "2024-01-31 00:00:00", 30 * 24 * 60  # covers every row
SINCE = "TIMESTAMP '2024-01-01 00:00:00'"


def add(name, query, sql, digits=6):
    QUERIES[name] = lambda spark, sf: tidy(query(spark, sf), digits)
    if sql is not None:
        ORACLES[name] = sql


def routed(spark, sf):
    """Routed updates, written out once because most reports read them several times."""
    return settle(B.route_depth(depth(spark, sf)), "routed")


def book(spark, sf, updates=None):
    return settle(B.book_asof(routed(spark, sf) if updates is None else updates), "book")


def book_and_trades(spark, sf):
    updates = routed(spark, sf)
    return book(spark, sf, updates), B.routed_trades(updates)


def trades(spark, sf):
    """Executions with the side implied by the quotes at their time."""
    return B.routed_trades(routed(spark, sf))


BBO_SQL = """n AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY contract ORDER BY ts, seq) - 1 AS rn FROM depth),
lv AS (SELECT contract, type, price, volume, rn AS a, lead(rn) OVER (PARTITION BY contract, type, price ORDER BY rn) AS z
  FROM n WHERE type IN (1, 2)),
q AS (SELECT n.contract, n.rn, max(CASE WHEN lv.type = 2 THEN lv.price END) AS best_bid,
    min(CASE WHEN lv.type = 1 THEN lv.price END) AS best_ask
  FROM n LEFT JOIN lv ON lv.contract = n.contract AND lv.volume > 0 AND lv.a <= n.rn AND (lv.z IS NULL OR n.rn < lv.z)
  GROUP BY n.contract, n.rn),
b AS MATERIALIZED (SELECT n.contract, n.ts, n.seq, n.price, n.volume, n.type, q.best_bid, q.best_ask,
    CASE WHEN best_bid <> 0 AND best_ask <> 0 THEN best_ask - best_bid END AS spread,
    CASE WHEN best_bid <> 0 AND best_ask <> 0 THEN (best_ask + best_bid) / 2 END AS mid
  FROM n JOIN q ON n.contract = q.contract AND n.rn = q.rn)"""
ROUTED_SQL = """routed AS MATERIALIZED (
  SELECT contract, ts, seq, price, volume, 'bid' AS side, 'bid' AS type FROM b WHERE type = 2
  UNION ALL SELECT contract, ts, seq, price, volume, 'ask', 'ask' FROM b WHERE type = 1
  UNION ALL SELECT contract, ts, seq, price, volume, 'trade', 'trade' FROM b WHERE type = 5 AND volume > 0
  UNION ALL SELECT contract, ts, seq, price, volume, 'bid', 'bid_mod_' || type FROM b
    WHERE type IN (9, 10) AND (mid IS NULL OR mid = 0 OR price = 0 OR price <= mid)
  UNION ALL SELECT contract, ts, seq, price, volume, 'ask', 'ask_mod_' || type FROM b
    WHERE type IN (9, 10) AND (mid IS NULL OR mid = 0 OR price = 0 OR price > mid))"""
BOOK_SQL = """last_state AS (SELECT * FROM routed WHERE side IN ('bid', 'ask')
  QUALIFY row_number() OVER (PARTITION BY contract, side, price ORDER BY ts DESC, seq DESC) = 1),
book AS MATERIALIZED (SELECT contract, side, price, volume, ts, type,
    row_number() OVER (PARTITION BY contract, side ORDER BY CASE side WHEN 'bid' THEN -price ELSE price END) AS lvl
  FROM last_state WHERE volume > 0)"""
BEST_SQL = """best0 AS (SELECT contract, max(CASE WHEN side = 'bid' THEN price END) AS best_bid,
    min(CASE WHEN side = 'ask' THEN price END) AS best_ask FROM book GROUP BY contract),
best AS MATERIALIZED (SELECT *, CASE WHEN best_bid <> 0 AND best_ask <> 0 THEN best_ask - best_bid END AS spread,
    CASE WHEN best_bid <> 0 AND best_ask <> 0 THEN (best_ask + best_bid) / 2 END AS mid FROM best0)"""
TRADES_SQL = """trades AS MATERIALIZED (SELECT contract, ts, seq, price, volume, best_bid, best_ask,
    CASE WHEN price >= best_ask THEN 'buy' WHEN price <= best_bid THEN 'sell' ELSE 'unknown' END AS side
  FROM b WHERE type = 5 AND volume > 0)"""
_ROUTED = with_sql(DEPTH_SQL, BBO_SQL, ROUTED_SQL)
_BOOK = with_sql(DEPTH_SQL, BBO_SQL, ROUTED_SQL, BOOK_SQL, BEST_SQL)
_ALL = with_sql(DEPTH_SQL, BBO_SQL, ROUTED_SQL, BOOK_SQL, BEST_SQL, TRADES_SQL)

add("bbo_history", lambda s, d: B.bbo_history(depth(s, d)).select("contract", "seq", "best_bid", "best_ask", "spread", "mid"),
    with_sql(DEPTH_SQL, BBO_SQL) + "SELECT contract, seq, best_bid, best_ask, spread, mid FROM b")
add("route_depth", lambda s, d: B.route_depth(depth(s, d)).select("contract", "ts", "seq", "price", "volume", "side", "type"),
    _ROUTED + "SELECT contract, ts, seq, price, volume, side, type FROM routed")
# The walk through each contract, with the live prices of both sides as lists.
_MID = "(list_max(p.bids) + list_min(p.asks)) / 2"
_SIDE = f"""CASE WHEN x.type = 2 THEN 'bid' WHEN x.type = 1 THEN 'ask' WHEN x.type IN (9, 10) THEN
  CASE WHEN list_max(p.bids) IS NULL OR list_min(p.asks) IS NULL OR list_max(p.bids) = 0 OR list_min(p.asks) = 0 OR {_MID} = 0 OR x.price = 0 THEN 'both'
       WHEN x.price <= {_MID} THEN 'bid' ELSE 'ask' END ELSE 'none' END"""


def _live(side):
    rest = f"list_filter(p.{side}s, lambda y: y <> x.price)"
    return f"CASE WHEN {_SIDE} IN ('{side}', 'both') THEN CASE WHEN x.volume > 0 THEN list_append({rest}, x.price) ELSE {rest} END ELSE p.{side}s END"


_WALK = with_sql(DEPTH_SQL, "x AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY contract ORDER BY ts, seq) AS rn FROM depth)", f"""w AS (
  SELECT contract, CAST(0 AS BIGINT) AS rn, CAST([] AS DOUBLE[]) AS bids, CAST([] AS DOUBLE[]) AS asks, 'none' AS placed FROM x WHERE rn = 1
  UNION ALL SELECT x.contract, x.rn, {_live('bid')}, {_live('ask')}, {_SIDE} FROM w p JOIN x ON x.contract = p.contract AND x.rn = p.rn + 1),
wx AS (SELECT x.*, w.placed, list_max(w.bids) AS bid, list_min(w.asks) AS ask FROM w JOIN x ON x.contract = w.contract AND x.rn = w.rn)""") + """
SELECT contract, ts, seq, price, volume, side, CASE WHEN type IN (9, 10) THEN side || '_mod_' || type ELSE side END AS type, best_bid, best_ask FROM (
  SELECT contract, ts, seq, price, volume, type, 'bid' AS side, CAST(NULL AS DOUBLE) AS best_bid, CAST(NULL AS DOUBLE) AS best_ask FROM wx WHERE placed IN ('bid', 'both')
  UNION ALL SELECT contract, ts, seq, price, volume, type, 'ask', NULL, NULL FROM wx WHERE placed IN ('ask', 'both')
  UNION ALL SELECT contract, ts, seq, price, volume, type, 'trade', bid, ask FROM wx WHERE type = 5 AND volume > 0)"""
add("route_depth_exact", lambda s, d: B.route_depth_exact(depth(s, d)), _WALK)
# Messages of six hours: changes are placed by the mid before theirs, trades meet the book after it.
_MESSAGE = 6 * 3600 * 1_000_000


def _batch_walk():
    """The same walk, carrying the best prices from before the current message."""
    x = f"x AS MATERIALIZED (SELECT *, epoch_us(ts) // {_MESSAGE} AS message, row_number() OVER (PARTITION BY contract ORDER BY ts, seq) AS rn FROM depth)"
    fresh = "x.message <> p.message"
    bid, ask = f"CASE WHEN {fresh} THEN list_max(p.bids) ELSE p.mb END", f"CASE WHEN {fresh} THEN list_min(p.asks) ELSE p.ma END"
    side = f"""CASE WHEN x.type = 2 THEN 'bid' WHEN x.type = 1 THEN 'ask' WHEN x.type IN (9, 10) THEN
  CASE WHEN {bid} IS NULL OR {ask} IS NULL OR {bid} = 0 OR {ask} = 0 OR ({bid} + {ask}) / 2 = 0 OR x.price = 0 THEN 'both' WHEN x.price <= ({bid} + {ask}) / 2 THEN 'bid' ELSE 'ask' END ELSE 'none' END"""

    def live(name):
        rest = f"list_filter(p.{name}s, lambda y: y <> x.price)"
        return f"CASE WHEN {side} IN ('{name}', 'both') THEN CASE WHEN x.volume > 0 THEN list_append({rest}, x.price) ELSE {rest} END ELSE p.{name}s END"

    return with_sql(DEPTH_SQL, x, f"""w AS (
  SELECT contract, CAST(0 AS BIGINT) AS rn, CAST(-1 AS BIGINT) AS message, CAST([] AS DOUBLE[]) AS bids, CAST([] AS DOUBLE[]) AS asks, CAST(NULL AS DOUBLE) AS mb, CAST(NULL AS DOUBLE) AS ma, 'none' AS placed FROM x WHERE rn = 1
  UNION ALL SELECT x.contract, x.rn, x.message, {live('bid')}, {live('ask')}, {bid}, {ask}, {side} FROM w p JOIN x ON x.contract = p.contract AND x.rn = p.rn + 1),
wx AS (SELECT x.*, w.placed, last_value(list_max(w.bids)) OVER m AS bid, last_value(list_min(w.asks)) OVER m AS ask FROM w JOIN x ON x.contract = w.contract AND x.rn = w.rn
  WINDOW m AS (PARTITION BY x.contract, x.message ORDER BY x.rn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))""") + _WALK[_WALK.rindex("\nSELECT contract, ts, seq, price, volume, side, CASE"):]


def _messages(s, d):
    return depth(s, d).withColumn("message", F.floor(F.unix_micros("ts") / _MESSAGE))


add("route_depth_batches", lambda s, d: B.route_depth_exact(_messages(s, d), batch="message"), _batch_walk())
add("depth_type_counts", lambda s, d: B.depth_type_counts(depth(s, d)), with_sql(DEPTH_SQL) + """
SELECT contract, count(*) FILTER (type = 1) AS type_1_count, count(*) FILTER (type = 2) AS type_2_count,
  count(*) FILTER (type = 5) AS type_5_count, count(*) FILTER (type = 9) AS type_9_count,
  count(*) FILTER (type = 10) AS type_10_count, count(*) FILTER (type IS NULL OR type NOT IN (1, 2, 5, 9, 10)) AS other_types
FROM depth GROUP BY contract""")
add("book_asof", lambda s, d: B.book_asof(B.route_depth(depth(s, d))), _BOOK + "SELECT contract, side, price, volume, ts, type FROM book")

_T0, _T1, _STEP = "2024-01-02 00:00:00", "2024-01-30 00:00:00", 86400
add("book_at_grid", lambda s, d: B.book_at_grid(routed(s, d), _T0, _T1, _STEP), _ROUTED + f""",
iv AS (SELECT *, lead(ts) OVER (PARTITION BY contract, side, price ORDER BY ts, seq) AS till FROM routed WHERE side IN ('bid', 'ask')),
grid AS (SELECT unnest(generate_series(TIMESTAMP '{_T0}', TIMESTAMP '{_T1}', INTERVAL {_STEP} SECOND)) AS as_of),
live AS (SELECT iv.contract, grid.as_of, iv.side, iv.price, iv.volume,
    row_number() OVER (PARTITION BY iv.contract, grid.as_of, iv.side ORDER BY CASE side WHEN 'bid' THEN -price ELSE price END) AS level
  FROM iv JOIN grid ON iv.ts <= grid.as_of AND (iv.till IS NULL OR grid.as_of < iv.till) WHERE iv.volume > 0)
SELECT contract, as_of, side, price, volume, level FROM live""")
add("bbo", lambda s, d: B.bbo(book(s, d)), _BOOK + "SELECT contract, best_bid, best_ask, spread, mid FROM best")
_SNAP = """(SELECT contract, max(CASE WHEN side = 'bid' THEN price END) AS best_bid, min(CASE WHEN side = 'ask' THEN price END) AS best_ask,
  CAST(coalesce(sum(volume) FILTER (side = 'bid'), 0) AS BIGINT) AS total_bid_volume,
  CAST(coalesce(sum(volume) FILTER (side = 'ask'), 0) AS BIGINT) AS total_ask_volume,
  count(*) FILTER (side = 'bid') AS bid_levels, count(*) FILTER (side = 'ask') AS ask_levels FROM book WHERE lvl <= 10 GROUP BY contract)"""
add("book_snapshot", lambda s, d: B.book_snapshot(book(s, d)), _BOOK + f"""
SELECT s.*, CASE WHEN best_bid <> 0 AND best_ask <> 0 THEN best_ask - best_bid END AS spread,
  CASE WHEN best_bid <> 0 AND best_ask <> 0 THEN (best_ask + best_bid) / 2 END AS mid FROM {_SNAP} s""")

_BATCH = ["contract", "batch"]


def batches(s, d):
    return depth(s, d).withColumn("batch", F.date_trunc("hour", "ts"))


_BATCH_SQL = with_sql(DEPTH_SQL, "bt AS (SELECT *, date_trunc('hour', ts) AS batch FROM depth)")
add("batch_levels", lambda s, d: B.batch_levels(batches(s, d), batch=_BATCH), _BATCH_SQL + """
SELECT contract, batch, CASE type WHEN 2 THEN 'bid' ELSE 'ask' END AS side, price, volume, row_number() OVER (
  PARTITION BY contract, batch, type ORDER BY CASE type WHEN 2 THEN -price ELSE price END, ts, seq) AS level
FROM bt WHERE type IN (1, 2) AND volume > 0""")
add("batch_quotes", lambda s, d: B.batch_quotes(batches(s, d), batch=_BATCH), _BATCH_SQL + """
SELECT *, CASE WHEN best_bid <> 0 AND best_ask <> 0 THEN best_ask - best_bid ELSE 0.0 END AS spread FROM (
  SELECT contract, batch, coalesce(max(price) FILTER (type = 2 AND volume > 0), 0.0) AS best_bid,
    coalesce(min(price) FILTER (type = 1 AND volume > 0), 0.0) AS best_ask,
    count(*) FILTER (type = 2 AND volume > 0) AS bids, count(*) FILTER (type = 1 AND volume > 0) AS asks
  FROM bt GROUP BY contract, batch)""")
add("depth_within", lambda s, d: B.depth_within(book(s, d), 10.0), _BOOK + """
SELECT contract, mid AS mid_price,
  CAST(coalesce(sum(volume) FILTER (side = 'bid' AND price >= mid - 10 AND price <= mid), 0) AS BIGINT) AS bid_volume,
  CAST(coalesce(sum(volume) FILTER (side = 'ask' AND price <= mid + 10 AND price >= mid), 0) AS BIGINT) AS ask_volume,
  count(*) FILTER (side = 'bid' AND price >= mid - 10 AND price <= mid) AS bid_levels,
  count(*) FILTER (side = 'ask' AND price <= mid + 10 AND price >= mid) AS ask_levels
FROM book JOIN best USING (contract) GROUP BY contract, mid""")


def _liq(name, min_volume, levels):
    return f"""{name} AS (SELECT contract, side, price, volume, ts, volume / avg(volume) OVER (PARTITION BY contract, side) AS liquidity_score
  FROM book WHERE lvl <= {levels} AND volume >= {min_volume})"""


add("liquidity_levels", lambda s, d: B.liquidity_levels(book(s, d), 50, 20).select("contract", "side", "price", "volume", "liquidity_score"),
    _BOOK + ", " + _liq("liq", 50, 20) + f"SELECT contract, side, price, volume, {r6('liquidity_score')} AS liquidity_score FROM liq")
_CLUSTERS_SQL = """rc AS (
  SELECT contract, side, lvl, price, volume, price AS anchor, 1 AS cid FROM book WHERE lvl = 1
  UNION ALL SELECT k.contract, k.side, k.lvl, k.price, k.volume,
    CASE WHEN abs(k.price - rc.anchor) <= 1.0 THEN rc.anchor ELSE k.price END,
    CASE WHEN abs(k.price - rc.anchor) <= 1.0 THEN rc.cid ELSE rc.cid + 1 END
  FROM rc JOIN book k ON k.contract = rc.contract AND k.side = rc.side AND k.lvl = rc.lvl + 1),
clusters AS (SELECT contract, side, cid, avg(price) AS center_price, min(price) AS low_price, max(price) AS high_price,
    CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS order_count, sum(price * volume) / sum(volume) AS volume_weighted_price
  FROM rc GROUP BY contract, side, cid HAVING count(*) >= 3)"""
add("order_clusters", lambda s, d: B.order_clusters(book(s, d), 1.0, 3), _BOOK + "," + _CLUSTERS_SQL + f"""
SELECT contract, side, {r6('center_price')} AS center_price, low_price, high_price, total_volume, order_count,
  {r6('volume_weighted_price')} AS volume_weighted_price FROM clusters""")
add("strongest_clusters", lambda s, d: B.strongest_clusters(B.order_clusters(book(s, d), 1.0, 3)), _BOOK + "," + _CLUSTERS_SQL + f"""
SELECT contract, side, count(*) AS clusters, {r6('first(center_price ORDER BY total_volume DESC, center_price)')} AS center_price,
  max(total_volume) AS total_volume FROM clusters GROUP BY contract, side""")
add("book_stats", lambda s, d: B.book_stats(routed(s, d)), _BOOK + """
, c AS (SELECT contract, count(*) AS updates, count(*) FILTER (side = 'trade') AS trades, max(ts) AS last_update FROM routed GROUP BY contract),
l AS (SELECT contract, count(*) FILTER (side = 'bid') AS bid_levels, count(*) FILTER (side = 'ask') AS ask_levels FROM book GROUP BY contract)
SELECT c.*, coalesce(bid_levels, 0) AS bid_levels, coalesce(ask_levels, 0) AS ask_levels, best_bid, best_ask, spread, mid
FROM c LEFT JOIN l USING (contract) LEFT JOIN best USING (contract)""")
_FLOW_SQL = """tf AS (SELECT contract, CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS trade_count,
    CAST(coalesce(sum(volume) FILTER (side = 'buy'), 0) AS BIGINT) AS buy_volume,
    CAST(coalesce(sum(volume) FILTER (side = 'sell'), 0) AS BIGINT) AS sell_volume,
    count(*) FILTER (side = 'buy') AS buy_trades, count(*) FILTER (side = 'sell') AS sell_trades,
    sum(price * volume) / sum(volume) AS vwap FROM trades GROUP BY contract)"""
_IMBALANCE_SQL = """t5 AS (SELECT contract, CAST(sum(volume) FILTER (side = 'bid') AS BIGINT) AS top_bid_volume,
    CAST(sum(volume) FILTER (side = 'ask') AS BIGINT) AS top_ask_volume FROM book WHERE lvl <= 5 GROUP BY contract),
im AS (SELECT t5.*, coalesce((top_bid_volume - top_ask_volume) / nullif(top_bid_volume + top_ask_volume, 0), 0.0) AS imbalance_ratio,
    coalesce((buy_volume - sell_volume) / nullif(total_volume, 0), 0.0) AS trade_imbalance FROM t5 LEFT JOIN tf USING (contract)),
imb AS (SELECT contract, imbalance_ratio, CASE WHEN imbalance_ratio > 0.3 THEN 'bullish' WHEN imbalance_ratio < -0.3 THEN 'bearish' ELSE 'neutral' END AS direction,
  CASE WHEN imbalance_ratio > 0.3 AND trade_imbalance > 0.2 THEN 'high' WHEN imbalance_ratio < -0.3 AND trade_imbalance < -0.2 THEN 'high'
    WHEN abs(imbalance_ratio) > 0.3 THEN 'medium' ELSE 'low' END AS confidence, top_bid_volume, top_ask_volume, trade_imbalance FROM im)"""
def _imbalance(s, d):
    levels, executed = book_and_trades(s, d)
    return B.market_imbalance(levels, W.trade_flow(executed, MINUTES, asof=ASOF))


add("market_imbalance", _imbalance,
    _ALL + "," + _FLOW_SQL + "," + _IMBALANCE_SQL + f"""
SELECT contract, {r6('imbalance_ratio')} AS imbalance_ratio, direction, confidence, top_bid_volume, top_ask_volume,
  {r6('trade_imbalance')} AS trade_imbalance FROM imb""")
_PROFILE_SQL = """vp AS (SELECT contract, CAST(floor(price / 5.0) AS BIGINT) AS bucket, CAST(sum(volume) AS BIGINT) AS total_volume,
    avg(price) AS avg_price, count(*) AS trade_count FROM trades GROUP BY 1, 2)"""
_SR_SQL = _PROFILE_SQL + "," + _liq("liq", 200, 15) + """,
cand AS (
  SELECT contract, mid AS current_price, CASE WHEN avg_price < mid THEN 'support' ELSE 'resistance' END AS kind, avg_price AS price,
    total_volume AS volume, total_volume / m AS strength, 'volume_cluster' AS type
  FROM vp JOIN (SELECT contract, avg(total_volume) AS m FROM vp GROUP BY contract) USING (contract) JOIN best USING (contract)
  WHERE total_volume > 1.5 * m AND mid IS NOT NULL
  UNION ALL
  SELECT contract, mid, CASE side WHEN 'bid' THEN 'support' ELSE 'resistance' END, price, volume, liquidity_score, 'orderbook_liquidity'
  FROM liq JOIN best USING (contract) WHERE mid IS NOT NULL AND ((side = 'bid' AND price < mid) OR (side = 'ask' AND price > mid))
    AND contract IN (SELECT contract FROM vp)),
sr AS (SELECT *, row_number() OVER (PARTITION BY contract, kind ORDER BY strength DESC, abs(price - current_price), price, type) AS rank
  FROM cand QUALIFY rank <= 10)"""
def _support(s, d):
    levels, executed = book_and_trades(s, d)
    return B.support_resistance(W.volume_profile(executed, 5.0), levels)


add("support_resistance", _support,
    _ALL + "," + _SR_SQL + f"""
SELECT contract, {r6('current_price')} AS current_price, kind, {r6('price')} AS price, volume, {r6('strength')} AS strength, type, rank FROM sr""")

# --- trades against quotes ------------------------------------------------------------------------------------


def _partial_quotes(s, d):
    q = depth(s, d).filter(F.col("type").isin(1, 2))
    price = F.col("price")
    return q.select("contract", "ts", "seq", F.when(F.col("type") == 2, price).alias("bid"), F.when(F.col("type") == 1, price).alias("ask"))


def _raw_trades(s, d):
    return depth(s, d).filter((F.col("type") == 5) & (F.col("volume") > 0)).select("contract", "ts", "seq", "price", "volume")


_PARTIAL_SQL = """pq AS (SELECT contract, ts, seq, CASE WHEN type = 2 THEN price END AS bid, CASE WHEN type = 1 THEN price END AS ask
  FROM depth WHERE type IN (1, 2)),
fq AS MATERIALIZED (SELECT contract, ts, seq, last(bid IGNORE NULLS) OVER w AS bid, last(ask IGNORE NULLS) OVER w AS ask
  FROM pq WINDOW w AS (PARTITION BY contract ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
rt AS (SELECT contract, ts, seq, price, volume FROM depth WHERE type = 5 AND volume > 0)"""
_ASOF_SQL = with_sql(DEPTH_SQL, _PARTIAL_SQL) + """SELECT rt.contract, rt.ts, rt.seq, rt.price, rt.volume, fq.bid, fq.ask
FROM rt ASOF LEFT JOIN fq ON rt.contract = fq.contract AND rt.ts >= fq.ts"""


def _asof(chunk):
    def query(s, d):
        return asof_join(_raw_trades(s, d), _partial_quotes(s, d), by="contract", values=["bid", "ask"], fill=True, chunk=chunk)

    return query


add("asof_join", _asof("auto"), _ASOF_SQL)
add("asof_join_split", _asof(cut(100)), _ASOF_SQL)
add("classify_trades",
    lambda s, d: W.classify_trades(_raw_trades(s, d), B.bbo_history(depth(s, d)).select("contract", "ts", "seq", "best_bid", "best_ask"))
    .select("contract", "ts", "seq", "price", "volume", "best_bid", "best_ask", "side"),
    _ALL + "SELECT contract, ts, seq, price, volume, best_bid, best_ask, side FROM trades")

# --- hidden orders ------------------------------------------------------------------------------------------------

add("iceberg_heuristic", lambda s, d: X.iceberg_heuristic(book(s, d), MINUTES, asof=ASOF, volume_threshold=40), _BOOK + f"""
SELECT contract, side, price, volume, ts, CASE WHEN score >= 0.8 - 1e-9 THEN 'high' WHEN score >= 0.6 THEN 'medium' ELSE 'low' END AS confidence,
  {r6('score')} AS confidence_score, CAST(floor(volume * (2 + score)) AS BIGINT) AS estimated_hidden_size FROM (
  SELECT *, CAST(0.3 AS DOUBLE) + CASE WHEN volume > 80 THEN CAST(0.4 AS DOUBLE) ELSE CAST(0.2 AS DOUBLE) END + CAST(0.3 AS DOUBLE) AS score
  FROM book WHERE ts >= {SINCE} AND volume > 40 AND CAST(round(price * 100) AS BIGINT) % 50 = 0)""")
_REFRESH_SQL = """rf AS (SELECT contract, side, price, avg(volume) AS avg_volume, stddev_samp(volume) AS volume_std, count(*) AS refresh_count,
    CAST(sum(volume) AS BIGINT) AS total_volume, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 / nullif(count(*) - 1, 0) AS avg_refresh_seconds
  FROM routed WHERE side IN ('bid', 'ask') AND volume > 0 GROUP BY contract, side, price
  HAVING count(*) >= 3 AND sum(volume) >= 100 AND stddev_samp(volume) / avg(volume) < 1 - 0.6)"""
def _refresh(s, d, updates=None):
    return X.iceberg_refresh(B.route_depth(depth(s, d)) if updates is None else updates, MINUTES, 3, 0.6, 100, asof=ASOF)


def _confirmed(s, d):
    updates = routed(s, d)
    return X.confirm_with_trades(_refresh(s, d, updates), B.routed_trades(updates), 0.26).select(
        "contract", "side", "price", "nearby_trades", "trade_volume", "avg_trade_size", "execution_consistency", "volume_to_trade_ratio",
        "trade_confirmed", "confidence_score")



add("iceberg_refresh", _refresh, _ROUTED + "," + _REFRESH_SQL + f"""
SELECT contract, side, price, {r6('avg_volume')} AS avg_volume, {r6('volume_std')} AS volume_std, refresh_count, total_volume,
  {r6('avg_refresh_seconds')} AS avg_refresh_seconds, 'medium' AS confidence, {r6('0.7')} AS confidence_score,
  {r6('avg_volume * 3')} AS estimated_hidden_size FROM rf""")
_CONFIRM = """cf AS (SELECT rf.contract, rf.side, rf.price, rf.avg_volume, count(t.price) AS n, sum(t.volume) AS v, avg(t.volume) AS m, stddev_samp(t.volume) AS sd
  FROM rf LEFT JOIN trades t ON t.contract = rf.contract AND t.price >= rf.price - 0.26 AND t.price <= rf.price + 0.26 GROUP BY 1, 2, 3, 4),
cg AS (SELECT *, CASE WHEN n > 1 THEN 1.0 - sd / m WHEN n = 1 THEN 1.0 END AS c FROM cf)"""
add("confirm_with_trades",
    _confirmed,
    _ALL + "," + _REFRESH_SQL + "," + _CONFIRM + f"""
SELECT contract, side, price, n AS nearby_trades, {r6('v')} AS trade_volume, {r6('m')} AS avg_trade_size, {r6('greatest(c, 0.0)')} AS execution_consistency,
  {r6('avg_volume / greatest(1.0, m)')} AS volume_to_trade_ratio, coalesce(c > 0.7 AND n >= 3, FALSE) AS trade_confirmed,
  {r6('CASE WHEN c > 0.7 AND n >= 3 THEN least(1.0, 0.7 * 1.1) ELSE 0.7 END')} AS confidence_score FROM cg""")
add("range_join",
    lambda s, d: price_range_join(
        _raw_trades(s, d).withColumnRenamed("volume", "trade_volume"),
        book(s, d).select("contract", "side", F.col("price").alias("level_price"), "volume"), by="contract", tol=0.5),
    _ALL + """SELECT k.contract, k.side, k.price AS level_price, k.volume, t.ts, t.seq, t.price, t.volume AS trade_volume
FROM book k JOIN trades t ON t.contract = k.contract AND t.price >= k.price - 0.5 AND t.price <= k.price + 0.5""")
add("round_price_score", lambda s, d: depth(s, d).groupBy("contract", "price").agg(F.count(F.lit(1)).alias("n")).select(
    "contract", "price", "n", X.round_price_score(F.col("price")).alias("score"), X.round_price_score(F.col("price"), fine=True).alias("fine_score")),
    with_sql(DEPTH_SQL, "p AS (SELECT contract, price, count(*) AS n, CAST(round(price * 100) AS BIGINT) AS c FROM depth GROUP BY contract, price)") + f"""
SELECT contract, price, n, {r6("CASE WHEN c % 100 = 0 THEN 1.0 WHEN c % 50 = 0 THEN 0.8 WHEN c % 25 = 0 THEN 0.6 WHEN c % 10 = 0 THEN 0.4 ELSE 0.0 END")} AS score,
  {r6("CASE WHEN c % 100 = 0 THEN 1.0 WHEN c % 50 = 0 THEN 0.8 WHEN c % 25 = 0 THEN 0.6 WHEN c % 10 = 0 THEN 0.4 WHEN c % 5 = 0 THEN 0.2 ELSE 0.1 END")} AS fine_score FROM p""")
_REPL = """v AS (SELECT *, lag(volume, 1) OVER w AS b, lag(volume, 2) OVER w AS a FROM routed WINDOW w AS (PARTITION BY contract, side, price ORDER BY ts, seq))
SELECT contract, side, price, count(*) AS updates, round(3e-9 + CAST(CASE WHEN count(*) < 4 THEN 0.0 ELSE
  least(1.0, count(*) FILTER (a > 0 AND b < a * 0.5 AND volume > a * 0.8) / greatest(1, count(*) - 2)) END AS DOUBLE), 6) + 0.0 AS replenishment_score
FROM v GROUP BY contract, side, price"""
add("replenishment_score", lambda s, d: X.replenishment_score(routed(s, d)), _ROUTED + "," + _REPL)
add("replenishment_score_split", lambda s, d: X.replenishment_score(routed(s, d), chunk=cut(3)), _ROUTED + "," + _REPL)
_SIG = """sg AS (SELECT contract, side, price, count(*) AS updates, avg(volume) AS avg_volume, stddev_samp(volume) AS sd, CAST(sum(volume) AS BIGINT) AS total
  FROM routed GROUP BY contract, side, price),
sh AS (SELECT *, CASE WHEN updates < 3 THEN 0.0 ELSE
  coalesce(greatest(0.0, least(1.0, 1.0 - CASE WHEN avg_volume > 0 THEN sd / avg_volume END)), 0.0) * least(1.0, updates / 10.0) END AS significance FROM sg)"""
add("level_significance", lambda s, d: X.level_significance(B.route_depth(depth(s, d))), _ROUTED + "," + _SIG + f"""
SELECT contract, side, price, updates, {r6('avg_volume')} AS avg_volume, {r6('significance')} AS significance FROM sh""")


def _hidden(s, d):
    r = routed(s, d)
    sig = X.level_significance(r)
    total = r.groupBy("contract", "side", "price").agg(F.sum("volume").alias("total"))
    return sig.join(total, ["contract", "side", "price"]).select(
        "contract", "side", "price", X.hidden_size(F.col("avg_volume"), F.round("significance", 6), F.col("updates"), F.col("total")).alias("hidden_size"))


add("hidden_size", _hidden, _ROUTED + "," + _SIG + """
SELECT contract, side, price, CAST(least(floor(avg_volume * ((3.0 + round(CAST(significance AS DOUBLE), 6) * 7.0)
  * CASE WHEN updates > 5 THEN 1.0 + updates / 20.0 ELSE 1.0 END)), total * 5) AS BIGINT) AS hidden_size FROM sh""")

_multi = lambda s, d: X.iceberg_multifactor(_ladder(s, d), _ladder_trades(s, d), MINUTES, asof=ASOF)


def _ladder(s, d):
    """Depth history on whole prices, scaled so that levels repeat with steady volume."""
    return depth(s, d).filter(F.col("type") != 5).select(
        "contract", "ts", "seq", F.floor(F.col("price") / 50).cast("double").alias("price"), (F.col("volume") * 2 + 900).alias("volume"))


def _ladder_trades(s, d):
    return depth(s, d).filter((F.col("type") == 5) & (F.col("volume") > 0)).select(
        "contract", "ts", F.floor(F.col("price") / 50).cast("double").alias("price"), (F.col("volume") + 300).alias("volume"))


_LADDER_SQL = """ld AS (SELECT contract, ts, seq, CAST(floor(price / 50) AS DOUBLE) AS price, volume * 2 + 900 AS volume FROM depth WHERE type <> 5),
lt AS (SELECT contract, ts, CAST(floor(price / 50) AS DOUBLE) AS price, volume + 300 AS volume FROM depth WHERE type = 5 AND volume > 0),
st AS (SELECT *, lag(volume) OVER (PARTITION BY contract, price ORDER BY ts, seq) AS prev FROM ld),
gp AS (SELECT contract, price, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY contract, price ORDER BY ts, seq) AS us FROM st WHERE prev > 0 AND volume > prev * 1.2),
rh AS (SELECT contract, price, count(us) AS refresh_count, avg(us / 1e6) AS gm, stddev_samp(us / 1e6) AS gs FROM gp GROUP BY 1, 2),
md AS (SELECT contract, price, count(*) AS updates, avg(volume) AS volume_mean, stddev_samp(volume) AS sd, CAST(sum(volume) AS BIGINT) AS total_observed FROM ld GROUP BY 1, 2 HAVING count(*) >= 5),
tr AS (SELECT contract, price, count(*) AS trades, avg(volume) AS tm, stddev_samp(volume) AS tsd FROM lt GROUP BY 1, 2),
f AS (SELECT md.contract, md.price, updates, volume_mean, total_observed, coalesce(refresh_count, 0) AS refresh_count, coalesce(gm, 0.0) AS avg_refresh_seconds,
  coalesce(trades, 0) AS trades, greatest(0.0, 1.0 - coalesce(sd, 0.0) / volume_mean) AS vc,
  CASE WHEN refresh_count >= 2 AND gm > 0 THEN 1.0 / (1.0 + gs / gm) ELSE 0.0 END AS rr, 1.0 AS ps, least(1.0, volume_mean / 1000.0) AS vs,
  least(1.0, updates / 20.0) AS sc, least(1.0, updates / 50.0) AS tp, CASE WHEN trades >= 3 THEN greatest(0.0, 1.0 - tsd / tm) ELSE 0.0 END AS ec
  FROM md LEFT JOIN rh USING (contract, price) LEFT JOIN tr USING (contract, price)),
g AS (SELECT *, CAST(0.30 * vc + 0.25 * rr + 0.20 * ec + 0.10 * vs + 0.08 * ps + 0.04 * sc + 0.03 * tp AS DOUBLE) AS score FROM f),
h AS (SELECT *, least(floor(volume_mean * ((5.0 + score * 10.0) * CASE WHEN rr > 0.8 THEN 1.5 ELSE 1.0 END * CASE WHEN vc > 0.9 THEN 1.3 ELSE 1.0 END
    * (1.0 + ps * 0.5))), total_observed * 3) AS hidden,
  CASE WHEN trades >= 2 THEN 0.3 ELSE 0.0 END + CASE WHEN updates >= 10 THEN 0.3 ELSE 0.0 END + CASE WHEN refresh_count >= 3 THEN 0.4 ELSE 0.0 END AS checks
  FROM g WHERE score >= 0.7),
mf AS (SELECT * FROM h WHERE checks >= 0.6 - 1e-9)"""
add("iceberg_multifactor", lambda s, d: _multi(s, d).select(
    "contract", "price", "confidence", "confidence_score", "volume_consistency", "refresh_regularity", "execution_correlation", "refresh_count",
    "avg_refresh_seconds", F.col("estimated_hidden_size").cast("long").alias("estimated_hidden_size"), "validation_score", "statistical_significance",
    F.col("visible_volume").cast("long").alias("visible_volume"), F.col("total_estimated_size").cast("long").alias("total_estimated_size")),
    with_sql(DEPTH_SQL, _LADDER_SQL) + f"""SELECT contract, price, CASE WHEN score >= 0.9 THEN 'very_high' ELSE 'high' END AS confidence,
  {r6('score')} AS confidence_score, {r6('vc')} AS volume_consistency, {r6('rr')} AS refresh_regularity, {r6('ec')} AS execution_correlation, refresh_count,
  {r6('avg_refresh_seconds')} AS avg_refresh_seconds, CAST(hidden AS BIGINT) AS estimated_hidden_size, {r6('checks')} AS validation_score,
  {r6('least(1.0, updates / 30.0) * 0.6 + vc * 0.4')} AS statistical_significance, CAST(floor(volume_mean) AS BIGINT) AS visible_volume,
  CAST(floor(volume_mean + hidden) AS BIGINT) AS total_estimated_size FROM mf""")
add("multifactor_summary", lambda s, d: X.multifactor_summary(_multi(s, d)).withColumn("total_hidden", F.col("total_hidden").cast("long")),
    with_sql(DEPTH_SQL, _LADDER_SQL) + f"""SELECT contract, count(*) AS total_detected, {r6('avg(score)')} AS avg_confidence, count(*) FILTER (score >= 0.8) AS high_confidence_count,
  CAST(sum(hidden) AS BIGINT) AS total_hidden, {r6('avg(hidden / floor(volume_mean))')} AS avg_size_ratio FROM mf GROUP BY contract""")
add("iceberg_summary", lambda s, d: X.detection_summary(_refresh(s, d)), _ROUTED + "," + _REFRESH_SQL + f"""
SELECT contract, count(*) AS total_detected, count(*) FILTER (side = 'bid') AS bid_icebergs, count(*) FILTER (side = 'ask') AS ask_icebergs,
  CAST(0 AS BIGINT) AS very_high_confidence, CAST(0 AS BIGINT) AS high_confidence, count(*) AS medium_confidence, CAST(0 AS BIGINT) AS low_confidence,
  {r6('sum(avg_volume * 3)')} AS total_hidden, {r6('0.7')} AS avg_confidence FROM rf GROUP BY contract""")
