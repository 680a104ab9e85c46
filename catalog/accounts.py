"""Queries and oracles of positions, risk, orders, prices, symbols and sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapestry.functions.joins import dimension_join, upsert
from tapestry.operators.bars import bars
from tapestry.operators import orders as O, positions as P, sessions as C

from .stats import _EXEC, executions
from .tables import cut, LOTS_SQL, TICKS_SQL, TRADE_ORDER, lots, r6, table, ticks, tidy, with_sql

QUERIES, ORACLES = {}, {}


def add(name, query, sql, digits=6):
    QUERIES[name] = lambda spark, sf: tidy(query(spark, sf), digits)
    if sql is not None:
        ORACLES[name] = sql


KEY = ["accountId", "contractId"]
POS_ORDER = ["creationTimestamp", "id"]


def position_events(s, d):
    """Position updates per supplier account over fifty contracts; returned lines close the position."""
    return lots(s, d).select(
        F.col("contract").alias("accountId"), (F.col("l_partkey") % 50).alias("contractId"), F.col("ts").alias("creationTimestamp"), F.col("seq").alias("id"), "l_extendedprice",
         F.when(F.col("l_linestatus") == "O", 1).otherwise(2).alias("type"),
        F.when(F.col("l_returnflag") == "R", 0).otherwise(F.col("volume")).cast("int").alias("size"), F.col("price").alias("averagePrice"))


EVENTS_SQL = LOTS_SQL + f""",
pe AS MATERIALIZED (SELECT contract AS "accountId", l_partkey % 50 AS "contractId", ts AS "creationTimestamp", seq AS id, l_extendedprice,
  CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS type, CAST(CASE WHEN l_returnflag = 'R' THEN 0 ELSE volume END AS INTEGER) AS size, price AS "averagePrice" FROM lots)"""
_DESC = ", ".join(f'"{c}" DESC' if c == "creationTimestamp" else f"{c} DESC" for c in POS_ORDER)
_ASC = _DESC.replace(" DESC", "")
_PK = 'PARTITION BY "accountId", "contractId" ORDER BY '
POS_SQL = EVENTS_SQL + f""",
pos AS MATERIALIZED (SELECT * FROM (SELECT * FROM pe QUALIFY row_number() OVER ({_PK}{_DESC}) = 1) WHERE size <> 0)"""


def positions(s, d):
    return P.latest_positions(position_events(s, d), order=POS_ORDER)


def prices(s, d):
    """Mean prices; every seventh contract is not quoted."""
    p = table(s, d, "part").groupBy((F.col("p_partkey") % 50).alias("contractId")).agg(F.avg("p_retailprice").alias("price"))
    return p.withColumn("price", F.when(F.col("contractId") % 7 != 0, F.col("price")))


def instruments(s, d):
    p = F.col("p_partkey") % 50
    return table(s, d, "part").groupBy(p.alias("id")).agg(F.max("p_size").alias("m")).select(
        "id", F.element_at(F.array(*[F.lit(x) for x in (0.25, 0.1, 0.05, 0.0)]), (F.col("m") % 4 + 1).cast("int")).alias("tickSize"), (F.col("m") / 10.0).alias("tickValue"))


PRICES_SQL = """px AS (SELECT p_partkey % 50 AS "contractId", CASE WHEN any_value(p_partkey) % 50 % 7 <> 0 THEN avg(p_retailprice) END AS price FROM part GROUP BY 1),
ins AS (SELECT p_partkey % 50 AS id, CASE max(p_size) % 4 WHEN 0 THEN 0.25::DOUBLE WHEN 1 THEN 0.1::DOUBLE WHEN 2 THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END AS "tickSize",
  max(p_size) / 10.0::DOUBLE AS "tickValue" FROM part GROUP BY 1)"""
PNL_SQL = """pnl AS MATERIALIZED (SELECT pos."accountId", pos."contractId", pos.type, pos.size, pos."averagePrice", px.price AS current_price,
  CASE WHEN type = 1 THEN price - "averagePrice" ELSE "averagePrice" - price END AS pnl_per_contract,
  CASE WHEN type = 1 THEN price - "averagePrice" ELSE "averagePrice" - price END * size * coalesce(CASE WHEN "tickSize" <> 0 THEN "tickValue" / "tickSize" END, 1.0) AS unrealized_pnl,
  price * size AS market_value, CASE WHEN type = 1 THEN 'LONG' ELSE 'SHORT' END AS direction
  FROM pos LEFT JOIN px USING ("contractId") LEFT JOIN ins ON ins.id = pos."contractId")"""
pnl = lambda s, d: P.position_pnl(positions(s, d), prices(s, d), instruments=instruments(s, d))
_PNL = with_sql(POS_SQL, PRICES_SQL, PNL_SQL)

add("latest_positions", lambda s, d: positions(s, d).select(*KEY, "creationTimestamp", "id", "type", "size", "averagePrice"),
    with_sql(POS_SQL) + f'''SELECT "accountId", "contractId", "creationTimestamp", id, type, size, {r6('"averagePrice"')} AS "averagePrice" FROM pos''')
_HIST = with_sql(EVENTS_SQL) + f"""SELECT "accountId", "contractId", "creationTimestamp", id, l_extendedprice, size, size_change FROM (
  SELECT *, coalesce(size - lag(size) OVER ({_PK}{_ASC}), 0) AS size_change FROM pe) QUALIFY row_number() OVER ({_PK}{_DESC}) <= 8"""
_hist = lambda chunk: lambda s, d: P.position_history(position_events(s, d), 8, order=POS_ORDER, chunk=chunk).select(
    *KEY, "creationTimestamp", "id", "l_extendedprice", "size", "size_change")
add("position_history", _hist("auto"), _HIST)
add("position_history_split", _hist(cut(5)), _HIST)
add("position_pnl", lambda s, d: pnl(s, d).select(*KEY, "current_price", "pnl_per_contract", "unrealized_pnl", "market_value", "direction"), _PNL + f"""
SELECT "accountId", "contractId", {r6('current_price', 4)} AS current_price, {r6('pnl_per_contract', 4)} AS pnl_per_contract, {r6('unrealized_pnl', 4)} AS unrealized_pnl,
  {r6('market_value', 4)} AS market_value, direction FROM pnl""", 4)
add("portfolio_pnl", lambda s, d: P.portfolio_pnl(pnl(s, d)), _PNL + f"""
SELECT "accountId", {r6('coalesce(sum(unrealized_pnl), 0.0)', 3)} AS total_pnl, count(*) AS positions_count, count(unrealized_pnl) AS positions_with_prices,
  count(*) - count(unrealized_pnl) AS positions_without_prices FROM pnl GROUP BY 1""", 3)


def accounts(s, d):
    return table(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), "c_mktsegment", "c_nationkey")


_ACC = 'acc AS (SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment, c_nationkey FROM customer)'
add("exposure_risk", lambda s, d: P.exposure_risk(positions(s, d), accounts=accounts(s, d).select(F.col("id").alias("accountId"))).withColumn("risk_warnings", F.array_join("risk_warnings", "; ")),
    with_sql(POS_SQL, _ACC, """ev AS (SELECT "accountId", sum(abs(size * "averagePrice")) AS e, max(abs(size * "averagePrice")) AS m, count(*) AS n FROM pos GROUP BY 1),
ea AS (SELECT acc.id AS "accountId", coalesce(e, 0.0) AS e, coalesce(n, 0) AS n, CASE WHEN e > 0 THEN m / e ELSE 0.0 END AS top FROM acc LEFT JOIN ev ON ev."accountId" = acc.id)""") + f"""
SELECT "accountId", {r6('e', 3)} AS total_exposure, n AS position_count, {r6('top', 3)} AS largest_position_risk,
  {r6('CASE WHEN n = 0 THEN 1.0 WHEN top < 1.0 THEN 1.0 - top ELSE 0.0 END', 3)} AS diversification_score,
  concat_ws('; ', CASE WHEN top > 0.01 THEN 'largest position exceeds its limit' END, CASE WHEN n = 1 THEN 'single position' END) AS risk_warnings FROM ea""", 3)
add("account_rollup", lambda s, d: P.account_rollup(accounts(s, d), positions(s, d), group="c_mktsegment"),
    with_sql(POS_SQL, _ACC, 'pc AS (SELECT "accountId", count(*) AS n FROM pos GROUP BY 1)') + f"""
SELECT c_mktsegment, count(*) AS accounts, {r6('sum(balance)', 4)} AS total_balance, CAST(coalesce(sum(n), 0) AS BIGINT) AS total_positions
FROM acc LEFT JOIN pc ON pc."accountId" = acc.id GROUP BY 1""", 4)


def _rules(s, d):
    return table(s, d, "supplier").select(
        F.col("s_suppkey").alias("accountId"), F.lit(30000.0).alias("max_loss"), F.lit(60000.0).alias("max_gain"), F.when(F.col("s_suppkey") % 2 == 0, 20000.0).alias("pnl_threshold"))


_ALERTS = with_sql(EVENTS_SQL, f"""av AS (SELECT *, l_extendedprice / 20 AS price, size - lag(size) OVER (PARTITION BY "accountId" ORDER BY {_ASC}) AS change FROM pe),
ap AS (SELECT av.*, CASE WHEN type = 1 THEN price - "averagePrice" ELSE "averagePrice" - price END * size AS pnl, CASE WHEN s_suppkey % 2 = 0 THEN 20000.0 END AS thr
  FROM av JOIN supplier ON s_suppkey = "accountId"),
ar AS (SELECT *, CASE WHEN change <> 0 THEN 'size_change' WHEN pnl <= -30000.0 THEN 'max_loss' WHEN pnl >= 60000.0 THEN 'max_gain' WHEN abs(pnl) >= thr THEN 'pnl_threshold' END AS reason FROM ap)""") + f"""
SELECT "accountId", id, reason, size, coalesce(change, 0) AS size_change, {r6('pnl', 4)} AS pnl FROM ar WHERE reason IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY "accountId" ORDER BY {_ASC}) = 1"""
add("position_alerts", lambda s, d: P.position_alerts(
    position_events(s, d).withColumn("price", F.col("l_extendedprice") / 20), _rules(s, d), by="accountId", order=POS_ORDER).select(
    "accountId", "id", "reason", "size", "size_change", "pnl"), _ALERTS, 4)


def plans(s, d):
    """Planned entries with stop and target around the retail price; some are unusable."""
    p = table(s, d, "part")
    e = F.col("p_retailprice")
    return p.select(
        F.col("p_partkey").alias("plan"), (F.col("p_partkey") % 100).alias("accountId"), (F.col("p_partkey") % 50).alias("contractId"), e.alias("entry"),
        (e + (F.col("p_size") % 11) - 5).alias("stop"), (e - 2 * ((F.col("p_size") % 7) - 3)).alias("target"), (F.col("p_partkey") % 2).cast("int").alias("side"),
        F.when(F.col("p_partkey") % 3 != 0, F.lit(500.0)).alias("risk_amount"), F.lit(0.02).alias("risk_fraction"))


_PLANS = """pl AS (SELECT p_partkey AS plan, p_partkey % 100 AS "accountId", p_partkey % 50 AS "contractId", p_retailprice AS entry, p_retailprice + (p_size % 11) - 5 AS stop,
  p_retailprice - 2 * ((p_size % 7) - 3) AS target, CAST(p_partkey % 2 AS INTEGER) AS side, CASE WHEN p_partkey % 3 <> 0 THEN 500.0::DOUBLE END AS risk_amount FROM part)"""
add("size_positions", lambda s, d: P.size_positions(plans(s, d), accounts(s, d), instruments(s, d)).select(
    "plan", "risk_per_contract", "suggested_size", "total_risk", "risk_percentage", "error", F.array_join("risk_warnings", "; ").alias("risk_warnings")),
    with_sql(PRICES_SQL, _ACC, _PLANS, """z AS (SELECT plan, entry, stop, balance, abs(entry - stop) AS gap, coalesce(CASE WHEN "tickSize" <> 0 THEN "tickValue" / "tickSize" END, 1.0) AS scale,
  coalesce(risk_amount, balance * 0.02::DOUBLE) AS budget FROM pl LEFT JOIN acc ON acc.id = pl."accountId" LEFT JOIN ins ON ins.id = pl."contractId"),
y AS (SELECT *, gap * scale AS rpc, CASE WHEN gap <> 0 THEN CAST(floor(CASE WHEN gap * scale <> 0 THEN budget / (gap * scale) ELSE 0.0 END) AS BIGINT) END AS n FROM z),
x AS (SELECT *, n * rpc AS total, CASE WHEN balance > 0 THEN n * rpc / balance * 100.0 ELSE 0.0 END AS pct FROM y)""") + f"""
SELECT plan, {r6('rpc')} AS risk_per_contract, n AS suggested_size, {r6('total')} AS total_risk, {r6('pct')} AS risk_percentage, CASE WHEN gap = 0 THEN 'entry equals stop' END AS error,
  concat_ws('; ', CASE WHEN pct > 1.0 THEN 'risk exceeds its limit' END, CASE WHEN n = 0 THEN 'size is 0' END, CASE WHEN n > 10 THEN 'large size' END) AS risk_warnings FROM x""")
add("risk_reward", lambda s, d: P.risk_reward(plans(s, d)).select("plan", "invalid_reason", "risk_reward"), with_sql(_PLANS) + f"""
SELECT plan, reason AS invalid_reason, {r6('CASE WHEN reason IS NULL AND entry <> stop THEN abs(target - entry) / abs(entry - stop) END')} AS risk_reward FROM (
  SELECT *, CASE WHEN entry = stop THEN 'entry equals stop' WHEN stop < entry AND target <= entry THEN 'target not above entry'
    WHEN stop > entry AND target >= entry THEN 'target not below entry' END AS reason FROM pl)""")
add("validate_brackets", lambda s, d: P.validate_brackets(plans(s, d)).select("plan", "reject_reason", "valid"), with_sql(_PLANS) + """
SELECT plan, reason AS reject_reason, reason IS NULL AS valid FROM (SELECT *, CASE WHEN side = 0 AND stop >= entry THEN 'stop must be below entry'
  WHEN side = 0 AND target <= entry THEN 'target must be above entry' WHEN side <> 0 AND stop <= entry THEN 'stop must be above entry'
  WHEN side <> 0 AND target >= entry THEN 'target must be below entry' END AS reason FROM pl)""")


def fills(s, d):
    return lots(s, d).withColumns({"side": F.when(F.col("l_linestatus") == "O", 0).otherwise(1), "quantity": F.col("volume")})


_FILLS = with_sql(LOTS_SQL, f"""fx AS MATERIALIZED (SELECT contract, price, CASE WHEN l_linestatus = 'O' THEN volume ELSE -volume END AS q,
  row_number() OVER (PARTITION BY contract ORDER BY {', '.join(TRADE_ORDER)}) AS n FROM lots)""", """
fr AS (SELECT contract, n, q AS net, abs(q) * price AS paid, abs(q) AS grown FROM fx WHERE n = 1
  UNION ALL SELECT f.contract, f.n, fr.net + f.q,
    CASE WHEN fr.net + f.q = 0 THEN fr.paid WHEN fr.net = 0 OR sign(fr.net + f.q) = -sign(fr.net) THEN abs(fr.net + f.q) * f.price
      WHEN abs(fr.net + f.q) > abs(fr.net) THEN fr.paid + abs(f.q) * f.price ELSE fr.paid END,
    CASE WHEN fr.net + f.q = 0 THEN fr.grown WHEN fr.net = 0 OR sign(fr.net + f.q) = -sign(fr.net) THEN abs(fr.net + f.q)
      WHEN abs(fr.net + f.q) > abs(fr.net) THEN fr.grown + abs(f.q) ELSE fr.grown END
  FROM fr JOIN fx f ON f.contract = fr.contract AND f.n = fr.n + 1)""") + f"""
SELECT contract, CAST(net AS BIGINT) AS net_size, {r6('CASE WHEN net <> 0 THEN paid / grown END', 4)} AS average_price FROM fr
QUALIFY row_number() OVER (PARTITION BY contract ORDER BY n DESC) = 1"""
add("positions_from_fills", lambda s, d: P.positions_from_fills(fills(s, d), order=TRADE_ORDER), _FILLS, 4)
add("positions_from_fills_split", lambda s, d: P.positions_from_fills(fills(s, d), order=TRADE_ORDER, chunk=cut(70)), _FILLS, 4)
add("daily_loss", lambda s, d: P.daily_loss(executions(s, d), 80.0), with_sql(_EXEC) + f"""
SELECT "accountId", CAST("creationTimestamp" AS DATE) AS day, {r6('coalesce(sum("profitAndLoss"), 0.0)')} AS realized_pnl,
  coalesce(sum("profitAndLoss"), 0.0) <= -80.0 AS limit_reached FROM ex GROUP BY 1, 2""")
add("group_exposure", lambda s, d: P.group_exposure(positions(s, d), table(s, d, "part").select((F.col("p_partkey") % 50).alias("contract")).distinct().select(
    "contract", F.when(F.col("contract") < 40, F.concat(F.lit("group_"), (F.col("contract") % 6).cast("string"))).alias("group"))),
    with_sql(POS_SQL) + f"""SELECT "accountId", "group", {r6('exposure', 4)} AS exposure, contracts, {r6('exposure / total', 4)} AS exposure_share, exposure / total > 0.3 AS exceeds FROM (
  SELECT "accountId", 'group_' || ("contractId" % 6) AS "group", sum(abs(size * "averagePrice")) AS exposure, count(DISTINCT "contractId") AS contracts FROM pos WHERE "contractId" < 40 GROUP BY 1, 2)
JOIN (SELECT "accountId", sum(abs(size * "averagePrice")) AS total FROM pos GROUP BY 1) USING ("accountId")""", 4)
add("dimension_join", lambda s, d: dimension_join(positions(s, d).select(*KEY, "size"), instruments(s, d).withColumnRenamed("id", "contractId"), "contractId"),
    with_sql(POS_SQL, PRICES_SQL) + f"""SELECT "accountId", "contractId", size, "tickSize", {r6('"tickValue"')} AS "tickValue" FROM pos LEFT JOIN ins ON ins.id = pos."contractId" """)

# --- orders -------------------------------------------------------------------------------------------------

_SYM = ["MGC", "NQ", "ES", "MES"]


def order_events(s, d):
    """Three consecutive order rows act as updates of one order."""
    k, p, st = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderstatus")
    status = F.when(st == "O", 1).when(st == "F", 2).otherwise(0)
    kind = F.element_at(F.array(*[F.lit(x) for x in (1, 2, 4, 5, 6)]), F.substring("o_orderpriority", 1, 1).cast("int"))
    size = (k % 10 + 1).cast("int")
    contract = F.concat(F.lit("CON.F.US."), F.element_at(F.array(*[F.lit(x) for x in _SYM]), (F.col("o_custkey") % 4 + 1).cast("int")), F.lit(".M25"))
    return table(s, d, "orders").select(
        F.floor(k / 3).alias("id"), F.col("o_custkey").alias("accountId"), contract.alias("contractId"), F.col("o_orderdate").cast("timestamp").alias("updateTimestamp"),
        k.alias("seq"), status.alias("status"), kind.alias("type"), (k % 2).cast("int").alias("side"), size.alias("size"),
        F.when(st == "F", size).when(st == "P", F.floor(size / 2)).otherwise(0).cast("int").alias("fillVolume"), p.alias("limitPrice"), (p * 0.5).alias("stopPrice"))


ORDERS_SQL = """oe AS (SELECT CAST(floor(o_orderkey / 3) AS BIGINT) AS id, o_custkey AS "accountId",
  'CON.F.US.' || ['MGC', 'NQ', 'ES', 'MES'][o_custkey % 4 + 1] || '.M25' AS "contractId", o_orderdate AS "updateTimestamp", o_orderkey AS seq,
  CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 0 END AS status, [1, 2, 4, 5, 6][CAST(substr(o_orderpriority, 1, 1) AS INTEGER)] AS type,
  CAST(o_orderkey % 2 AS INTEGER) AS side, CAST(o_orderkey % 10 + 1 AS INTEGER) AS size,
  CAST(CASE o_orderstatus WHEN 'F' THEN o_orderkey % 10 + 1 WHEN 'P' THEN floor((o_orderkey % 10 + 1) / 2) ELSE 0 END AS INTEGER) AS "fillVolume",
  o_totalprice AS "limitPrice", o_totalprice * 0.5 AS "stopPrice" FROM orders),
ord AS MATERIALIZED (SELECT * FROM oe QUALIFY row_number() OVER (PARTITION BY id ORDER BY "updateTimestamp" DESC, seq DESC) = 1)"""
orders = lambda s, d: O.latest_orders(order_events(s, d))
_ORD = with_sql(ORDERS_SQL)
_OC = '"accountId", "contractId", "updateTimestamp", id, seq, status, type, side, size, "fillVolume"'
_ocols = ["accountId", "contractId", "updateTimestamp", "id", "seq", "status", "type", "side", "size", "fillVolume"]
add("latest_orders", lambda s, d: orders(s, d).select(*_ocols), _ORD + f"SELECT {_OC} FROM ord")
add("open_orders", lambda s, d: O.open_orders(orders(s, d), contract="CON.F.US.NQ.M25").select(*_ocols), _ORD + f"""
SELECT {_OC} FROM ord WHERE status = 1 AND "contractId" = 'CON.F.US.NQ.M25'""")
_BYAC = ["accountId", "contractId"]
add("stop_and_target", lambda s, d: O.stop_and_target(orders(s, d), by=_BYAC), _ORD + """
SELECT "accountId", "contractId", s.id AS stop_order_id, s.p AS stop_price, t.id AS target_order_id, t.p AS target_price FROM
  (SELECT "accountId", "contractId", id, "stopPrice" AS p FROM ord WHERE status = 1 AND type = 4 QUALIFY row_number() OVER (PARTITION BY "accountId", "contractId" ORDER BY "updateTimestamp" DESC, id DESC) = 1) s
  FULL JOIN (SELECT "accountId", "contractId", id, "limitPrice" AS p FROM ord WHERE status = 1 AND type = 1 QUALIFY row_number() OVER (PARTITION BY "accountId", "contractId" ORDER BY "updateTimestamp" DESC, id DESC) = 1) t
  USING ("accountId", "contractId")""")
_order_fills = lambda s, d: executions(s, d).filter("NOT voided").select((F.col("id") * 3).alias("orderId"))
_OF = with_sql(ORDERS_SQL, _EXEC, "fl AS (SELECT id * 3 AS oid FROM ex WHERE NOT voided)")
add("filled_orders", lambda s, d: O.filled_orders(orders(s, d), _order_fills(s, d)).select(*_ocols), _OF + f"SELECT {_OC} FROM ord WHERE status = 2 OR id IN (SELECT oid FROM fl)")
add("unfilled_orders", lambda s, d: O.unfilled_orders(orders(s, d), _order_fills(s, d)).select(*_ocols), _OF + f"SELECT {_OC} FROM ord WHERE status <> 2 AND id NOT IN (SELECT oid FROM fl)")
add("order_stats", lambda s, d: O.order_stats(orders(s, d)), _ORD + f"""SELECT "accountId", count(*) AS orders, {', '.join(f'count(*) FILTER (status = {i}) AS status_{i}' for i in range(5))},
  {', '.join(f'count(*) FILTER (type = {i}) AS type_{i}' for i in (1, 2, 4, 5, 6, 7))}, max("updateTimestamp") AS last_update,
  {r6('sum("fillVolume") / nullif(sum(size), 0)')} AS fill_ratio FROM ord GROUP BY 1""")
add("expire_events", lambda s, d: O.expire_events(order_events(s, d), "1999-01-01", 24 * 365, ts="updateTimestamp").select(*_ocols), _ORD + f"""
SELECT {_OC} FROM oe WHERE "updateTimestamp" >= TIMESTAMP '1999-01-01' - INTERVAL 365 DAY""")
add("upsert", lambda s, d: upsert(order_events(s, d).filter("status <> 2"), order_events(s, d).filter("status = 2"), key="id", order=["updateTimestamp", "seq"]).select(*_ocols),
    _ORD + f"SELECT {_OC} FROM ord")


def _odd_ids(s, d):
    """Contract ids of several shapes, one per part."""
    k = F.col("p_partkey")
    shapes = [F.lit("CON.F.US.MGC.M25"), F.lit("NQ"), F.concat(F.lit("CON.F.US.ES.A"), (k % 90 + 10).cast("string")), F.lit("bad.id"),
              F.concat(F.lit("CON.F.US.MES.Z"), (k % 90 + 10).cast("string")), F.concat(F.lit("x"), k.cast("string"))]
    return table(s, d, "part").select(k.alias("part"), F.element_at(F.array(*shapes), (k % 6 + 1).cast("int")).alias("contract"))


_IDS = """cid AS (SELECT p_partkey AS part, ['CON.F.US.MGC.M25', 'NQ', 'CON.F.US.ES.A' || (p_partkey % 90 + 10), 'bad.id', 'CON.F.US.MES.Z' || (p_partkey % 90 + 10), 'x' || p_partkey][p_partkey % 6 + 1] AS contract FROM part)"""
_FULL, _SIMPLE = r"^CON\.F\.US\.([A-Z]{2,4})\.[FGHJKMNQUVXZ]\d{2}$", r"^[A-Z]{2,4}$"
add("contract_symbols", lambda s, d: _odd_ids(s, d).select("part", "contract", O.contract_symbol(F.col("contract")).alias("symbol"), O.valid_contract(F.col("contract")).alias("valid")),
    with_sql(_IDS) + f"""SELECT part, contract, CASE WHEN regexp_matches(contract, '{_SIMPLE}') THEN contract WHEN regexp_matches(contract, '{_FULL}') THEN regexp_extract(contract, '{_FULL}', 1) END AS symbol,
  regexp_matches(contract, '{_SIMPLE}') OR regexp_matches(contract, '{_FULL}') AS valid FROM cid""")


def _ticked(s, d):
    return table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").alias("price"),
        F.element_at(F.array(*[F.lit(x) for x in (0.25, 0.1, 0.5, 0.0)]), (F.col("l_partkey") % 4 + 1).cast("int")).alias("tick"), F.col("l_quantity").cast("int").alias("size"))


_TICKED = """tk AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS price, [0.25::DOUBLE, 0.1::DOUBLE, 0.5::DOUBLE, 0.0::DOUBLE][l_partkey % 4 + 1] AS tick,
  CAST(l_quantity AS INTEGER) AS size FROM lineitem)"""
_LK = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_cents, _tcents = "CAST(round(price * 100) AS BIGINT)", "CAST(round(tick * 100) AS BIGINT)"
add("align_prices", lambda s, d: _ticked(s, d).select(*_LK, O.align_half_up(F.col("price"), F.col("tick")).alias("half_up"), O.align_half_even(F.col("price"), F.col("tick")).alias("half_even")),
    with_sql(_TICKED) + f"""SELECT {', '.join(_LK)}, {r6(f"CASE WHEN tick > 0 THEN ((2 * {_cents} + {_tcents}) // (2 * {_tcents})) * {_tcents} / 100.0 ELSE price END")} AS half_up,
  {r6("CASE WHEN tick > 0 THEN round_even(price / tick, 0) * tick ELSE price END")} AS half_even FROM tk""")
add("align_to_tick", lambda s, d: O.align_to_tick(
    order_events(s, d).select("id", "seq", F.col("contractId").alias("contract"), F.col("limitPrice").alias("price")),
    s.createDataFrame([("MGC", 0.1), ("NQ", 0.25), ("ES", 0.5)], "name string, tickSize double")),
    with_sql(ORDERS_SQL, """ot AS (SELECT *, "limitPrice" AS price, CASE "accountId" % 4 WHEN 0 THEN 0.1::DOUBLE WHEN 1 THEN 0.25::DOUBLE WHEN 2 THEN 0.5::DOUBLE END AS tick FROM oe)""") + f"""
SELECT id, seq, "contractId" AS contract, {r6(f"CASE WHEN tick > 0 THEN ((2 * {_cents} + {_tcents}) // (2 * {_tcents})) * {_tcents} / 100.0 ELSE price END")} AS price FROM ot""")
add("tick_values", lambda s, d: _ticked(s, d).select(*_LK, O.tick_value(F.col("price") - 900, F.col("tick"), F.lit(5.0)).alias("value"),
    O.notional(F.col("size"), F.col("price"), F.col("tick"), F.lit(5.0)).alias("notional")), with_sql(_TICKED) + f"""
SELECT {', '.join(_LK)}, {r6('CASE WHEN tick > 0 THEN abs(price - 900) / tick * 5.0 ELSE 0.0 END', 3)} AS value,
  {r6('CASE WHEN tick > 0 THEN abs(size) * price * (1.0 / tick) * 5.0 ELSE 0.0 END', 3)} AS notional FROM tk""", 3)


def _named(s, d):
    return table(s, d, "part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("id"), F.col("p_brand").alias("name"), F.col("p_name").alias("description"))


_NAMED = "nm AS (SELECT 'P' || p_partkey AS id, p_brand AS name, p_name AS description FROM part)"
_MATCH = "WHERE contains(lower(id), 'blue') OR contains(lower(name), 'blue') OR contains(lower(description), 'blue')"
add("find_instruments", lambda s, d: O.find_instruments(_named(s, d), "Blue"), with_sql(_NAMED) + f"SELECT id, name, description FROM nm {_MATCH}")
add("find_instrument", lambda s, d: O.find_instrument(_named(s, d), "Blue"), with_sql(_NAMED) + f"SELECT id, name, description FROM nm {_MATCH} ORDER BY id LIMIT 1")

# --- sessions (January: Chicago is UTC-6) -------------------------------------------------------------------

_L = "(ts - INTERVAL 6 HOUR)"
_LOCAL = f"""lc AS (SELECT seq, ts, {_L} AS l, CAST(date_trunc('day', {_L}) AS TIMESTAMP) AS day, isodow({_L}) - 1 AS wd, hour({_L}) AS h FROM ticks),
fl AS (SELECT *, (wd = 4 AND h >= 16) OR wd = 5 OR (wd = 6 AND h < 17) OR h = 16 AS closed FROM lc)"""
add("session_flags", lambda s, d: C.session_flags(ticks(s, d).select("seq", "ts")), with_sql(TICKS_SQL, _LOCAL) + """
SELECT seq, ts, NOT closed AS is_open, CASE WHEN closed THEN day + INTERVAL 23 HOUR + CASE WHEN wd = 4 AND h >= 16 THEN INTERVAL 2 DAY WHEN wd = 5 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END END AS next_open,
  CASE WHEN NOT closed THEN day + INTERVAL 22 HOUR + CASE WHEN h >= 16 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END END AS next_close FROM fl""")
add("calendar_columns", lambda s, d: C.calendar_columns(C.to_exchange_tz(ticks(s, d).select("seq", "ts"))), with_sql(TICKS_SQL, _LOCAL) + """
SELECT seq, ts, l AS local_ts, CAST(l AS DATE) AS local_date, CAST(wd AS INTEGER) AS local_weekday, CAST(h AS INTEGER) AS local_hour, CAST(minute(l) AS INTEGER) AS local_minute FROM fl""")

# Years with both changes of the clock: order times at every hour of the day.
_Z = "America/Chicago"


def _order_times(s, d):
    ts = F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 24 * 3_600_000_000)
    return table(s, d, "orders").select(F.col("o_orderkey").alias("seq"), ts.alias("ts"), (F.col("o_custkey") % 5).alias("contract"), F.col("o_totalprice").alias("price"), F.lit(1).cast("long").alias("volume"))


_DST = f"""ot AS (SELECT o_orderkey AS seq, o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 24) AS ts, o_custkey % 5 AS contract, o_totalprice AS price, 1 AS volume FROM orders),
ol AS (SELECT *, (ts AT TIME ZONE 'UTC') AT TIME ZONE '{_Z}' AS l FROM ot),
od AS (SELECT *, CAST(CAST(l AS DATE) AS TIMESTAMP) AS day, isodow(l) - 1 AS wd, hour(l) AS h FROM ol)"""
_UTC = lambda x: f"((({x}) AT TIME ZONE '{_Z}') AT TIME ZONE 'UTC')"
add("calendar_dst", lambda s, d: C.calendar_columns(_order_times(s, d).select("seq", "ts")), with_sql(_DST) + """
SELECT seq, ts, CAST(l AS DATE) AS local_date, CAST(wd AS INTEGER) AS local_weekday, CAST(h AS INTEGER) AS local_hour, CAST(minute(l) AS INTEGER) AS local_minute FROM od""")
add("session_flags_dst", lambda s, d: C.session_flags(_order_times(s, d).select("seq", "ts")), with_sql(
    _DST, "fl AS (SELECT *, (wd = 4 AND h >= 16) OR wd = 5 OR (wd = 6 AND h < 17) OR h = 16 AS closed FROM od)") + f"""
SELECT seq, ts, NOT closed AS is_open,
  CASE WHEN closed THEN {_UTC("day + INTERVAL 17 HOUR + CASE WHEN wd = 4 AND h >= 16 THEN INTERVAL 2 DAY WHEN wd = 5 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END")} END AS next_open,
  CASE WHEN NOT closed THEN {_UTC("day + INTERVAL 16 HOUR + CASE WHEN h >= 16 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END")} END AS next_close FROM fl""")
add("bars_1day_dst", lambda s, d: bars(_order_times(s, d), "1 day", by="contract", order=["ts", "seq"]), with_sql(_DST) + f"""
SELECT contract, {_UTC("day")} AS ts, first(price ORDER BY ts, seq) AS open, max(price) AS high, min(price) AS low, last(price ORDER BY ts, seq) AS close,
  CAST(sum(volume) AS BIGINT) AS volume FROM od GROUP BY contract, day""")
