"""Queries and oracles of statistics, patterns and trade performance."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapestry.operators import patterns as P, portfolio as R, stats as S
from tapestry.operators.overlap import bbands
from tapestry.functions.history import over_history
from tapestry.functions.joins import merge_on_time

from .indicators import lag, over, roll
from .tables import cut, HOUR_BARS_SQL, TICKS_SQL, WEEK_BARS_SQL, hour_bars, hour_split, r6, table, ticks, tidy, week_bars, week_split, with_sql

QUERIES, ORACLES = {}, {}
_W = "PARTITION BY contract ORDER BY ts"


def add(name, query, sql, digits=6):
    QUERIES[name] = lambda spark, sf: tidy(query(spark, sf), digits)
    if sql is not None:
        ORACLES[name] = sql


_RET = f"rt AS MATERIALIZED (SELECT *, CASE WHEN {lag('close')} <> 0 THEN (close - {lag('close')}) / {lag('close')} END AS returns FROM bars)"


def rets(s, d, chunk=None):
    return S.returns(week_bars(s, d), chunk=chunk or week_split(s, d))


add("returns", lambda s, d: rets(s, d).select("contract", "ts", "returns"), with_sql(WEEK_BARS_SQL, _RET) + f"SELECT contract, ts, {r6('returns')} AS returns FROM rt")
add("returns_split", lambda s, d: rets(s, d, 40).select("contract", "ts", "returns"), with_sql(WEEK_BARS_SQL, _RET) + f"SELECT contract, ts, {r6('returns')} AS returns FROM rt")
def _moves(s, d):
    """Rolling sums of the rises and of the falls."""
    def body(df, t):
        df = df.withColumn("move", F.col("close") - t.lag("close"))
        return df.withColumns({"gains": t.gains(F.col("move"), 10), "losses": t.losses(F.col("move"), 10)})

    return over_history(hour_bars(s, d), body, by="contract", order="ts", lookback=10, chunk=hour_split(s, d)).select("contract", "ts", "gains", "losses")


add("rolling_moves", _moves, with_sql(HOUR_BARS_SQL, f"mv AS (SELECT contract, ts, close - {lag('close')} AS m FROM bars)",
    "mw AS (SELECT *, CASE WHEN m > 0 THEN m ELSE 0.0 END AS g, CASE WHEN m < 0 THEN -m ELSE 0.0 END AS l FROM mv)")
    + f"SELECT contract, ts, {r6(roll('sum', 'g', 10))} AS gains, {r6(roll('sum', 'l', 10))} AS losses FROM mw")
_COLS = ["open", "high", "low", "close", "volume"]


def _c(a, b):
    return "1.0" if a == b else f"coalesce(corr({a}, {b}), 0.0)"


add("correlation_matrix", lambda s, d: S.correlation_matrix(hour_bars(s, d), _COLS), with_sql(HOUR_BARS_SQL) + " UNION ALL ".join(
    f"SELECT '{a}' AS \"column\", " + ", ".join(f"{r6(_c(a, b))} AS {b}" for b in _COLS) + " FROM bars" for a in _COLS))
add("correlation_by_contract", lambda s, d: S.correlation_matrix(hour_bars(s, d), _COLS, by="contract"), with_sql(HOUR_BARS_SQL) + " UNION ALL ".join(
    f"SELECT contract, '{a}' AS \"column\", " + ", ".join(f"{r6(_c(a, b))} AS {b}" for b in _COLS) + " FROM bars GROUP BY contract" for a in _COLS))
_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_RANKS = "rk AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in _NUM) + " FROM lineitem)"
add("correlation_spearman", lambda s, d: S.correlation_matrix(table(s, d, "lineitem"), _NUM, "spearman"), with_sql(_RANKS) + " UNION ALL ".join(
    f"SELECT '{a}' AS \"column\", " + ", ".join(f"{r6(_c(a, b))} AS {b}" for b in _NUM) + " FROM rk" for a in _NUM))
_BY_RANKS = ", ".join(f"rank() OVER (PARTITION BY contract ORDER BY {c}) + (count(*) OVER (PARTITION BY contract, {c}) - 1) / 2.0 AS {c}" for c in _COLS)
add("correlation_spearman_by_contract", lambda s, d: S.correlation_matrix(hour_bars(s, d), _COLS, "spearman", by="contract"),
    with_sql(HOUR_BARS_SQL, f"rk AS (SELECT contract, {_BY_RANKS} FROM bars)") + " UNION ALL ".join(
    f"SELECT contract, '{a}' AS \"column\", " + ", ".join(f"{r6(_c(a, b))} AS {b}" for b in _COLS) + " FROM rk GROUP BY contract" for a in _COLS))


def _daily(s, d):
    from tapestry.operators.bars import rollup_bars

    return S.returns(rollup_bars(hour_bars(s, d), "1day", by="contract", tz="UTC"), chunk=hour_split(s, d))


add("pair_correlation", lambda s, d: S.pair_correlation(_daily(s, d)),
    with_sql(HOUR_BARS_SQL, """dy AS (SELECT contract, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts, last(close ORDER BY ts) AS close FROM bars GROUP BY 1, 2)""",
             f"dr AS (SELECT contract, ts, (close - {lag('close')}) / {lag('close')} AS x FROM dy)") + f"""
SELECT p.contract AS a, q.contract AS b, {r6('corr(p.x, q.x)')} AS correlation, count(*) AS points
FROM dr p JOIN dr q ON p.ts = q.ts AND p.contract < q.contract WHERE p.x IS NOT NULL AND q.x IS NOT NULL GROUP BY 1, 2""")
add("volatility_metrics", lambda s, d: S.volatility_metrics(week_bars(s, d), chunk=week_split(s, d)),
    with_sql(WEEK_BARS_SQL, _RET, f"rv AS (SELECT *, {roll('stddev_samp', 'returns', 20)} AS rv FROM rt)") + f"""
SELECT contract, {r6('coalesce(stddev_samp(returns), 0.0)')} AS volatility, {r6('avg(returns)')} AS mean_return, {r6('avg(rv)')} AS avg_rolling_volatility,
  {r6('max(rv)')} AS max_rolling_volatility, {r6('min(rv)')} AS min_rolling_volatility,
  {r6('coalesce(stddev_samp(returns), 0.0) * sqrt(252)')} AS annualized_volatility, {r6('avg(returns) * 252')} AS annualized_return
FROM rv GROUP BY contract HAVING count(returns) > 0""")
add("sharpe_ratio", lambda s, d: S.sharpe_ratio(rets(s, d)), with_sql(WEEK_BARS_SQL, _RET) + f"""
SELECT contract, {r6("CASE WHEN stddev_samp(returns) > 0 THEN (avg(returns) * 252 - CAST(0.02 AS DOUBLE)) / (stddev_samp(returns) * sqrt(252)) ELSE 0.0 END")} AS sharpe
FROM rt GROUP BY contract""")
_DD = f"""dd AS (SELECT *, close / max(close) OVER ({_W} ROWS UNBOUNDED PRECEDING) - 1.0 AS dd FROM bars),
dr AS (SELECT *, sum(CASE WHEN dd < 0 THEN 0 ELSE 1 END) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS run FROM dd),
dg AS (SELECT contract, run, min(dd) AS dd, count(*) FILTER (dd < 0) AS n FROM dr GROUP BY contract, run)
SELECT contract, """ + r6("min(dd)") + " AS max_drawdown, max(n) AS max_drawdown_duration FROM dg GROUP BY contract"
add("max_drawdown", lambda s, d: S.max_drawdown(week_bars(s, d), chunk=week_split(s, d)), with_sql(WEEK_BARS_SQL) .rstrip() + ",\n" + _DD)
add("max_drawdown_split", lambda s, d: S.max_drawdown(week_bars(s, d), chunk=cut(30)), with_sql(WEEK_BARS_SQL).rstrip() + ",\n" + _DD)
_LI = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"), ("l_quantity", "double"),
       ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double")]
add("profile_table", lambda s, d: S.profile_table(table(s, d, "lineitem")), " UNION ALL ".join(
    f"""SELECT count(*) AS rows, min(l_shipdate) AS first_ts, max(l_shipdate) AS last_ts, '{c}' AS "column", '{t}' AS dtype, CAST(min({c}) AS DOUBLE) AS min,
  CAST(max({c}) AS DOUBLE) AS max, {r6(f'avg({c})')} AS mean FROM lineitem""" for c, t in _LI))

# --- patterns -------------------------------------------------------------------------------------------------

_FLAGS = ["doji", "hammer", "shooting_star", "bullish_candle", "bearish_candle", "long_body"]
add("candlestick_patterns", lambda s, d: P.candlestick_patterns(hour_bars(s, d)).select("contract", "ts", *_FLAGS),
    with_sql(HOUR_BARS_SQL, """k AS (SELECT contract, ts, abs(close - open) AS body, high - low AS span, high - greatest(open, close) AS above,
  least(open, close) - low AS below, open, close FROM bars)""") + """
SELECT contract, ts, body <= CAST(0.1 AS DOUBLE) * span AS doji,
  body <= CAST(0.3 AS DOUBLE) * span AND below >= 2 * body AND above <= CAST(0.1 AS DOUBLE) * span AS hammer,
  body <= CAST(0.3 AS DOUBLE) * span AND above >= 2 * body AND below <= CAST(0.1 AS DOUBLE) * span AS shooting_star,
  close > open AS bullish_candle, close < open AS bearish_candle, body >= CAST(0.7 AS DOUBLE) * span AS long_body FROM k""")
_AROUND = f"OVER ({_W} ROWS BETWEEN 20 PRECEDING AND 20 FOLLOWING)"
_CHART = f"""i AS MATERIALIZED (SELECT contract, ts, close, row_number() OVER ({_W}) - 1 AS n, max(close) {_AROUND} AS top, min(close) {_AROUND} AS low, count(*) {_AROUND} AS c FROM bars),
m AS (SELECT i.contract, i.ts, i.n AS index1, i.close AS price, i.top, i.low, min(j.n) AS index2 FROM i JOIN i j ON j.contract = i.contract
  AND j.n >= i.n + 10 AND j.n < i.n + 20 AND abs(j.close - i.close) / i.close < CAST(0.02 AS DOUBLE) WHERE i.c = 41 AND (i.close = i.top OR i.close = i.low) GROUP BY 1, 2, 3, 4, 5, 6)
""" + "SELECT contract, ts, 'double_top' AS pattern, index1, index2, " + r6("price", 4) + " AS price, " + r6("top - low", 4) + """ AS strength FROM m WHERE price = top
UNION ALL SELECT contract, ts, 'double_bottom', index1, index2, """ + r6("price", 4) + ", " + r6("top - low", 4) + " FROM m WHERE price = low"
add("chart_patterns", lambda s, d: P.chart_patterns(week_bars(s, d), chunk=week_split(s, d)), with_sql(WEEK_BARS_SQL).rstrip() + ",\n" + _CHART, 4)
add("chart_patterns_split", lambda s, d: P.chart_patterns(week_bars(s, d), chunk=cut(50)), with_sql(WEEK_BARS_SQL).rstrip() + ",\n" + _CHART, 4)
_m, _sd = roll("avg", "close", 20), roll("stddev_samp", "close", 20)
add("bollinger_position", lambda s, d: P.bollinger_position(bbands(week_bars(s, d), by="contract", order="ts", chunk=week_split(s, d))).select("contract", "ts", "bb_position"),
    with_sql(WEEK_BARS_SQL, f"bb AS (SELECT contract, ts, close, {_m} - 2.0 * {_sd} AS lo, {_m} + 2.0 * {_sd} AS hi FROM bars)") + f"""
SELECT contract, ts, {r6('CASE WHEN hi - lo <> 0 THEN (close - lo) / (hi - lo) * 100.0 END')} AS bb_position FROM bb""")

# --- performance -------------------------------------------------------------------------------------------------


def closed(s, d):
    return table(s, d, "events").select(F.col("user_id").alias("account"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"),
                                        (F.col("value") - 50).alias("pnl"))


def executions(s, d):
    k = F.get_json_object("props", "$.k").cast("long")
    return table(s, d, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("accountId"), F.col("event_type").alias("contractId"),
        F.col("ts").cast("timestamp").alias("creationTimestamp"), F.when(k % 3 != 0, F.col("value") - 50).alias("profitAndLoss"),
        (F.col("event_type") == "error").alias("voided"), (k + 1).alias("size"))


def metrics_sql(source: str, account: str, ts: str, seq: str, pnl: str, initial: float) -> str:
    w = f"PARTITION BY {account} ORDER BY {ts}, {seq}"
    return f"""eq AS (SELECT {account} AS a, {ts} AS t, {seq} AS q, {pnl} AS pnl, {initial} + sum({pnl}) OVER ({w} ROWS UNBOUNDED PRECEDING) AS equity FROM {source}),
pk AS (SELECT *, greatest({initial}, max(equity) OVER (PARTITION BY a ORDER BY t, q ROWS UNBOUNDED PRECEDING)) AS peak,
  coalesce(greatest({initial}, max(equity) OVER (PARTITION BY a ORDER BY t, q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), {initial}) AS before FROM eq),
rn AS (SELECT *, equity > before AS fresh, sum(CASE WHEN equity > before THEN 1 ELSE 0 END) OVER (PARTITION BY a ORDER BY t, q ROWS UNBOUNDED PRECEDING) AS run FROM pk),
du AS (SELECT a, max(n) AS n FROM (SELECT a, run, count(*) FILTER (NOT fresh) AS n FROM rn GROUP BY a, run) GROUP BY a),
tt AS (SELECT a, count(*) AS total_trades, sum(pnl) AS total_pnl, count(*) FILTER (pnl > 0) AS wins, count(*) FILTER (pnl < 0) AS losses,
  coalesce(sum(pnl) FILTER (pnl > 0), 0.0) AS gross_profit, coalesce(-sum(pnl) FILTER (pnl < 0), 0.0) AS gross_loss, max((peak - equity) / peak) AS dd,
  max(pnl) AS best, min(pnl) AS worst FROM rn GROUP BY a)
SELECT a AS {account}, total_trades, {r6('total_pnl', 4)} AS total_pnl, {r6('gross_profit', 4)} AS gross_profit, {r6('gross_loss', 4)} AS gross_loss,
  {r6('dd')} AS max_drawdown, n AS max_drawdown_duration, {r6('best', 4)} AS largest_win, {r6('worst', 4)} AS largest_loss, {r6(f'total_pnl / {initial}')} AS total_return,
  {r6('wins / total_trades')} AS win_rate, {r6("CASE WHEN gross_loss > 0 THEN gross_profit / gross_loss ELSE CAST('inf' AS DOUBLE) END")} AS profit_factor,
  {r6('CASE WHEN wins > 0 THEN gross_profit / wins ELSE 0.0 END', 4)} AS avg_win, {r6('CASE WHEN losses > 0 THEN -gross_loss / losses ELSE 0.0 END', 4)} AS avg_loss,
  {r6('wins / total_trades * CASE WHEN wins > 0 THEN gross_profit / wins ELSE 0.0 END + (1.0 - wins / total_trades) * CASE WHEN losses > 0 THEN -gross_loss / losses ELSE 0.0 END', 4)} AS expectancy
FROM tt JOIN du USING (a)"""


_MONEY = ["total_pnl", "gross_profit", "gross_loss", "largest_win", "largest_loss", "avg_win", "avg_loss", "expectancy"]


def money(df):
    rest = [c for c in df.columns if c not in _MONEY]
    return df.select(*rest, *[F.round(F.col(c) + F.lit(3e-7), 4).alias(c) for c in _MONEY])


_PNL = "pn AS (SELECT user_id AS account, ts, event_id AS seq, value - 50 AS pnl FROM events)"
_PORT = with_sql(_PNL).rstrip() + ",\n" + metrics_sql("pn", "account", "ts", "seq", "pnl", 10000.0)
add("portfolio_metrics", lambda s, d: money(R.portfolio_metrics(closed(s, d), 10000.0)), _PORT)
add("portfolio_metrics_split", lambda s, d: money(R.portfolio_metrics(closed(s, d), 10000.0, chunk=cut(20))), _PORT)
_EXEC = r"""ex AS (SELECT event_id AS id, user_id AS "accountId", event_type AS "contractId", ts AS "creationTimestamp",
  CASE WHEN CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) % 3 <> 0 THEN value - 50 END AS "profitAndLoss", event_type = 'error' AS voided,
  CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) + 1 AS size FROM events)"""
add("performance", lambda s, d: money(R.performance(executions(s, d), 10000.0)),
    with_sql(_EXEC, """ok AS (SELECT * FROM ex WHERE NOT voided AND "profitAndLoss" IS NOT NULL)""").rstrip() + ",\n"
    + metrics_sql("ok", '"accountId"', '"creationTimestamp"', "id", '"profitAndLoss"', 10000.0))
add("trade_history", lambda s, d: R.trade_history(executions(s, d), start="2024-01-03", end="2024-02-01", limit=20), with_sql(_EXEC) + """
SELECT id, "accountId", "contractId", "creationTimestamp", round("profitAndLoss" + 3e-9, 6) AS "profitAndLoss", voided, size FROM ex
WHERE "creationTimestamp" >= TIMESTAMP '2024-01-03' AND "creationTimestamp" <= TIMESTAMP '2024-02-01'
QUALIFY row_number() OVER (PARTITION BY "accountId" ORDER BY "creationTimestamp" DESC, id DESC) <= 20""")
add("merge_on_time", lambda s, d: merge_on_time(
    hour_bars(s, d).select("contract", "ts", "close"), hour_bars(s, d).select("contract", (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("ts"), "volume")),
    with_sql(HOUR_BARS_SQL) + "SELECT v.contract, v.ts, v.close, c.volume FROM bars v JOIN bars c ON v.contract = c.contract AND v.ts = c.ts + INTERVAL 1 HOUR")
