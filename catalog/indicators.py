"""Queries and oracles of the technical indicators, over weekly bars per supplier."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

import tapestry.operators  # noqa: F401
from tapestry.operators.registry import REGISTRY, with_indicators

from .tables import cut, HOUR_BARS_SQL, WEEK_BARS_SQL, hour_bars, hour_split, r6, tidy, week_bars, week_split, with_sql

KEYS = ["contract", "ts"]
QUERIES, ORACLES = {}, {}
DIGITS = 4  # prices run to 1e5, so that double noise stays far below the last digit


def _run(name, outputs, params, chunk=None):
    def query(spark, sf):
        split = cut(chunk) if chunk is not None else week_split(spark, sf)
        out = REGISTRY[name](week_bars(spark, sf), by="contract", order="ts", chunk=split, **params)
        return tidy(out.select(*KEYS, *outputs), DIGITS)

    return query


def add(name, outputs, sql, key=None, chunk=None, **params):
    key = key or name
    QUERIES[key], ORACLES[key] = _run(name, list(outputs), params, chunk), sql


def select(outputs: dict[str, str], *ctes: str, source="bars", tail="") -> str:
    cols = ", ".join(f"{r6(e, DIGITS)} AS {n}" for n, e in outputs.items())
    return with_sql(WEEK_BARS_SQL, *ctes) + f"SELECT contract, ts, {cols} FROM {source} {tail}"


W = "PARTITION BY contract ORDER BY ts"


def over(p):
    return f"OVER ({W} ROWS BETWEEN {p - 1} PRECEDING AND CURRENT ROW)"


def roll(fn, x, p):
    return f"(CASE WHEN count({x}) {over(p)} = {p} THEN {fn}({x}) {over(p)} END)"


def lag(x, n=1):
    return f"lag({x}, {n}) OVER ({W})"


def div(n, d):
    return f"(CASE WHEN ({d}) <> 0 THEN ({n}) / ({d}) ELSE 0.0 END)"


def inputs(**cols: str) -> str:
    """CTE ``x``: bars with named inputs and a row number."""
    extra = "".join(f", {e} AS {n}" for n, e in cols.items())
    return f"x AS MATERIALIZED (SELECT *, row_number() OVER ({W}) - 1 AS rn{extra} FROM bars)"


def recursion(first: dict[str, str], step: dict[str, str]) -> str:
    """CTE ``r``: one state row per bar; ``step`` may read the state before as ``p.*`` and inputs as ``x.*``."""
    a = ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in first.items())
    b = ", ".join(f"{e} AS {n}" for n, e in step.items())
    return (
        f"r AS (SELECT x.contract, x.ts, x.rn, {a} FROM x WHERE x.rn = 0 UNION ALL "
        f"SELECT x.contract, x.ts, x.rn, {b} FROM r p JOIN x ON x.contract = p.contract AND x.rn = p.rn + 1)"
    )


def ema_chain(alphas: list[tuple[str, str, float]]):
    """States of adjusted EMAs ``(name, source, alpha)``; a source may name an earlier mean as ``@name``."""
    first, step, value0, value1 = {}, {}, {}, {}
    for name, src, a in alphas:
        q = f"{1.0 - a!r}"
        s0 = src if not src.startswith("@") else value0[src[1:]]
        s1 = src if not src.startswith("@") else value1[src[1:]]
        first[f"{name}n"], first[f"{name}d"] = s0, "1.0"
        step[f"{name}n"], step[f"{name}d"] = f"({s1} + {q} * p.{name}n)", f"(1.0 + {q} * p.{name}d)"
        value0[name] = f"({s0})"
        value1[name] = f"({step[f'{name}n']} / {step[f'{name}d']})"
    return recursion(first, step)


def mean(name):
    return f"{name}n / {name}d"


def span(p):
    return 2.0 / (p + 1)


def wilder(states: dict[str, str], p: int):
    a = 1.0 / p
    return recursion({n: e for n, e in states.items()}, {n: f"({a!r} * {e} + {1 - a!r} * p.{n})" for n, e in states.items()})


add("sma", ["sma_20"], select({"sma_20": roll("avg", "close", 20)}))
add("bbands", ["bb_middle_20", "bb_upper_20", "bb_lower_20"], select({
    "bb_middle_20": roll("avg", "close", 20),
    "bb_upper_20": f"{roll('avg', 'close', 20)} + 2.0 * {roll('stddev_samp', 'close', 20)}",
    "bb_lower_20": f"{roll('avg', 'close', 20)} - 2.0 * {roll('stddev_samp', 'close', 20)}"}))
_ema20 = select({"ema_20": mean("a")}, inputs(), ema_chain([("a", "x.close", span(20))]), source="r")
add("ema", ["ema_20"], _ema20)
add("dema", ["dema_20"], select({"dema_20": f"2.0 * ({mean('a')}) - {mean('b')}"}, inputs(),
    ema_chain([("a", "x.close", span(20)), ("b", "@a", span(20))]), source="r"))
_tema20 = select({"tema_20": f"3.0 * ({mean('a')}) - 3.0 * ({mean('b')}) + {mean('c')}"}, inputs(),
    ema_chain([("a", "x.close", span(20)), ("b", "@a", span(20)), ("c", "@b", span(20))]), source="r")
add("tema", ["tema_20"], _tema20)
_wma = "(" + " + ".join([f"{20 - i}.0 * {lag('close', i) if i else 'close'}" for i in range(20)]) + ") / 210.0"
add("wma", ["wma_20"], select({"wma_20": _wma}))
add("wma", ["wma_20"], select({"wma_20": roll("avg", "close", 20)}), key="wma_mean", mode="mean")
add("midpoint", ["midpoint_14"], select({"midpoint_14": f"({roll('max', 'close', 14)} + {roll('min', 'close', 14)}) / 2"}))

_moves = inputs(up=f"CASE WHEN close > {lag('close')} THEN close - {lag('close')} ELSE 0.0 END",
                down=f"CASE WHEN close < {lag('close')} THEN {lag('close')} - close ELSE 0.0 END")
_rsi = f"100.0 - 100.0 / (1.0 + {div('up_s', 'down_s')})"
_rsi_states = wilder({"up_s": "x.up", "down_s": "x.down"}, 14)
_rsi14 = select({"rsi_14": _rsi}, _moves, _rsi_states, source="r")
add("rsi", ["rsi_14"], _rsi14)
add("rsi", ["rsi_14"], select({"rsi_14": f"CASE WHEN down_s = 0 AND up_s > 0 THEN 100.0 ELSE {_rsi} END"}, _moves, _rsi_states, source="r"),
    key="rsi_standard", mode="standard")
_macd = [("f", "x.close", span(12)), ("s", "x.close", span(26))]
def _macd_sql():
    qf, qs, qg = 1 - span(12), 1 - span(26), 1 - span(9)
    f1, fd1 = f"(x.close + {qf!r} * p.fn)", f"(1.0 + {qf!r} * p.fd)"
    s1, sd1 = f"(x.close + {qs!r} * p.sn)", f"(1.0 + {qs!r} * p.sd)"
    m1 = f"({f1} / {fd1} - {s1} / {sd1})"
    return recursion(
        {"fn": "x.close", "fd": "1.0", "sn": "x.close", "sd": "1.0", "m": "0.0", "gn": "0.0", "gd": "1.0"},
        {"fn": f1, "fd": fd1, "sn": s1, "sd": sd1, "m": m1, "gn": f"({m1} + {qg!r} * p.gn)", "gd": f"(1.0 + {qg!r} * p.gd)"})
add("macd", ["macd", "macd_signal", "macd_histogram"],
    select({"macd": "m", "macd_signal": "gn / gd", "macd_histogram": "m - gn / gd"}, inputs(), _macd_sql(), source="r"))

_k = f"k AS (SELECT *, 100.0 * {div(f'close - {roll('min', 'low', 14)}', f'{roll('max', 'high', 14)} - {roll('min', 'low', 14)}')} AS k FROM bars)"
add("stoch", ["stoch_k_14", "stoch_d_3"], select({"stoch_k_14": "k", "stoch_d_3": roll("avg", "k", 3)}, _k, source="k"))
add("willr", ["williams_r_14"], select({"williams_r_14":
    f"-100.0 * {div(f'{roll('max', 'high', 14)} - close', f'{roll('max', 'high', 14)} - {roll('min', 'low', 14)}')}"}))
_tp = "t AS (SELECT *, (high + low + close) / 3.0 AS tp FROM bars)"
_off = f"o AS (SELECT *, tp - {roll('avg', 'tp', 20)} AS off FROM t)"
add("cci", ["cci_20"], select({"cci_20": div("off", f"0.015 * {roll('avg', 'abs(off)', 20)}")}, _tp, _off, source="o"))
add("roc", ["roc_10"], select({"roc_10": f"100.0 * {div(f'close - {lag('close', 10)}', lag('close', 10))}"}))
add("mom", ["mom_10"], select({"mom_10": f"close - {lag('close', 10)}"}))
_sr1 = f"q AS (SELECT contract, ts, {_rsi} AS rsi FROM r)"
_sr2 = f"u AS (SELECT *, 100.0 * {div(f'rsi - {roll('min', 'rsi', 14)}', f'{roll('max', 'rsi', 14)} - {roll('min', 'rsi', 14)}')} AS raw FROM q)"
_sr3 = f"v AS (SELECT *, {roll('avg', 'raw', 3)} AS k FROM u)"
add("stochrsi", ["rsi_14", "stochrsi_k_3", "stochrsi_d_3"],
    select({"rsi_14": "rsi", "stochrsi_k_3": "k", "stochrsi_d_3": roll("avg", "k", 3)}, _moves, _rsi_states, _sr1, _sr2, _sr3, source="v"))

_trange = f"greatest(high - low, abs(high - {lag('close')}), abs(low - {lag('close')}))"
add("trange", ["trange"], select({"trange": _trange}))
_tr_in = inputs(tr=_trange)
add("atr", ["atr_14"], select({"atr_14": "s"}, _tr_in, wilder({"s": "x.tr"}, 14), source="r"))
add("natr", ["natr_14"], select({"natr_14": f"100.0 * {div('r.s', 'x.close')}"}, _tr_in, wilder({"s": "x.tr"}, 14),
    source="r JOIN x USING (contract, ts)"))
_up, _dn = f"(high - {lag('high')})", f"({lag('low')} - low)"
_dm = inputs(tr=_trange, up=f"CASE WHEN {_up} > {_dn} AND {_up} > 0 THEN {_up} ELSE 0.0 END",
             dn=f"CASE WHEN {_dn} > {_up} AND {_dn} > 0 THEN {_dn} ELSE 0.0 END")
def _adx_sql():
    a, q = 1 / 14, 1 - 1 / 14
    u, d, t = (f"({a!r} * x.{c} + {q!r} * p.{c}_s)" for c in ("up", "dn", "tr"))
    def dx(u, d, t):
        return f"100.0 * {div(f'abs({div(f'100.0 * {u}', t)} - {div(f'100.0 * {d}', t)})', f'{div(f'100.0 * {u}', t)} + {div(f'100.0 * {d}', t)}')}"
    return recursion({"up_s": "x.up", "dn_s": "x.dn", "tr_s": "x.tr", "adx": dx("x.up", "x.dn", "x.tr")},
                     {"up_s": u, "dn_s": d, "tr_s": t, "adx": f"({a!r} * ({dx(u, d, t)}) + {q!r} * p.adx)"})
_adx14 = select({"di_plus_14": f"100.0 * {div('up_s', 'tr_s')}", "di_minus_14": f"100.0 * {div('dn_s', 'tr_s')}", "adx_14": "adx"},
    _dm, _adx_sql(), source="r")
add("adx", ["di_plus_14", "di_minus_14", "adx_14"], _adx14)
_uo = f"u AS (SELECT *, close - least(low, {lag('close')}) AS bp, {_trange} AS tr FROM bars)"
add("ultosc", ["ultosc_7_14_28"], select({"ultosc_7_14_28": "100.0 * (" + " + ".join(
    f"{w}.0 * {div(roll('sum', 'bp', p), roll('sum', 'tr', p))}" for w, p in ((4, 7), (2, 14), (1, 28))) + ") / 7.0"}, _uo, source="u"))

_cum = f"OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_obv_in = f"o AS (SELECT *, CASE WHEN close > {lag('close')} THEN volume WHEN close < {lag('close')} THEN -volume ELSE 0 END AS step FROM bars)"
_obv = with_sql(WEEK_BARS_SQL, _obv_in) + f"SELECT contract, ts, CAST(sum(step) {_cum} AS BIGINT) AS obv FROM o"
add("obv", ["obv"], _obv)
_vwap = select({"vwap": f"sum((high + low + close) / 3.0 * volume) {_cum} / nullif(sum(volume) {_cum}, 0)"})
add("vwap", ["vwap"], _vwap)
add("vwap", ["vwap_20"], select({"vwap_20": f"{roll('sum', '((high + low + close) / 3.0 * volume)', 20)} / nullif({roll('sum', 'volume', 20)}, 0)"}),
    key="vwap_rolling", period=20)
_flow = "CASE WHEN high <> low THEN ((close - low) - (high - close)) / (high - low) * volume ELSE 0.0 END"
_ad = f"d AS (SELECT *, sum({_flow}) {_cum} AS ad FROM bars)"
add("ad", ["ad"], select({"ad": "ad"}, _ad, source="d"))
_ad_in = f"x AS MATERIALIZED (SELECT contract, ts, ad, row_number() OVER ({W}) - 1 AS rn FROM d)"
_adosc = select({"adosc_3_10": f"{mean('f')} - {mean('s')}"}, _ad, _ad_in,
    ema_chain([("f", "x.ad", span(3)), ("s", "x.ad", span(10))]), source="r")
add("adosc", ["adosc_3_10"], _adosc)

# The same operators with every history cut into short blocks must give the same rows.
for _key, _name, _out, _sql, _rows in [
    ("ema_split", "ema", ["ema_20"], _ema20, 60), ("rsi_split", "rsi", ["rsi_14"], _rsi14, 50),
    ("obv_split", "obv", ["obv"], _obv, 70), ("vwap_split", "vwap", ["vwap"], _vwap, 64),
    ("bbands_split", "bbands", ["bb_middle_20", "bb_upper_20", "bb_lower_20"], ORACLES["bbands"], 40),
]:
    add(_name, _out, _sql, key=_key, chunk=_rows)

# Means over columns with nulls: a chosen column with gaps, and the output of another indicator of the same call.
_gap_q = 1.0 - span(5)


def _gap_sql(value: str) -> str:
    live = "CASE WHEN x.g IS NULL THEN 0.0 ELSE 1.0 END"
    return select({"ema_5": "CASE WHEN g IS NOT NULL THEN n / d END"}, inputs(g=value), recursion(
        {"n": "coalesce(x.g, 0.0)", "d": live}, {"n": f"(coalesce(x.g, 0.0) + {_gap_q!r} * p.n)", "d": f"({live} + {_gap_q!r} * p.d)"}),
        source="x JOIN r USING (contract, ts)")


def _gaps(spark, sf):
    bars = week_bars(spark, sf).withColumn("gappy", F.when(F.col("volume") % 3 != 0, F.col("close")))
    return tidy(REGISTRY["ema"](bars, column="gappy", period=5, by="contract", order="ts", chunk=week_split(spark, sf)).select(*KEYS, "ema_5"), DIGITS)


def _chained(spark, sf):
    specs = [("ema", {"column": "sma_10", "period": 5}), ("sma", {"period": 10})]
    return tidy(with_indicators(week_bars(spark, sf), specs, by="contract", order="ts", chunk=week_split(spark, sf)).select(*KEYS, "ema_5"), DIGITS)


QUERIES["ema_with_gaps"], ORACLES["ema_with_gaps"] = _gaps, _gap_sql("CASE WHEN volume % 3 <> 0 THEN close END")
QUERIES["ema_of_sma"], ORACLES["ema_of_sma"] = _chained, _gap_sql(roll("avg", "close", 10))

_MANY = [("sma", {}), ("ema", {}), ("rsi", {}), ("atr", {}), ("obv", {})]


def _many(spark, sf):
    out = with_indicators(week_bars(spark, sf), _MANY, by="contract", order="ts", chunk=week_split(spark, sf))
    return tidy(out.select(*KEYS, "sma_20", "ema_20", "rsi_14", "atr_14", "obv"), DIGITS)


QUERIES["with_indicators"] = _many
_a = 1 / 14
ORACLES["with_indicators"] = with_sql(
    WEEK_BARS_SQL,
    inputs(up=f"CASE WHEN close > {lag('close')} THEN close - {lag('close')} ELSE 0.0 END",
           down=f"CASE WHEN close < {lag('close')} THEN {lag('close')} - close ELSE 0.0 END", tr=_trange,
           step=f"CASE WHEN close > {lag('close')} THEN volume WHEN close < {lag('close')} THEN -volume ELSE 0 END"),
    recursion({"n": "x.close", "d": "1.0", "up_s": "x.up", "down_s": "x.down", "tr_s": "x.tr"},
              {"n": f"(x.close + {1 - span(20)!r} * p.n)", "d": f"(1.0 + {1 - span(20)!r} * p.d)",
               **{f"{c}_s": f"({_a!r} * x.{c} + {1 - _a!r} * p.{c}_s)" for c in ("up", "down", "tr")}}),
) + f"""SELECT contract, ts, {r6(roll('avg', 'close', 20), DIGITS)} AS sma_20, {r6('n / d', DIGITS)} AS ema_20, {r6(_rsi, DIGITS)} AS rsi_14,
  {r6('tr_s', DIGITS)} AS atr_14, CAST(sum(step) {_cum} AS BIGINT) AS obv FROM x JOIN r USING (contract, ts)"""


# --- signals on hourly bars per event type --------------------------------------------------------------------------
