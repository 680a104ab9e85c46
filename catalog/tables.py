"""The given tables read as market tables, for Spark and for the oracle.

Each ``*_SQL`` string is a list of CTEs that DuckDB evaluates to the same rows as the function next to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapestry.functions.history import Split, plan_split
from tapestry.operators.bars import bars


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _nudge(digits: int) -> float:
    """Shift far below the last printed digit: decimal halves (x.xx5) then round the same way in both engines."""
    return float(f"3e-{digits + 3}")


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double so that both engines print the same digits, and turn -0.0 into 0.0."""
    return df.select(
        *[
            (F.round(F.col(f"`{c}`") + F.lit(_nudge(digits)), digits) + F.lit(0.0)).alias(c) if t in ("double", "float") else F.col(f"`{c}`")
            for c, t in df.dtypes
        ]
    )


def r6(expr: str, digits: int = 6) -> str:
    return f"(round(CAST({expr} AS DOUBLE) + {_nudge(digits)!r}, {digits}) + 0.0)"


def with_sql(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


# --- ticks: one contract per event type -------------------------------------------------------------------

TICK_ORDER = ["ts", "seq"]


def ticks(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_type").alias("contract"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"),
        F.col("value").alias("price"), F.get_json_object("props", "$.k").cast("long").alias("volume"),
    )


TICKS_SQL = r"""ticks AS (
  SELECT event_type AS contract, ts, event_id AS seq, value AS price,
         CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS volume FROM events)"""


def hour_bars(spark, sf):
    return bars(ticks(spark, sf), "1hr", by="contract", order=TICK_ORDER)


def bars_sql(name: str, source: str, start: str, order: str) -> str:
    return f"""{name} AS (
  SELECT contract, {start} AS ts, first(price ORDER BY {order}) AS open, max(price) AS high, min(price) AS low,
         last(price ORDER BY {order}) AS close,
         CAST(greatest(sum(volume) + CASE WHEN first(volume ORDER BY {order}) <= 0
              THEN 1 - first(volume ORDER BY {order}) ELSE 0 END, 1) AS BIGINT) AS volume
  FROM {source} GROUP BY contract, {start})"""


HOUR_BARS_SQL = TICKS_SQL + ",\n" + bars_sql("bars", "ticks", "time_bucket(INTERVAL 1 HOUR, ts)", "ts, seq")


# --- trades: one contract per supplier ----------------------------------------------------------------------

# Order and line number, with the part as a last tiebreak, in one integer (fits up to 10^12 orders).
TRADE_ORDER = ["ts", "seq"]


def lots(spark, sf):
    seq = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * (1 << 20) + F.col("l_partkey") % (1 << 20)
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("contract"), F.col("l_shipdate").cast("timestamp").alias("ts"), seq.alias("seq"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").cast("long").alias("volume"),
        "l_partkey", "l_extendedprice", "l_returnflag", "l_linestatus",
    )


LOTS_SQL = """lots AS (
  SELECT l_suppkey AS contract, l_shipdate AS ts, (l_orderkey * 8 + l_linenumber) * 1048576 + l_partkey % 1048576 AS seq,
         l_extendedprice / l_quantity AS price, CAST(l_quantity AS BIGINT) AS volume,
         l_partkey, l_extendedprice, l_returnflag, l_linestatus FROM lineitem)"""


def week_bars(spark, sf):
    return bars(lots(spark, sf), "1week", by="contract", order=TRADE_ORDER, tz="UTC")


def cut(rows: int) -> Split:
    """Cut histories into blocks of a few rows and a dozen ranges, as very long ones would be."""
    return Split(rows, 12)


def week_split(spark, sf) -> Split:
    """How to cut the weekly bars, measured on the slim trade columns instead of on the aggregated bars."""
    return plan_split(lots(spark, sf), "contract", "ts", "auto", bar_seconds=7 * 86400)


def hour_split(spark, sf) -> Split:
    return plan_split(ticks(spark, sf), "contract", "ts", "auto", bar_seconds=3600)


WEEK_BARS_SQL = LOTS_SQL + ",\n" + bars_sql("bars", "lots", "CAST(date_trunc('week', ts) AS TIMESTAMP)", ", ".join(TRADE_ORDER))


# --- depth: ten contracts, quarter-point prices -----------------------------------------------------------------

DEPTH_TYPES = {"view": 1, "click": 2, "purchase": 5, "signup": 9, "error": 10}


def depth(spark, sf):
    kind = F.col("event_type")
    code = F.lit(None).cast("int")
    for name, v in DEPTH_TYPES.items():
        code = F.when(kind == name, v).otherwise(code)
    return table(spark, sf, "events").select(
        (F.col("user_id") % 10).alias("contract"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"),
        (F.round(F.col("value") * 4) / 4).alias("price"), F.get_json_object("props", "$.k").cast("long").alias("volume"),
        code.alias("type"),
    )


DEPTH_SQL = r"""depth AS (
  SELECT user_id % 10 AS contract, ts, event_id AS seq, round(value * 4) / 4 AS price,
         CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS volume,
         CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 5 WHEN 'signup' THEN 9
              WHEN 'error' THEN 10 END AS type FROM events)"""
