"""Wire messages (JSON text) to flat tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clock import instant
from ..schemas import EXCHANGE_TZ

QUOTE_FIELDS = "bestBid double, bid double, bestAsk double, ask double, lastPrice double, last double, price double, volume bigint, timestamp string"
TRADE_FIELDS = "price double, volume bigint, timestamp string"
DEPTH_FIELDS = "price double, volume bigint, type int, timestamp string"
ORDER_FIELDS = (
    "id bigint, accountId bigint, contractId string, creationTimestamp string, updateTimestamp string, status int, type int, side int, size int, "
    "fillVolume int, limitPrice double, stopPrice double"
)
POSITION_FIELDS = "id bigint, accountId bigint, contractId string, creationTimestamp string, type int, size int, averagePrice double"
ACCOUNT_FIELDS = "id bigint, name string, balance double, canTrade boolean, isVisible boolean, simulated boolean"


def unwrap(df: DataFrame, fields: str, payload: str = "payload") -> DataFrame:
    """``[{action, data}, ..]``, ``[{..}, ..]`` or ``{..}`` as one row per record with its ``action`` (null if bare)."""
    text = F.trim(F.col(payload))
    many, one = text.startswith("["), text.startswith("{")
    enveloped = F.from_json(text, f"array<struct<action: int, data: struct<{_colons(fields)}>>>")
    bare = F.from_json(text, f"array<struct<{_colons(fields)}>>")
    single_env = F.from_json(text, f"struct<action: int, data: struct<{_colons(fields)}>>")
    single = F.from_json(text, f"struct<{_colons(fields)}>")
    record = lambda action, data: F.struct(action.alias("action"), data.alias("data"))
    none = F.lit(None).cast("int")
    pairs = F.zip_with(enveloped, bare, lambda e, b: record(e["action"], F.coalesce(e["data"], b)))
    rows = F.when(many, pairs).when(one, F.array(record(F.coalesce(single_env["action"], none), F.coalesce(single_env["data"], single))))
    rest = [c for c in df.columns if c != payload]
    return df.withColumn("__r", F.explode(rows)).select(*rest, F.col("__r.action").alias("action"), "__r.data.*")


def _colons(fields: str) -> str:
    return ", ".join(f"`{f.split()[0]}`: {f.split()[1]}" for f in fields.split(", "))


def split_market(df: DataFrame, payload: str = "payload") -> DataFrame:
    """``[contract, data]`` or ``{contractId|contract_id, ..}`` as columns ``contract`` and ``data`` (JSON text)."""
    text = F.trim(F.col(payload))
    listed = text.startswith("[")
    parts = F.from_json(text, "array<string>")
    bare = F.coalesce(F.get_json_object(text, "$.contractId"), F.get_json_object(text, "$.contract_id"))
    rest = [c for c in df.columns if c != payload]
    return df.select(
        *rest, F.when(listed, F.get(parts, F.lit(0))).otherwise(bare).alias("contract"), F.when(listed, F.get(parts, F.lit(1))).otherwise(text).alias("data")
    ).filter(F.col("contract").isNotNull() & (F.col("contract") != ""))


def _or(*cols: Column) -> Column:
    """First value that is neither null nor 0; the last one as it is."""
    out = cols[-1]
    for c in reversed(cols[:-1]):
        out = F.when(c.isNotNull() & (c != 0), c).otherwise(out)
    return out


def parse_quotes(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Quote messages with their field aliases resolved: ``bid, ask, last, volume``."""
    d = split_market(df, payload).withColumn("q", F.from_json("data", f"struct<{_colons(QUOTE_FIELDS)}>"))
    q = lambda n: F.col(f"q.{n}")
    rest = [c for c in d.columns if c not in ("data", "q")]
    return d.select(
        *rest, _or(q("bestBid"), q("bid")).alias("bid"), _or(q("bestAsk"), q("ask")).alias("ask"),
        _or(q("lastPrice"), q("last"), q("price")).alias("last"), q("volume").alias("volume"),
    )


def parse_trades(df: DataFrame, arrival: str = "arrival_ts", payload: str = "payload") -> DataFrame:
    """Trade messages, one row per trade: ``price``, ``volume`` (missing: 0), time; trades without a price are left out."""
    d = split_market(df, payload)
    many = F.startswith(F.trim("data"), F.lit("["))
    one = F.array(F.from_json("data", f"struct<{_colons(TRADE_FIELDS)}>"))
    trades = F.when(many, F.from_json("data", f"array<struct<{_colons(TRADE_FIELDS)}>>")).otherwise(one)
    rest = [c for c in d.columns if c != "data"]
    return d.select(*rest, F.posexplode(trades).alias("nth", "t")).filter("t.price IS NOT NULL").select(
        *rest, F.col("nth").cast("long").alias("nth"), F.col("t.price").alias("price"), F.coalesce("t.volume", F.lit(0)).alias("volume"),
        depth_time(F.col("t.timestamp"), F.col(arrival)).alias("ts"), F.lit("trade").alias("type"),
    )


def parse_depth(df: DataFrame, arrival: str = "arrival_ts", payload: str = "payload") -> DataFrame:
    """Depth messages, one row per level update, numbered within the message."""
    d = split_market(df, payload)
    levels = F.from_json("data", f"array<struct<{_colons(DEPTH_FIELDS)}>>")
    rest = [c for c in d.columns if c != "data"]
    return d.select(*rest, F.posexplode(levels).alias("seq", "e")).select(
        *rest, F.col("seq").cast("long").alias("seq"), F.col("e.price").alias("price"), F.col("e.volume").alias("volume"), F.col("e.type").alias("type"),
        depth_time(F.col("e.timestamp"), F.col(arrival)).alias("ts"),
    )


def depth_time(text: Column, arrival: Column) -> Column:
    """Time of a depth entry; the arrival time if it is missing, unreadable or the empty-date sentinel.

    A time without an offset is the exchange's wall clock.
    """
    usable = F.when((text != "") & (text != "0001-01-01T00:00:00+00:00"), text)
    zoned = F.regexp_like(usable, F.lit(r"(Z|UTC|[+-]\d{2}(:?\d{2})?)$")) & F.contains(usable, F.lit(":"))
    naive = instant(usable.try_cast("timestamp_ntz"), EXCHANGE_TZ)
    return F.coalesce(F.when(zoned, F.try_to_timestamp(usable)).otherwise(naive), arrival)
