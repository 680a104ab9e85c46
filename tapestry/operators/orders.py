"""Order events: latest state, open orders, fills, statistics, and price and symbol helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.history import names
from ..functions.joins import dimension_join, latest_state
from ..schemas import ORDER_FILLED, ORDER_LIMIT, ORDER_OPEN, ORDER_STOP

# Contract id formats.
FULL_ID = r"^CON\.F\.US\.([A-Z]{2,4})\.[FGHJKMNQUVXZ]\d{2}$"
SIMPLE_ID = r"^[A-Z]{2,4}$"


def latest_orders(events: DataFrame, *, key="id", order=("updateTimestamp", "seq")) -> DataFrame:
    """Newest state per order."""
    return latest_state(events, key=key, order=order)


def open_orders(orders: DataFrame, contract: str | None = None, account: int | None = None) -> DataFrame:
    """Working orders, optionally of one contract or account."""
    d = orders.filter(F.col("status") == ORDER_OPEN)
    if contract is not None:
        d = d.filter(F.col("contractId") == contract)
    return d if account is None else d.filter(F.col("accountId") == account)


def stop_and_target(orders: DataFrame, *, by="contractId", order=("updateTimestamp", "id")) -> DataFrame:
    """Newest working stop and limit order per contract, with their prices."""
    at = F.struct(*names(order))
    pick = lambda kind, col: F.max_by(F.when(F.col("type") == kind, F.struct("id", F.col(col).alias("price"))), F.when(F.col("type") == kind, at))
    d = orders.filter(F.col("status") == ORDER_OPEN).groupBy(*names(by)).agg(pick(ORDER_STOP, "stopPrice").alias("s"), pick(ORDER_LIMIT, "limitPrice").alias("t"))
    return d.select(
        *names(by), F.col("s.id").alias("stop_order_id"), F.col("s.price").alias("stop_price"), F.col("t.id").alias("target_order_id"),
        F.col("t.price").alias("target_price"),
    ).filter(F.col("stop_order_id").isNotNull() | F.col("target_order_id").isNotNull())


def filled_orders(orders: DataFrame, fills: DataFrame) -> DataFrame:
    """Orders that are marked filled or have a fill event (``orderId``)."""
    marked = orders.filter(F.col("status") == ORDER_FILLED)
    reported = orders.filter((F.col("status") != ORDER_FILLED) | F.col("status").isNull()).join(
        fills.select(F.col("orderId").alias("id")), "id", "left_semi"
    )
    return marked.unionByName(reported)


def unfilled_orders(orders: DataFrame, fills: DataFrame) -> DataFrame:
    """Orders neither marked filled nor reported by a fill event."""
    return orders.filter((F.col("status") != ORDER_FILLED) | F.col("status").isNull()).join(
        fills.select(F.col("orderId").alias("id")), "id", "left_anti"
    )


def order_stats(orders: DataFrame, *, by="accountId") -> DataFrame:
    """Counts by status and kind, newest update, and filled share of the ordered size."""
    return orders.groupBy(*names(by)).agg(
        F.count(F.lit(1)).alias("orders"), *[F.count_if(F.col("status") == s).alias(f"status_{s}") for s in range(5)],
        *[F.count_if(F.col("type") == k).alias(f"type_{k}") for k in (1, 2, 4, 5, 6, 7)],
        F.max("updateTimestamp").alias("last_update"), F.try_divide(F.sum("fillVolume").cast("double"), F.sum("size").cast("double")).alias("fill_ratio"),
    )


def expire_events(events: DataFrame, asof, hours: float = 24, *, ts="ts") -> DataFrame:
    """Drop events older than the retention before ``asof``."""
    cutoff = F.timestamp_micros(F.unix_micros(F.lit(asof).cast("timestamp")) - F.lit(int(hours * 3_600_000_000)))
    return events.filter(F.col(ts) >= cutoff)


# --- prices -------------------------------------------------------------------------------------------------


def align_half_up(price: Column, tick: Column) -> Column:
    """Nearest multiple of the tick in decimal arithmetic, halves away from zero; unusable ticks leave the price."""
    p, t = price.cast("decimal(20,8)"), tick.cast("decimal(20,8)")
    return F.when(tick > 0, (F.round(F.try_divide(p, t)) * t).cast("double")).otherwise(price)


def align_half_even(price: Column, tick: Column) -> Column:
    """Nearest multiple of the tick in floating point, halves to even."""
    return F.when(tick > 0, F.bround(F.try_divide(price, tick)) * tick).otherwise(price)


def align_to_tick(df: DataFrame, instruments: DataFrame, *, price="price", contract="contract", mode: str = "half_up") -> DataFrame:
    """Replace ``price`` by the nearest valid one of its contract's tick size (matched on the symbol)."""
    ticks = instruments.select(F.col("name").alias("__symbol"), F.col("tickSize").alias("__tick"))
    d = dimension_join(df.withColumn("__symbol", contract_symbol(F.col(contract))), ticks, "__symbol")
    fn = align_half_up if mode == "half_up" else align_half_even
    return d.withColumn(price, F.coalesce(fn(F.col(price), F.col("__tick")), F.col(price))).drop("__symbol", "__tick")


def tick_value(change: Column, tick_size: Column, value: Column) -> Column:
    """Currency value of a price change."""
    return F.when(tick_size > 0, F.try_divide(F.abs(change), tick_size) * value).otherwise(0.0)


def notional(size: Column, price: Column, tick_size: Column, value: Column) -> Column:
    """Currency value of a position."""
    return F.when(tick_size > 0, F.abs(size) * price * F.try_divide(F.lit(1.0), tick_size) * value).otherwise(0.0)


# --- symbols ------------------------------------------------------------------------------------------------


def valid_contract(contract: Column) -> Column:
    return F.coalesce(contract.rlike(FULL_ID) | contract.rlike(SIMPLE_ID), F.lit(False))


def contract_symbol(contract: Column) -> Column:
    """Base symbol of a full contract id, a bare symbol itself, else null."""
    return F.when(contract.rlike(SIMPLE_ID), contract).when(contract.rlike(FULL_ID), F.regexp_extract(contract, FULL_ID, 1))


def find_instruments(instruments: DataFrame, text: str) -> DataFrame:
    """Instruments whose id, name or description holds ``text`` (any case)."""
    t = F.lit(text.lower())
    return instruments.filter(
        F.contains(F.lower("id"), t) | F.contains(F.lower("name"), t) | F.contains(F.lower("description"), t)
    )


def find_instrument(instruments: DataFrame, text: str) -> DataFrame:
    """First match by id, as a one-row table."""
    return find_instruments(instruments, text).orderBy("id").limit(1)
