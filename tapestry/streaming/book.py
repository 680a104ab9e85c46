"""A live order book with routing of changes: a map of live levels per contract in Spark's state store."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.history import names
from ..operators.book import ORDER, _mid, new_book
from ..schemas import DEPTH_ASK, DEPTH_BID, DEPTH_CHANGES, DEPTH_TRADE

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def map_state(spark: SparkSession):
    """Start queries with map state inside: they need the store that can look up single entries."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


class RouteChanges(StatefulProcessor):
    """Places changes by the mid of the book so far and compares trades with it, as ``route_depth_exact`` does on tables.

    The state of a contract is the volume of each live level; a level that dies leaves it, so it holds no more than the book.
    A micro-batch reads it once and writes the levels that changed.
    """

    def __init__(self, order: list[str], columns: list[str]):
        self.order, self.columns = order, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.levels = handle.getMapState("levels", "side string, price double", "volume long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        book = new_book()
        for (side, price), (volume,) in self.levels.iterator():
            book[side].put(price, volume)
        frame = pd.concat(list(rows), ignore_index=True).sort_values(self.order, kind="stable", ignore_index=True)
        at, told, changed = [], [], set()
        for i, (code, price, volume) in enumerate(zip(*(frame[c].tolist() for c in ("type", "price", "volume")))):
            if code in (DEPTH_BID, DEPTH_ASK):
                sides, label = ["bid" if code == DEPTH_BID else "ask"], ""
            elif code in DEPTH_CHANGES:
                mid, label = _mid(book), f"_mod_{int(code)}"
                sides = ["bid", "ask"] if not mid or price == 0 else ["bid"] if price <= mid else ["ask"]
            elif code == DEPTH_TRADE and volume > 0:
                at.append(i)
                told.append(("trade", "trade", book["bid"].best(), book["ask"].best()))
                continue
            else:
                continue
            for side in sides:
                book[side].put(price, int(volume) if volume == volume else None)
                changed.add((side, price))
                at.append(i)
                told.append((side, side + label, None, None))
        for side, price in changed:
            if price == price:
                if price in book[side].live:
                    self.levels.updateValue((side, price), (book[side].live[price],))
                else:
                    self.levels.removeKey((side, price))
        out = frame.loc[at, self.columns].reset_index(drop=True)
        yield out.join(pd.DataFrame(told, columns=["side", "type", "best_bid", "best_ask"]).astype({"best_bid": "float64", "best_ask": "float64"}))

    def close(self) -> None:
        pass


def route_depth_stream(depth: DataFrame, *, by="contract", order=ORDER) -> DataFrame:
    """Routed updates of a stream of depth rows, whose micro-batches come in time order; run it inside ``map_state``."""
    by, order = names(by), names(order)
    columns = [*by, *order, "price", "volume"]
    schema = T.StructType([depth.schema[c] for c in columns]).add("side", "string").add("type", "string").add("best_bid", "double").add("best_ask", "double")
    return depth.groupBy(*by).transformWithStateInPandas(
        statefulProcessor=RouteChanges(order, columns), outputStructType=schema, outputMode="Append", timeMode="None"
    )
