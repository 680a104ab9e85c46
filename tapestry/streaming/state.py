"""Stateful stream operators on Spark's own state store.

State is kept per key by Spark, checkpointed and restored with the query.  ``newest`` is a streaming aggregation; fills, alerts and
expiry step through the rows of a key in order, one micro-batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.history import names
from ..functions.joins import latest_state
from ..schemas import LONG
from ..session import scratch_dir


def _ddl(df: DataFrame, columns: Sequence[str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join(f"`{c}` {kinds[c]}" for c in columns)


def _in_order(frames: Iterator[pd.DataFrame], order: Sequence[str]) -> pd.DataFrame:
    return pd.concat(list(frames), ignore_index=True).sort_values(list(order), kind="stable", ignore_index=True)


def _nullable(frame: pd.DataFrame, kinds: dict[str, str]) -> pd.DataFrame:
    """Whole numbers with gaps as nullable integers, not as floats."""
    whole = {c: "Int64" for c in frame.columns if kinds.get(c) in ("bigint", "int", "smallint", "tinyint")}
    return frame.astype(whole)


def newest(stream: DataFrame, *, key, order) -> DataFrame:
    """Newest row per key (orders, positions, levels of a book); ``update`` mode emits the keys that changed."""
    key, order = names(key), names(order)
    rest = [c for c in stream.columns if c not in key and c not in order]
    extra = [c for c in order if c not in key]
    best = stream.groupBy(*key).agg(F.max(F.struct(*order, *rest)).alias("__s"))
    return best.select(*key, *[F.col(f"__s.{c}").alias(c) for c in stream.columns if c in rest or c in extra])


def fill_quotes(stream: DataFrame, *, by="contract", order=("ts", "seq")) -> DataFrame:
    """Carry the last known bid and ask across partial updates; the state of a contract is that pair."""
    by, order, kinds = names(by), names(order), dict(stream.dtypes)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = _in_order(frames, order)
        known = state.get if state.exists else (None, None)
        for c, last in zip(("bid", "ask"), known):
            filled = rows[c].astype("Float64").ffill()
            rows[c] = filled if last is None else filled.fillna(last)
        state.update(tuple(None if pd.isna(rows[c].iloc[-1]) else float(rows[c].iloc[-1]) for c in ("bid", "ask")))
        yield _nullable(rows, kinds)

    return stream.groupBy(*by).applyInPandasWithState(step, _ddl(stream, stream.columns), "bid double, ask double", "append", GroupStateTimeout.NoTimeout)


def alerts(stream: DataFrame, rules: DataFrame, *, by="contractId", order=("creationTimestamp", "id"), price="price") -> DataFrame:
    """First update of each contract that triggers its alert (see ``position_alerts``); a contract is raised once.

    The state of a contract is its last size and whether it was raised.
    """
    by, order = names(by), names(order)
    joined = stream.join(rules, by)
    kinds = dict(joined.dtypes)
    out = [*by, *order, "reason", "size", "size_change", "pnl"]
    schema = f"{_ddl(joined, [*by, *order])}, reason string, size {kinds['size']}, size_change {kinds['size']}, pnl double"

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, raised = state.get if state.exists else (None, False)
        rows = _in_order(frames, order)
        size = rows["size"].astype("float64")
        before = size.shift(1)
        if last is not None:
            before.iloc[0] = last
        change = size - before
        gap = (rows[price] - rows["averagePrice"]).where(rows["type"] == LONG, rows["averagePrice"] - rows[price])
        pnl = gap * size
        reason = pd.Series(None, index=rows.index, dtype=object)
        reason[pnl.abs() >= rows["pnl_threshold"].astype("float64")] = "pnl_threshold"
        reason[pnl >= rows["max_gain"].astype("float64")] = "max_gain"
        reason[pnl <= -rows["max_loss"].astype("float64")] = "max_loss"
        reason[change.notna() & (change != 0)] = "size_change"
        hit = reason.first_valid_index()
        state.update((float(size.iloc[-1]), bool(raised or hit is not None)))
        if hit is not None and not raised:
            found = rows.loc[[hit], [*by, *order, "size"]].assign(reason=reason[hit], size_change=change.fillna(0)[hit], pnl=pnl[hit])
            yield _nullable(found[out], kinds | {"size_change": kinds["size"]})

    return joined.groupBy(*by).applyInPandasWithState(step, schema, "last double, raised boolean", "append", GroupStateTimeout.NoTimeout)


def tracked(stream: DataFrame, *, key, order, ttl_seconds: float, delay: str = "0 seconds") -> DataFrame:
    """Newest row per key while it lives: rows with ``expired`` false on an update, and once true when the key has had no
    update for ``ttl_seconds`` of event time; its state is dropped then."""
    key, order = names(key), names(order)
    ts, columns, kinds = order[0], stream.columns, dict(stream.dtypes)
    ttl = int(ttl_seconds * 1000)

    def step(which: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, rows = state.get[0] if state.exists else None, None
        if not state.hasTimedOut:
            rows = _in_order(frames, order).tail(1)
            came = int(rows[ts].iloc[0].value // 1000)
            if at is None or at <= came:
                at = came
                yield _nullable(rows, kinds).assign(expired=False)
        # A key may come when its time is over: Spark takes no timeout before the watermark.
        if state.hasTimedOut or at // 1000 + ttl < state.getCurrentWatermarkMs():
            row = pd.DataFrame([dict(zip(key, which)) | {ts: pd.Timestamp(at, unit="us")}])
            state.remove()
            yield _nullable(row.reindex(columns=columns), kinds).assign(expired=True)
            return
        state.update((at,))
        state.setTimeoutTimestamp(at // 1000 + ttl)  # in every call: a call without it drops the timeout

    grouped = stream.withWatermark(ts, delay).groupBy(*key)
    schema = f"{_ddl(stream, columns)}, expired boolean"
    return grouped.applyInPandasWithState(step, schema, "at long", "update", GroupStateTimeout.EventTimeTimeout)


def drain_changes(stream: DataFrame, label: str, *, key, order) -> DataFrame:
    """Process everything available of an ``update`` stream and return the newest row of each key.

    Every micro-batch writes its changes to a folder of its own, so a batch that is run again replaces what it wrote.
    """
    spark, base, schema = stream.sparkSession, scratch_dir(stream.sparkSession, label), stream.schema

    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{base}/changes/batch={number}")

    query = stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return latest_state(spark.read.schema(schema).parquet(f"{base}/changes/batch=*"), key=key, order=order)
