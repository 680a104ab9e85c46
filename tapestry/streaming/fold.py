"""Bounded side tables of a stream: the newest rows of each group, and rows that came too late.

What is kept between micro-batches is small (``keep`` rows per group, one time stamp) and alternates between two folders
by batch number: batch n reads what n-1 wrote and overwrites the other one, so a batch that is retried after a failure
starts from the same table again.  Per-key state of any size belongs in Spark's state store (see ``state``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..functions.history import newest
from ..operators.bars import timeframe_seconds
from ..session import scratch_dir

Step = Callable[[DataFrame, "DataFrame | None"], "tuple[DataFrame | None, DataFrame]"]


def fold(stream: DataFrame, step: Step, *, state_path: str, checkpoint: str, output: str | None = None, hooks=(), trigger: dict | None = None):
    """Start ``step(batch, state) -> (rows to emit, next state)`` on a stream.

    ``output``: folder for the emitted rows, one sub-folder per batch; ``hooks``: functions called with (rows, batch number).
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        state = spark.read.parquet(f"{state_path}/slot={(number - 1) % 2}") if number > 0 else None
        rows, following = step(batch, state)
        following.write.mode("overwrite").parquet(f"{state_path}/slot={number % 2}")
        if rows is not None and output is not None:
            rows.write.mode("overwrite").parquet(f"{output}/batch={number}")
        for hook in hooks:
            hook(rows, number)

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def current_state(spark, state_path: str, last_batch: int) -> DataFrame:
    """State table after ``last_batch``."""
    return spark.read.parquet(f"{state_path}/slot={last_batch % 2}")


def _with(state: DataFrame | None, batch: DataFrame) -> DataFrame:
    return batch if state is None else state.unionByName(batch, allowMissingColumns=True)


def rolling_retention(*, keep: int, by, order) -> Step:
    """Newest ``keep`` rows per group, as the live tables retain them."""

    def step(batch, state):
        kept = newest(_with(state, batch), keep, by=by, order=order)
        return None, kept

    return step


def late_step(timeframe: str, *, delay_seconds: float = 0, ts: str = "ts") -> Step:
    """Ticks that come too late for their bar, for a side table.

    A bar is closed once the newest time of the earlier batches, less the delay, has reached its end.  The windowed
    operators drop such rows silently (Spark may still accept one in the batch right after).  The state is that one
    time stamp.
    """
    width = timeframe_seconds(timeframe) * 1_000_000

    def step(batch, state):
        newest_before = None if state is None else state.first()["newest"]
        if newest_before is None:
            return batch.limit(0), batch.agg(F.max(F.unix_micros(ts)).alias("newest"))
        closed = newest_before - int(delay_seconds * 1_000_000)
        end = (F.floor(F.unix_micros(ts) / F.lit(width)) + 1) * F.lit(width)
        return batch.filter(end <= closed), batch.agg(F.greatest(F.max(F.unix_micros(ts)), F.lit(newest_before)).alias("newest"))

    return step


def run_to_end(stream: DataFrame, step: Step, label: str, hooks=()) -> tuple[DataFrame | None, DataFrame]:
    """Process everything available and return (all emitted rows or None, final state)."""
    spark = stream.sparkSession
    base = scratch_dir(spark, label)
    schema: dict = {}

    def remember(batch, state):
        rows, following = step(batch, state)
        if rows is not None:
            schema["rows"] = rows.schema
        return rows, following

    query = fold(stream, remember, state_path=f"{base}/state", checkpoint=f"{base}/checkpoint", output=f"{base}/rows", hooks=hooks)
    query.awaitTermination()
    progress = query.lastProgress
    rows = spark.read.schema(schema["rows"]).parquet(f"{base}/rows/batch=*") if "rows" in schema else None
    return rows, current_state(spark, f"{base}/state", progress["batchId"])
