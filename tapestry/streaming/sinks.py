"""Running streams to tables and hooks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..session import scratch_dir


def append_to_table(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Append finished rows to a parquet folder, exactly once."""
    return stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(
        **(trigger or {"availableNow": True})
    ).start()


def on_event(stream: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", trigger: dict | None = None):
    """Call ``handler(rows, batch number)`` for every micro-batch (new bars, updates, alerts ..)."""
    return stream.writeStream.outputMode(mode).foreachBatch(handler).option("checkpointLocation", checkpoint).trigger(
        **(trigger or {"availableNow": True})
    ).start()


def drain(stream: DataFrame, label: str) -> DataFrame:
    """Process everything available of an append stream and read the result back."""
    spark = stream.sparkSession
    base = scratch_dir(spark, label)
    append_to_table(stream, f"{base}/rows", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")
