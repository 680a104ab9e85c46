"""Readers and writers of bar and tick tables with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions.clock import wall, wall_date
from ..functions.checks import ParameterError
from ..functions.history import names, newest


def normalize_bars(wire: DataFrame, contract: str | None = None) -> DataFrame:
    """Wire bars (``t, o, h, l, c, v``) as a bar table in UTC."""
    key = F.lit(contract) if contract is not None else F.col("contract")
    return wire.select(
        key.alias("contract"), parse_iso(F.col("t")).alias("ts"), F.col("o").alias("open"), F.col("h").alias("high"), F.col("l").alias("low"),
        F.col("c").alias("close"), F.col("v").cast("bigint").alias("volume"),
    )


def normalize_ticks(wire: DataFrame, contract: str | None = None) -> DataFrame:
    """Wire ticks (``timestamp`` string) as a tick table."""
    key = F.lit(contract) if contract is not None else F.col("contract")
    rest = [c for c in wire.columns if c not in ("timestamp", "contract")]
    return wire.select(key.alias("contract"), parse_iso(F.col("timestamp")).alias("ts"), *rest)


def parse_iso(text):
    """ISO 8601 text, with offset or ``Z``, as a timestamp; null if unreadable."""
    return F.try_to_timestamp(text)


def _read(spark: SparkSession, path, schema: str, fmt: str) -> DataFrame:
    if fmt not in ("json", "parquet", "csv", "orc"):
        raise ParameterError(f"unknown format {fmt!r}")
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.format(fmt).load(path)


def read_bars(spark: SparkSession, path, fmt: str = "json", *, contract: str | None = None, wire: bool = True) -> DataFrame:
    """Bars from files: wire records, or tables written by :func:`write_bars`."""
    if not wire:
        return _read(spark, path, schemas.BARS, fmt)
    schema = schemas.BARS_WIRE if contract is not None else "contract string, " + schemas.BARS_WIRE
    return normalize_bars(_read(spark, path, schema, fmt), contract)


def read_ticks(spark: SparkSession, path, fmt: str = "json", *, contract: str | None = None, wire: bool = True) -> DataFrame:
    if not wire:
        return _read(spark, path, schemas.TICKS, fmt)
    schema = schemas.TICKS_WIRE if contract is not None else "contract string, " + schemas.TICKS_WIRE
    return normalize_ticks(_read(spark, path, schema, fmt), contract)


# Bars per day by unit code (1 second, 2 minute, 3 hour), as bars per unit interval of one day.
_UNIT_SECONDS = {1: 1, 2: 60, 3: 3600}


def row_limit(days: int, interval: int, unit: int) -> int:
    """Bars that ``days`` of a timeframe can hold; units beyond hours count like minutes."""
    if interval < 1 or days < 1:
        raise ParameterError("days and interval must be >= 1")
    return days * 86400 // (interval * _UNIT_SECONDS.get(unit, 60))


def date_range(df: DataFrame, asof, days: int, *, limit: int | None = None, by="contract", order="ts") -> DataFrame:
    """Rows of the last ``days`` before ``asof``; at most the newest ``limit`` per group."""
    ts = names(order)[0]
    end = F.lit(asof).cast("timestamp")
    start = F.timestamp_micros(F.unix_micros(end) - F.lit(days * 86_400_000_000))
    d = df.filter((F.col(ts) >= start) & (F.col(ts) <= end))
    return d if limit is None else newest(d, limit, by=by, order=order)


def write_table(df: DataFrame, path: str, *, partition_by=(), mode: str = "append", fmt: str = "parquet") -> None:
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*names(partition_by))
    writer.save(path)


def write_bars(df: DataFrame, path: str, *, ts: str = "ts", mode: str = "append") -> None:
    """Bars laid out by day, so that readers prune by time; rows of a day stay together per contract."""
    d = df.withColumn("date", wall_date(wall(F.col(ts).cast("timestamp"), "UTC")))
    # Rebalancing lets AQE split a day of a hot contract over several files and merge small ones.
    write_table(d.hint("rebalance", "date", "contract").sortWithinPartitions("date", "contract", ts), path, partition_by="date", mode=mode)


def write_series(df: DataFrame, name: str, *, by="contract", order="ts", buckets: int | None = None, mode: str = "overwrite", path: str | None = None) -> None:
    """Histories as a table of the warehouse (its files under ``path`` if given), dealt into buckets by contract and sorted in them.

    Windows and aggregations by contract over the table need no exchange, however often they run.  A contract lives in one
    bucket, so this layout is for many contracts of like size; ``write_bars`` spreads single hot ones.
    """
    spark, by, order = df.sparkSession, names(by), names(order)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # One file per bucket, so that its rows come back in order.
    dealt = df.repartition(buckets, *by).sortWithinPartitions(*by, *order)
    writer = dealt.write.mode(mode).format("parquet").bucketBy(buckets, *by).sortBy(*by, *order)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def read_series(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
