"""Ordered computations over long per-contract histories.

Every operator works on rows ordered inside a group (``by``), usually one contract.  A plain
``Window.partitionBy(by)`` puts a whole group into one task, which does not hold when a single contract
owns a large share of the data.  Two kernels keep the group size bounded:

``over_history``  for look-back / look-ahead computations.  Rows get their global position, the history
    is cut into blocks of consecutive positions, and each block receives copies of the few neighbouring
    rows its frames reach into.  The window partition is then ``by + block``.
``running``       for unbounded prefixes (sum, max, last known value, previous row).  Ranges of the whole order, cut at
    sampled quantiles, are scanned on their own; the state before a range comes from the last rows of the ranges.

Whether ``over_history`` cuts is decided by measuring the largest group (one column-pruned count); groups that fit use
the single-shuffle plain form, with the same results.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from . import prefix
from ..session import settle

# Rows one window group may hold before its history is split (override per session).
MAX_GROUP_ROWS = 1_000_000
MAX_GROUP_ROWS_CONF = "tapestry.maxGroupRows"

RN, BLK, BUCKET, SUB, K = "__rn", "__blk", "__bucket", "__sub", "__k"


@dataclass(frozen=True)
class Split:
    """How to cut a history: ``rows`` per block, number of ``ranges`` of the whole order (None: do not cut).

    ``null_keys``: some group key is null, so state must be joined null-safely (at the price of another shuffle).
    ``largest``, ``total``: measured rows of the largest group and of all (0 if nothing was measured).
    """

    rows: int
    ranges: int | None
    null_keys: bool = False
    largest: int = 0
    total: int = 0

    def settle(self, df: DataFrame) -> DataFrame:
        """Write ``df`` out before it is scanned again, if histories are cut (every prefix scan reads it twice)."""
        return df if self.ranges is None else settle(df)


def names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def order_key(df: DataFrame, order: Sequence[str]) -> Column | None:
    """One number in the order of a time (and an integer tiebreak), null first; None if the columns are of other types.

    Numbers can be compared inside hash aggregation, records only after a sort.
    """
    kinds = dict(df.dtypes)
    whole = ("tinyint", "smallint", "int", "bigint")
    if len(order) > 2 or kinds.get(order[0]) not in ("timestamp", *whole) or any(kinds.get(c) not in whole for c in order[1:]):
        return None
    first = F.unix_micros(order[0]) if kinds[order[0]] == "timestamp" else F.col(order[0]).cast("long")
    if len(order) == 1:
        return first
    if kinds[order[0]] != "timestamp":
        return None  # two full 64-bit numbers do not fit
    lowest = F.lit(-(1 << 62))
    wide = F.lit("18446744073709551616").cast("decimal(20,0)")
    return F.coalesce(first, lowest).cast("decimal(19,0)") * wide + F.coalesce(F.col(order[1]).cast("long"), F.lit(-(1 << 63))).cast("decimal(19,0)")


def row_limit(spark: SparkSession, chunk) -> int:
    if chunk == "auto":
        return int(spark.conf.get(MAX_GROUP_ROWS_CONF, str(MAX_GROUP_ROWS)))
    return int(chunk)


def ranges_of(spark: SparkSession, total: int, rows: int) -> int:
    """Ranges of ``rows`` rows, but no more than shuffle partitions while those stay within the session limit: each is a task.

    Blocks may be much smaller than ranges, as they only group rows.
    """
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / row_limit(spark, "auto")))
    return max(1, min(math.ceil(total / rows), most))


def plan_split(df: DataFrame, by, order, chunk="auto", bar_seconds: float | None = None) -> Split:
    """Measure ``df`` and say how its groups must be cut.

    ``chunk``: ``"auto"`` (session limit), an int (rows per group), ``None`` (never cut) or a ready ``Split``.
    ``bar_seconds``: ``df`` holds ticks of which only one bar per interval will be processed.
    """
    if isinstance(chunk, Split):
        return chunk
    if chunk is None:
        return Split(0, None)
    by, ts = names(by), names(order)[0]
    limit = row_limit(df.sparkSession, chunk)
    n = F.count(F.lit(1))
    if bar_seconds:
        n = F.least(n, ((F.max("__us") - F.min("__us")) / (bar_seconds * 1e6)).cast("long") + 2)
    slim = df.select(*by, micros(ts).alias("__us"))
    groups = slim.groupBy(*by).agg(n.alias("n"), (F.max("__us") - F.min("__us") + 1).alias("span"))
    unnamed = F.lit(False)
    for c in by:
        unnamed = unnamed | F.col(c).isNull()
    worst = groups.agg(F.max("n").alias("n"), F.max(unnamed).alias("nulls"), F.sum("n").alias("total")).first()
    if worst.n is None or worst.n <= limit:
        return Split(limit, None, False, worst.n or 0, worst.total or 0)
    return Split(limit, ranges_of(df.sparkSession, worst.total, limit), bool(worst.nulls), worst.n, worst.total)


def same_keys(left: DataFrame, right: DataFrame, on: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Left join on equally named keys; plain equality keeps the partitioning the windows already have."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns])
    pairs = [left[c].eqNullSafe(renamed[f"__r_{c}"]) if null_safe else left[c] == renamed[f"__r_{c}"] for c in on]
    return left.join(renamed, reduce(lambda a, b: a & b, pairs), "left").drop(*[f"__r_{c}" for c in on])


# ---------------------------------------------------------------------------------------------------------
# prefix scans


def range_count(df: DataFrame, chunk) -> int:
    """Number of ranges: one per shuffle partition, unless ``chunk`` asks for ranges of so many rows or is a ready ``Split``."""
    if isinstance(chunk, int):
        return max(1, math.ceil(df.count() / chunk))
    wanted = chunk.ranges if isinstance(chunk, Split) else None
    return wanted or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def running(
    df: DataFrame,
    *,
    by,
    order,
    chunk="auto",
    sums: Mapping[str, Column] | None = None,
    peaks: Mapping[str, str] | None = None,
    maxes: Mapping[str, Column] | None = None,
    reigns: Mapping[str, str] | None = None,
    lasts: Mapping[str, Column] | None = None,
    prevs: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add running values to every row.

    ``sums``/``maxes``: prefix sum / maximum including the row; ``peaks``: highest value so far of a named sum; ``reigns``: a
    number pair that stays the same from one row at the named maximum to the next such row; ``lasts``: last non-null value up
    to and including the row; ``prevs``: value of the row before (null on the first).

    One shuffle, at every size: rows are dealt into ranges of the whole order (group, time, tiebreak) at sampled quantiles, even
    whatever the times are, and scanned there one after the other.  A range only lacks what came before it of its first
    group; the last rows of all ranges, one per range, tell it.  The ranges are written out, so that a lost executor
    cannot cut them anew, and the table that comes back is the written one with that carry added.
    """
    by, order = names(by), names(order)
    sums, peaks, maxes, reigns, lasts, prevs = (dict(m or {}) for m in (sums, peaks, maxes, reigns, lasts, prevs))
    given = sums | maxes | lasts | prevs
    dealt = df.repartitionByRange(range_count(df, chunk), *by, *order).sortWithinPartitions(*by, *order)
    kinds = {f.name: f.dataType for f in df.select(*[c.alias(n) for n, c in given.items()]).schema}
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    for n in (*sums, *maxes):
        kinds[n] = T.LongType() if isinstance(kinds[n], whole) else T.DoubleType()
    plain = [c for c in df.columns if c not in given and c not in peaks and c not in reigns]
    dealt = dealt.select(*plain, F.spark_partition_id().alias(BUCKET), *[c.cast(kinds[n]).alias(f"__x_{n}") for n, c in given.items()])
    peak_of, reign_of = {s: n for n, s in peaks.items()}, {m: n for n, m in reigns.items()}
    scans = [prefix.running_sum(f"__l_{n}", f"__x_{n}", f"__l_{peak_of[n]}" if n in peak_of else None) for n in sums]
    scans += [prefix.running_max(f"__l_{n}", f"__x_{n}", f"__l_{reign_of[n]}" if n in reign_of else None) for n in maxes]
    scans += [prefix.running_last(f"__l_{n}", f"__x_{n}") for n in lasts] + [prefix.previous(f"__l_{n}", f"__x_{n}") for n in prevs]
    local = {n: kinds[n] for n in given} | {n: kinds[s] for n, s in peaks.items()} | {n: T.LongType() for n in reigns}
    schema = T.StructType([dealt.schema[c] for c in (*plain, BUCKET)])
    for n, kind in [(f"__l_{n}", k) for n, k in local.items()] + [(f"__x_{n}", kinds[n]) for n in prevs]:
        schema = schema.add(n, kind)
    schema = schema.add(prefix.AT_START, "boolean").add(prefix.AT_END, "boolean")
    ranged = settle(dealt.mapInArrow(prefix.scanner(by, scans, schema.names), schema), "ranges")

    # From here on one row per range.
    ends = ranged.filter(prefix.AT_END)
    here = Window.partitionBy(*by).orderBy(BUCKET)
    before, upto = here.rowsBetween(Window.unboundedPreceding, -1), here.rowsBetween(Window.unboundedPreceding, 0)
    carry = {n: F.sum(f"__l_{n}").over(upto) for n in sums} | {n: F.max(f"__l_{n}").over(upto) for n in maxes}
    carry |= {n: F.last(f"__l_{n}", ignorenulls=True).over(upto) for n in lasts} | {n: F.col(f"__x_{n}") for n in prevs}
    steps = {f"__h_{n}": F.coalesce(F.sum(f"__l_{s}").over(before), F.lit(0)) + F.col(f"__l_{n}") for n, s in peaks.items()}
    steps |= {f"__h_{n}": _reign(f"__l_{m}", F.max(f"__l_{m}").over(before), f"__l_{n}", F.lit(None)) for n, m in reigns.items()}
    carry |= {n: F.max(f"__h_{n}").over(upto) for n in peaks} | {n: F.last(f"__h_{n}", ignorenulls=True).over(upto) for n in reigns}
    following = F.lead(BUCKET).over(Window.orderBy(BUCKET))
    carries = ends.withColumns(steps).select(
        *[F.col(c).alias(f"__r_{c}") for c in by], following.alias("__r_bucket"), *[c.alias(f"__c_{n}") for n, c in carry.items()], F.lit(True).alias("__carried")
    )
    match = reduce(lambda a, b: a & b, [ranged[c].eqNullSafe(carries[f"__r_{c}"]) for c in by], ranged[BUCKET] == carries["__r_bucket"])
    joined = ranged.join(F.broadcast(carries), match, "left")
    own, brought = (lambda n: F.col(f"__l_{n}")), (lambda n: F.col(f"__c_{n}"))
    out = {n: F.coalesce(own(n) + brought(n), own(n), brought(n)) for n in sums}
    out |= {n: F.greatest(F.coalesce(brought(s), F.lit(0)) + own(n), brought(n)) for n, s in peaks.items()}
    out |= {n: F.greatest(own(n), brought(n)) for n in maxes} | {n: F.coalesce(own(n), brought(n)) for n in lasts}
    out |= {n: _reign(f"__l_{m}", brought(m), f"__l_{n}", brought(n)) for n, m in reigns.items()}
    out |= {n: F.when(F.col(prefix.AT_START) & F.col("__carried"), brought(n)).otherwise(own(n)) for n in prevs}
    return joined.select(*plain, *[c.alias(n) for n, c in out.items()])


def _reign(high: str, earlier: Column, count: str, inherited: Column) -> Column:
    """Which row at the maximum reigns: the range's own, unless an earlier range went higher."""
    pair = F.struct(F.col(BUCKET).alias("range"), F.col(count).alias("at"))
    return F.when(earlier.isNotNull() & (F.col(high).isNull() | (F.col(high) < earlier)), inherited).otherwise(pair)


def number_rows(df: DataFrame, *, by, order, chunk="auto", name: str = RN) -> DataFrame:
    """Zero-based position of each row in its group's order."""
    out = running(df, by=by, order=order, chunk=chunk, sums={name: F.lit(1)})
    return out.withColumn(name, F.col(name) - 1)


def newest(df: DataFrame, n: int = 1, *, by, order) -> DataFrame:
    """Newest ``n`` rows per group.

    Spark turns the ``row_number <= n`` filter into a per-task limit before the shuffle, so a hot group sends
    at most ``n`` rows per task; that holds for any n once the session threshold admits it.
    """
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n <= threshold:
        w = Window.partitionBy(*names(by)).orderBy(*[F.desc(c) for c in names(order)])
        return df.withColumn(RN, F.row_number().over(w)).filter(F.col(RN) <= n).drop(RN)
    totals = df.groupBy(*names(by)).agg(F.count(F.lit(1)).alias("__n"))
    numbered = number_rows(df, by=by, order=order)
    return same_keys(numbered, totals, names(by), True).filter(F.col(RN) >= F.col("__n") - n).drop(RN, "__n")


# ---------------------------------------------------------------------------------------------------------
# bounded look-back / look-ahead


class Timeline:
    """Window specifications for one group order; ``keys`` are the columns that bound a window partition."""

    def __init__(self, by: list[str], order: list[str], keys: list[str], split: tuple[int, int] | None = None, null_keys: bool = False):
        self.by, self.order, self.keys, self.split, self.null_keys = by, list(order), keys, split, null_keys

    @property
    def w(self):
        return Window.partitionBy(*self.keys).orderBy(*self.order)

    def frame(self, lo: int, hi: int = 0):
        return self.w.rowsBetween(lo, hi)

    def lag(self, x, n: int = 1) -> Column:
        return F.lag(x, n).over(self.w)

    def lead(self, x, n: int = 1) -> Column:
        return F.lead(x, n).over(self.w)

    def roll(self, fn: Callable[[Column], Column], x, period: int) -> Column:
        """Aggregate of the newest ``period`` rows; null until that many non-null rows exist."""
        x = F.col(x) if isinstance(x, str) else x
        f = self.frame(-(period - 1))
        return F.when(F.count(x).over(f) == period, fn(x).over(f))

    def mean(self, x, period):
        return self.roll(F.avg, x, period)

    def high(self, x, period):
        return self.roll(F.max, x, period)

    def low(self, x, period):
        return self.roll(F.min, x, period)

    def total(self, x, period):
        return self.roll(F.sum, x, period)

    def std(self, x, period):
        return self.roll(F.stddev_samp, x, period) if period > 1 else F.lit(None).cast("double")

    def gains(self, x, period):
        """Rolling sum of the positive values."""
        return self.total(F.when(x > 0, x).otherwise(0.0), period)

    def losses(self, x, period):
        """Rolling sum of the negative values, as a positive number."""
        return self.total(F.when(x < 0, -x).otherwise(0.0), period)

    def cumsum(self, df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
        """Prefix sums over the whole history (not only the block)."""
        f = self.frame(Window.unboundedPreceding)
        if self.split is None:
            return df.withColumns({n: F.sum(c).over(f) for n, c in columns.items()})
        size, _ = self.split
        start = F.col(BLK) * size
        own = (F.col(RN) >= start) & (F.col(RN) < start + size)
        sums = df.groupBy(*self.keys).agg(
            *[F.sum(F.when(own, c)).alias(f"__own_{n}") for n, c in columns.items()],
            *[F.sum(F.when(F.col(RN) < start, c)).alias(f"__halo_{n}") for n, c in columns.items()],
        )
        upto = Window.partitionBy(*self.by).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
        base = sums.select(
            *self.keys,
            *[
                (F.coalesce(F.sum(f"__own_{n}").over(upto), F.lit(0)) - F.coalesce(F.col(f"__halo_{n}"), F.lit(0))).alias(
                    f"__base_{n}"
                )
                for n in columns
            ],
        )
        local = df.withColumns({n: F.sum(c).over(f) for n, c in columns.items()})
        joined = same_keys(local, base, self.keys, self.null_keys)
        return joined.withColumns({n: F.col(n) + F.col(f"__base_{n}") for n in columns}).drop(
            *[f"__base_{n}" for n in columns]
        )


def over_history(
    df: DataFrame,
    body: Callable[[DataFrame, Timeline], DataFrame],
    *,
    by,
    order,
    lookback: int = 0,
    lookahead: int = 0,
    chunk="auto",
    positions: bool = False,
) -> DataFrame:
    """Run ``body`` over ordered groups, cutting long ones into blocks with the rows their frames need.

    ``positions``: ``body`` reads the global position column even when no cut is needed.
    """
    by, order = names(by), names(order)
    split = plan_split(df, by, order, chunk)
    if split.ranges is None:
        t = Timeline(by, order, by)
        if positions:
            df = df.withColumn(RN, F.row_number().over(t.w) - 1)
            t.order = [RN]
        return body(df, t).drop(RN, SUB, K)

    size = max(split.rows, lookback, lookahead, 1)
    numbered = split.settle(number_rows(df, by=by, order=order, chunk=split))
    block, at = F.floor(F.col(RN) / size), F.col(RN) % size
    homes = [F.array(block)]
    if lookback:
        homes.append(F.when(at >= size - lookback, F.array(block + 1)).otherwise(F.array().cast("array<bigint>")))
    if lookahead:
        homes.append(F.when((at < lookahead) & (block > 0), F.array(block - 1)).otherwise(F.array().cast("array<bigint>")))
    framed = numbered.withColumn(BLK, F.explode(F.concat(*homes)))
    t = Timeline(by, [RN], by + [BLK], (size, lookback), split.null_keys)
    out = body(framed, t)
    return out.filter(F.floor(F.col(RN) / size) == F.col(BLK)).drop(RN, BLK, SUB, K)
