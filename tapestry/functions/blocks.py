"""Walks through long histories: blocks of the whole order, each walked in its own task from the state at its start.

``positioned`` deals rows into ranges of group, time and tiebreak and numbers them; ``level_states`` says which keyed states
(price levels, say) hold when a block starts, from one row per key and block; ``walk`` brings both together, so every row
moves twice whatever the length of its history, and a task holds the live states of one group at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import settle
from .history import names, range_count, same_keys
from .prefix import Rows

POS, BLOCK = "__pos", "__block"
AT_ENTRY = -1  # position of the rows that tell the state at the start of a block


def positioned(df: DataFrame, *, by, order, chunk="auto") -> DataFrame:
    """``df`` with a block and a position that grows in the order of group, time and tiebreak; written out."""
    by, order = names(by), names(order)
    dealt = df.repartitionByRange(range_count(df, chunk), *by, *order).sortWithinPartitions(*by, *order)
    return settle(dealt.select("*", F.spark_partition_id().alias(BLOCK), F.monotonically_increasing_id().alias(POS)), "positioned")


def newest_in_block(updates: DataFrame, *, by, key: Sequence[str], value: str) -> DataFrame:
    """The newest ``value`` of each key in each block that has one."""
    return updates.groupBy(*names(by), BLOCK, *key).agg(F.max_by(value, POS).alias(value))


def level_states(newest: DataFrame, spans: DataFrame, *, by, key: Sequence[str], alive: Column) -> DataFrame:
    """Live states at the start of each block: one row per group, block and key.

    ``newest``: from ``newest_in_block``; ``spans``: last block of every group (column ``__until``).  A key has one row per block
    at most, so no window grows with the history.
    """
    by = names(by)
    following = F.lead(BLOCK).over(Window.partitionBy(*by, *key).orderBy(BLOCK))
    held = same_keys(newest.withColumn("__next", following).filter(alive), spans, by, True)
    held = held.withColumn("__z", F.coalesce("__next", "__until")).filter(F.col("__z") > F.col(BLOCK))
    blocks = F.explode(F.sequence(F.col(BLOCK) + 1, F.col("__z")))
    return held.withColumn(BLOCK, blocks).drop("__next", "__until", "__z").withColumn(POS, F.lit(AT_ENTRY).cast("long"))


def last_blocks(rows: DataFrame, *, by) -> DataFrame:
    return rows.groupBy(*names(by)).agg(F.max(BLOCK).alias("__until"))


Walker = Callable[[Rows], pa.RecordBatch | None]


def walk(rows: DataFrame, *, by, order: Sequence[str], blocks: int, walker: Callable[[], Walker], schema: T.StructType) -> DataFrame:
    """Hand the rows of every block, with the states at its start first, in order to a new ``walker``.

    It gets Arrow batches whose ``start`` flags say where another group begins, and returns what it has to say about each;
    what it holds back until the end comes from its ``finish``, if it has one.
    """
    by = names(by)
    dealt = rows.repartitionById(blocks, F.col(BLOCK)).sortWithinPartitions(*by, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, key = walker(), None
        for batch in batches:
            if len(batch):
                part = Rows(batch, by, key)
                key = part.key(by, part.n - 1)
                out = step(part)
                if out is not None and len(out):
                    yield out
        out = getattr(step, "finish", lambda: None)()
        if out is not None and len(out):
            yield out

    return dealt.mapInArrow(run, schema)


def same_block(a: DataFrame, b: DataFrame, by: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in by], a[BLOCK] == b[BLOCK])


def settled_walk(
    rows: DataFrame, entry: DataFrame, *, by, order: Sequence[str], blocks: int, walker: Callable[[], Walker], schema: T.StructType,
    entry_after: Callable[[DataFrame], DataFrame], state: Sequence[str],
) -> DataFrame:
    """A walk whose states at block starts depend on the walk itself.

    Blocks are walked from the states that are expected (``entry``).  What they leave behind (``entry_after`` all rows walked)
    tells the states again; blocks that began with others are walked once more.  The first block of a group is right at once
    and each round settles the next one at least, so there are at most as many rounds as blocks.  ``state``: the columns that
    make up a state, besides group and block; ``schema`` has the columns of the group, block and position.
    """
    by = names(by)
    todo, expected, done, stale = rows, entry, None, None
    for _ in range(blocks):
        start = expected if stale is None else expected.join(stale, same_block(expected, stale, by), "left_semi")
        fresh = settle(walk(todo.unionByName(start, allowMissingColumns=True), by=by, order=order, blocks=blocks, walker=walker, schema=schema), "walked")
        done = fresh if done is None else done.join(stale, same_block(done, stale, by), "left_anti").unionByName(fresh)
        after = settle(entry_after(done), "entry")
        stale = _changed(expected, after, [*by, BLOCK], state)
        if stale.isEmpty():
            break
        stale = settle(stale, "stale")
        todo, expected = rows.join(stale, same_block(rows, stale, by), "left_semi"), after
    return done


def _changed(old: DataFrame, new: DataFrame, key: Sequence[str], state: Sequence[str]) -> DataFrame:
    """Groups and blocks whose states at the start differ."""
    both = old.select(*key, *state, F.lit(1).alias("__n")).unionByName(new.select(*key, *state, F.lit(-1).alias("__n")))
    return both.groupBy(*key, *state).agg(F.sum("__n").alias("__n")).filter("__n != 0").select(*key).distinct()
