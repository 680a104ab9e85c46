"""Order book: routing of depth updates, reconstruction at any instant, and its summaries.

A book is a table ``contract, side, price, volume, ts, type`` with one row per live level.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.blocks import AT_ENTRY, BLOCK, POS, Walker, last_blocks, level_states, newest_in_block, positioned, settled_walk, walk
from ..functions.exprs import classify, safe_div
from ..functions.history import names, over_history, range_count
from ..functions.prefix import Rows
from ..schemas import DEPTH_ASK, DEPTH_BID, DEPTH_CHANGES, DEPTH_TRADE
from ..session import settle

ORDER = ["ts", "seq"]
GRID_BLOCK = 4096


def route_depth(depth: DataFrame, *, by="contract", order=ORDER, chunk="auto") -> DataFrame:
    """Assign every depth update to a side.

    1 is an ask, 2 a bid, 5 a trade (only with volume).  Changes (9, 10) go to the bid side at or below the mid of
    the book built from plain bids and asks, to the ask side above it, and to both sides when there is no mid or
    the price is 0.  The wire code stays visible in ``type`` (``bid_mod_9``).  Trades and changes also carry the best
    prices they were compared with.
    """
    code = F.col("type")
    looked_up = code.isin(*DEPTH_CHANGES, DEPTH_TRADE)
    placed = bbo_history(depth, by=by, order=order, chunk=chunk, wanted=looked_up).select(*depth.columns, "best_bid", "best_ask", "mid")
    rest = depth.filter(~F.coalesce(looked_up, F.lit(False)))
    with_mid = placed.unionByName(rest, allowMissingColumns=True)
    price, mid = F.col("price"), F.col("mid")
    change = code.isin(*DEPTH_CHANGES)
    undecided = mid.isNull() | (mid == 0) | (price == 0)
    entry = lambda side, label: F.struct(F.lit(side).alias("side"), label.alias("label"))
    bid_mod = entry("bid", F.concat(F.lit("bid_mod_"), code.cast("string")))
    ask_mod = entry("ask", F.concat(F.lit("ask_mod_"), code.cast("string")))
    routes = (
        F.when(code == DEPTH_BID, F.array(entry("bid", F.lit("bid"))))
        .when(code == DEPTH_ASK, F.array(entry("ask", F.lit("ask"))))
        .when((code == DEPTH_TRADE) & (F.col("volume") > 0), F.array(entry("trade", F.lit("trade"))))
        .when(change & undecided, F.array(bid_mod, ask_mod))
        .when(change & (price <= mid), F.array(bid_mod))
        .when(change, F.array(ask_mod))
    )
    return with_mid.withColumn("__r", F.explode(routes)).select(
        *names(by), *names(order), "price", "volume", F.col("__r.side").alias("side"), F.col("__r.label").alias("type"),
        "best_bid", "best_ask",
    )


def route_depth_exact(depth: DataFrame, *, by="contract", order=ORDER, batch: str | None = None, chunk="auto") -> DataFrame:
    """Like :func:`route_depth`, with the mid of the book that includes the changes placed before.

    Each placement depends on the earlier ones, so blocks are walked from the book that is expected at their start: at first
    that of the plain quotes.  A walk tells which levels each block leaves behind, and the blocks whose book at the start turns
    out to be another one are walked again.  The first block of a contract is right at once and every round settles the
    next one at least, so there are as many rounds as blocks at most; two or three are usual, as a placement depends on
    the mid alone.  ``batch``: column numbering the messages (rows that follow each other); the book changes after a message,
    and its trades are compared with the book after it.
    """
    by, order = names(by), names(order)
    message, line = [], order
    if batch is not None:
        # A message stays in one block: all its rows are ordered by its first one.
        opens = F.min(F.struct(*order)).over(Window.partitionBy(*by, batch))
        depth, message, line = depth.withColumn("__opens", opens), [batch], ["__opens", *order]
    blocks = range_count(depth, chunk)
    slim = depth.select(*by, *line, *[c for c in message if c not in by + line], "price", "volume", "type")
    rows = _whole_messages(slim, by, line, order, chunk) if message else positioned(slim, by=by, order=line, chunk=chunk)
    rows = rows.withColumn("side", _plain_side())
    until = last_blocks(rows, by=by)
    state = lambda updates: level_states(newest_in_block(updates, by=by, key=["side", "price"], value="volume"), until, by=by, key=["side", "price"], alive=F.col("volume") > 0)
    entry = settle(state(rows.filter(F.col("side").isNotNull())), "entry")
    schema = T.StructType([rows.schema[c] for c in (*by, *order, "price", "volume")]).add("side", "string").add("type", "string")
    schema = schema.add("best_bid", "double").add("best_ask", "double").add(rows.schema[BLOCK]).add(rows.schema[POS])
    columns = [*by, *order, "price", "volume"]
    done = settled_walk(
        rows, entry, by=by, order=[POS], blocks=blocks, walker=lambda: _placements(columns, message), schema=schema,
        entry_after=lambda d: state(d.filter(F.col("side") != "trade")), state=["side", "price", "volume"],
    )
    return done.select(*columns, "side", "type", "best_bid", "best_ask")


def _whole_messages(slim: DataFrame, by, line, order, chunk) -> DataFrame:
    """Rows dealt by the start of their message, so that no block ends inside one."""
    dealt = slim.repartitionByRange(range_count(slim, chunk), *by, line[0]).sortWithinPartitions(*by, *line)
    return settle(dealt.select("*", F.spark_partition_id().alias(BLOCK), F.monotonically_increasing_id().alias(POS)), "positioned")


def _placements(columns: list[str], message: list[str]) -> Walker:
    """Walker that places changes by the mid before their message and compares trades with the book after theirs."""
    book: dict[str, Side] = new_book()
    mid, current, waiting = None, None, []

    def step(rows: Rows) -> pa.RecordBatch:
        nonlocal book, mid, current, waiting
        out: list[tuple] = []  # (batch, row, side, label, bid, ask)
        fields = [rows.batch.column(c).to_pylist() for c in ("type", "price", "volume", POS, *message)]
        for i, (start, code, price, volume, pos, *number) in enumerate(zip(rows.start.tolist(), *fields)):
            if start:
                out += after_message()
                book, current = new_book(), None
            if pos == AT_ENTRY:
                book[rows.batch.column("side")[i].as_py()].put(price, volume)
                continue
            number = number[0] if number else pos
            if current is None or current[0] != number:
                out += after_message()
                current = (number,)
                mid = _mid(book)
            if code in (DEPTH_BID, DEPTH_ASK):
                sides, label = ["bid" if code == DEPTH_BID else "ask"], None
            elif code in DEPTH_CHANGES:
                sides = ["bid", "ask"] if not mid or price == 0 else ["bid"] if price is not None and price <= mid else ["ask"]
                label = f"_mod_{code}"
            else:
                if code == DEPTH_TRADE and volume is not None and volume > 0:
                    waiting.append((rows.batch, i))
                continue
            for side in sides:
                book[side].put(price, volume)
                out.append((rows.batch, i, side, side + (label or ""), None, None))
        # Trades of an open message wait for its end; its last rows may come with the next batch.
        return written(out)

    def after_message() -> list[tuple]:
        nonlocal waiting
        bid, ask = book["bid"].best(), book["ask"].best()
        told, waiting = [(batch, i, "trade", "trade", bid, ask) for batch, i in waiting], []
        return told

    def written(out: list[tuple]) -> pa.RecordBatch | None:
        parts = []
        for batch in {id(o[0]): o[0] for o in out}.values():
            mine = [o for o in out if o[0] is batch]
            taken = batch.select([*columns, BLOCK, POS]).take(pa.array([o[1] for o in mine], pa.int64()))
            told = {"side": pa.string(), "type": pa.string(), "best_bid": pa.float64(), "best_ask": pa.float64()}
            extra = [pa.array([o[k] for o in mine], kind) for k, kind in enumerate(told.values(), 2)]
            n = len(columns)
            parts.append(pa.RecordBatch.from_arrays([*taken.columns[:n], *extra, *taken.columns[n:]], [*columns, *told, BLOCK, POS]))
        return pa.concat_batches(parts) if parts else None

    step.finish = lambda: written(after_message())
    return step


def _mid(book: dict[str, Side]) -> float | None:
    bid, ask = book["bid"].best(), book["ask"].best()
    return (bid + ask) / 2.0 if bid and ask else None


def routed_trades(routed: DataFrame) -> DataFrame:
    """Trades among routed updates, with the aggressor as ``side``."""
    return routed.filter(F.col("side") == "trade").withColumn("side", classify(F.col("price"), F.col("best_bid"), F.col("best_ask"))).drop("type")


def depth_type_counts(depth: DataFrame, *, by="contract") -> DataFrame:
    """Number of updates per wire code."""
    known = [1, 2, 5, 9, 10]
    return depth.groupBy(*names(by)).agg(
        *[F.count_if(F.col("type") == k).alias(f"type_{k}_count") for k in known],
        F.count_if(~F.coalesce(F.col("type").isin(*known), F.lit(False))).alias("other_types"),
    )


def book_asof(updates: DataFrame, asof=None, levels: int | None = None, *, by="contract", order=ORDER) -> DataFrame:
    """All live levels at ``asof`` (default: after the last update), or the best ``levels`` per side.

    The newest update per level is a partial aggregate.
    """
    by, order = names(by), names(order)
    d = updates.filter(F.col("side").isin("bid", "ask"))
    if asof is not None:
        d = d.filter(F.col(order[0]) <= F.lit(asof).cast("timestamp"))
    live = d.groupBy(*by, "side", "price").agg(F.max(F.struct(*order, "volume", "type")).alias("s")).filter(F.col("s.volume") > 0)
    book = live.select(*by, "side", "price", "s.volume", F.col(f"s.{order[0]}").alias("ts"), "s.type")
    return book if levels is None else top_levels(book, levels, by=by)


def level_rank() -> Column:
    """Sort key that puts the best price of either side first."""
    return F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price"))


def top_levels(book: DataFrame, levels: int, *, by="contract") -> DataFrame:
    w = Window.partitionBy(*names(by), "side").orderBy(level_rank())
    return book.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= levels).drop("__n")


def level_intervals(updates: DataFrame, *, by="contract", order=ORDER, chunk="auto") -> DataFrame:
    """Each level state with the time it held: ``valid_from``, ``valid_to`` (null: still valid)."""
    by, order = names(by), names(order)
    d = updates.filter(F.col("side").isin("bid", "ask"))
    out = over_history(
        d, lambda x, t: x.withColumn("valid_to", t.lead(order[0])), by=by + ["side", "price"], order=order, lookahead=1, chunk=chunk
    )
    return out.withColumn("valid_from", F.col(order[0]))


def book_at_grid(updates: DataFrame, start, end, step_seconds: int, *, levels: int | None = None, by="contract", order=ORDER,
                 chunk="auto") -> DataFrame:
    """Books at the instants ``start, start+step, .. <= end``, their levels numbered from the best (or the best ``levels`` only).

    The instants are put among the updates of every contract, and whoever walks through a block writes the book down when it
    meets one; levels are sorted again only after a change.
    """
    by, order = names(by), names(order)
    step, ts = step_seconds * 1_000_000, order[0]
    t0, t1 = (F.unix_micros(F.lit(x).cast("timestamp")) for x in (start, end))
    changes = updates.filter(F.col("side").isin("bid", "ask") & (F.col(ts) <= F.lit(end).cast("timestamp")))
    changes = changes.select(*by, *order, "side", "price", "volume", F.lit(False).alias("__asked"))
    first = changes.groupBy(*by).agg(F.greatest(F.ceil((F.unix_micros(F.min(ts)) - t0) / F.lit(step)), F.lit(0)).alias("__a"))
    spots = first.withColumn("__z", F.floor((t1 - t0) / F.lit(step))).filter("__a <= __z")
    # Two short arrays instead of one with every instant: blocks of the grid, then the instants of a block.
    spots = spots.withColumn("__b", F.explode(F.expr(f"sequence(__a div {GRID_BLOCK}, __z div {GRID_BLOCK})")))
    spots = spots.withColumn("__i", F.explode(F.expr(f"sequence(greatest(__a, __b * {GRID_BLOCK}), least(__z, (__b + 1) * {GRID_BLOCK} - 1))")))
    asked = spots.select(*by, F.timestamp_micros(t0 + F.col("__i") * step).alias(ts), F.lit(True).alias("__asked"))
    both, line = changes.unionByName(asked, allowMissingColumns=True), [ts, "__asked", *order[1:]]
    blocks = range_count(both, chunk)
    rows = positioned(both, by=by, order=line, chunk=chunk)
    entry = _entry_levels(rows.filter(~F.col("__asked")), rows, by)
    schema = T.StructType([changes.schema[c] for c in by]).add("as_of", "timestamp")
    schema = schema.add("side", "string").add("price", "double").add("volume", changes.schema["volume"].dataType).add("level", "integer")
    walked = rows.unionByName(entry, allowMissingColumns=True)
    return walk(walked, by=by, order=[POS], blocks=blocks, walker=lambda: _whole_books(by, ts, levels), schema=schema)


def _whole_books(by: list[str], ts: str, levels: int | None) -> Walker:
    """Walker that writes down all levels at the rows that ask for them."""
    book: dict[str, Side] = new_book()
    known: dict[str, list[tuple]] = {}

    def step(rows: Rows) -> pa.RecordBatch:
        nonlocal book, known
        at, sides, prices, volumes, ranks = [], [], [], [], []
        fields = [rows.batch.column(c).to_pylist() for c in ("side", "price", "volume", "__asked")]
        for i, (start, side, price, volume, asked) in enumerate(zip(rows.start.tolist(), *fields)):
            if start:
                book, known = new_book(), {}
            if side is not None:
                book[side].put(price, volume)
                known.pop(side, None)
            elif asked:
                for name in ("bid", "ask"):
                    if name not in known:
                        known[name] = list(zip(*book[name].levels(levels))) or [(), ()]
                    p, v = known[name]
                    at += [i] * len(p)
                    sides += [name] * len(p)
                    prices += p
                    volumes += v
                    ranks += range(1, len(p) + 1)
        spots = rows.batch.select([*by, ts]).take(pa.array(at, pa.int64()))
        found = [pa.array(sides, pa.string()), pa.array(prices, pa.float64()), pa.array(volumes, rows.batch.schema.field("volume").type), pa.array(ranks, pa.int32())]
        return pa.RecordBatch.from_arrays([*spots.columns, *found], [*by, "as_of", "side", "price", "volume", "level"])

    return step


def bbo_history(depth: DataFrame, *, by="contract", order=ORDER, chunk="auto", wanted: Column | None = None) -> DataFrame:
    """Best bid and ask of the plain-quote book (codes 1 and 2) right after every depth row (or every ``wanted`` one).

    Blocks of the history are walked from the levels that are live at their start, with the best price of a side kept on top
    of a heap.
    """
    by, columns = names(by), depth.columns
    blocks = range_count(depth, chunk)
    rows = positioned(depth, by=by, order=order, chunk=chunk).withColumn("side", _plain_side())
    rows = rows.withColumn("__asked", F.lit(True) if wanted is None else F.coalesce(wanted, F.lit(False)))
    entry = _entry_levels(rows.filter(F.col("side").isNotNull()), rows, by)
    needed = rows.filter(F.col("side").isNotNull() | F.col("__asked")).unionByName(entry, allowMissingColumns=True)
    schema = T.StructType([depth.schema[c] for c in columns]).add("best_bid", "double").add("best_ask", "double")
    return with_mid(walk(needed, by=by, order=[POS], blocks=blocks, walker=lambda: _best_prices(columns), schema=schema))


def _plain_side() -> Column:
    return F.when(F.col("type") == DEPTH_BID, "bid").when(F.col("type") == DEPTH_ASK, "ask")


def _entry_levels(updates: DataFrame, rows: DataFrame, by) -> DataFrame:
    """Live levels at the start of every block of ``rows``."""
    newest = newest_in_block(updates, by=by, key=["side", "price"], value="volume")
    return level_states(newest, last_blocks(rows, by=by), by=by, key=["side", "price"], alive=F.col("volume") > 0)


class Side:
    """Live levels of one side, the best on top of a heap that forgets dead prices when they surface."""

    def __init__(self, sign: int):
        self.sign, self.live, self.heap = sign, {}, []

    def put(self, price: float | None, volume) -> None:
        if price is None:
            return
        if volume is not None and volume > 0:
            if price not in self.live:
                heapq.heappush(self.heap, self.sign * price)
            self.live[price] = volume
        else:
            self.live.pop(price, None)
            if len(self.heap) > 2 * len(self.live) + 64:
                self.heap = [self.sign * p for p in self.live]
                heapq.heapify(self.heap)

    def best(self) -> float | None:
        while self.heap and self.sign * self.heap[0] not in self.live:
            heapq.heappop(self.heap)
        return self.sign * self.heap[0] if self.heap else None

    def levels(self, n: int | None) -> list[tuple]:
        order = sorted(self.live.items(), reverse=self.sign < 0)
        return order if n is None else order[:n]


def new_book() -> dict[str, Side]:
    return {"bid": Side(-1), "ask": Side(1)}


def _best_prices(columns: list[str]) -> Walker:
    """Walker that applies updates (side, price, volume) and tells the best prices after the rows that are asked for."""
    book: dict[str, Side] = new_book()

    def step(rows: Rows) -> pa.RecordBatch:
        nonlocal book
        at, bids, asks = [], [], []
        fields = [rows.batch.column(c).to_pylist() for c in ("side", "price", "volume", "__asked")]
        bid, ask = book["bid"].best(), book["ask"].best()
        for i, (start, side, price, volume, asked) in enumerate(zip(rows.start.tolist(), *fields)):
            if start:
                book, bid, ask = new_book(), None, None
            if side is not None:
                book[side].put(price, volume)
                if side == "bid":
                    bid = book["bid"].best()
                else:
                    ask = book["ask"].best()
            if asked:
                at.append(i)
                bids.append(bid)
                asks.append(ask)
        taken = rows.batch.select(columns).take(pa.array(at, pa.int64()))
        return taken.append_column("best_bid", pa.array(bids, pa.float64())).append_column("best_ask", pa.array(asks, pa.float64()))

    return step


def with_mid(df: DataFrame) -> DataFrame:
    b, a = F.col("best_bid"), F.col("best_ask")
    both = b.isNotNull() & a.isNotNull() & (b != 0) & (a != 0)
    return df.withColumns({"spread": F.when(both, a - b), "mid": F.when(both, (a + b) / 2.0)})


def bbo(book: DataFrame, *, by="contract") -> DataFrame:
    """Best bid and ask, spread and mid; null where a side is empty."""
    best = book.groupBy(*names(by)).agg(
        F.max(F.when(F.col("side") == "bid", F.col("price"))).alias("best_bid"),
        F.min(F.when(F.col("side") == "ask", F.col("price"))).alias("best_ask"),
    )
    return with_mid(best)


def book_snapshot(book: DataFrame, levels: int | None = 10, *, by="contract") -> DataFrame:
    """Per contract: best prices, volume and level count of the best ``levels`` per side (None: all)."""
    d = book if levels is None else top_levels(book, levels, by=by)
    side = lambda s, c: F.when(F.col("side") == s, c)
    agg = d.groupBy(*names(by)).agg(
        F.max(side("bid", F.col("price"))).alias("best_bid"), F.min(side("ask", F.col("price"))).alias("best_ask"),
        F.coalesce(F.sum(side("bid", F.col("volume"))), F.lit(0)).alias("total_bid_volume"),
        F.coalesce(F.sum(side("ask", F.col("volume"))), F.lit(0)).alias("total_ask_volume"),
        F.count(side("bid", F.lit(1))).alias("bid_levels"), F.count(side("ask", F.lit(1))).alias("ask_levels"),
    )
    return with_mid(agg)


def batch_levels(depth: DataFrame, *, batch) -> DataFrame:
    """Sorted non-empty plain levels of every incoming batch, one row per level with its rank."""
    d = depth.filter(F.col("type").isin(DEPTH_ASK, DEPTH_BID) & (F.col("volume") > 0))
    d = d.withColumn("side", F.when(F.col("type") == DEPTH_BID, "bid").otherwise("ask"))
    w = Window.partitionBy(*names(batch), "side").orderBy(level_rank(), *[c for c in ORDER if c in depth.columns])
    return d.withColumn("level", F.row_number().over(w)).select(*names(batch), "side", "level", "price", "volume")


def batch_quotes(depth: DataFrame, *, batch) -> DataFrame:
    """Best prices and spread of every batch; 0 where a side is missing."""
    live = F.col("volume") > 0
    bid = F.coalesce(F.max(F.when((F.col("type") == DEPTH_BID) & live, F.col("price"))), F.lit(0.0))
    ask = F.coalesce(F.min(F.when((F.col("type") == DEPTH_ASK) & live, F.col("price"))), F.lit(0.0))
    out = depth.groupBy(*names(batch)).agg(
        bid.alias("best_bid"), ask.alias("best_ask"),
        F.count_if((F.col("type") == DEPTH_BID) & live).alias("bids"), F.count_if((F.col("type") == DEPTH_ASK) & live).alias("asks"),
    )
    both = (F.col("best_bid") != 0) & (F.col("best_ask") != 0)
    return out.withColumn("spread", F.when(both, F.col("best_ask") - F.col("best_bid")).otherwise(0.0))


def depth_within(book: DataFrame, price_range: float = 10.0, *, by="contract") -> DataFrame:
    """Volume and number of levels within ``price_range`` of the mid; zeros without a mid."""
    by = names(by)
    d = book.join(bbo(book, by=by).select(*by, F.col("mid").alias("mid_price")), by)
    p, m = F.col("price"), F.col("mid_price")
    bid = (F.col("side") == "bid") & (p >= m - price_range) & (p <= m)
    ask = (F.col("side") == "ask") & (p <= m + price_range) & (p >= m)
    return d.groupBy(*by, "mid_price").agg(
        F.coalesce(F.sum(F.when(bid, F.col("volume"))), F.lit(0)).alias("bid_volume"),
        F.coalesce(F.sum(F.when(ask, F.col("volume"))), F.lit(0)).alias("ask_volume"),
        F.count_if(bid).alias("bid_levels"), F.count_if(ask).alias("ask_levels"),
    )


def liquidity_levels(book: DataFrame, min_volume: int = 100, levels: int = 20, *, by="contract") -> DataFrame:
    """Best ``levels`` per side that hold ``min_volume``, scored against their mean volume."""
    d = top_levels(book, levels, by=by).filter(F.col("volume") >= min_volume)
    mean = F.avg("volume").over(Window.partitionBy(*names(by), "side"))
    return d.withColumn("liquidity_score", F.col("volume") / mean)


def order_clusters(book: DataFrame, price_tolerance: float = 0.25, min_cluster_size: int = 3, *, by="contract", chunk="auto") -> DataFrame:
    """Runs of neighbouring levels within a tolerance of the run's first (best) price.

    Where a run ends depends on where it began, so levels are walked in order, block by block; a block first takes its own
    first level for the start of a run, and is walked again if the run before reaches into it.
    """
    by = names(by)
    sides, order = [*by, "side"], ["__rank"]
    levels = book.select(*sides, "price", "volume", level_rank().alias("__rank"))
    rows = positioned(levels, by=sides, order=order, chunk=chunk)
    schema = T.StructType([rows.schema[c] for c in (*sides, "price", "volume", BLOCK, POS)]).add("__anchor", "double")
    none = rows.select(*sides, BLOCK, F.lit(None).cast("double").alias("__anchor"), POS).limit(0)

    def entry_after(done: DataFrame) -> DataFrame:
        ends = done.groupBy(*sides, BLOCK).agg(F.max_by("__anchor", POS).alias("__anchor"))
        following = F.lead(BLOCK).over(Window.partitionBy(*sides).orderBy(BLOCK))
        return ends.select(*sides, following.alias(BLOCK), "__anchor", F.lit(AT_ENTRY).cast("long").alias(POS)).filter(F.col(BLOCK).isNotNull())

    columns = [*sides, "price", "volume", BLOCK, POS]
    runs = settled_walk(
        rows, none, by=sides, order=[POS], blocks=range_count(levels, chunk), walker=lambda: _run_anchors(columns, price_tolerance), schema=schema,
        entry_after=entry_after, state=["__anchor"],
    )
    price, volume = F.col("price"), F.col("volume")
    clusters = runs.groupBy(*sides, "__anchor").agg(
        F.avg(price).alias("center_price"), F.min(price).alias("low_price"), F.max(price).alias("high_price"), F.sum(volume).alias("total_volume"),
        F.count(F.lit(1)).alias("order_count"), (F.sum(price * volume) / F.sum(volume)).alias("volume_weighted_price"),
    )
    return clusters.filter(F.col("order_count") >= min_cluster_size).drop("__anchor")


def _run_anchors(columns: list[str], tolerance: float) -> Walker:
    """Walker that gives every level the first price of its run."""
    anchor: float | None = None

    def step(rows: Rows) -> pa.RecordBatch:
        nonlocal anchor
        anchors, at = [], []
        fields = [rows.batch.column(c).to_pylist() for c in (POS, "__anchor", "price")]
        for i, (start, pos, known, price) in enumerate(zip(rows.start.tolist(), *fields)):
            if start:
                anchor = None
            if pos == AT_ENTRY:
                anchor = known
                continue
            if anchor is None or abs(anchor - price) > tolerance:
                anchor = price
            at.append(i)
            anchors.append(anchor)
        return rows.batch.select(columns).take(pa.array(at, pa.int64())).append_column("__anchor", pa.array(anchors, pa.float64()))

    return step


def strongest_clusters(clusters: DataFrame, *, by="contract") -> DataFrame:
    """Per side: number of clusters and the one with most volume."""
    best = F.max_by(F.struct("center_price", "total_volume"), F.struct(F.col("total_volume"), -F.col("center_price")))
    return clusters.groupBy(*names(by), "side").agg(F.count(F.lit(1)).alias("clusters"), best.alias("b")).select(
        *names(by), "side", "clusters", F.col("b.center_price").alias("center_price"), F.col("b.total_volume").alias("total_volume")
    )


def book_stats(updates: DataFrame, *, by="contract", order=ORDER) -> DataFrame:
    """Level counts, best prices, number of updates and trades."""
    by = names(by)
    book = book_asof(updates, by=by, order=order)
    shape = book_snapshot(book, None, by=by).select(*by, "bid_levels", "ask_levels", "best_bid", "best_ask", "spread", "mid")
    counts = updates.groupBy(*by).agg(
        F.count(F.lit(1)).alias("updates"), F.count_if(F.col("side") == "trade").alias("trades"), F.max(order[0]).alias("last_update")
    )
    return counts.join(shape, by, "left").withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("bid_levels", "ask_levels")})


def market_imbalance(book: DataFrame, flow: DataFrame, *, by="contract") -> DataFrame:
    """Volume imbalance of the best five levels; recent trade flow in the same direction makes it reliable."""
    by = names(by)
    top = top_levels(book, 5, by=by).groupBy(*by).agg(
        F.sum(F.when(F.col("side") == "bid", F.col("volume"))).alias("top_bid_volume"),
        F.sum(F.when(F.col("side") == "ask", F.col("volume"))).alias("top_ask_volume"),
    )
    b, a = F.col("top_bid_volume"), F.col("top_ask_volume")
    tflow = flow.select(*by, safe_div(F.col("buy_volume") - F.col("sell_volume"), F.col("total_volume")).alias("trade_imbalance"))
    d = top.join(tflow, by, "left").withColumn("trade_imbalance", F.coalesce("trade_imbalance", F.lit(0.0)))
    d = d.withColumn("imbalance_ratio", F.coalesce(F.try_divide((b - a).cast("double"), (b + a).cast("double")), F.lit(0.0)))
    r, t = F.col("imbalance_ratio"), F.col("trade_imbalance")
    # 0.3 of the book and 0.2 of the trades make a direction.
    return d.withColumns({
        "direction": F.when(r > 0.3, "bullish").when(r < -0.3, "bearish").otherwise("neutral"),
        "confidence": F.when((r > 0.3) & (t > 0.2), "high").when((r < -0.3) & (t < -0.2), "high")
        .when(F.abs(r) > 0.3, "medium").otherwise("low"),
    }).select(*by, "imbalance_ratio", "direction", "confidence", "top_bid_volume", "top_ask_volume", "trade_imbalance")


def support_resistance(profile: DataFrame, book: DataFrame, top: int = 10, *, by="contract") -> DataFrame:
    """Strongest levels below (support) and above (resistance) the mid.

    Candidates are profile buckets with more than 1.5 times the mean volume, and liquid book levels.
    """
    by = names(by)
    mid = bbo(book, by=by).filter(F.col("mid").isNotNull()).select(*by, F.col("mid").alias("current_price"))
    mean = profile.groupBy(*by).agg(F.avg("total_volume").alias("__mean"))
    heavy = profile.join(mean, by).filter(F.col("total_volume") > 1.5 * F.col("__mean")).join(mid, by).select(
        *by, "current_price", F.when(F.col("avg_price") < F.col("current_price"), "support").otherwise("resistance").alias("kind"),
        F.col("avg_price").alias("price"), F.col("total_volume").alias("volume"),
        (F.col("total_volume") / F.col("__mean")).alias("strength"), F.lit("volume_cluster").alias("type"),
    )
    p, m = F.col("price"), F.col("current_price")
    has_profile = profile.select(*by).distinct()
    liquid = (
        liquidity_levels(book, 200, 15, by=by).drop("type").join(mid, by).join(has_profile, by, "left_semi")
        .withColumn("kind", F.when((F.col("side") == "bid") & (p < m), "support").when((F.col("side") == "ask") & (p > m), "resistance"))
        .filter(F.col("kind").isNotNull())
        .select(*by, "current_price", "kind", "price", "volume", F.col("liquidity_score").alias("strength"), F.lit("orderbook_liquidity").alias("type"))
    )
    w = Window.partitionBy(*by, "kind").orderBy(F.desc("strength"), F.abs(F.col("price") - F.col("current_price")), "price", "type")
    return heavy.unionByName(liquid).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
