"""Hard negatives by an inverted multi-index over two halves of the vectors.

Each half of the vectors has a codebook; a pair of codes is a cell.  The index holds every row, sorted by cell and dealt into
blocks of bounded size, so that a cell with a third of all rows is several blocks.  A search knows for every code of a block
how high a half-score can get (score with the centre plus length times radius); a heap visits the block's cells by the sum of
both half-scores, highest first, and stops once no cell that is left can reach the lowest score that is still wanted.

A search has two rounds: the block that promises most, then every other block that can still reach what was found there.
Index and questions meet by block in one sorted stream, so a task holds one block and some questions at a time.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import partitions, store

ANCHORS, POSITIVES, NEGATIVES = 100, 5, 5
FLOOR_PERCENT = 80  # of the positive's score
SCALE = 256
SAMPLE = 16384  # rows, about, that the codebooks are fitted on
CELL_ROWS = 256  # rows per cell on average, while there are fewer than MOST_CODES
MOST_CODES = 256  # codes per half: cells and their radii stay below 65 536, and one more per block
BLOCK_ROWS = 8192
ROUNDS = 8
TOP = 1 << 62
ASK = "row long, vec_id long, label long, v array<long>, same boolean, highs array<long>, lows array<long>"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
FOUND = "row long, k int, score long, found_id long, found_row long"


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``row, vec_id, label, v`` of the rows that take part: integer components, noisy labels, a number for each row."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), x.alias("x"), bad.alias("bad"))
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL AND NOT bad")
    return rows.select(
        F.monotonically_increasing_id().alias("row"), "vec_id", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)").alias("label"),
        F.transform("x", lambda c: F.floor(SCALE * c.cast("double")).cast("long")).alias("v"),
    )


def matrix(batch: pa.RecordBatch, column: str, width: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), width)


def codebook(points: np.ndarray, codes: int, rng: np.random.Generator) -> np.ndarray:
    """Centres of ``points`` by Lloyd's rounds."""
    centres = points[rng.choice(len(points), codes, replace=False)].astype(float)
    for _ in range(ROUNDS):
        at = nearest(points, centres)
        sums, n = np.zeros_like(centres), np.bincount(at, minlength=len(centres))
        np.add.at(sums, at, points)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(1) - 2.0 * (points @ centres.T), axis=1)


class Halves:
    """Where vectors are cut, and the codebook of each half."""

    def __init__(self, sample: np.ndarray, codes: int):
        self.width = sample.shape[1]
        self.cut = self.width // 2
        rng = np.random.default_rng(7)
        self.books = [codebook(part, min(codes, len(sample)), rng) for part in self.split(sample.astype(float))]

    def split(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return v[..., : self.cut], v[..., self.cut :]


def fit(rows: DataFrame, total: int) -> Halves:
    """Codebooks from a hashed sample of about ``SAMPLE`` rows, at most twice as many."""
    share = min(1.0, SAMPLE / total)
    some = rows.filter(F.pmod(F.xxhash64("vec_id", "row"), F.lit(1 << 30)) <= int(share * (1 << 30))).limit(2 * SAMPLE).select("row", "v").toArrow().sort_by("row")
    sample = np.array(some.column("v").combine_chunks().flatten()).reshape(len(some), -1)
    return Halves(sample, min(MOST_CODES, int(np.ceil(np.sqrt(total / CELL_ROWS)))))


def build(rows: DataFrame, halves: Halves, total: int) -> DataFrame:
    """The index: ``block, c1, c2, r1, r2`` (codes and distances from their centres) of every row, sorted by cell in each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = batch
            for side, (part, book) in enumerate(zip(halves.split(matrix(batch, "v", halves.width).astype(float)), halves.books), 1):
                code = nearest(part, book)
                away = np.sqrt(((part - book[code]) ** 2).sum(1))
                out = out.append_column(f"c{side}", pa.array(code.astype("int32"))).append_column(f"r{side}", pa.array(away))
            yield out.select(["row", "vec_id", "label", "v", "c1", "c2", "r1", "r2"])

    coded = rows.mapInArrow(run, "row long, vec_id long, label long, v array<long>, c1 int, c2 int, r1 double, r2 double")
    dealt = coded.repartitionByRange(max(1, -(-total // BLOCK_ROWS)), "c1", "c2", "row").withColumn("block", F.spark_partition_id())
    return store(dealt.sortWithinPartitions("c1", "c2", "row"), "multi-index")


class Outline:
    """What is known of all blocks: their cells and radii; at most one entry per cell and block."""

    def __init__(self, index: DataFrame, halves: Halves):
        cells = index.groupBy("block", "c1", "c2").agg(F.max("r1").alias("r1"), F.max("r2").alias("r2")).toArrow().sort_by("block")
        block, self.c1, self.c2, self.r1, self.r2 = (np.array(cells.column(c)) for c in ("block", "c1", "c2", "r1", "r2"))
        self.blocks, self.starts = np.unique(block, return_index=True)
        self.halves = halves

    def promises(self, v: np.ndarray) -> np.ndarray:
        """Highest score that each block can hold for the question ``v``."""
        (a, b), (p, q) = self.halves.split(v), self.halves.books
        high = (p @ a)[self.c1] + np.linalg.norm(a) * self.r1 + (q @ b)[self.c2] + np.linalg.norm(b) * self.r2
        return np.maximum.reduceat(high, self.starts) + slack(v, high)


def slack(v: np.ndarray, high: np.ndarray) -> float:
    """Room for rounding of the half-scores; scores themselves are whole numbers."""
    return 0.5 + 1e-9 * float(np.abs(high).max(initial=0.0) + v @ v)


def to_blocks(asks: DataFrame, outline: Outline, home: bool) -> DataFrame:
    """The questions with the blocks that they go to: their best one, or all others that reach the lowest score wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch, "v", outline.halves.width).astype(float)
            rows, blocks, lows = [], [], batch.column("lows").to_pylist()
            for i, v in enumerate(vectors):
                high = outline.promises(v)
                best = int(high.argmax())
                wanted = np.array([best]) if home else np.flatnonzero(high >= min(lows[i], default=TOP))
                wanted = wanted if home else wanted[wanted != best]
                rows.append(np.full(len(wanted), i))
                blocks.append(outline.blocks[wanted])
                if sum(map(len, rows)) > 1 << 14 or i == len(vectors) - 1:
                    yield batch.take(pa.array(np.concatenate(rows))).append_column("block", pa.array(np.concatenate(blocks).astype("int32")))
                    rows, blocks = [], []

    return asks.mapInArrow(run, f"{ASK}, block int")


class Block:
    """Rows of one block, sorted by cell."""

    def __init__(self, parts: list[pa.RecordBatch], halves: Halves):
        self.halves = halves
        column = lambda c: np.concatenate([p.column(c).to_numpy(zero_copy_only=False) for p in parts])
        self.row, self.ids, self.labels = column("row"), column("vec_id"), column("label")
        self.v = np.concatenate([matrix(p, "v", halves.width) for p in parts])
        if self.v.size and float(np.abs(self.v).max()) < 2**20:
            self.v = self.v.astype(float)  # products and sums stay exact whole numbers
        (self.u1, at1), (self.u2, at2) = (np.unique(column(c), return_inverse=True) for c in ("c1", "c2"))
        self.radius1, self.radius2 = np.zeros(len(self.u1)), np.zeros(len(self.u2))
        np.maximum.at(self.radius1, at1, column("r1"))
        np.maximum.at(self.radius2, at2, column("r2"))
        cell = at1 * len(self.u2) + at2
        cells, starts = np.unique(cell, return_index=True)
        self.cells = dict(zip(cells.tolist(), zip(starts.tolist(), np.r_[starts[1:], len(cell)].tolist())))

    def visits(self, v: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """Cells as (highest possible score, first row, end), by the multi-sequence walk over both sorted lists of half-scores."""
        (a, b), (p, q) = self.halves.split(v), self.halves.books
        high1 = p[self.u1] @ a + np.linalg.norm(a) * self.radius1
        high2 = q[self.u2] @ b + np.linalg.norm(b) * self.radius2
        order1, order2 = np.argsort(-high1), np.argsort(-high2)
        first, second = high1[order1].tolist(), high2[order2].tolist()
        order1, order2 = (order1 * len(self.u2)).tolist(), order2.tolist()
        more = slack(v, np.r_[high1, high2])
        heap = [(-first[0] - second[0], 0, 0)]
        while heap:
            low, i, j = heapq.heappop(heap)
            cell = self.cells.get(order1[i] + order2[j])
            if cell:
                yield -low + more, *cell
            if j == 0 and i + 1 < len(first):
                heapq.heappush(heap, (-first[i + 1] - second[0], i + 1, 0))
            if j + 1 < len(second):
                heapq.heappush(heap, (-first[i] - second[j + 1], i, j + 1))

    def search(self, row: int, label: int, v: np.ndarray, same: bool, highs: list[int], lows: list[int], wanted: int) -> list[tuple]:
        """For each window the first ``wanted`` rows (score descending, id, row) with a score from low to high, as (k, score, id, row)."""
        best: list[list[tuple]] = [[] for _ in highs]
        needs, ask = list(lows), v.astype(self.v.dtype)
        for possible, start, end in self.visits(v.astype(float)):
            least = min(needs)
            if possible < least:
                break
            scores = self.v[start:end] @ ask
            other = self.labels[start:end]
            at = np.flatnonzero((scores >= least) & ((other == label) & (self.row[start:end] != row) if same else other != label))
            if not len(at):
                continue
            found = sorted(zip((-scores[at].astype(np.int64)).tolist(), self.ids[start + at].tolist(), self.row[start + at].tolist()))
            for k, high in enumerate(highs):
                fits = [f for f in found if needs[k] <= -f[0] <= high][:wanted]
                if fits:
                    best[k] = sorted(best[k] + fits)[:wanted]
                    if len(best[k]) == wanted:
                        needs[k] = max(needs[k], -best[k][-1][0])
        return [(k, -s, i, r) for k, some in enumerate(best) for s, i, r in some]


def meet(index: DataFrame, asks: DataFrame, halves: Halves, wanted: int) -> DataFrame:
    """What the questions find in the blocks that they go to."""
    none = lambda kind: F.lit(None).cast(kind)
    held = index.select("block", F.lit(0).alias("kind"), "c1", "c2", "r1", "r2", "row", "vec_id", "label", "v", none("boolean").alias("same"), none("array<long>").alias("highs"), none("array<long>").alias("lows"))
    asked = asks.select("block", F.lit(1).alias("kind"), *[none(t).alias(c) for c, t in (("c1", "int"), ("c2", "int"), ("r1", "double"), ("r2", "double"))], "row", "vec_id", "label", "v", "same", "highs", "lows")
    both = held.unionByName(asked).repartition(partitions(index.sparkSession), "block").sortWithinPartitions("block", "kind", "c1", "c2", "row")
    names = [c.split()[0] for c in FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, block = None, [], None
        for batch in batches:
            where, kind = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero((np.diff(where) != 0) | (np.diff(kind) != 0)) + 1
            for start, end in zip(np.r_[0, edges].tolist(), np.r_[edges, len(batch)].tolist()):
                if start == end:
                    continue
                part = batch.slice(start, end - start)
                if where[start] != at:
                    at, parts, block = where[start], [], None
                if kind[start] == 0:
                    parts.append(part)
                    continue
                block = block or Block(parts, halves)
                parts = []
                out = []
                ask = [part.column(c).to_pylist() for c in ("row", "label", "same", "highs", "lows")]
                for row, label, same, highs, lows, v in zip(*ask, matrix(part, "v", halves.width)):
                    out += [(row, *f) for f in block.search(row, label, v, same, highs, lows, wanted)]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int32() if n == "k" else pa.int64()) for n, c in zip(names, zip(*out))] if out else [pa.array([], pa.int32() if n == "k" else pa.int64()) for n in names], names)

    return both.mapInArrow(run, FOUND)


def search(index: DataFrame, asks: DataFrame, outline: Outline, wanted: int) -> DataFrame:
    """``row, k, score, found_id, found_row, place``: the first ``wanted`` rows for each question and window, over all blocks."""
    halves = outline.halves
    home = store(meet(index, to_blocks(asks, outline, True), halves, wanted), "found-at-home")
    sure = home.groupBy("row", "k").agg(F.count("*").alias("n"), F.min("score").alias("score")).filter(F.col("n") == wanted)
    sure = sure.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("k", "score"))).alias("sure"))
    raised = F.transform("lows", lambda low, k: F.greatest(low, F.try_element_at("sure", k)))
    asks = asks.join(sure, "row", "left").withColumn("lows", F.when(F.col("sure").isNull(), F.col("lows")).otherwise(raised)).drop("sure")
    away = meet(index, to_blocks(asks, outline, False), halves, wanted)
    first = Window.partitionBy("row", "k").orderBy(F.desc("score"), "found_id", "found_row")
    return store(home.unionByName(away).withColumn("place", F.row_number().over(first)).filter(F.col("place") <= wanted), "found")


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: the hard negatives of every anchor and positive.

    Rows without id, label or vector, or with a null or non-finite component, take no part.  Shorter vectors count as filled
    up with zeros.  Rows repeated whole, or with one id, are rows of their own: they are positives, negatives and anchors of
    their own, and ties of score and id are in no stated order.  Positives with a negative score have an empty window.
    Scores must fit 63 bits, otherwise this raises.  No rows, or no anchors, give no rows; other columns are ignored.
    """
    rows = store(usable(vectors, id_col, vector_col, label_col), "vectors")
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.max(F.expr("array_max(transform(v, c -> abs(c)))")).alias("most")).first()
    if not size.n:
        return vectors.sparkSession.createDataFrame([], RESULT)
    width = max(size.width, 1)
    if width * float(size.most or 0) ** 2 >= 2.0**62:
        raise ValueError("vectors are too long: their scores do not fit 63 bits")
    rows = rows.withColumn("v", F.expr(f"concat(v, array_repeat(0L, {width} - size(v)))"))
    halves = fit(rows, size.n)
    index = build(rows, halves, size.n)
    outline = Outline(index, halves)
    wide = lambda x: F.array(F.lit(x).cast("long"))
    anchors = index.filter(F.col("vec_id") % ANCHORS == 0).select("row", "vec_id", "label", "v")
    asks = store(anchors.select("*", F.lit(True).alias("same"), wide(TOP).alias("highs"), wide(-TOP).alias("lows")), "anchors")
    positives = search(index, asks, outline, POSITIVES).filter("score >= 0")
    return _negatives(index, asks, positives, outline)


def _negatives(index: DataFrame, asks: DataFrame, positives: DataFrame, outline: Outline) -> DataFrame:
    """The window of each positive, searched for rows of other labels."""
    least: Callable[[Column], Column] = lambda s: F.ceil(s * F.lit(FLOOR_PERCENT).cast("decimal(19,0)") / 100).cast("long")
    windows = positives.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "score", F.col("found_id").alias("id")))).alias("windows"))
    highs, lows = F.col("windows.score"), F.transform("windows", lambda w: least(w["score"]))
    asks = store(asks.drop("highs", "lows").join(windows, "row").withColumns({"same": F.lit(False), "highs": highs, "lows": lows}), "windows")
    found = search(index, asks.drop("windows"), outline, NEGATIVES)
    pairs = found.join(asks.select("row", F.col("vec_id").alias("anchor_id"), "windows"), "row").withColumn("w", F.expr("windows[k]"))
    return pairs.select(
        "anchor_id", F.col("w.id").alias("positive_id"), F.col("place").alias("rank"), F.col("found_id").alias("negative_id"),
        F.col("w.score").alias("positive_score"), F.col("score").alias("negative_score"),
    )
