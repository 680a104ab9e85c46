"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints at four or fewer differing bits agree on one of five bands, so each distinct fingerprint enters five buckets.
Inside a bucket the fingerprints are sorted by Gray rank; runs of neighbours share most bits, which a node keeps as mask and
pattern.  Upper nodes hold what a run of leaves shares and leaves only what they add, so a search adds up differences from
the top and drops a whole group as soon as they exceed the limit.

A bucket of many fingerprints (a large group of near copies) is dealt out as pairs of chunks, each searched in a task of its
own.  A search returns a forest (each fingerprint with one of its component), never all pairs, and the forests are joined by
rounds of contraction on written tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import partitions, store, whole

SHINGLE = 4
LIMIT = 4  # differing bits
CHUNK = 1024  # fingerprints of a bucket that one task compares with as many others
FAN = 16  # children of a node
PAIRS = 1 << 18  # pairs that may be looked at together
SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles of ``text`` in ASCII lower case, as a signed 64-bit number; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words])
    k = min(shingle, len(words))
    joined = b" ".join(words)
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - k + 1].tolist()
    stops = (ends[k - 1 :] - 1).tolist()
    digest, set_bits, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(starts)
    for at in range(0, n, 1 << 15):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[at : at + (1 << 15)], stops[at : at + (1 << 15)])], "<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<i8")[0])


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Level:
    """Nodes over runs of ``FAN`` rows that never cross a segment: first child, children, shared mask and pattern."""

    def __init__(self, segments: np.ndarray, every: np.ndarray, some: np.ndarray):
        new = np.r_[True, segments[1:] != segments[:-1]]
        place = np.arange(len(segments)) - np.maximum.accumulate(np.where(new, np.arange(len(segments)), 0))
        self.first = np.flatnonzero(place % FAN == 0)
        self.children = np.diff(np.r_[self.first, len(segments)])
        self.segments = segments[self.first]
        self.every, self.some = np.bitwise_and.reduceat(every, self.first), np.bitwise_or.reduceat(some, self.first)
        self.mask = ~(self.every ^ self.some)  # bits on which all below agree


def _spread(owner: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of each owner with the ``count`` rows from ``first``."""
    total = np.cumsum(count)
    offset = np.arange(total[-1] if len(total) else 0) - np.repeat(total - count, count)
    return np.repeat(owner, count), np.repeat(first, count) + offset


def _near_pairs(code, asked, top: Level, leaf: Level, asks, lo, hi, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows within ``limit`` bits: each asker goes down from the upper nodes ``lo`` to ``hi`` of its cell."""
    count = lambda x: np.bitwise_count(x).astype(np.int16)
    q, node = _spread(asks, lo, hi - lo)
    apart = count((code[q] ^ top.every[node]) & top.mask[node])
    near = apart <= limit
    at, child = _spread(np.flatnonzero(near), top.first[node[near]], top.children[node[near]])
    q, above, apart = q[at], top.mask[node[at]], apart[at]
    apart = apart + count((code[q] ^ leaf.every[child]) & leaf.mask[child] & ~above)
    near = apart <= limit
    at, row = _spread(np.flatnonzero(near), leaf.first[child[near]], leaf.children[child[near]])
    q, above, apart, row = q[at], leaf.mask[child[at]], apart[at], asked[row]
    near = (apart + count((code[q] ^ code[row]) & ~above) <= limit) & (q != row)
    return q[near], row[near]


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of the pairs; every row ends up at its root."""
    a, b = parent[a], parent[b]
    a, b = a[a != b], b[a != b]
    while len(a):
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up
        a, b = parent[a], parent[b]
        a, b = a[a != b], b[a != b]


def linked(codes: np.ndarray, cells: np.ndarray, sides: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Component of each row within its cell, as the row number of one member.

    ``sides``: 0 asks and is asked (a chunk with itself), 1 asks, 2 is asked.
    """
    order = np.lexsort((gray_rank(codes), sides, cells))
    code, cell, side = codes[order], cells[order], sides[order]
    asked = np.flatnonzero(side != 1)
    parent = np.arange(len(code))
    if len(asked):
        leaf = Level(cell[asked], code[asked], code[asked])
        top = Level(leaf.segments, leaf.every, leaf.some)
        asks = np.flatnonzero(side != 2)
        lo, hi = np.searchsorted(top.segments, cell[asks], "left"), np.searchsorted(top.segments, cell[asks], "right")
        # Some askers at a time, so that the pairs that are left stay few even if all are near.
        below = np.diff(np.searchsorted(cell[asked], np.r_[np.unique(cell), cell[-1] + 1]))[np.searchsorted(np.unique(cell), cell[asks])]
        turn = np.cumsum(below) // PAIRS
        for some in np.split(np.arange(len(asks)), np.flatnonzero(np.diff(turn)) + 1):
            a, b = _near_pairs(code, asked, top, leaf, asks[some], lo[some], hi[some], limit)
            _unite(parent, a, b)
    out = np.empty(len(code), np.int64)
    out[order] = order[parent]
    return out


def _search(limit: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        rows = 0

        def links(frame: pd.DataFrame) -> pd.DataFrame:
            cell = frame.groupby(["band", "key", "i", "j"], sort=False).ngroup().to_numpy()
            codes = frame["fp"].to_numpy().view(np.uint64)
            found = []
            sizes = np.bincount(cell).astype(np.int64)
            part = np.cumsum(sizes * sizes) // PAIRS  # cells looked at together
            for p in np.unique(part):
                rows = np.flatnonzero(part[cell] == p)
                root = rows[linked(codes[rows], cell[rows], frame["side"].to_numpy()[rows], limit)]
                own = root != rows
                found.append(pd.DataFrame({"u": frame["fp"].to_numpy()[rows[own]], "v": frame["fp"].to_numpy()[root[own]]}))
            return pd.concat(found) if found else pd.DataFrame({"u": [], "v": []}, dtype="int64")

        for frame in batches:
            held.append(frame)
            rows += len(frame)
            if rows < 50_000:
                continue
            frame = pd.concat(held, ignore_index=True)
            last = frame[["band", "key", "i", "j"]].iloc[-1]
            whole_cells = ~(frame[["band", "key", "i", "j"]] == last).all(axis=1)
            if whole_cells.any():
                yield links(frame[whole_cells].reset_index(drop=True)).drop_duplicates()
            held, rows = [frame[~whole_cells]], int((~whole_cells).sum())
        if held and rows:
            yield links(pd.concat(held, ignore_index=True)).drop_duplicates()

    return run


def links(codes: DataFrame, limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    """Links (u, v) that connect all of the distinct ``codes`` (fp) at ``limit`` or fewer differing bits."""
    bands = limit + 1
    edges = [64 * b // bands for b in range(bands + 1)]
    keys = F.array(*[F.struct(F.lit(b).alias("band"), F.shiftrightunsigned(F.shiftleft("fp", 64 - edges[b + 1]), 64 - edges[b + 1] + edges[b]).alias("key")) for b in range(bands)])
    rows = codes.select("fp", F.inline(keys))
    large = store(rows.groupBy("band", "key").agg(F.count("*").alias("n")).filter(F.col("n") > chunk), "large-buckets")
    rows = rows.join(large, ["band", "key"], "left").withColumn("chunks", F.coalesce(F.ceil(F.col("n") / chunk), F.lit(1)).cast("int"))
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
    side = F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2)
    cells = rows.select("band", "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), side.alias("side"), "fp")
    where = ["band", "key", "i", "j"]
    cells = cells.repartition(partitions(codes.sparkSession), *where).sortWithinPartitions(*where)
    return cells.mapInPandas(_search(limit), "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node that ``edges`` (u, v) connect; the root is one node of the component.

    Each round points every node to its smallest neighbour, follows that pointer once and contracts the graph, until no
    link is left.  Nothing grows in a round, and a node with many links is aggregated map-side and met in joins only.
    """
    ordered = lambda df: df.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u < v").groupBy("u", "v").agg(F.count("*").alias("n")).drop("n")
    edges = store(ordered(edges), "links")
    roots = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = store(both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("p")), "pointers")
        far = near.select(F.col("u").alias("p"), F.col("p").alias("pp"))
        near = store(near.join(far, "p").select("u", F.col("pp").alias("p")), "pointers")
        left, right = near.select("u", F.col("p").alias("pu")), near.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        edges = store(ordered(edges.join(left, "u").join(right, "v").select(F.col("pu").alias("u"), F.col("pv").alias("v"))), "links")
        if roots is None:
            roots = near.select(F.col("u").alias("node"), F.col("p").alias("root"))
        else:
            moved = roots.join(near.select(F.col("u").alias("root"), "p"), "root", "left")
            roots = store(moved.select("node", F.coalesce("p", "root").alias("root")), "roots")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")) if roots is None else roots


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, limit: int = LIMIT, shingle: int = SHINGLE) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id, component_size`` and a hash of the text.

    Null and empty texts have fingerprint zero, which links like any other.  Rows repeated whole are members of one
    component; its id is the smallest non-null id (null if there is none).  Other columns are ignored.
    """

    @F.pandas_udf("long")
    def simhash(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series([fingerprint(x, shingle) for x in t], dtype="int64")

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("body"))
    rows = store(rows.select("doc_id", F.xxhash64("body").alias("text_hash"), simhash("body").alias("fp")), "fingerprints")
    classes = store(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("members")), "classes")
    roots = components(links(classes.select("fp"), limit))
    placed = store(classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "placed")
    groups = store(placed.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("members").alias("component_size")), "components")
    known = store(placed.join(groups, "root").select("fp", "component_id", "component_size", F.col("root").alias("component_key")), "known")
    return rows.join(known, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "component_size", "component_key", "text_hash"
    )
