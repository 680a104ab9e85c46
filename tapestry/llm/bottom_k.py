"""Near copies by bottom-k sketches of word shingles.

One hash function orders all shingles; a text's sketch is the k smallest values of its set.  k follows the set, n // 5 + 1 of
n: two sets with a Jaccard similarity of 4/5 or more then share a value of their sketches for certain, so the inverted lists
of sketch values miss no link.  The hash function begins with how frequent a sample of the texts finds a shingle, so that a
passage that many texts share is in hardly any sketch; the result does not depend on the sample.

The place of a shared value bounds what two sets can have in common from there on, which drops most meetings.  For the pairs
that are left both sketches make that of the union, the smallest values of both sets: how many of them both have, and what
lies beyond, bounds the similarity of the sets.  Only the bound drops a pair, as the estimate (shared / k) could err.
Pairs that pass are compared on the full sets of their texts; texts are smaller than sets of hashes, so they are what travels.
Sets first meet a few members of their lists only, among them those that share most of their sketches: they lie in the middle
of a group of near copies, so that a large group falls together in few links.  Members of a list that still lie apart after
that all meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .common import partitions, store, whole
from .gray_index import components

SHINGLE = 5
SAMPLE = 8  # one text of so many is looked at for frequent shingles
FREQUENT = 2  # texts of the sample that have a frequent shingle
MOST_FREQUENT = 1_000_000  # of them a task knows, the most frequent ones
STAR_TURNS, STARS = 1, 6  # turns, and members of its lists that a set meets in one
ROWS = 1 << 18  # values that a task holds before it passes them on
SEEN = 1 << 18  # sets that a task remembers, not to write a copy again
MARKS = 1 << 17  # words of 64 bits that say which texts are asked for: at most so many rows are broadcast
SEED = 42
SET = "doc_id long, text_hash long, words long, node long, n int, low array<long>"


def shingles(text: str | None, shingle: int = SHINGLE) -> tuple[int, np.ndarray]:
    """Words of ``text``, and the distinct hashes of its word shingles in ASCII lower case, ascending.

    With fewer words than a shingle has, the whole sequence is the only one; that of no words at all too.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    k = min(shingle, len(words))
    if not k:
        return 0, np.array([xxhash.xxh64_intdigest(b"", SEED)], "<u8")
    joined, ends, digest = b" ".join(words), np.cumsum([len(w) + 1 for w in words], dtype=np.int64), xxhash.xxh64_intdigest
    starts, stops = np.r_[0, ends[:-1]][: len(words) - k + 1].tolist(), (ends[k - 1 :] - 1).tolist()
    return len(words), np.unique(np.array([digest(joined[s:e], SEED) for s, e in zip(starts, stops)], "<u8"))


def _frequent(texts: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles of a sample, ascending, and the texts that have them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            held, n = [], 0
            for body in frame["body"].tolist():
                held.append(shingles(body, shingle)[1].view("<i8"))
                n += len(held[-1])
                if n >= ROWS:
                    yield pd.DataFrame({"value": np.concatenate(held)})
                    held, n = [], 0
            if held:
                yield pd.DataFrame({"value": np.concatenate(held)})

    some = texts.filter(F.pmod(F.col("text_hash"), F.lit(SAMPLE)) == 0)
    # Copies of a text count once.
    once = some.groupBy("text_hash").agg(F.min("doc_id").alias("doc_id"))
    some = some.join(once, ["text_hash", "doc_id"], "left_semi").select("body")
    counted = some.mapInPandas(run, "value long").groupBy("value").agg(F.count("*").alias("n"))
    counted = store(counted.filter(F.col("n") >= FREQUENT), "frequent")  # its shuffles go when it is written
    top = counted.orderBy(F.desc("n"), "value").limit(MOST_FREQUENT).toArrow().to_pandas()
    values = top["value"].to_numpy("int64").view("uint64")
    order = np.argsort(values)
    return values[order], top["n"].to_numpy("int64")[order]


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """One row per text with the identity ``node`` of its set and the sketch ``low`` (null for a copy in the same task)."""
    frequent, times = _frequent(texts, shingle)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for frame in batches:
            rows, held = [], 0
            for doc_id, text_hash, body in zip(frame["doc_id"].tolist(), frame["text_hash"].tolist(), frame["body"].tolist()):
                words, found = shingles(body, shingle)
                node, n = xxhash.xxh3_64_intdigest(found.tobytes(), SEED), len(found)
                node -= (node >> 63) << 64
                low = None
                if node not in seen:
                    seen = seen if len(seen) < SEEN else set()
                    seen.add(node)
                    low = hashed(found, frequent, times)[: n // 5 + 1].copy()
                rows.append((None if pd.isna(doc_id) else int(doc_id), text_hash, words, node, n, low))
                held += 1 if low is None else len(low)
                if held >= ROWS:
                    yield as_frame(rows)
                    rows, held = [], 0
            if rows:
                yield as_frame(rows)

    def as_frame(rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=[c.split()[0] for c in SET.split(", ")])
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        return frame

    return texts.mapInPandas(run, SET)


def hashed(found: np.ndarray, frequent: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The one hash function that sketches are cut by, of shingle hashes; ascending.

    Five bits grow with the logarithm of how often the sample has a shingle, 0 for most; the other 58 are those of its hash.
    """
    rank = np.zeros(len(found), np.uint64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
        rank = np.where(frequent[at] == found, np.minimum(1.4 * np.log2(times[at]) + 1, 31), 0).astype(np.uint64)
    return np.sort((rank << np.uint64(58)) | (found >> np.uint64(6))).view("<i8")


def union_sketched(pairs: DataFrame) -> DataFrame:
    """``pairs`` (lowu, lowv, nu, nv) with the sketch of their union, which ends where the first of both sketches does.

    ``shared``: its values that both sets have, ``k``: all of them, so that shared / k estimates the similarity; ``restu``,
    ``restv``: values of each set beyond it.
    """
    upto = lambda low: F.filter(low, lambda x: x <= F.col("edge"))
    ends = pairs.withColumn("edge", F.least(F.element_at("lowu", -1), F.element_at("lowv", -1)))
    cut = ends.withColumns({"lowu": upto("lowu"), "lowv": upto("lowv")})
    cut = cut.withColumns({"k": F.size(F.array_union("lowu", "lowv")), "restu": F.col("nu") - F.size("lowu"), "restv": F.col("nv") - F.size("lowv")})
    return cut.withColumn("shared", F.size("lowu") + F.size("lowv") - F.col("k")).drop("edge")


# What both sets may share at most, and their union is at least then: a similarity of 4/5 or more?
UNION_BOUND = "5 * (shared + least(restu, restv)) >= 4 * (k + greatest(restu, restv))"


def most_shared(places: str, sizes: str) -> str:
    """SQL: may sets of sizes n and m, whose first shared value is at places i and j, have a similarity of 4/5 or more?"""
    (i, j), (n, m) = places.split(), sizes.split()
    return f"9 * least({n} - {i}, {m} - {j}) >= 4 * ({n} + {m})"


def _marked(frame: DataFrame, asked: DataFrame, key: str) -> DataFrame:
    """The rows of ``frame`` whose ``key`` may be in ``asked`` (key): a bitmap of bounded size keeps nearly all others from being shuffled."""
    hashed = F.xxhash64(key)
    word, bit = F.pmod(hashed, F.lit(MARKS)), F.shiftrightunsigned(hashed, 58).cast("int")
    marks = asked.groupBy(word.alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64({key}), 58) as int))")).alias("bits"))
    near = frame.withColumn("word", word).join(F.broadcast(marks), "word").filter(F.getbit("bits", bit) == 1)
    return near.drop("word", "bits")


def _confirmed(texts: DataFrame, sets: DataFrame, nodes: DataFrame, pairs: DataFrame, shingle: int) -> DataFrame:
    """The ``pairs`` (u, v) whose sets have a similarity of 4/5 or more."""
    ends = lambda p: p.select(F.col("u").alias("node")).unionByName(p.select(F.col("v").alias("node"))).groupBy("node").agg(F.count("*").alias("pairs"))
    row = lambda x: nodes.select(F.col("node").alias(x), F.col("row").alias(f"row{x}"))
    pairs = store(pairs.join(row("u"), "u").join(row("v"), "v"), "pairs")
    # Sketches go from the table of sets to the pairs that ask for them; no copy of them is written, and the others do not travel.
    low = lambda x: _marked(sets.select("row", "n", "low"), pairs.select(F.col(f"row{x}").alias("row")), "row").toDF(f"row{x}", f"n{x}", f"low{x}")
    sketched = union_sketched(pairs.join(low("u"), "rowu").join(low("v"), "rowv"))
    near = store(sketched.filter(UNION_BOUND).select("u", "v"), "candidates")
    asked = store(nodes.join(ends(near), "node").select("node", F.col("text").alias("text_hash")), "asked")
    # Dealt by text_hash already, so that copies are dropped where they meet.
    found = _marked(texts.select("text_hash", "body"), asked, "text_hash").join(asked, "text_hash").dropDuplicates(["text_hash", "node"])
    bodies = store(found.select("node", "body"), "asked-texts")
    body = lambda x: bodies.select(F.col("node").alias(x), F.col("body").alias(f"t{x}"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = lru_cache(256)(lambda text: shingles(text, shingle)[1])
        for frame in batches:
            pairs = [(known(a), known(b)) for a, b in zip(frame["tu"], frame["tv"])]
            same = np.array([9 * len(np.intersect1d(a, b, assume_unique=True)) >= 4 * (len(a) + len(b)) for a, b in pairs], bool)
            yield frame.loc[same, ["u", "v"]]

    return store(near.join(body("u"), "u").join(body("v"), "v").select("u", "v", "tu", "tv").mapInPandas(run, "u long, v long"), "similar")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE) -> DataFrame:
    """One row per input row: ``doc_id, text_hash, words, n_shingles, component_id, component_key``.

    Texts whose sets of word shingles have a Jaccard similarity of 0.8 or more are linked; linked texts are one component.
    Its id is the smallest non-null id of its rows (null if there is none); its key tells components apart in any case.
    Texts without words, null included, have the set of the empty sequence and are one component.  Rows repeated whole are
    members like any other; an empty table gives no rows; other columns are ignored.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(whole(text_col)).alias("text_hash"), whole(text_col).alias("body"))
    sets = store(_sets(texts, shingle).withColumn("row", F.monotonically_increasing_id()), "sets")
    rows = sets.select("doc_id", "text_hash", "words", "node", "n")
    nodes = store(
        sets.groupBy("node").agg(F.min("doc_id").alias("first"), F.min("text_hash").alias("text"), F.min(F.when(F.col("low").isNotNull(), F.col("row"))).alias("row")), "nodes"
    )
    sets = sets.filter("low IS NOT NULL")
    # Size and place travel as one number, as most entries are in no list.
    entries = sets.select("node", "n", F.posexplode("low").alias("at", "value")).select("value", "node", F.expr("shiftleft(cast(at as long), 32) | n").alias("place"))
    entries = entries.repartition(partitions(docs.sparkSession), "value")
    listed = Window.partitionBy("value")
    entries = entries.dropDuplicates(["value", "node"]).withColumn("members", F.count("*").over(listed))
    lists = store(entries.filter("members > 1").selectExpr("node", "cast(place & 2147483647 as int) n", "cast(shiftright(place, 32) as int) at", "value"), "lists")
    # How much of its sketch a set shares: most for those in the middle of a group of near copies.
    shared = store(lists.groupBy("node").agg((F.count("*") / F.max(F.expr("n div 5 + 1"))).cast("float").alias("shared")), "shared")

    fits, links, roots = F.expr(most_shared("i j", "n m")), None, None
    alike = Window.partitionBy("value", F.floor(F.log("n") / F.log(F.lit(1.25))))
    for turn in range(STAR_TURNS + 1):
        if roots is not None:
            placed = lists.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
            mixed = placed.withColumn("least", F.min("root").over(listed)).withColumn("most", F.max("root").over(listed))
            lists = store(mixed.filter("least < most").drop("least", "most"), "apart")
        else:
            lists = lists.withColumn("root", F.col("node"))
        asks = lists.withColumnsRenamed({"node": "u", "at": "i"}).select("value", "u", "n", "i", "root")
        if turn < STAR_TURNS:
            # Dealt here, so that what the seeds add to a row does not travel.
            asks = asks.join(shared.withColumnRenamed("node", "u"), "u").repartition(partitions(docs.sparkSession), "value")
            # Each list names one member per seed and size, the same ones in all lists of a group, every other one from its middle;
            # a set asks those it meets most often.
            middle = lambda k: F.floor(F.col("shared") * 10) if k % 2 else F.lit(0).cast("long")
            named = [
                F.min(F.struct((-middle(k)).alias("c"), F.xxhash64("u", F.lit(turn * STARS + k)).alias("h"), F.col("u").alias("v"), F.col("n").alias("m"), F.col("i").alias("j"), F.col("root").alias("other"))).over(alike)
                for k in range(STARS)
            ]
            meet = asks.withColumn("stars", F.array_distinct(F.array(*named))).select("u", "n", "i", "root", F.inline("stars")).filter("root != other").filter(fits)
            counted = meet.groupBy("u", "v").agg(F.count("*").alias("lists"))
            often = counted.withColumn("nth", F.row_number().over(Window.partitionBy("u").orderBy(F.desc("lists"), "v"))).filter(F.col("nth") <= STARS)
            pairs = often.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        else:
            other = lists.select("value", F.col("node").alias("v"), F.col("n").alias("m"), F.col("at").alias("j"), F.col("root").alias("other"))
            meet = asks.join(other, "value").filter("root < other").filter(fits)
            pairs = meet.groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).agg(F.count("*").alias("lists")).drop("lists")
        found = _confirmed(texts, sets, nodes, pairs, shingle)
        links = found if links is None else links.unionByName(found)
        roots = components(links)
        lists = lists.drop("root")

    placed = store(nodes.select("node", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "placed")
    firsts = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    known = store(placed.join(firsts, "root").select("node", "component_id", F.col("root").alias("component_key")), "known")
    return rows.join(known, "node").select("doc_id", "text_hash", "words", F.col("n").cast("long").alias("n_shingles"), "component_id", "component_key")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 4) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` as ``near_copies`` finds them, but texts without words have no shingle and no link."""
    none = F.col("words") == 0
    rows = near_copies(docs, id_col, text_col, shingle=shingle).select(
        "doc_id", F.when(none, F.lit(0).cast("long")).otherwise(F.col("n_shingles")).alias("n_shingles"), F.when(none, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
