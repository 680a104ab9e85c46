"""Exact deduplication by deterministic block naming.

A normalised text is cut into blocks of a fixed number of bytes.  The distinct blocks are sorted and get integer names;
names of adjacent blocks are paired, the distinct pairs sorted and named again, until each document has one name.  Equal
names of documents with equally many blocks mean equal texts: names come from comparing contents, not from hashes, so
nothing can collide.

A block or pair that occurs once needs no name, because its document has no equal; such documents leave at once.  Only
repeated blocks are joined back, so a group of copies meets its name in a join that Spark can split, never in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import WHITE, store, whole

BLOCK_BYTES = 8192


def _named(distinct: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Integer names of the rows of ``distinct`` that stand for several: their place in the sorted partitions."""
    repeated = distinct.filter(F.col("times") > 1).select(*keys)
    return store(repeated.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id()), label)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256`` and ``text_hash`` of the text as it is.

    Of equal normalised texts (white space deleted, null as empty) the row with the most code points in the original
    text stays, then the smallest id (a null id comes first).  Rows repeated whole are a group of which one stays.
    Empty texts equal each other.  Other columns are ignored, whatever their names.
    """
    text = whole(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.char_length(text).cast("long").alias("points"), F.xxhash64(text).alias("hash"), F.regexp_replace(text, WHITE, "").alias("norm"))
    rows = rows.withColumn("body", F.encode("norm", "UTF-8")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "points", "hash", F.sha2("norm", 256).alias("sha"), "body",
        F.greatest(F.ceil(F.octet_length("body") / block_bytes), F.lit(1)).cast("int").alias("n"),
    )
    blocks = rows.select(
        "row", "doc_id", "points", "hash", "sha", "n",
        F.posexplode(F.expr(f"transform(sequence(0, n - 1), i -> substring(body, i * {block_bytes} + 1, {block_bytes}))")).alias("pos", "block"),
    )
    names = _named(blocks.groupBy("block").agg(F.count("*").alias("times")), ["block"], "block-names")
    first = F.col("pos") == 0
    placed = store(
        blocks.join(names, "block", "left").select(
            "row", "pos", "name", "n", *[F.when(first, F.col(c)).alias(c) for c in ("doc_id", "points", "hash", "sha")]
        ),
        "placed",
    )
    about = placed.filter(first).select("row", "doc_id", "points", "hash", "sha", F.col("n").alias("blocks"))
    named = placed.select("row", "pos", "name", "n")
    longest = placed.agg(F.max("n")).first()[0] or 1
    finished = []
    while True:
        unnamed = F.max(F.col("name").isNull().cast("int")).over(Window.partitionBy("row"))
        named = named.withColumn("alone", unnamed).filter("alone = 0").drop("alone")
        finished.append(named.filter("n = 1").select("row", "name"))
        if longest == 1:
            break
        pairs = store(
            named.filter("n > 1").groupBy("row", F.expr("pos div 2").cast("int").alias("pos")).agg(
                F.max(F.expr("if(pos % 2 = 0, name, null)")).alias("a"),
                F.coalesce(F.max(F.expr("if(pos % 2 = 1, name, null)")), F.lit(-1)).alias("b"),
                F.max(F.expr("cast((n + 1) div 2 as int)")).alias("n"),
            ),
            "pairs",
        )
        names = _named(pairs.groupBy("a", "b").agg(F.count("*").alias("times")), ["a", "b"], "pair-names")
        named = pairs.join(names, ["a", "b"], "left").select("row", "pos", "name", "n")
        longest = (longest + 1) // 2
        if longest > 1:
            named = store(named, "named")
    identity = finished[0]
    for more in finished[1:]:
        identity = identity.unionByName(more)
    rows = store(about.join(identity, "row", "left"), "identities")

    # Longest original text first, then the smallest id: one number that hash aggregation can keep.
    rank = F.expr("cast(points as decimal(38, 0)) * 18446744073709551616 - cast(coalesce(doc_id, -9223372036854775808) as decimal(38, 0))")
    groups = store(
        rows.filter("name is not null").withColumn("rank", rank).groupBy("blocks", "name").agg(
            F.max_by("doc_id", "rank").alias("keep_id"), F.max_by("row", F.struct("rank", -F.col("row"))).alias("keep_row"), F.count("*").alias("group_size")
        ),
        "groups",
    )
    out = rows.join(groups, ["blocks", "name"], "left")
    alone = F.col("group_size").isNull()
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("keep_row") == F.col("row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
        F.col("hash").alias("text_hash"),
    )
