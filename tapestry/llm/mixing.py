"""Mixing sources to target weights by Pareto order sampling.

Each source has a target in words.  Whole copies that every document can give are allocated first; the rest is a sample
without replacement with unequal inclusion probabilities: documents are ranked by the odds of a random number divided by
the odds of their inclusion (Pareto order sampling) and taken in that order until the source's words are reached.

The order is never sorted in one task: ranks fall into bins, bins are summed, and only rows of one bin of one source are
sorted together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .common import WORD, store, whole

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
BINS = 4096


def source_targets(totals: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Targets of ``totals`` (source, source_size): weights repeat over the sources by code point, null last.

    The targets share ``share`` of all sizes by weight; none goes above ``most`` times its size, and what is cut off is
    shared again by weight.  The level where that ends is found by sorting the sources by size over weight: those below the
    level are full.  Works on one row per source.
    """
    everyone = Window.partitionBy()
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.partitionBy(F.lit(0)).orderBy("ratio", "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("place") % len(weights) + 1)
    t = totals.withColumn("place", F.row_number().over(by_name) - 1).withColumn("weight", weight)
    t = t.withColumn("cap", F.col("source_size") * most).withColumn("ratio", F.col("cap") / F.col("weight"))
    t = t.withColumns({"all": F.sum("source_size").over(everyone) * share, "weights": F.sum("weight").over(everyone)})
    full, used = F.coalesce(F.sum("cap").over(before), F.lit(0.0)), F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    t = t.withColumn("level", (F.col("all") - full) / (F.col("weights") - used))
    reached = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place", "level"))).over(everyone)["level"]
    target = F.when(reached.isNull(), F.col("cap")).otherwise(F.least("cap", reached * F.col("weight")))
    return t.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, bins: int = BINS, seed: int = 0,
) -> DataFrame:
    """One row per input row: ``doc_id, size, source_size, target, taken``, the source and a hash of the text.

    ``size`` counts the words of the text (null: 0) and ``taken`` the words the mix takes, repeats counted: whole copies and
    at most one cut copy per source, where the target falls inside a document.  Longer documents are included with
    greater probability: in proportion to 1 + floor(log2(size)).  Random numbers are hashes of id, text and ``seed``, so reruns
    agree; rows repeated whole share one random number and stand next to each other.  Null sources are one source.
    """
    text = whole(text_col)
    size = F.regexp_count(text, F.lit(WORD)).cast("long")
    # 52 hash bits, strictly between 0 and 1.
    chance = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col).cast("long"), text), 12).cast("double") + 0.5) / float(1 << 52)
    sized = store(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), F.xxhash64(text).alias("text_hash"), size.alias("size"), chance.alias("u")), "sized")
    grade = F.when(F.col("size") > 0, F.floor(F.log2("size")) + 1).otherwise(0).cast("long")
    sized = sized.withColumn("grade", grade)
    grades = sized.groupBy("source", "grade").agg(F.sum("size").alias("words"))
    targets = source_targets(grades.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)

    # Chance of a grade: level x grade, and certain from 1 on. The level of a source makes the expected words its target.
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = targets.withColumn("copies", copies).withColumn("rest", F.floor(F.col("target")).cast("long") - F.col("copies") * F.col("source_size"))
    g = grades.alias("g").join(plan.alias("p"), F.expr("g.source <=> p.source")).select(F.col("p.source").alias("source"), "grade", "words", "source_size", "target", "copies", "rest")
    above = Window.partitionBy("source").orderBy(F.desc("grade")).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("source").orderBy("grade").rowsBetween(Window.unboundedPreceding, 0)
    certain = F.coalesce(F.sum("words").over(above), F.lit(0))
    g = g.withColumn("certain", certain).withColumn("level", (F.col("rest") - F.col("certain")) / F.sum(F.col("words") * F.col("grade")).over(upto))
    g = g.filter("words > 0 and level * grade < 1")
    best = g.groupBy("source").agg(F.max("grade").alias("top"), F.max_by(F.struct("level", "certain"), "grade").alias("at"))
    plan = store(
        plan.alias("p").join(best.alias("b"), F.expr("p.source <=> b.source"), "left").select(
            F.col("p.source").alias("source"), "source_size", "target", "copies",
            F.coalesce("top", F.lit(0)).alias("top"), F.coalesce("at.level", F.lit(0.0)).alias("level"), (F.col("rest") - F.coalesce("at.certain", F.lit(0))).alias("left"),
        ),
        "plan",
    )

    odds = lambda p: p / (1 - p)
    chosen = sized.alias("s").join(plan.alias("p"), F.expr("s.source <=> p.source")).select(
        "doc_id", "text_hash", F.col("s.source").alias("source"), "size", "u", "source_size", "target", "copies", "left",
        (F.col("grade") > F.col("top")).alias("sure"), (F.col("level") * F.col("grade")).alias("p"),
    )
    chance = F.when((F.col("p") > 0) & ~F.col("sure"), odds(F.col("u")) / odds(F.col("p")))
    chosen = chosen.withColumn("q", chance).withColumn("bin", F.floor(F.col("q") / (1 + F.col("q")) * bins))
    ranked = store(chosen, "ranked")
    sums = ranked.filter("q is not null").groupBy("source", "bin").agg(F.sum("size").alias("words"))
    starts = store(
        sums.select("source", "bin", F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start")),
        "bins",
    )
    in_bin = Window.partitionBy("source", "bin").orderBy("q", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, -1)
    drawn = ranked.filter("q is not null").withColumn("ahead", F.coalesce(F.sum("size").over(in_bin), F.lit(0))).alias("r")
    drawn = drawn.join(starts.alias("b"), F.expr("r.source <=> b.source and r.bin = b.bin")).select(
        "r.*", (F.col("left") - F.col("start") - F.col("ahead")).alias("room")
    )
    others = ranked.filter("q is null").withColumns({"ahead": F.lit(0).cast("long"), "room": F.when(F.col("sure"), F.col("size")).otherwise(0)})
    rows = drawn.unionByName(others)
    taken = F.col("copies") * F.col("size") + F.least("size", F.greatest("room", F.lit(0)))
    return rows.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source", "text_hash")
