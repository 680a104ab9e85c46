"""How filters interact: what each of them removes at each place of every order.

A document is a mask of the filters that it fails.  Masks are counted first, so that what is left is at most 32 cells per
part, whatever the input's size.  Each cell folds over the array of all 120 orders (``transform`` over orders, ``aggregate``
along one) into 600 structs, one per order and step, weighted by the cell's documents; the cells of a part are merged by
elementwise sums.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WHITE, whole

FILTERS = "ABCDE"
LEAST_WORDS = 50
LEAST_DISTINCT = 65  # percent of the words
MOST_CAPITALS = 5  # percent of the code points
SYMBOLS = "[#$%&*|]"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
STEP = "struct<filter:int," + ",".join(f"{c}:bigint" for c in COUNTS) + ">"

FOLD = f"""flatten(transform(orders, o -> aggregate(
    o,
    named_struct('gone', false, 'steps', cast(array() as array<{STEP}>)),
    (acc, f) -> named_struct(
        'gone', acc.gone OR getbit(mask, f) = 1,
        'steps', concat(acc.steps, array(named_struct(
            'filter', f,
            'kept', if(acc.gone OR getbit(mask, f) = 1, 0L, docs),
            'removed', if(NOT acc.gone AND getbit(mask, f) = 1, docs, 0L),
            'redundant', if(acc.gone AND getbit(mask, f) = 1, docs, 0L),
            'unique_fails', if(mask = shiftleft(1, f), docs, 0L),
            'good_lost', if(NOT acc.gone AND getbit(mask, f) = 1, good, 0L),
            'toxic_lost', if(NOT acc.gone AND getbit(mask, f) = 1, toxic, 0L))))),
    acc -> acc.steps)))"""
ADD = "named_struct('filter', x.filter, " + ", ".join(f"'{c}', x.{c} + y.{c}" for c in COUNTS) + ")"
MERGE = f"aggregate(slice(folds, 2, size(folds)), folds[0], (a, b) -> zip_with(a, b, (x, y) -> {ADD}))"
SHAPLEY = "transform(sequence(0, 4), f -> aggregate(steps, 0L, (a, x) -> a + if(x.filter = f, x.removed, 0L)))"


def orders() -> Column:
    """All orders of the filters, in alphabetical order, as a constant array of arrays."""
    return F.array(*[F.array(*[F.lit(f) for f in order]) for order in permutations(range(len(FILTERS)))])


def own_failures(text: Column) -> Column:
    """Mask of the filters that look at a text alone (A to D), from columns ``words`` and ``body``."""
    n = F.size("words")
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))
    fails = [
        n < LEAST_WORDS,
        100 * F.size(F.array_distinct("words")) < LEAST_DISTINCT * n,
        100 * capitals > MOST_CAPITALS * F.char_length(text),
        text.rlike(SYMBOLS),
    ]
    return sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(fails)), F.lit(0))


def masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``part, mask, docs, good, toxic``: documents of each part that fail exactly the filters in ``mask``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), whole(text_col).alias("body"))
    rows = rows.withColumn("words", F.array_remove(F.split("body", WHITE), "")).select(
        "doc_id", "part", F.xxhash64("body").alias("h1"), F.xxhash64(F.lit(1), F.col("body")).alias("h2"), own_failures(F.col("body")).alias("mask")
    )
    same = rows.groupBy("doc_id", "part", "h1", "h2", "mask").agg(F.count("*").alias("n"))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("q"), (F.col("toxic") == 1).alias("t"))
    marks = marks.groupBy("doc_id").agg(F.coalesce(F.max("q"), F.lit(False)).alias("good"), F.coalesce(F.max("t"), F.lit(False)).alias("toxic"))
    same = same.join(marks, "doc_id", "left").fillna(False, ["good", "toxic"])
    # Rows of one text that all but the smallest id fail E; ids are counted down to a few rows per text before they meet.
    texts = same.groupBy("h1", "h2", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
        F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("at_first"),
    )
    lowest = F.min("first").over(Window.partitionBy("h1", "h2"))
    texts = texts.withColumn("fresh", F.col("unnamed") + F.when(F.col("first") == lowest, F.col("at_first")).otherwise(0))
    both = F.array(
        F.struct(F.col("mask").alias("mask"), F.col("fresh").alias("n")),
        F.struct((F.col("mask") + (1 << FILTERS.index("E"))).alias("mask"), (F.col("n") - F.col("fresh")).alias("n")),
    )
    cells = texts.select("part", "good", "toxic", F.inline(both)).filter("n > 0")
    weight = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0))
    return cells.groupBy("part", "mask").agg(F.sum("n").alias("docs"), weight("good").alias("good"), weight("toxic").alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per part, order of the filters and step: ``part, filter_order, step, filter``, the ``COUNTS`` and ``shapley``.

    Every row of ``docs`` is a document, repeated rows included; parts are the values of ``part_col``, null and empty being
    one.  Null texts are empty.  E compares with smaller ids only, so rows of one id do not fail each other, and a null id is
    neither smaller nor larger than any.  A document is good (toxic) if any row of ``labels`` with its id says so.  An empty
    table has no parts and gives no rows; other columns are ignored.
    """
    folded = masks(docs, labels, id_col, text_col, part_col).select("part", "mask", "docs", "good", "toxic", orders().alias("orders")).select("part", F.expr(FOLD).alias("fold"))
    merged = folded.groupBy("part").agg(F.collect_list("fold").alias("folds")).select("part", F.expr(MERGE).alias("steps"))
    rows = merged.withColumn("shares", F.expr(SHAPLEY)).select("part", "shares", F.posexplode("steps").alias("at", "s"))
    named = F.lit(["".join(p) for p in permutations(FILTERS)])
    return rows.select(
        "part", F.element_at(named, F.floor(F.col("at") / 5).cast("int") + 1).alias("filter_order"), (F.col("at") % 5 + 1).alias("step"),
        F.substring(F.lit(FILTERS), F.col("s.filter") + 1, F.lit(1)).alias("filter"), *[F.col(f"s.{c}").alias(c) for c in COUNTS],
        F.element_at("shares", F.col("s.filter") + 1).alias("shapley"),
    )
