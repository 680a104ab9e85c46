"""Quality rules with cross-document line frequency, in DataFrame functions only.

Every line is normalised and hashed; per host the distinct documents of each hash are counted.  Lines above the limit count
as boilerplate, and a document that loses most of its words with them is rejected, as is one that fails the base rules on
length and repetition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import WHITE, WORD, store, whole

MIN_WORDS = 50
MOST_REPEATED = 50  # percent of the words
LINE_SHARE = 0.01  # of the distinct documents of a host
LINE_DOCS = 20  # and in more documents than this
MOST_REMOVED = 0.5  # of the words
SYMBOLS = "#*$%&|<>"


def line_hash(line: Column) -> Column:
    """Hash of a line in lower case with single spaces."""
    return F.xxhash64(F.lower(F.btrim(F.regexp_replace(line, WHITE, " "))))


def lines_of(text: Column) -> Column:
    """The \\n-split lines that have a word."""
    return F.filter(F.split(text, "\n", -1), lambda x: F.regexp_like(x, F.lit(WORD)))


def base_metrics(docs: DataFrame, text: str) -> DataFrame:
    """Add the base columns from ``text`` (not null): words, their code points, symbols, repeated lines and windows.

    ``n_repeat_words``: hashes of the 3-word windows are sorted with their places; equal neighbours are repeated windows,
    and walking their places in order counts every covered word once.  Only texts with an equal pair are sorted that way.
    """
    white = F.lit(" \t\n\x0b\x0c\r")
    t = F.col(text)
    d = docs.withColumn("w_trim", F.btrim(t, white)).withColumn("w_all", F.when(F.col("w_trim") == "", F.array().cast("array<string>")).otherwise(F.split("w_trim", WHITE)))
    d = d.withColumns(
        {
            "n_words": F.size("w_all").cast("long"),
            "word_chars": F.char_length(F.regexp_replace(t, WHITE, "")).cast("long"),
            "n_symbols": (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long"),
            "w_lines": lines_of(t),
            "w_grams": F.expr("if(size(w_all) < 3, array(), transform(sequence(0, size(w_all) - 3), i -> xxhash64(get(w_all, i), get(w_all, i + 1), get(w_all, i + 2))))"),
        }
    )
    d = d.withColumns(
        {
            "n_dup_lines": (F.size("w_lines") - F.size(F.array_distinct("w_lines"))).cast("long"),
            "w_sorted": F.expr("if(size(array_distinct(w_grams)) = size(w_grams), array(), sort_array(transform(w_grams, (h, i) -> struct(h, i))))"),
        }
    )
    places = "sort_array(transform(filter(w_sorted, (x, j) -> coalesce(get(w_sorted, j - 1).h = x.h, false) or coalesce(get(w_sorted, j + 1).h = x.h, false)), x -> x.i))"
    covered = f"aggregate({places}, struct(0L as total, -3L as last), (a, p) -> struct(a.total + least(3L, p - a.last) as total, cast(p as bigint) as last), a -> a.total)"
    return d.withColumn("n_repeat_words", F.expr(covered))


def frequent_lines(lines: DataFrame, share: float, least: int) -> DataFrame:
    """Of ``lines`` (host, body, line), the (host, line) in more than ``least`` documents and more than ``share`` of the host's.

    Equal texts (equal ``body``) are one document, so copies do not make their own lines boilerplate.
    """
    once = lines.groupBy("host", "line", "body").agg(F.count("*").alias("n"))
    docs = once.groupBy("host", "line").agg(F.count("*").alias("docs")).filter(F.col("docs") > least)
    hosts = lines.groupBy("host", "body").agg(F.count("*").alias("n")).groupBy("host").agg(F.count("*").alias("host_docs"))
    above = docs.alias("d").join(hosts.alias("h"), F.expr("d.host <=> h.host")).filter(F.col("docs") > F.col("host_docs") * share)
    return above.select("d.host", "line", "docs")


def line_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", *, share: float = LINE_SHARE,
    least: int = LINE_DOCS, most_removed: float = MOST_REMOVED, min_words: int = MIN_WORDS, most_repeated: float = MOST_REPEATED,
) -> DataFrame:
    """One row per input row: ``doc_id, n_words``, base metrics, ``base_failed, kept, removed_words``.

    A null text is empty and fails (no words); a null host is a host of its own; rows repeated whole are judged alike.
    Other columns are ignored, whatever their names.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).alias("host"), whole(text_col).alias("body_text")
    )
    judged = store(
        base_metrics(rows, "body_text").select(
            "row", "doc_id", "host", F.xxhash64("body_text").alias("body"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            F.transform("w_lines", lambda x: F.struct(line_hash(x).alias("line"), F.regexp_count(x, F.lit(WORD)).alias("words"))).alias("lines"),
        ),
        "lines",
    )
    lines = judged.select("row", "host", "body", F.inline("lines"))
    above = store(frequent_lines(lines, share, least), "frequent-lines")
    # Each line of a document once per join row: repeated lines are summed first.
    mine = lines.groupBy("row", "host", "line").agg(F.sum("words").alias("words"))
    removed = mine.alias("m").join(above.alias("a"), F.expr("m.line = a.line and m.host <=> a.host")).groupBy("row").agg(F.sum("words").alias("removed"))
    out = judged.drop("lines").join(removed, "row", "left").withColumn("removed_words", F.coalesce("removed", F.lit(0)).cast("long"))
    out = out.withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words")))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("removed_words") <= most_removed * F.col("n_words"))).alias("kept"), "removed_words", "host",
        F.col("body").alias("text_hash"),
    )


def strip_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", *, share: float = LINE_SHARE, least: int = LINE_DOCS) -> DataFrame:
    """The real output: ``doc_id, text, removed_lines`` with the frequent lines of each host taken out, order kept."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).alias("host"), whole(text_col).alias("body_text")
    )
    split = store(rows.select("row", "doc_id", "host", F.xxhash64("body_text").alias("body"), F.posexplode(F.split("body_text", "\n", -1)).alias("pos", "words")), "split-lines")
    split = split.withColumn("line", F.when(F.regexp_like("words", F.lit(WORD)), line_hash(F.col("words"))))
    above = frequent_lines(split.filter("line is not null"), share, least)
    marked = split.alias("s").join(above.alias("a"), F.expr("s.line = a.line and s.host <=> a.host"), "left").select("row", "doc_id", "pos", "words", F.col("docs").isNotNull().alias("out"))
    left = F.array_sort(F.collect_list(F.when(~F.col("out"), F.struct("pos", "words"))))
    return marked.groupBy("row", "doc_id").agg(F.concat_ws("\n", F.transform(left, lambda x: x["words"])).alias("text"), F.sum(F.col("out").cast("long")).alias("removed_lines")).drop("row")
