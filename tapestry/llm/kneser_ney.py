"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is a character model over a fixed alphabet of 64 symbols, so an n-gram of up to 10 is an integer.  Documents are dealt
into blocks by a hash of their id.  A block counts the n-grams of its trusted documents and names the n-grams that any of
its documents has; both are far fewer than the characters.  The frequent n-grams of a bounded sample of the documents are in
most blocks, so all tasks know them: their counts travel as arrays and nobody asks for them.  The sample changes no result.
Counts, continuation counts, discounts and back-off weights are sharded by n-gram and joined order by order; the
log-probabilities go back to the blocks that asked for them, those of the frequent n-grams to all, where they are summed
per document.  Thresholds are quantiles of the trusted documents' perplexities, language by language.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import partitions, store, whole

ORDER = 4
QUERY_ORDER = 6  # of op1: 64 ** 6 n-grams are no ceiling, what is counted grows with the text
BITS = 6
SYMBOLS = 1 << BITS
QUANTILE = 0.995
SLACK = 1.15  # of the quantile's log-perplexity, so that ordinary documents outside the trusted set pass
SHORT = 12.0  # a text of n symbols may exceed the threshold's log-perplexity by SHORT / n ...
TRUSTED_LEAST = 30  # trusted documents a language needs for a quantile of its own
BATCH = 1 << 20
BLOCK_DOCS = 4096  # documents of a block, on average: its n-grams and its texts meet in one task
SAMPLE_DOCS = 1 << 14  # documents that are looked at for frequent n-grams, on average at most twice as many
FREQUENT = 1 << 20  # n-grams that all tasks know, the most frequent ones of the sample
SLICE = 1 << 10  # of them in one array of counts


def _symbol_table() -> np.ndarray:
    """Symbol of each code point up to U+02FF: 0 start, 1 white space, 2 digit, 3 sentence end, 4 other sign, 5 other letter,
    6-31 a-z, 32-63 the letters U+00DF to U+00FF; capitals count as small letters."""
    out = np.full(0x301, 4, np.uint8)
    for code in range(0x300):
        c = chr(code)
        low = c.lower() if len(c.lower()) == 1 else c
        if "a" <= low <= "z":
            out[code] = 6 + ord(low) - 97
        elif 0xDF <= ord(low) <= 0xFF and low.isalpha():
            out[code] = 32 + (ord(low) - 0xDF) % 32
        elif c.isspace():
            out[code] = 1
        elif c.isdigit():
            out[code] = 2
        elif c in ".!?":
            out[code] = 3
        elif c.isalpha():
            out[code] = 5
    out[0x300] = 5  # everything above
    return out


TABLE = _symbol_table()


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return TABLE[np.minimum(codes, 0x300)]


def grams(syms: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The n-gram that ends at each symbol, as an integer; the text begins after ``order - 1`` start symbols."""
    padded = np.concatenate([np.zeros(order - 1, np.int64), syms.astype(np.int64)])
    out = np.zeros(len(syms), np.int64)
    for k in range(order):
        out = (out << BITS) | padded[k : k + len(syms)]
    return out


def _ungram(gram: int, order: int = ORDER) -> tuple[int, ...]:
    return tuple((gram >> (BITS * k)) & (SYMBOLS - 1) for k in range(order - 1, -1, -1))


def _packed(texts: pd.Series) -> pd.Series:
    """The symbols of each text, compressed: half as long as the text in a shuffle, and read off once."""
    return pd.Series([zlib.compress(symbols(t).tobytes(), 1) for t in texts], dtype=object)


def _batches(texts, order: int = ORDER):
    """Row numbers and n-grams of some texts (or packed symbols) at a time; a long text is cut, with the symbols before the cut as context."""
    held, rows, n = [], [], 0
    for i, text in enumerate(texts):
        syms = symbols(text) if isinstance(text, str) else np.frombuffer(zlib.decompress(text), np.uint8)
        for a in range(0, len(syms), BATCH):
            lead = min(a, order - 1)
            g = grams(syms[a - lead : a + BATCH], order)[lead:]
            held.append(g)
            rows.append(np.full(len(g), i, np.int32))
            n += len(g)
            if n >= BATCH:
                yield np.concatenate(rows), np.concatenate(held)
                held, rows, n = [], [], 0
    if held:
        yield np.concatenate(rows), np.concatenate(held)


def _trusted(frame: pd.DataFrame) -> np.ndarray:
    ids = set(frame.loc[frame["kind"] == 0, "doc_id"].tolist())
    return np.array([x in ids for x in frame.loc[frame["kind"] == 1, "doc_id"].tolist()], bool)


def _frequent(docs: DataFrame, id_col: str, text_col: str, times: int, order: int) -> np.ndarray:
    """The most frequent n-grams in one document of ``times``, ascending."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for _, g in _batches(frame["body"].tolist(), order):
                found, n = np.unique(g, return_counts=True)
                yield pd.DataFrame({"gram": found, "n": n})

    some = docs.filter(F.pmod(F.xxhash64(id_col, text_col), F.lit(times)) == 0).select(whole(text_col).alias("body"))
    counted = store(some.mapInPandas(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")), "frequent")
    return np.sort(counted.orderBy(F.desc("n"), "gram").limit(FREQUENT).select("gram").toArrow()["gram"].to_numpy())


def _counter(order: int, frequent: np.ndarray):
    def count(frame: pd.DataFrame) -> pd.DataFrame:
        """How often a block's trusted documents have its n-grams: ``counts`` of a slice of ``frequent``, if any; (block, gram, trusted) of all others."""
        block, trusted = frame["block"].iloc[0], _trusted(frame).astype(np.int64)
        marked, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]  # the last bit of a marked n-gram says whether the text is trusted
        for rows, g in _batches(frame.loc[frame["kind"] == 1, "body"].tolist(), order):
            found, n = np.unique((g << 1) | trusted[rows], return_counts=True)
            marked.append(found)
            times.append(n)
        marked, times = np.concatenate(marked), np.concatenate(times)
        found, place = np.unique(marked >> 1, return_inverse=True)
        counts = np.bincount(place, times * (marked & 1), len(found)).astype(np.int64)
        at = np.searchsorted(frequent, found)
        known = np.append(frequent, -1)[at] == found
        dense = np.zeros(-(-len(frequent) // SLICE) * SLICE, np.int64)
        dense[at[known]] = counts[known]
        slices = [(k, v) for k, v in enumerate(dense.reshape(-1, SLICE)) if v.any()]
        rare = pd.DataFrame({"block": block, "gram": found[~known], "trusted": counts[~known]})
        arrays = pd.DataFrame({"slice": pd.array([k for k, _ in slices], "Int32"), "counts": pd.Series([v for _, v in slices], dtype=object)})
        out = pd.concat([rare.astype({"block": "Int32", "gram": "Int64", "trusted": "Int64"}), arrays], ignore_index=True)
        return out[["block", "gram", "trusted", "slice", "counts"]].assign(counts=out["counts"].where(out["counts"].notna(), None))

    return count


def _summed(counted: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(gram, trusted) over all blocks, of every n-gram that is in one or in ``frequent``."""
    spark = counted.sparkSession
    rare = counted.filter("gram is not null").groupBy("gram").agg(F.sum("trusted").alias("trusted"))
    gram_at = F.pandas_udf(lambda at: pd.Series(frequent[at.to_numpy()]), "long")
    arrays = counted.filter("counts is not null").select("slice", "counts").repartition(partitions(spark), "slice")  # an array is opened where it is summed
    sums = arrays.select("slice", F.posexplode("counts").alias("nth", "c")).groupBy("slice", "nth").agg(F.sum("c").alias("trusted"))
    # Those that no trusted document has are asked for all the same, and no array need hold them.
    every = spark.range(len(frequent)).select(F.col("id").alias("at"))
    sums = every.join(sums.select((F.col("slice") * F.lit(SLICE) + F.col("nth")).cast("long").alias("at"), "trusted"), "at", "left")
    return sums.select(gram_at("at").alias("gram"), F.coalesce("trusted", F.lit(0).cast("long")).alias("trusted")).unionByName(rare)


def _scorer(order: int, frequent: np.ndarray, logp: np.ndarray):
    def score(frame: pd.DataFrame, rare: pd.DataFrame) -> pd.DataFrame:
        docs = frame[frame["kind"] == 1]
        gram, value = np.append(frequent, rare["gram"].to_numpy("int64")), np.append(logp, rare["logp"].to_numpy("float32"))
        by = np.argsort(gram, kind="stable")
        gram, value = gram[by], value[by]
        total, n = np.zeros(len(docs)), np.zeros(len(docs), np.int64)
        for rows, g in _batches(docs["body"].tolist(), order):
            total += np.bincount(rows, value[np.searchsorted(gram, g)] if len(g) else None, len(docs))
            n += np.bincount(rows, minlength=len(docs))
        return pd.DataFrame({"doc_id": docs["doc_id"].astype("Int64"), "lang": docs["lang"], "trusted": _trusted(frame), "n_symbols": n, "logp": total})

    return score


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more, from how many n-grams occur 1, 2, 3 and 4 times."""
    if not n1 or not n2:
        return (0.5, 0.5, 0.5)  # too few n-grams to estimate
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw))


def log_probabilities(counted: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, logp) of every n-gram in ``counted`` (gram, trusted), seen in trusted text or not."""
    counts = {order: store(counted.filter("trusted > 0").select("gram", F.col("trusted").alias("c")), "counts")}
    wanted = {order: counted.select("gram")}
    for n in range(order - 1, 0, -1):
        shorter = F.expr(f"gram & {(1 << (BITS * n)) - 1}").alias("gram")
        counts[n] = store(counts[n + 1].groupBy(shorter).agg(F.count("*").alias("c")), "counts")
        wanted[n] = wanted[n + 1].select(shorter).distinct()
    below = None
    for n in range(1, order + 1):
        c = counts[n].withColumn("context", F.shiftright("gram", BITS))
        many = c.agg(*[F.count(F.when(F.col("c") == k, 1)) for k in (1, 2, 3, 4)]).first()
        d1, d2, d3 = discounts(*many)
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        contexts = c.groupBy("context").agg(F.sum("c").alias("total"), F.sum(cut).alias("saved"))
        w = wanted[n].withColumn("context", F.shiftright("gram", BITS)).join(counts[n], "gram", "left").join(contexts, "context", "left")
        own, spared = F.coalesce(F.greatest(F.col("c") - cut, F.lit(0.0)) / F.col("total"), F.lit(0.0)), F.coalesce(F.col("saved") / F.col("total"), F.lit(1.0))
        if below is None:
            below = w.select("gram", (own + spared / SYMBOLS).alias("p"))
        else:
            suffix = F.expr(f"gram & {(1 << (BITS * (n - 1))) - 1}").alias("suffix")
            lower = below.select(F.col("gram").alias("suffix"), F.col("p").alias("q"))
            below = w.withColumn("suffix", suffix).join(lower, "suffix").select("gram", (own + spared * F.col("q")).alias("p"))
        if n < order:
            below = store(below, "probabilities")
    return below.select("gram", F.log("p").alias("logp"))


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *, quantile: float = QUANTILE, slack: float = SLACK,
    order: int = ORDER,
) -> DataFrame:
    """One row per input row: ``doc_id, lang, n_symbols, perplexity, threshold, kept``.

    The model has n-grams of ``order`` symbols, 10 at most.  Trusted are documents with labels of quality 1 only and none of toxic 1.  A document passes if its log-perplexity is at
    most ``slack`` times that of its language's quantile of the trusted ones, plus ``SHORT / n_symbols``.  Languages with
    fewer than ``TRUSTED_LEAST`` trusted documents, and null, take the quantile over all languages.  Null and empty texts
    have no perplexity and do not pass; without any trusted document all others pass.  Rows repeated whole are scored alike;
    other columns are ignored, and labels of unknown documents have no effect.
    """
    n_docs = docs.count()
    blocks = max(1, math.ceil(n_docs / BLOCK_DOCS))
    block = F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int").alias("block")
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).alias("lang"), F.pandas_udf(_packed, "binary")(whole(text_col)).alias("body"))
    good = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("q"), F.max("toxic").alias("t")).filter("doc_id is not null and q = 1 and coalesce(t, 0) = 0")
    rows = text.select(block, F.lit(1).alias("kind"), "*").unionByName(good.select(block, F.lit(0).alias("kind"), "doc_id"), allowMissingColumns=True)
    frequent = _frequent(docs, id_col, text_col, max(1, n_docs // SAMPLE_DOCS), order)
    counted = store(rows.groupBy("block").applyInPandas(_counter(order, frequent), "block int, gram long, trusted long, slice int, counts array<long>"), "grams")
    logp = store(log_probabilities(store(_summed(counted, frequent), "all-grams"), order).withColumn("logp", F.col("logp").cast("float")), "logp")
    rare = store(counted.filter("gram is not null").select("block", "gram").join(logp, "gram"), "rare")
    # At most FREQUENT values, for all tasks.
    is_frequent = F.pandas_udf(lambda g: pd.Series(np.append(frequent, -1)[np.searchsorted(frequent, g.to_numpy())] == g.to_numpy()), "boolean")
    values = logp.filter(is_frequent("gram")).toArrow().to_pandas().sort_values("gram")["logp"].to_numpy("float32")
    scored = rows.groupBy("block").cogroup(rare.groupBy("block")).applyInPandas(_scorer(order, frequent, values), "doc_id long, lang string, trusted boolean, n_symbols long, logp double")
    scored = store(scored.withColumn("loss", F.when(F.col("n_symbols") > 0, -F.col("logp") / F.col("n_symbols"))), "scored")

    sure = scored.filter("trusted and loss is not null")
    limit = F.percentile_approx("loss", quantile, 10_000)
    overall = sure.agg(limit.alias("q")).first()[0]
    own = sure.groupBy("lang").agg(limit.alias("q"), F.count("*").alias("n")).filter((F.col("n") >= TRUSTED_LEAST) & F.col("lang").isNotNull())
    bound = F.coalesce("q", F.lit(math.inf if overall is None else overall)) * slack
    out = scored.join(own.select("lang", "q"), "lang", "left").withColumn("bound", bound)
    return out.select(
        "doc_id", "lang", "n_symbols", F.exp("loss").alias("perplexity"), F.exp("bound").alias("threshold"),
        F.coalesce(F.col("loss") <= F.col("bound") + SHORT / F.col("n_symbols"), F.lit(False)).alias("kept"),
    )
