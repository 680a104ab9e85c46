"""Returns, correlation, volatility, drawdown and table profiles."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.checks import ParameterError, need_columns, need_period
from ..functions.history import names, over_history, plan_split, running, same_keys

NUMERIC = ("double", "float", "bigint", "int", "smallint", "tinyint")


def returns(df: DataFrame, column: str = "close", *, by="contract", order="ts", name: str = "returns", chunk="auto") -> DataFrame:
    """Relative change to the row before."""
    need_columns(df, column)

    def body(d, t):
        prev = t.lag(column)
        return d.withColumn(name, F.try_divide(F.col(column) - prev, prev))

    return over_history(df, body, by=by, order=order, lookback=1, chunk=chunk)


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in NUMERIC or t.startswith("decimal")]


def correlation_matrix(df: DataFrame, columns=None, method: str = "pearson", *, by=()) -> DataFrame:
    """Pairwise correlation, one row per column (and group); 1 on the diagonal, 0 where undefined.

    Pearson: all pairs in one aggregation.  Spearman: the same over average ranks of the complete rows of each group.
    """
    by = names(by)
    columns = list(columns or [c for c in numeric_columns(df) if c not in by])
    if not columns:
        raise ParameterError("no numeric columns")
    need_columns(df, *columns)
    if method not in ("pearson", "spearman"):
        raise ParameterError(f"unknown method {method!r}")
    if method == "spearman":
        df = _spearman(df, columns, by)
    pairs = list(combinations(range(len(columns)), 2))
    wide = df.groupBy(*by).agg(*[_corr(columns[i], columns[j]).alias(f"__{i}_{j}") for i, j in pairs], F.count(F.lit(1)).alias("__n"))

    def cell(i, j):
        if i == j:
            return F.lit(1.0)
        return F.coalesce(F.col(f"__{min(i, j)}_{max(i, j)}"), F.lit(0.0))

    lines = [
        F.struct(F.lit(c).alias("column"), *[cell(i, j).alias(other) for j, other in enumerate(columns)]) for i, c in enumerate(columns)
    ]
    return wide.select(*by, F.inline(F.array(*lines)))


def _corr(a: str, b: str) -> Column:
    """Pearson correlation of the rows that have both values; null where one of them is constant."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def average_ranks(df: DataFrame, column: str, *, by=(), name: str = "rank") -> DataFrame:
    """Rank of each row's value in its group, equal values sharing the mean of their ranks.

    Distinct values are ranked in even ranges of the whole order and joined back, so neither a large group nor a value that
    many rows share is one task.
    """
    by = names(by)
    values = running(df.groupBy(*by, column).agg(F.count(F.lit(1)).alias("__n")), by=by, order=[column], sums={"__upto": F.col("__n")})
    ranks = values.select(*by, column, (F.col("__upto") - (F.col("__n") - 1) / 2.0).alias(name))
    return same_keys(df, ranks, [*by, column], True)


def _spearman(df: DataFrame, columns, by) -> DataFrame:
    """Rows with all values, each value replaced by its rank in the group."""
    d = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).dropna(subset=columns)
    for i, c in enumerate(columns):
        d = average_ranks(d, c, by=by, name=f"__rank_{i}")
    return d.select(*by, *[F.col(f"__rank_{i}").alias(c) for i, c in enumerate(columns)])


def pair_correlation(series: DataFrame, pairs: DataFrame | None = None, *, value: str = "returns", contract: str = "contract", ts: str = "ts") -> DataFrame:
    """Correlation of the values of contract pairs (columns ``a, b``) at common times.

    Without ``pairs``: every two contracts of the data that have a common time, the smaller name first.
    """
    named = series.filter(F.col(value).isNotNull())
    left = named.select(F.col(contract).alias("a"), F.col(ts).alias("__ts"), F.col(value).cast("double").alias("__x"))
    right = named.select(F.col(contract).alias("b"), F.col(ts).alias("__ts"), F.col(value).cast("double").alias("__y"))
    if pairs is None:
        both = left.join(right, "__ts").filter(F.col("a") < F.col("b"))
    else:
        both = left.join(pairs.select("a", "b").distinct(), "a").join(right, ["b", "__ts"])
    return both.groupBy("a", "b").agg(_corr("__x", "__y").alias("correlation"), F.count(F.lit(1)).alias("points"))


def volatility_metrics(df: DataFrame, column: str = "close", window: int = 20, *, return_column: str | None = None, by="contract", order="ts",
                       periods_per_year: int = 252, chunk="auto") -> DataFrame:
    """Deviation and mean of the returns, their annual values, and the range of the rolling deviation."""
    need_period(window, 2, "window")
    by = names(by)
    split = plan_split(df, by, names(order), chunk)
    d = df if return_column else split.settle(returns(df, column, by=by, order=order, chunk=split))
    r = return_column or "returns"
    d = over_history(d, lambda x, t: x.withColumn("__roll", t.std(r, window)), by=by, order=order, lookback=window - 1, chunk=split)
    zero, root = F.lit(0.0), float(periods_per_year) ** 0.5
    out = d.groupBy(*by).agg(
        F.coalesce(F.stddev_samp(r), zero).alias("volatility"), F.coalesce(F.avg(r), zero).alias("mean_return"), F.count(r).alias("__n"),
        F.avg("__roll").alias("avg_rolling_volatility"), F.max("__roll").alias("max_rolling_volatility"), F.min("__roll").alias("min_rolling_volatility"),
    )
    return out.filter(F.col("__n") > 0).withColumns({
        "annualized_volatility": F.col("volatility") * root, "annualized_return": F.col("mean_return") * float(periods_per_year),
    }).drop("__n")


def sharpe_ratio(df: DataFrame, return_column: str = "returns", risk_free_rate: float = 0.02, periods_per_year: int = 252, *, by="contract") -> DataFrame:
    """Annual excess return per annual deviation; 0 without data or deviation."""
    mean, std = F.avg(return_column), F.stddev_samp(return_column)
    value = (mean * periods_per_year - risk_free_rate) / (std * float(periods_per_year) ** 0.5)
    return df.groupBy(*names(by)).agg(F.when(std > 0, value).otherwise(0.0).alias("sharpe"))


def longest_run(df: DataFrame, flag: Column, *, by, order, chunk="auto", name: str = "longest_run") -> DataFrame:
    """Length of the longest run of consecutive rows with ``flag``, per group."""
    by = names(by)
    d = running(df.select(*by, *names(order), flag.alias("__flag")), by=by, order=order, chunk=chunk, sums={"__run": F.when(F.col("__flag"), 0).otherwise(1)})
    runs = d.groupBy(*by, "__run").agg(F.count_if("__flag").alias("n"))
    return runs.groupBy(*by).agg(F.max("n").alias(name))


def max_drawdown(df: DataFrame, column: str = "close", *, by="contract", order="ts", chunk="auto") -> DataFrame:
    """Deepest fall below the running peak (negative) and the longest stretch below it.

    Rows at the peak divide the history into reigns; together with the missing values before a row they tell its stretch, so
    one scan in order is enough and the rest is aggregation.
    """
    need_columns(df, column)
    by, order, x = names(by), names(order), F.col(column)
    hole = F.when(x.isNull(), 1).otherwise(0)
    d = running(df.select(*by, *order, column), by=by, order=order, chunk=chunk, maxes={"__peak": x}, reigns={"__reign": "__peak"}, sums={"__holes": hole})
    d = d.withColumn("__dd", F.try_divide(x.cast("double"), F.col("__peak")) - 1.0)
    runs = d.groupBy(*by, "__reign", "__holes").agg(F.min("__dd").alias("__dd"), F.count_if(F.col("__dd") < 0).alias("n"))
    return runs.groupBy(*by).agg(F.least(F.coalesce(F.min("__dd"), F.lit(0.0)), F.lit(0.0)).alias("max_drawdown"), F.max("n").alias("max_drawdown_duration"))


def profile_table(df: DataFrame, limit: int | None = None, *, ts: str | None = None) -> DataFrame:
    """One row per numeric column (or the first ``limit``): type, range and mean, with the number of rows and the time range."""
    cols = numeric_columns(df)[:limit]
    kinds = dict(df.dtypes)
    ts = ts or next((c for c, t in df.dtypes if t.startswith("timestamp")), None)
    span = [F.min(ts).alias("__t0"), F.max(ts).alias("__t1")] if ts else [F.lit(None).cast("timestamp").alias("__t0"), F.lit(None).cast("timestamp").alias("__t1")]
    wide = df.agg(
        F.count(F.lit(1)).alias("__rows"), *span,
        *[f(F.col(c).cast("double")).alias(f"__{k}_{i}") for i, c in enumerate(cols) for k, f in (("lo", F.min), ("hi", F.max), ("mean", F.avg))],
    )
    lines = [
        F.struct(
            F.lit(c).alias("column"), F.lit(kinds[c]).alias("dtype"), F.col(f"__lo_{i}").alias("min"), F.col(f"__hi_{i}").alias("max"),
            F.col(f"__mean_{i}").alias("mean"),
        )
        for i, c in enumerate(cols)
    ]
    return wide.select(F.col("__rows").alias("rows"), F.col("__t0").alias("first_ts"), F.col("__t1").alias("last_ts"), F.inline(F.array(*lines)))
