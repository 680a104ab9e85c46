"""Joins over market tables: dimension, as-of, range, merge on time, append/upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .history import names, newest, running

def dimension_join(facts: DataFrame, dim: DataFrame, on, *, fact_key: str | None = None, how: str = "left") -> DataFrame:
    """Look up ``dim`` for every fact; Spark broadcasts a dimension whose measured size allows it, and splits hot keys otherwise."""
    if fact_key is None:
        return facts.join(dim, names(on), how)
    return facts.join(dim, facts[fact_key] == dim[on], how).drop(dim[on])


def asof_join(left: DataFrame, right: DataFrame, *, by, ts: str = "ts", tie: str = "seq", values, fill: bool = False,
              strict: bool = False, chunk="auto") -> DataFrame:
    """Give each left row the ``values`` of the newest right row at or before it.

    Both sides are merged into one ordered history and the last right value is carried along, so a hot contract
    is cut like any other history.  ``fill``: carry each value's last non-null separately (partial updates).
    ``strict``: only right rows before the left row's time count.  ``tie`` orders rows of one side at one time.
    """
    by = names(by)
    rank = (0, 1) if not strict else (1, 0)
    whole = F.struct(*[F.col(c) for c in left.columns])
    vals = F.struct(*[F.col(c) for c in values])
    lhs = left.select(*by, F.col(ts).alias("__ts"), F.lit(rank[1]).alias("__side"), F.col(tie).alias("__tie"),
                      whole.alias("__l"))
    rhs = right.select(*by, F.col(ts).alias("__ts"), F.lit(rank[0]).alias("__side"), F.col(tie).alias("__tie"), vals.alias("__v"))
    both = lhs.unionByName(rhs, allowMissingColumns=True)
    if fill:
        lasts = {f"__v_{c}": F.col(f"__v.{c}") for c in values}
    else:
        lasts = {"__last": F.col("__v")}
    out = running(both, by=by, order=["__ts", "__side", "__tie"], lasts=lasts, chunk=chunk).filter(F.col("__l").isNotNull())
    picked = [F.col(f"__v_{c}").alias(c) for c in values] if fill else [F.col(f"__last.{c}").alias(c) for c in values]
    return out.select("__l.*", *picked)


def near_price_buckets(price: Column, tol: float) -> tuple[Column, Column]:
    """Equi-join keys for ``|a - b| <= tol``: (one bucket of the dense side, buckets to explode of the sparse side)."""
    b = F.floor(price / F.lit(2.0 * tol)).cast("long")
    return b, F.array(b - 1, b, b + 1)


def price_range_join(dense: DataFrame, levels: DataFrame, *, by, tol: float, price: str = "price", level: str = "level_price") -> DataFrame:
    """Rows of ``dense`` within ``tol`` of a level, by an equi-join on price buckets and an exact filter.

    A hot price does no harm: AQE broadcasts levels that turn out to be few, and otherwise splits the large side of the sort-merge join.
    """
    by = names(by)
    one, _ = near_price_buckets(F.col(price), tol)
    _, many = near_price_buckets(F.col(level), tol)
    a = dense.withColumn("__b", one)
    b = levels.withColumn("__b", F.explode(many))
    pairs = a.join(b, by + ["__b"]).drop("__b")
    return pairs.filter((F.col(price) >= F.col(level) - tol) & (F.col(price) <= F.col(level) + tol))


def merge_on_time(left: DataFrame, right: DataFrame, *, by="contract", ts: str = "ts") -> DataFrame:
    """Align two series on equal timestamps."""
    return left.join(right, names(by) + [ts], "inner")


def append(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new, allowMissingColumns=True)


def upsert(old: DataFrame, new: DataFrame, *, key, order) -> DataFrame:
    """Append and keep the newest row per key."""
    return newest(append(old, new), 1, by=key, order=order)


def latest_state(df: DataFrame, *, key, order) -> DataFrame:
    """Newest row per key as one partially aggregated pass (the largest record, ordering columns first)."""
    key, order = names(key), names(order)
    rest = [c for c in df.columns if c not in key and c not in order]
    extra = [c for c in order if c not in key]
    best = F.max(F.struct(*order, *rest))
    return df.groupBy(*key).agg(best.alias("__s")).select(*key, *[F.col(f"__s.{c}").alias(c) for c in df.columns if c in rest or c in extra])
