"""Detection of hidden (iceberg) orders from book levels, depth history and trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import safe_div
from ..functions.history import names, over_history, running
from ..functions.joins import price_range_join
from .flow import within

ORDER = ["ts", "seq"]


def _multiple_of(price: Column, cents: int) -> Column:
    """Price is a whole multiple of ``cents``; in integer ten-thousandths, so no float remainder."""
    return F.pmod(F.round(price * 10000).cast("long"), F.lit(cents * 100)) == 0


def round_price_score(price: Column, fine: bool = False) -> Column:
    """1 / .8 / .6 / .4 on whole, half, quarter and tenth prices; ``fine`` adds .2 on twentieths and .1 elsewhere."""
    s = (
        F.when(_multiple_of(price, 100), 1.0).when(_multiple_of(price, 50), 0.8)
        .when(_multiple_of(price, 25), 0.6).when(_multiple_of(price, 10), 0.4)
    )
    return s.when(_multiple_of(price, 5), 0.2).otherwise(0.1) if fine else s.otherwise(0.0)


def iceberg_heuristic(book: DataFrame, minutes: float = 10, *, asof, by="contract", volume_threshold: int = 500) -> DataFrame:
    """Fresh, large levels on whole or half prices."""
    v = F.col("volume")
    d = within(book, minutes, asof).filter((v > volume_threshold) & _multiple_of(F.col("price"), 50))
    score = F.lit(0.3) + F.when(v > 2 * volume_threshold, 0.4).otherwise(0.2) + F.lit(0.3)
    return d.withColumn("confidence_score", score).select(
        *names(by), "side", "price", "volume", "ts",
        F.when(F.col("confidence_score") >= 0.8 - 1e-9, "high").when(F.col("confidence_score") >= 0.6, "medium").otherwise("low").alias("confidence"),
        "confidence_score", F.floor(v * (2 + F.col("confidence_score"))).alias("estimated_hidden_size"),
    )


def iceberg_refresh(updates: DataFrame, minutes: float = 30, min_refresh: int = 5, consistency: float = 0.85, min_total: int = 1000, *,
                    asof, by="contract") -> DataFrame:
    """Levels refreshed often with nearly the same volume, over the update history (one aggregation)."""
    by = names(by)
    d = within(updates.filter(F.col("side").isin("bid", "ask") & (F.col("volume") > 0)), minutes, asof)
    n = F.count(F.lit(1))
    # Gaps between consecutive updates add up to the time between the first and the last one.
    gap = F.try_divide((F.max(F.unix_micros("ts")) - F.min(F.unix_micros("ts"))) / 1e6, n - 1)
    levels = d.groupBy(*by, "side", "price").agg(
        F.avg("volume").alias("avg_volume"), F.stddev_samp("volume").alias("volume_std"), n.alias("refresh_count"),
        F.sum("volume").alias("total_volume"), gap.alias("avg_refresh_seconds"),
    )
    keep = (F.col("refresh_count") >= min_refresh) & (F.col("total_volume") >= min_total)
    steady = F.try_divide(F.col("volume_std"), F.col("avg_volume")) < 1 - consistency
    return levels.filter(keep & steady).withColumns({
        "confidence": F.lit("medium"), "confidence_score": F.lit(0.7), "estimated_hidden_size": F.col("avg_volume") * 3,
    })


def confirm_with_trades(candidates: DataFrame, trades: DataFrame, tolerance: float = 0.01, *, by="contract") -> DataFrame:
    """Compare candidates (``price, avg_volume, confidence_score``) with the trades executed near their price.

    Trades are first reduced to one row per price, so the range join never pairs single trades.
    """
    by = names(by)
    v = F.col("volume").cast("double")
    prices = trades.groupBy(*by, F.col("price").alias("__p")).agg(
        F.count(F.lit(1)).alias("__n"), F.sum(v).alias("__v"), F.sum(v * v).alias("__vv")
    )
    spots = candidates.select(*by, F.col("price").alias("__level")).distinct()
    near = price_range_join(prices, spots, by=by, tol=tolerance, price="__p", level="__level").groupBy(*by, "__level").agg(
        F.sum("__n").alias("nearby_trades"), F.sum("__v").alias("trade_volume"), F.sum("__vv").alias("__vv")
    )
    n, total = F.col("nearby_trades"), F.col("trade_volume")
    mean = total / n
    std = F.sqrt(F.greatest(F.try_divide(F.col("__vv") - total * total / n, n - 1), F.lit(0.0)))
    near = near.withColumns({
        "avg_trade_size": mean, "__c": F.when(n > 1, 1.0 - F.try_divide(std, mean)).otherwise(1.0),
    }).withColumnRenamed("__level", "price")
    out = candidates.join(near.drop("__vv"), by + ["price"], "left")
    boosted = (F.col("__c") > 0.7) & (F.col("nearby_trades") >= 3)
    return out.withColumns({
        "nearby_trades": F.coalesce("nearby_trades", F.lit(0)),
        "execution_consistency": F.greatest(F.col("__c"), F.lit(0.0)),
        "volume_to_trade_ratio": F.col("avg_volume") / F.greatest(F.lit(1.0), F.col("avg_trade_size")),
        "trade_confirmed": F.coalesce(boosted, F.lit(False)),
        "confidence_score": F.when(boosted, F.least(F.lit(1.0), F.col("confidence_score") * 1.1)).otherwise(F.col("confidence_score")),
    }).drop("__c")


def replenishment_score(updates: DataFrame, *, by=("contract", "side", "price"), order=ORDER, chunk="auto") -> DataFrame:
    """Share of three-update runs in which a level fell below half and came back above 80 %; 0 for fewer than four."""
    by = names(by)

    def body(d, t):
        return d.withColumns({"__a": t.lag("volume", 2), "__b": t.lag("volume", 1)})

    a, b, c = F.col("__a"), F.col("__b"), F.col("volume")
    hits = F.count_if((a > 0) & (b < a * 0.5) & (c > a * 0.8))
    n = F.count(F.lit(1))
    score = F.when(n < 4, 0.0).otherwise(F.least(F.lit(1.0), hits / F.greatest(F.lit(1), n - 2)))
    return over_history(updates, body, by=by, order=order, lookback=2, chunk=chunk).groupBy(*by).agg(
        n.alias("updates"), score.alias("replenishment_score")
    )


def _variation(std: Column, mean: Column) -> Column:
    """Coefficient of variation; null (no consistency at all) when the mean is not positive."""
    return F.when(mean > 0, F.coalesce(std, F.lit(0.0)) / mean)


def level_significance(updates: DataFrame, *, by=("contract", "side", "price")) -> DataFrame:
    """Consistency of a level's volume, weighted by how often it was seen; 0 for fewer than three updates."""
    by = names(by)
    n = F.count(F.lit(1))
    d = updates.groupBy(*by).agg(n.alias("updates"), F.avg("volume").alias("avg_volume"), F.stddev_samp("volume").alias("__s"))
    cv = _variation(F.col("__s"), F.col("avg_volume"))
    value = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - cv)), F.lit(0.0)) * F.least(F.lit(1.0), F.col("updates") / 10.0)
    return d.withColumn("significance", F.when(F.col("updates") < 3, 0.0).otherwise(value)).drop("__s")


def hidden_size(avg_visible: Column, confidence: Column, updates: Column, total_observed: Column) -> Column:
    """Estimated hidden volume: 3 to 10 times the visible one, more with many updates, at most 5 times the observed."""
    # Multiples of the visible and the observed volume.
    factor = (3.0 + confidence * 7.0) * F.when(updates > 5, 1.0 + updates / 20.0).otherwise(1.0)
    return F.least(F.floor(avg_visible * factor), total_observed * 5).cast("long")


def iceberg_multifactor(updates: DataFrame, trades: DataFrame, minutes: float = 60, *, asof, by="contract", order=ORDER, chunk="auto") -> DataFrame:
    """Seven weighted factors per price level over its update history and the trades at its price."""
    by = names(by)
    key = by + ["price"]
    seen = within(updates, minutes, asof)
    steps = running(seen.select(*key, *order, "volume"), by=key, order=order, prevs={"__prev": F.col("volume")}, chunk=chunk)
    refreshed = (F.col("__prev") > 0) & (F.col("volume") > F.col("__prev") * 1.2)
    gaps = running(steps.filter(refreshed), by=key, order=order, prevs={"__last": F.col(order[0])}, chunk=chunk)
    seconds = (F.unix_micros(order[0]) - F.unix_micros("__last")) / 1e6
    rhythm = gaps.groupBy(*key).agg(
        F.count(seconds).alias("refresh_count"), F.avg(seconds).alias("avg_refresh_seconds"), F.stddev_samp(seconds).alias("__gap_std")
    )
    models = seen.groupBy(*key).agg(
        F.count(F.lit(1)).alias("updates"), F.avg("volume").alias("volume_mean"), F.stddev_samp("volume").alias("__std"),
        F.sum("volume").alias("total_observed"),
    ).filter(F.col("updates") >= 5)
    runs = within(trades, minutes, asof).groupBy(*key).agg(
        F.count(F.lit(1)).alias("trades"), F.avg("volume").alias("__tm"), F.stddev_samp("volume").alias("__ts")
    )
    zero, one = F.lit(0.0), F.lit(1.0)
    d = models.join(rhythm, key, "left").join(runs, key, "left").withColumns({
        "refresh_count": F.coalesce("refresh_count", F.lit(0)), "trades": F.coalesce("trades", F.lit(0)),
        "avg_refresh_seconds": F.coalesce("avg_refresh_seconds", zero),
    })
    n, mean = F.col("updates"), F.col("volume_mean")
    gap_mean = F.col("avg_refresh_seconds")
    d = d.withColumns({
        "volume_consistency": F.coalesce(F.greatest(zero, 1.0 - _variation(F.col("__std"), mean)), zero),
        "refresh_regularity": F.when(
            (F.col("refresh_count") >= 2) & (gap_mean > 0), one / (one + F.try_divide(F.col("__gap_std"), gap_mean))
        ).otherwise(zero),
        "price_significance": round_price_score(F.col("price"), fine=True),
        "volume_significance": F.least(one, mean / 1000.0),
        "statistical_confidence": F.least(one, n / 20.0),
        "time_persistence": F.least(one, n / 50.0),
        "execution_correlation": F.when(
            F.col("trades") >= 3, F.greatest(zero, F.coalesce(1.0 - F.try_divide(F.col("__ts"), F.col("__tm")), zero))
        ).otherwise(zero),
    })
    # Factor weights.
    weights = {
        "volume_consistency": 0.30, "refresh_regularity": 0.25, "execution_correlation": 0.20, "volume_significance": 0.10,
        "price_significance": 0.08, "statistical_confidence": 0.04, "time_persistence": 0.03,
    }
    score = sum((F.col(k) * w for k, w in weights.items()), F.lit(0.0))
    d = d.withColumn("confidence_score", score).filter(F.col("confidence_score") >= 0.7)
    s = F.col("confidence_score")
    factor = (
        (5.0 + s * 10.0) * F.when(F.col("refresh_regularity") > 0.8, 1.5).otherwise(1.0)
        * F.when(F.col("volume_consistency") > 0.9, 1.3).otherwise(1.0) * (1.0 + F.col("price_significance") * 0.5)
    )
    checks = (
        F.when(F.col("trades") >= 2, 0.3).otherwise(0.0) + F.when(n >= 10, 0.3).otherwise(0.0)
        + F.when(F.col("refresh_count") >= 3, 0.4).otherwise(0.0)
    )
    d = d.withColumns({
        "estimated_hidden_size": F.least(F.floor(mean * factor), F.col("total_observed") * 3),
        "visible_volume": F.floor(mean),
        "total_estimated_size": F.floor(mean + F.least(F.floor(mean * factor), F.col("total_observed") * 3)),
        "validation_score": checks,
        "statistical_significance": F.least(one, n / 30.0) * 0.6 + F.col("volume_consistency") * 0.4,
        "confidence": F.when(s >= 0.9, "very_high").otherwise("high"),
    }).filter(F.col("validation_score") >= 0.6 - 1e-9)
    return d.drop("__std", "__gap_std", "__tm", "__ts")


def detection_summary(hits: DataFrame, *, by="contract") -> DataFrame:
    """Counts by side and confidence, and the hidden volume in total."""
    side = "side" in hits.columns
    counts = [F.count_if(F.col("side") == s).alias(f"{s}_icebergs") for s in ("bid", "ask")] if side else []
    return hits.groupBy(*names(by)).agg(
        F.count(F.lit(1)).alias("total_detected"), *counts,
        *[F.count_if(F.col("confidence") == c).alias(f"{c}_confidence") for c in ("very_high", "high", "medium", "low")],
        F.sum("estimated_hidden_size").alias("total_hidden"), F.avg("confidence_score").alias("avg_confidence"),
    )


def multifactor_summary(hits: DataFrame, *, by="contract") -> DataFrame:
    """Quality figures of multi-factor detections: how many, how sure, and hidden against visible volume."""
    hidden, visible = F.col("estimated_hidden_size"), F.col("visible_volume")
    return hits.groupBy(*names(by)).agg(
        F.count(F.lit(1)).alias("total_detected"), F.avg("confidence_score").alias("avg_confidence"),
        F.count_if(F.col("confidence_score") >= 0.8).alias("high_confidence_count"), F.sum(hidden).alias("total_hidden"),
        F.avg(F.when(visible > 0, hidden / visible)).alias("avg_size_ratio"),
    )
