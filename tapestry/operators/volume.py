"""Volume indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.checks import need_less, need_period
from ..functions.ewm import Mean, span_alpha
from ..functions.exprs import typical_price
from .registry import Means, Sums, register

HLCV = ("high", "low", "close", "volume")


@register("obv", "volume", needs=("close", "volume"), lookback=lambda: 1)
def obv(t, x):
    """On-balance volume: ``obv``; 0 on the first row."""
    move, v = F.col("close") - t.lag("close"), F.col("volume")
    yield {x("step"): F.when(move > 0, v).when(move < 0, -v).otherwise(0)}
    yield Sums({"obv": F.col(x("step"))})


def _check_vwap(period):
    if period is not None:
        need_period(period)


@register("vwap", "volume", {"period": None}, needs=HLCV, check=_check_vwap, lookback=lambda period: (period or 1) - 1,
          min_rows=lambda period: period or 1)
def vwap(t, x, period):
    """Volume-weighted average price, cumulative (``vwap``) or rolling (``vwap_{period}``); null without volume."""
    v, pv = F.col("volume").cast("double"), typical_price() * F.col("volume")
    if period is not None:
        yield {f"vwap_{period}": F.try_divide(t.total(pv, period), t.total(v, period))}
    else:
        yield Sums({x("pv"): pv, x("v"): v})
        yield {"vwap": F.try_divide(F.col(x("pv")), F.col(x("v")))}


def _ad(name):
    h, lo, c = F.col("high"), F.col("low"), F.col("close")
    return Sums({name: F.when(h != lo, F.try_divide((c - lo) - (h - c), h - lo) * F.col("volume")).otherwise(0.0)})


@register("ad", "volume", needs=HLCV)
def ad(t, x):
    """Accumulation/distribution line: ``ad``; bars without range add nothing."""
    yield _ad("ad")


def _check_adosc(fast_period, slow_period):
    need_period(fast_period, 1, "fast_period")
    need_period(slow_period, 1, "slow_period")
    need_less(fast_period, slow_period, "fast_period < slow_period")


@register("adosc", "volume", {"fast_period": 3, "slow_period": 10}, needs=HLCV, check=_check_adosc,
          alphas=lambda fast_period, slow_period: [span_alpha(fast_period), span_alpha(slow_period)],
          min_rows=lambda fast_period, slow_period: slow_period)
def adosc(t, x, fast_period, slow_period):
    """Fast minus slow EMA of the A/D line: ``adosc_{fast}_{slow}``."""
    yield _ad(x("ad"))
    yield Means({x(n): Mean(x("ad"), span_alpha(p)) for n, p in (("fast", fast_period), ("slow", slow_period))})
    yield {f"adosc_{fast_period}_{slow_period}": F.col(x("fast")) - F.col(x("slow"))}
