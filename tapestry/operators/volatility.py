"""Volatility and trend-strength indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.checks import need_period
from ..functions.ewm import Mean, wilder_alpha
from ..functions.exprs import safe_div
from .registry import Means, register

HLC = ("high", "low", "close")


def true_range(t):
    """Greatest of the bar range and the distances to the close before; just the range on the first bar."""
    h, lo, prev = F.col("high"), F.col("low"), t.lag("close")
    return F.greatest(h - lo, F.abs(h - prev), F.abs(lo - prev))


def _check(period):
    need_period(period)


def _wilder(period):
    return [wilder_alpha(period)]


def _full(period):
    return period


@register("trange", "volatility", needs=HLC, lookback=lambda: 1)
def trange(t, x):
    """True range: ``trange``."""
    yield {"trange": true_range(t)}


def _atr(t, x, period, name):
    yield {x("tr"): true_range(t)}
    yield Means({name: Mean(x("tr"), wilder_alpha(period), False)})


@register("atr", "volatility", {"period": 14}, needs=HLC, check=_check, lookback=lambda period: 1, alphas=_wilder, min_rows=_full)
def atr(t, x, period):
    """Average true range: ``atr_{period}``."""
    yield from _atr(t, x, period, f"atr_{period}")


@register("natr", "volatility", {"period": 14}, needs=HLC, check=_check, lookback=lambda period: 1, alphas=_wilder, min_rows=_full)
def natr(t, x, period):
    """ATR in percent of the close: ``natr_{period}``."""
    yield from _atr(t, x, period, x("atr"))
    yield {f"natr_{period}": 100.0 * safe_div(F.col(x("atr")), F.col("close"))}


@register("adx", "volatility", {"period": 14}, needs=HLC, check=_check, alphas=_wilder,
          lookback=lambda period: 1, min_rows=lambda period: 2)
def adx(t, x, period):
    """Directional movement: ``di_plus_p, di_minus_p, adx_p``."""
    up, dn, a = F.col("high") - t.lag("high"), t.lag("low") - F.col("low"), wilder_alpha(period)
    yield {
        x("up"): F.when((up > dn) & (up > 0), up).otherwise(0.0),
        x("dn"): F.when((dn > up) & (dn > 0), dn).otherwise(0.0),
        x("tr"): true_range(t),
    }
    yield Means({x(f"{c}_mean"): Mean(x(c), a, False) for c in ("up", "dn", "tr")})
    plus, minus = (100.0 * safe_div(F.col(x(f"{c}_mean")), F.col(x("tr_mean"))) for c in ("up", "dn"))
    yield {f"di_plus_{period}": plus, f"di_minus_{period}": minus}
    plus, minus = F.col(f"di_plus_{period}"), F.col(f"di_minus_{period}")
    yield {x("dx"): 100.0 * safe_div(F.abs(plus - minus), plus + minus)}
    yield Means({f"adx_{period}": Mean(x("dx"), a, False)}, first=False)


def _check_ultosc(**periods):
    for n, p in periods.items():
        need_period(p, 1, n)


@register("ultosc", "volatility", {"period1": 7, "period2": 14, "period3": 28}, needs=HLC, check=_check_ultosc,
          lookback=lambda **p: max(p.values()), min_rows=lambda **p: max(p.values()))
def ultosc(t, x, period1, period2, period3):
    """Ultimate oscillator: ``ultosc_{p1}_{p2}_{p3}``."""
    yield {x("bp"): F.col("close") - F.least(F.col("low"), t.lag("close")), x("tr"): true_range(t)}
    parts = [w * safe_div(t.total(x("bp"), p), t.total(x("tr"), p)) for w, p in ((4.0, period1), (2.0, period2), (1.0, period3))]
    yield {f"ultosc_{period1}_{period2}_{period3}": 100.0 * (parts[0] + parts[1] + parts[2]) / 7.0}
