"""Overlap indicators: moving averages and bands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions.checks import ParameterError, need_period, need_positive
from ..functions.ewm import Mean, span_alpha
from .registry import Means, register


def _period(minimum=1):
    return lambda period, **_: need_period(period, minimum)


def _of_column(column, **_):
    return [column]


def _window(period, **_):
    return period - 1


def _full(period, **_):
    return period


def _span(period, **_):
    return [span_alpha(period)]


_COLUMN_PERIOD = {"column": "close", "period": 20}


@register("sma", "overlap", _COLUMN_PERIOD, needs=_of_column, check=_period(), lookback=_window, min_rows=_full)
def sma(t, x, column, period):
    """Simple moving average: ``sma_{period}``."""
    yield {f"sma_{period}": t.mean(column, period)}


@register("ema", "overlap", _COLUMN_PERIOD, needs=_of_column, check=_period(), alphas=_span, min_rows=_full)
def ema(t, x, column, period):
    """Exponential moving average with bias-corrected start: ``ema_{period}``."""
    yield Means({f"ema_{period}": Mean(column, span_alpha(period))})


def _check_bands(period, std_dev, **_):
    need_period(period, 2)
    need_positive(std_dev, "std_dev")


@register("bbands", "overlap", {**_COLUMN_PERIOD, "std_dev": 2.0}, needs=_of_column, check=_check_bands, lookback=_window, min_rows=_full)
def bbands(t, x, column, period, std_dev):
    """Bollinger bands: ``bb_middle_p, bb_upper_p, bb_lower_p``."""
    mid, dev = t.mean(column, period), t.std(column, period) * F.lit(float(std_dev))
    yield {f"bb_middle_{period}": mid, f"bb_upper_{period}": mid + dev, f"bb_lower_{period}": mid - dev}


def _chain(x, column, period, levels):
    """Chained exponential means, each over the one before."""
    source = column
    for i in range(levels):
        name = x(f"e{i + 1}")
        yield Means({name: Mean(source, span_alpha(period))}, first=i == 0)
        source = name


@register("dema", "overlap", _COLUMN_PERIOD, needs=_of_column, check=_period(), alphas=_span, min_rows=_full)
def dema(t, x, column, period):
    """Double EMA ``2*e1 - e2``: ``dema_{period}``."""
    yield from _chain(x, column, period, 2)
    yield {f"dema_{period}": 2.0 * F.col(x("e1")) - F.col(x("e2"))}


@register("tema", "overlap", _COLUMN_PERIOD, needs=_of_column, check=_period(), alphas=_span, min_rows=_full)
def tema(t, x, column, period):
    """Triple EMA ``3*e1 - 3*e2 + e3``: ``tema_{period}``."""
    yield from _chain(x, column, period, 3)
    yield {f"tema_{period}": 3.0 * F.col(x("e1")) - 3.0 * F.col(x("e2")) + F.col(x("e3"))}


def _check_wma(period, mode, **_):
    need_period(period)
    if mode not in ("linear", "mean"):
        raise ParameterError(f"mode must be 'linear' or 'mean', got {mode!r}")


@register("wma", "overlap", {**_COLUMN_PERIOD, "mode": "linear"}, needs=_of_column, check=_check_wma, lookback=_window, min_rows=_full)
def wma(t, x, column, period, mode):
    """Linearly weighted moving average (``mode='mean'``: equal weights): ``wma_{period}``."""
    if mode == "mean":
        yield {f"wma_{period}": t.mean(column, period)}
    else:
        terms = [F.lit(float(period)) * F.col(column)] + [float(period - i) * t.lag(column, i) for i in range(1, period)]
        yield {f"wma_{period}": reduce(lambda a, b: a + b, terms) / (period * (period + 1) / 2.0)}


@register("midpoint", "overlap", {"column": "close", "period": 14}, needs=_of_column, check=_period(), lookback=_window, min_rows=_full)
def midpoint(t, x, column, period):
    """Middle of the rolling range of one column: ``midpoint_{period}``."""
    yield {f"midpoint_{period}": (t.high(column, period) + t.low(column, period)) / 2.0}
