"""Momentum indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.checks import ParameterError, need_less, need_period, need_positive
from ..functions.ewm import Mean, span_alpha, wilder_alpha
from ..functions.exprs import positive_zero, safe_div, typical_price
from .registry import Means, register

HLC = ("high", "low", "close")
RSI_NOISE = 1e-9


def _of_column(column, **_):
    return [column]


def _window(period, **_):
    return period - 1


def _full(period, **_):
    return period


def _one_more(period, **_):
    return period + 1


def _check_rsi(mode="raw", **periods):
    for name, v in periods.items():
        if name.endswith("period"):
            need_period(v, 1, name)
    if mode not in ("raw", "standard"):
        raise ParameterError(f"mode must be 'raw' or 'standard', got {mode!r}")


def _rsi(t, x, column, period, mode):
    """``rsi_{period}``; without any loss it is 0 in raw mode and 100 in standard mode."""
    move = F.col(column) - t.lag(column)
    yield {x("up"): F.when(move > 0, move).otherwise(0.0), x("down"): F.when(move < 0, -move).otherwise(0.0)}
    a = wilder_alpha(period)
    yield Means({x("gain"): Mean(x("up"), a, False), x("loss"): Mean(x("down"), a, False)})
    gain, loss = F.col(x("gain")), F.col(x("loss"))
    value = 100.0 - 100.0 / (1.0 + safe_div(gain, loss))
    if mode == "standard":
        value = F.when((loss == 0) & (gain > 0), 100.0).otherwise(value)
    yield {f"rsi_{period}": value}


@register("rsi", "momentum", {"column": "close", "period": 14, "mode": "raw"}, needs=_of_column, check=_check_rsi,
          lookback=lambda **_: 1, alphas=lambda period, **_: [wilder_alpha(period)], min_rows=_one_more)
def rsi(t, x, column, period, mode):
    """Relative strength index with Wilder smoothing: ``rsi_{period}``."""
    yield from _rsi(t, x, column, period, mode)


def _check_macd(fast_period, slow_period, signal_period, **_):
    for v in (fast_period, slow_period, signal_period):
        need_period(v)
    need_less(fast_period, slow_period, "fast_period < slow_period")


@register("macd", "momentum", {"column": "close", "fast_period": 12, "slow_period": 26, "signal_period": 9},
          needs=_of_column, check=_check_macd,
          alphas=lambda fast_period, slow_period, signal_period, **_: [span_alpha(p) for p in (fast_period, slow_period, signal_period)],
          min_rows=lambda slow_period, **_: slow_period)
def macd(t, x, column, fast_period, slow_period, signal_period):
    """MACD: ``macd, macd_signal, macd_histogram``."""
    yield Means({x("fast"): Mean(column, span_alpha(fast_period)), x("slow"): Mean(column, span_alpha(slow_period))})
    yield {"macd": F.col(x("fast")) - F.col(x("slow"))}
    yield Means({"macd_signal": Mean("macd", span_alpha(signal_period))}, first=False)
    yield {"macd_histogram": F.col("macd") - F.col("macd_signal")}


@register("stoch", "momentum", {"k_period": 14, "d_period": 3}, needs=HLC,
          check=lambda k_period, d_period: (need_period(k_period, 1, "k_period"), need_period(d_period, 1, "d_period")),
          lookback=lambda k_period, d_period: k_period + d_period - 2, min_rows=lambda k_period, **_: k_period)
def stoch(t, x, k_period, d_period):
    """Stochastic oscillator: ``stoch_k_{k}, stoch_d_{d}``; %K is 0 while warming up."""
    lo, hi = t.low("low", k_period), t.high("high", k_period)
    k = f"stoch_k_{k_period}"
    yield {k: 100.0 * safe_div(F.col("close") - lo, hi - lo)}
    yield {f"stoch_d_{d_period}": t.mean(k, d_period)}


@register("willr", "momentum", {"period": 14}, needs=HLC, check=lambda period: need_period(period), lookback=_window, min_rows=_full)
def willr(t, x, period):
    """Williams %R: ``williams_r_{period}``."""
    lo, hi = t.low("low", period), t.high("high", period)
    yield {f"williams_r_{period}": positive_zero(-100.0 * safe_div(hi - F.col("close"), hi - lo))}


def _check_cci(period, constant):
    need_period(period)
    need_positive(constant, "constant")


@register("cci", "momentum", {"period": 20, "constant": 0.015}, needs=HLC, check=_check_cci,
          lookback=lambda period, **_: 2 * period - 2, min_rows=_full)
def cci(t, x, period, constant):
    """Commodity channel index: ``cci_{period}``; deviation is the mean of each row's own distance to its SMA."""
    yield {x("off"): typical_price() - t.mean(typical_price(), period)}
    off = F.col(x("off"))
    yield {f"cci_{period}": safe_div(off, F.lit(float(constant)) * t.mean(F.abs(off), period))}


@register("roc", "momentum", {"column": "close", "period": 10}, needs=_of_column, check=lambda period, **_: need_period(period),
          lookback=_full, min_rows=_one_more)
def roc(t, x, column, period):
    """Rate of change in percent: ``roc_{period}``; 0 while warming up."""
    old = t.lag(column, period)
    yield {f"roc_{period}": 100.0 * safe_div(F.col(column) - old, old)}


@register("mom", "momentum", {"column": "close", "period": 10}, needs=_of_column, check=lambda period, **_: need_period(period),
          lookback=_full, min_rows=_one_more)
def mom(t, x, column, period):
    """Momentum: ``mom_{period}``."""
    yield {f"mom_{period}": F.col(column) - t.lag(column, period)}


@register("stochrsi", "momentum", {"column": "close", "rsi_period": 14, "stoch_period": 14, "k_period": 3, "d_period": 3},
          needs=_of_column, check=_check_rsi, alphas=lambda rsi_period, **_: [wilder_alpha(rsi_period)],
          lookback=lambda stoch_period, k_period, d_period, **_: stoch_period + k_period + d_period - 2,
          min_rows=lambda rsi_period, **_: rsi_period + 1)
def stochrsi(t, x, column, rsi_period, stoch_period, k_period, d_period):
    """Stochastic of the RSI: ``stochrsi_k_{k}, stochrsi_d_{d}``; also leaves ``rsi_{p}``.

    While the price stands still the RSI keeps its value up to rounding noise; such a range counts as none.
    """
    yield from _rsi(t, x, column, rsi_period, "raw")
    r, k = f"rsi_{rsi_period}", f"stochrsi_k_{k_period}"
    lo, hi = t.low(r, stoch_period), t.high(r, stoch_period)
    yield {x("raw"): 100.0 * safe_div(F.col(r) - lo, F.when(hi - lo > RSI_NOISE, hi - lo))}
    yield {k: t.mean(x("raw"), k_period)}
    yield {f"stochrsi_d_{d_period}": t.mean(k, d_period)}
