"""Blocked exponential means against a sequential scan."""

import numpy as np
import pandas as pd
import pytest

from tapestry.functions.ewm import Mean, ewm, shareable, sub_length, with_sub_blocks
from tapestry.functions.history import over_history
from tapestry.operators.momentum import rsi
from tapestry.operators.registry import REGISTRY

K = {"by": "contract", "order": "ts"}


def frame(spark, x, name="A"):
    return pd.DataFrame({"contract": name, "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(len(x)), unit="s"), "x": x})


def run(df, alpha, adjust, chunk=None, length=None):
    def body(d, t):
        d = with_sub_blocks(d, t, [alpha])
        return ewm(d, t, sub_length([alpha]), {"y": Mean("x", alpha, adjust)})

    return over_history(df, body, chunk=chunk, positions=True, **K).toPandas().sort_values("ts")["y"].to_numpy()


@pytest.mark.parametrize("alpha,adjust", [(2 / 21, True), (1 / 14, False), (2 / 3, True), (2 / 201, True), (0.5, False), (1.0, True)])
@pytest.mark.parametrize("chunk", [None, 700])
def test_against_pandas(spark, alpha, adjust, chunk):
    x = 100 + np.cumsum(np.random.default_rng(1).normal(0, 1, 6000))
    got = run(spark.createDataFrame(frame(spark, x)), alpha, adjust, chunk)
    want = pd.Series(x).ewm(alpha=alpha, adjust=adjust).mean().to_numpy()
    assert np.abs(got - want).max() < 1e-8


@pytest.mark.parametrize("chunk", [None, 500])
def test_state_survives_long_zero_runs(spark, chunk):
    """After thousands of zeros the value is tiny but still exact, so ratios of two means stay right."""
    x = np.zeros(9000)
    x[:50] = np.arange(50)
    got = run(spark.createDataFrame(frame(spark, x)), 1 / 14, False, chunk)
    want = pd.Series(x).ewm(alpha=1 / 14, adjust=False).mean().to_numpy()
    assert np.allclose(got, want, rtol=1e-8, atol=0)


@pytest.mark.parametrize("chunk", [None, 600])
def test_rsi_of_a_flat_price_keeps_its_level(spark, chunk):
    close = np.concatenate([[100, 103, 101, 104], np.full(5000, 104.0)])
    d = frame(spark, close).rename(columns={"x": "close"})
    got = rsi(spark.createDataFrame(d), chunk=chunk, **K).toPandas().sort_values("ts")["rsi_14"].to_numpy()
    assert np.allclose(got[4:], got[4], rtol=1e-6) and 0 < got[4] < 100


def test_helpers():
    assert shareable([2 / 13, 2 / 27, 0.2]) and not shareable([2 / 3, 2 / 201])


@pytest.mark.parametrize("name", ["dema", "tema", "macd", "adx", "ema"])
@pytest.mark.parametrize("shape", ["constant", "step", "zeros"])
def test_chains_are_exact_for_any_block_size(spark, name, shape):
    """Every stage carries its state: the digits do not depend on where the history is cut."""
    x = {"constant": np.full(2500, 7.3), "step": np.r_[np.full(600, 1e6), np.full(1900, 3.0)], "zeros": np.r_[np.arange(1.0, 300.0), np.zeros(2201)]}[shape]
    d = frame(spark, x).rename(columns={"x": "close"}).assign(high=lambda f: f["close"] + 1, low=lambda f: f["close"] - 1)
    d, indicator = spark.createDataFrame(d), REGISTRY[name]
    whole, *cut = [indicator(d, chunk=c, **K).toPandas().sort_values("ts").drop(columns=["contract", "ts"]).to_numpy(float) for c in (None, 97, 800)]
    for got in cut:
        assert np.allclose(got, whole, rtol=1e-10, atol=1e-12 * np.abs(x).max(), equal_nan=True)
