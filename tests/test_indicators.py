"""Exact values on hand fixtures, bounds, parameter checks."""

import pytest
from conftest import values

import tapestry
from tapestry.functions.checks import ParameterError
from tapestry.operators import momentum as M, overlap as O, volatility as V, volume as U
from tapestry.operators.registry import REGISTRY, available, register_custom, with_indicators
from tapestry.plans.signals import latest_signals, signals

K = {"by": "contract", "order": "ts"}
HIGH = [105.0, 107, 106, 108, 110, 109, 111, 113, 112, 114]
LOW = [100.0, 102, 101, 103, 105, 104, 106, 108, 107, 109]
CLOSE = [102.0, 105, 103, 106, 108, 107, 109, 111, 110, 112]


@pytest.fixture(scope="module")
def rising(series):
    return series(close=[float(100 + i) for i in range(10)]).cache()


@pytest.fixture(scope="module")
def ohlc(series):
    return series(high=HIGH, low=LOW, close=CLOSE, volume=[100 + 10 * i for i in range(10)]).cache()


def test_sma(rising):
    v = values(O.sma(rising, period=5, **K), "sma_5")
    assert v[:4] == [None] * 4 and v[4] == 102.0 and v[9] == 107.0


def test_ema(rising):
    v = values(O.ema(rising, period=5, **K), "ema_5")
    assert v[0] == pytest.approx(100.0) and 105 < v[9] < 109


def test_mom_and_roc(rising):
    assert values(M.mom(rising, period=2, **K), "mom_2")[:3] == [None, None, 2.0]
    assert values(M.roc(rising, period=2, **K), "roc_2")[:3] == [0.0, 0.0, pytest.approx(2.0)]


def test_rsi_without_losses(rising):
    assert values(M.rsi(rising, period=3, **K), "rsi_3") == [0.0] * 10
    assert values(M.rsi(rising, period=3, mode="standard", **K), "rsi_3") == [0.0] + [100.0] * 9


def test_wma(rising):
    assert values(O.wma(rising, period=3, **K), "wma_3")[2] == pytest.approx((100 + 2 * 101 + 3 * 102) / 6)
    assert values(O.wma(rising, period=3, mode="mean", **K), "wma_3")[2] == 101.0


def test_rsi_bounds(series):
    zigzag = [100.0, 102, 101, 103, 105, 104, 106, 108, 107, 109, 111, 110, 112, 114, 113]
    assert all(0 <= v <= 100 for v in values(M.rsi(series(close=zigzag), **K), "rsi_14"))


def test_bands_are_ordered(series):
    d = O.bbands(series(close=[100.0, 101, 99, 102, 98, 103, 97, 104, 96, 105] * 3), **K)
    r = d.orderBy("ts").collect()[25]
    assert r.bb_upper_20 > r.bb_middle_20 > r.bb_lower_20


def test_macd_of_a_trend(series):
    assert values(M.macd(series(close=[100 + 0.5 * i for i in range(50)]), **K), "macd")[45] > 0


def test_trange_and_atr(ohlc):
    assert values(V.trange(ohlc, **K), "trange")[:3] == [5.0, 5.0, 5.0]
    assert all(v > 0 for v in values(V.atr(ohlc, period=5, **K), "atr_5"))


def test_trange_by_hand(ohlc):
    prev = [None] + CLOSE[:-1]
    want = [max(h - lo, *( [abs(h - p), abs(lo - p)] if p is not None else [])) if p is not None else h - lo for h, lo, p in zip(HIGH, LOW, prev)]
    assert values(V.trange(ohlc, **K), "trange") == want


def test_williams_and_stoch_bounds(ohlc):
    assert all(-100 <= v <= 0 for v in values(M.willr(ohlc, period=3, **K), "williams_r_3"))
    assert values(M.stoch(ohlc, k_period=3, d_period=2, **K), "stoch_k_3")[:2] == [0.0, 0.0]


def test_obv_by_hand(ohlc):
    total, want = 0, [0]
    for i in range(1, 10):
        v = 100 + 10 * i
        total += v if CLOSE[i] > CLOSE[i - 1] else -v if CLOSE[i] < CLOSE[i - 1] else 0
        want.append(total)
    assert values(U.obv(ohlc, **K), "obv") == want


def test_ad_of_a_flat_bar(series):
    d = series(high=[5.0, 6.0], low=[5.0, 4.0], close=[5.0, 6.0], volume=[7, 3])
    assert values(U.ad(d, **K), "ad") == [0.0, 3.0]


def test_vwap_without_volume(series):
    d = series(high=[5.0, 6.0], low=[5.0, 4.0], close=[5.0, 5.0], volume=[0, 3])
    assert values(U.vwap(d, **K), "vwap") == [None, 5.0]


def test_all_indicators_in_one_pass_match_single_calls(ohlc):
    specs = [(n, {}) for n in REGISTRY]
    d = ohlc.withColumn("open", ohlc.close)
    many = with_indicators(d, specs, **K)
    for name in REGISTRY:
        alone = REGISTRY[name](d, **K)
        for c in set(alone.columns) - set(d.columns):
            assert values(many, c) == pytest.approx(values(alone, c), nan_ok=True), c
    assert not [c for c in many.columns if c.startswith("__")]


def test_discovery():
    assert len(REGISTRY) == 24
    assert set(available("volume")) == {"obv", "vwap", "ad", "adosc"}


def test_custom_indicator(rising):
    register_custom("twice", lambda df, *, by, order, k=2: df.withColumn("twice", df.close * k))
    assert values(with_indicators(rising, ["sma", ("twice", {"k": 3})], **K), "twice")[0] == 300.0


@pytest.mark.parametrize("call", [
    lambda d: O.sma(d, period=0, **K), lambda d: O.sma(d, period=2.5, **K), lambda d: O.bbands(d, period=1, **K),
    lambda d: M.macd(d, fast_period=26, slow_period=12, **K), lambda d: O.sma(d, column="nope", **K), lambda d: M.willr(d, **K),
    lambda d: O.wma(d, mode="cubic", **K), lambda d: O.sma(d, perod=3, **K), lambda d: with_indicators(d, ["nope"], **K),
    lambda d: O.sma(d, period=50, strict=True, **K),
])
def test_bad_parameters(rising, call):
    with pytest.raises(ParameterError):
        call(rising)


def test_signals_follow_their_rule(series):
    n = 160
    c = [100.0 + 0.8 * abs(80 - i) + (2.0 if i % 5 == 0 else 0.0) for i in range(n)]
    d = series(high=[x + 1 for x in c], low=[x - 1 for x in c], close=c, open=c, volume=[1] * n)
    rows = signals(d, **K).orderBy("ts").collect()
    for r in rows:
        up = r.sma_50 is not None and r.sma_20 > r.sma_50
        lively, strong = r.rsi_14 > 50 and r.macd_histogram > 0, r.adx_14 > 25
        if r.sma_50 is None:
            continue
        want = "bullish" if up and lively and strong else "bearish" if not up and not lively and strong else "none"
        assert r.signal == want
        sign = {"bullish": 1, "bearish": -1}.get(want)
        if sign:
            assert r.stop == pytest.approx(r.close - 2 * sign * r.atr_14) and r.target == pytest.approx(r.close + 3 * sign * r.atr_14)
    assert {"bullish", "bearish", "none"} == {r.signal for r in rows}
    assert latest_signals(d, **K).first().ts == rows[-1].ts


def test_package_exports():
    assert "rsi" in tapestry.available("momentum")


def test_upper_case_names(rising):
    from tapestry import indicators

    assert len(indicators.__all__) == 24
    assert values(rising.transform(indicators.SMA, period=5, **K).transform(indicators.RSI, **K), "sma_5")[4] == 102.0
