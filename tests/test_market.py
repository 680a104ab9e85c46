"""Bars, book, flow, hidden orders, portfolio, positions, orders and sessions on hand fixtures."""

import datetime as dt
import math

import pytest
from conftest import values
from pyspark.sql import functions as F

from tapestry import schemas
from tapestry.functions.checks import ParameterError
from tapestry.functions.joins import merge_on_time, price_range_join
from tapestry.operators import bars as B, book as K, flow as W, icebergs as X, orders as O, patterns as A, portfolio as R, positions as P, sessions as C, stats as S
from tapestry.plans.market import market_report
from tapestry.sources import envelopes as E, readers
from tapestry.sources.quotes import forward_fill_quotes, quotes_to_ticks

T0 = dt.datetime(2024, 1, 2, 15, 0)
TICK = ["ts", "seq"]
ASOF = "2024-01-02 15:30:00"


def at(minutes=0, seconds=0):
    return T0 + dt.timedelta(minutes=minutes, seconds=seconds)


@pytest.fixture(scope="module")
def depth(spark):
    """Depth updates ``(price, volume, type)`` of one contract, one second apart."""

    def build(*rows, contract="A"):
        return spark.createDataFrame([(contract, at(seconds=i), i, float(p), v, t) for i, (p, v, t) in enumerate(rows)], schemas.DEPTH)

    return build


def live(depth):
    return K.book_asof(K.route_depth(depth))


# --- bars -----------------------------------------------------------------------------------------------


def test_bar_volume_rule(series):
    d = series(price=[2045.5, 2046.0], volume=[0, 10], seconds=5)
    r = B.bars(d, "1min", by="contract", order=TICK).first()
    assert (r.open, r.close, r.volume) == (2045.5, 2046.0, 11)
    assert B.bars(series(price=[1.0], volume=[0]), "1min", by="contract", order=TICK).first().volume == 1
    assert B.bars(series(price=[1.0], volume=[0]), "1min", by="contract", order=TICK, floor_volume=False).first().volume == 0


def test_ticks_at_one_instant_follow_the_sequence(spark):
    d = spark.createDataFrame([("A", T0, 2, 5.0, 1), ("A", T0, 1, 7.0, 1), ("A", T0, 3, 6.0, 1)], "contract string, ts timestamp, seq long, price double, volume long")
    r = B.bars(d, "1min", by="contract", order=TICK).first()
    assert (r.open, r.close, r.high, r.low) == (7.0, 6.0, 7.0, 5.0)


def test_calendar_bars_follow_daylight_saving(spark):
    stamps = ["2024-03-10 05:59:00", "2024-03-10 06:00:00", "2024-03-11 04:59:00", "2024-03-11 05:00:00"]
    d = spark.createDataFrame([(s, i) for i, s in enumerate(stamps)], "s string, seq long").select(
        F.lit("A").alias("contract"), F.col("s").cast("timestamp").alias("ts"), "seq", F.lit(1.0).alias("price"), F.lit(1).cast("long").alias("volume"))
    got = {str(r.ts): r.volume for r in B.bars(d, "1day", by="contract", order=TICK).collect()}
    assert got == {"2024-03-09 06:00:00": 1, "2024-03-10 06:00:00": 2, "2024-03-11 05:00:00": 1}


def test_timeframes():
    assert B.timeframe_seconds("5min") == 300 and B.timeframe_seconds("2 hours") == 7200 and B.timeframe_seconds("1hr") == 3600
    for bad in ("5 parsec", "min", "0min"):
        with pytest.raises(ParameterError):
            B.timeframe_seconds(bad)


def test_multi_timeframe_equals_single(series):
    d = series(price=[float(i % 7) for i in range(200)], volume=[i % 3 for i in range(200)], seconds=17)
    many = B.multi_timeframe(d, ["15sec", "1min", "1hr"], by="contract", order=TICK)
    for tf in ("15sec", "1min", "1hr"):
        one = B.bars(d, tf, by="contract", order=TICK)
        assert sorted(map(tuple, many.filter(F.col("timeframe") == tf).select(*one.columns).collect())) == sorted(map(tuple, one.collect()))


def test_rollup_equals_direct_bars(series):
    d = series(price=[float(i % 11) for i in range(300)], volume=[1 + i % 3 for i in range(300)], seconds=20)
    fine = B.bars(d, "1min", by="contract", order=TICK)
    assert sorted(map(tuple, B.rollup_bars(fine, "15min", by="contract").collect())) == sorted(map(tuple, B.bars(d, "15min", by="contract", order=TICK).collect()))


def test_staleness(series):
    d = series(price=[1.0], volume=[1])
    b = B.multi_timeframe(d, ["5sec", "5min"], by="contract", order=TICK)
    healthy = lambda a: {r.timeframe: r.healthy for r in B.staleness(b, a, expected=["5sec", "5min", "1hr"]).collect()}
    assert healthy(at(seconds=20)) == {"5sec": True, "5min": True, "1hr": False}
    assert healthy(at(seconds=21)) == {"5sec": False, "5min": True, "1hr": False}
    assert healthy(at(minutes=10)) == {"5sec": False, "5min": False, "1hr": False}


# --- book -------------------------------------------------------------------------------------------------


def test_best_prices(depth):
    r = K.bbo(live(depth((2045.0, 100, 2), (2045.5, 50, 1)))).first()
    assert (r.best_bid, r.best_ask, r.spread, r.mid) == (2045.0, 2045.5, 0.5, 2045.25)


def test_one_sided_and_empty(depth):
    r = K.bbo(live(depth((2045.0, 100, 2)))).first()
    assert (r.best_bid, r.best_ask, r.spread, r.mid) == (2045.0, None, None, None)
    assert live(depth((1.0, 0, 2))).count() == 0


def test_sorted_levels_and_removal(depth):
    d = depth((2045.0, 50, 2), (2044.9, 30, 2), (2044.8, 20, 2), (2045.1, 40, 1), (2045.2, 35, 1), (2045.3, 25, 1), (2044.9, 0, 2))
    b = live(d).collect()
    assert sorted(r.price for r in b if r.side == "bid") == [2044.8, 2045.0] and len([r for r in b if r.side == "ask"]) == 3
    top = K.top_levels(live(d), 1).collect()
    assert {(r.side, r.price) for r in top} == {("bid", 2045.0), ("ask", 2045.1)}


def test_changes_are_routed_by_the_mid(depth):
    d = depth((10.0, 5, 9), (10.0, 5, 2), (12.0, 5, 1), (11.0, 7, 9), (11.5, 7, 10), (0.0, 3, 9), (11.0, 0, 5), (11.0, 2, 5))
    got = {(r.seq, r.side, r.type) for r in K.route_depth(d).collect()}
    assert got == {(0, "bid", "bid_mod_9"), (0, "ask", "ask_mod_9"), (1, "bid", "bid"), (2, "ask", "ask"), (3, "bid", "bid_mod_9"), (4, "ask", "ask_mod_10"),
                   (5, "bid", "bid_mod_9"), (5, "ask", "ask_mod_9"), (7, "trade", "trade")}


def walk(rows):
    """Sequential placement of ``(batch, price, volume, type)`` rows, message by message."""
    books, out, seq = {"bid": {}, "ask": {}}, [], 0
    best = lambda: (max(books["bid"], default=None), min(books["ask"], default=None))
    for b in sorted({r[0] for r in rows}):
        bid, ask = best()
        mid = (bid + ask) / 2 if bid and ask else None
        moves, fills = [], []
        for _, price, volume, code in [r for r in rows if r[0] == b]:
            if code in (1, 2):
                moves.append((seq, "bid" if code == 2 else "ask", price, volume, "bid" if code == 2 else "ask"))
            elif code == 5 and volume > 0:
                fills.append((seq, price))
            elif code in (9, 10):
                sides = ["bid", "ask"] if not mid or price == 0 else ["bid"] if price <= mid else ["ask"]
                moves += [(seq, s, price, volume, f"{s}_mod_{code}") for s in sides]
            seq += 1
        for n, s, price, volume, label in moves:
            books[s].pop(price, None)
            if volume > 0:
                books[s][price] = volume
            out.append((n, s, label, None, None))
        out += [(n, "trade", "trade", *best()) for n, _ in fills]
    return set(out)


@pytest.mark.parametrize("per_message", [1, 4])
@pytest.mark.parametrize("chunk", [None, 40])
def test_exact_routing_equals_a_walk(spark, per_message, chunk):
    import random

    rnd = random.Random(5)
    rows = [(i // per_message, float(rnd.randint(95, 105)), rnd.randint(0, 3), rnd.choice([1, 2, 5, 9, 10])) for i in range(160)]
    d = spark.createDataFrame([("A", at(seconds=i), i, p, v, t, b) for i, (b, p, v, t) in enumerate(rows)], schemas.DEPTH + ", message int")
    got = K.route_depth_exact(d, batch="message" if per_message > 1 else None, chunk=chunk).collect()
    assert {(r.seq, r.side, r.type, r.best_bid, r.best_ask) for r in got} == walk(rows)


def test_trade_at_ask_is_a_buy(depth):
    t = K.routed_trades(K.route_depth(depth((2045.0, 100, 2), (2045.1, 80, 1), (2045.1, 50, 5))))
    flow = W.trade_flow(t, 60, asof=ASOF).first()
    assert (flow.buy_volume, flow.trade_count, flow.vwap) == (50, 1, pytest.approx(2045.1)) and math.isinf(flow.buy_sell_ratio)


def test_trade_without_quotes_is_unknown(depth):
    assert K.routed_trades(K.route_depth(depth((5.0, 1, 5)))).first().side == "unknown"


def test_imbalance(depth):
    d = depth((2045.0, 200, 2), (2044.9, 150, 2), (2045.1, 50, 1))
    none = W.trade_flow(K.routed_trades(K.route_depth(d)), asof=ASOF)
    r = K.market_imbalance(live(d), none).first()
    assert r.imbalance_ratio == pytest.approx(0.75) and (r.direction, r.confidence) == ("bullish", "medium")


def test_liquidity(depth):
    b = live(depth((2045.0, 200, 2), (2044.9, 40, 2), (2045.1, 150, 1), (2045.2, 30, 1)))
    got = K.liquidity_levels(b, 100).collect()
    assert {(r.side, r.volume, r.liquidity_score) for r in got} == {("bid", 200, 1.0), ("ask", 150, 1.0)}


def test_clusters(depth):
    b = live(depth((2045.0, 50, 2), (2045.05, 40, 2), (2045.1, 45, 2), (2045.5, 30, 1)))
    (r,) = K.order_clusters(b, 0.15, 2).collect()
    assert (r.side, r.order_count, r.total_volume) == ("bid", 3, 135)
    assert r.volume_weighted_price == pytest.approx((2045 * 50 + 2045.05 * 40 + 2045.1 * 45) / 135)


def test_cluster_is_anchored_at_its_first_price(depth):
    b = live(depth((10.0, 1, 1), (10.2, 1, 1), (10.4, 1, 1), (10.5, 1, 1)))
    got = sorted((r.low_price, r.high_price) for r in K.order_clusters(b, 0.25, 2).collect())
    assert got == [(10.0, 10.2), (10.4, 10.5)]


def test_deep_levels_come_back(depth):
    d = depth(*[(100.0 - i, 1, 2) for i in range(120)], *[(100.0 - i, 0, 2) for i in range(60)])
    assert live(d).count() == 60


def test_book_at_grid_equals_asof(depth):
    d = K.route_depth(depth((10.0, 5, 2), (11.0, 5, 1), (10.0, 0, 2), (9.0, 3, 2), (10.0, 4, 2)))
    grid = K.book_at_grid(d, at(), at(seconds=6), 1)
    for s in range(7):
        when = at(seconds=s)
        want = {(r.side, r.price, r.volume) for r in K.book_asof(d, when).collect()}
        assert {(r.side, r.price, r.volume) for r in grid.filter(F.col("as_of") == F.lit(when)).collect()} == want


def test_market_report(depth):
    r = market_report(depth((2045.0, 100, 2), (2045.1, 80, 1), (2045.1, 50, 5)), asof=ASOF, flow_minutes=60).first()
    assert (r.total_volume, r.data_quality, r.market_activity, r.poc_price) == (50, "medium", "quiet", pytest.approx(2045.1))


# --- flow -------------------------------------------------------------------------------------------------


def trades(series, **kw):
    return series(**{"price": [1.0, 1.1, 1.2, 1.6], "volume": [10, 20, 30, 40], "side": ["buy", "sell", "buy", "unknown"], **kw})


def test_flow_filters_by_time(spark):
    rows = [("A", at(seconds=-120), i, 1.0, 1, "buy") for i in range(5)] + [("A", at(seconds=i), i + 5, 1.0, 1, "sell") for i in range(3)]
    d = spark.createDataFrame(rows, schemas.TRADES)
    assert W.flow_since(d, T0, at(minutes=1)).first().trade_count == 3


def test_flow_of_silent_contracts(spark, series):
    known = spark.createDataFrame([("A",), ("Z",)], "contract string")
    got = {r.contract: r for r in W.trade_flow(trades(series), 60, asof=ASOF, contracts=known).collect()}
    assert got["Z"].total_volume == 0 and got["Z"].vwap == 0.0 and got["Z"].buy_sell_ratio == 0.0
    assert got["A"].buy_sell_ratio == 2.0 and got["A"].avg_trade_size == 25.0


def test_delta(series):
    d = W.cumulative_delta(trades(series), 60, asof=ASOF)
    assert values(d, "delta") == [10, -10, 20, 20]
    assert W.delta_summary(trades(series), 60, asof=ASOF).first().delta_trend == "neutral"


def test_profile_and_value_area(series):
    p = W.volume_profile(trades(series), 0.5)
    assert {(r.bucket, r.total_volume) for r in p.collect()} == {(2, 60), (3, 40)}
    assert W.point_of_control(p).first().poc_volume == 60
    v = W.value_area(p).first()
    assert (v.buckets, v.volume_percentage) == (2, 100.0)
    assert W.value_area(p, 0.6).first().buckets == 1


def test_profile_ties_take_the_lowest_bucket(series):
    d = trades(series, volume=[30, 10, 10, 50])
    assert W.point_of_control(W.volume_profile(d, 0.5)).first().poc_price == pytest.approx(1.1)


def test_profile_bins_of_one_price(series):
    d = series(close=[5.0, 5.0], volume=[1, 2])
    (r,) = W.volume_profile_bins(d).collect()
    assert (r.bucket, r.total_volume) == (0, 3)


def test_quotes(spark):
    d = spark.createDataFrame([("A", at(seconds=i), i, *q) for i, q in enumerate([(2045.2, None, None, None), (None, 2045.3, None, None), (None, None, 2045.25, None), (None, None, 2045.3, 10)])], schemas.QUOTES)
    t = quotes_to_ticks(forward_fill_quotes(d)).orderBy("ts").collect()
    assert [(r.price, r.volume, r.type) for r in t] == [(2045.2, 0, "quote"), (2045.25, 0, "quote"), (2045.25, 0, "quote"), (2045.3, 10, "trade")]


def test_spread_stats(spark):
    d = spark.createDataFrame([("A", 1.0, 1.0 + s) for s in (0.1, 0.2, 0.2, 0.5)], "contract string, bid double, ask double")
    r = W.spread_stats(d).first()
    assert r.median_spread == pytest.approx(0.2) and r.avg_spread == pytest.approx(0.25) and r.max_spread == pytest.approx(0.5)
    assert r.spread_volatility == pytest.approx(0.1732050807)


# --- hidden orders -------------------------------------------------------------------------------------------------


def test_round_prices(spark):
    d = spark.createDataFrame([(p,) for p in (100.0, 100.5, 100.25, 100.1, 100.05, 100.03)], "p double")
    got = [tuple(r) for r in d.select(X.round_price_score(F.col("p")), X.round_price_score(F.col("p"), fine=True)).collect()]
    assert got == [(1.0, 1.0), (0.8, 0.8), (0.6, 0.6), (0.4, 0.4), (0.0, 0.2), (0.0, 0.1)]


def test_heuristic(depth):
    b = live(depth((100.0, 600, 2), (100.5, 1200, 1), (100.25, 900, 1), (101.0, 500, 1)))
    got = {r.price: (round(r.confidence_score, 6), r.confidence, r.estimated_hidden_size) for r in X.iceberg_heuristic(b, 60, asof=ASOF).collect()}
    assert got == {100.0: (0.8, "high", 1680), 100.5: (1.0, "high", 3600)}


@pytest.fixture(scope="module")
def history(spark):
    """A steady level of 1000, a noisy one, and trades at the steady price."""
    rows = [("A", at(seconds=10 * i), i, 150.0, 1000 + 10 * (i % 3), "bid", "bid") for i in range(120)]
    rows += [("A", at(seconds=10 * i + 1), i, 150.5, 100 * (1 + i * i % 9), "ask", "ask") for i in range(30)]
    fills = [("A", at(seconds=30 * i), i, 150.0, 100 + i % 2, "buy") for i in range(20)]
    d = spark.createDataFrame(rows, "contract string, ts timestamp, seq long, price double, volume long, side string, type string")
    return d, spark.createDataFrame(fills, schemas.TRADES)


def test_refresh_detection(history):
    updates, fills = history
    hits = X.iceberg_refresh(updates, 60, asof=ASOF)
    (r,) = hits.collect()
    assert (r.price, r.refresh_count, r.avg_refresh_seconds) == (150.0, 120, 10.0) and r.estimated_hidden_size == pytest.approx(3 * r.avg_volume)
    c = X.confirm_with_trades(hits, fills).first()
    assert c.nearby_trades == 20 and c.trade_confirmed and c.confidence_score == pytest.approx(0.77)


def test_level_scores(spark, history):
    updates, _ = history
    s = {r.price: r.significance for r in X.level_significance(updates).collect()}
    assert s[150.0] > 0.99 and s[150.5] < 0.6
    v = [100, 40, 90, 100, 100]
    d = spark.createDataFrame([("A", at(seconds=i), i, 1.0, x, "bid") for i, x in enumerate(v)], "contract string, ts timestamp, seq long, price double, volume long, side string")
    assert X.replenishment_score(d).first().replenishment_score == pytest.approx(1 / 3)
    assert X.replenishment_score(d.filter("seq < 3")).first().replenishment_score == 0.0


def test_multifactor(spark):
    volume = [900, 1200] * 30  # a refresh every other update
    d = spark.createDataFrame([("A", at(seconds=10 * i), i, 150.0, v) for i, v in enumerate(volume)], "contract string, ts timestamp, seq long, price double, volume long")
    t = spark.createDataFrame([("A", at(seconds=30 * i), i, 150.0, 100, "buy") for i in range(10)], schemas.TRADES)
    r = X.iceberg_multifactor(d, t, 60, asof=ASOF).first()
    assert (r.refresh_count, r.refresh_regularity, r.validation_score) == (29, 1.0, 1.0) and r.execution_correlation == 1.0
    assert r.estimated_hidden_size <= r.total_observed * 3


def test_range_join_finds_edges(spark):
    prices = [x / 100 for x in range(0, 400)]
    d = spark.createDataFrame([("A", p) for p in prices], "contract string, price double")
    lv = spark.createDataFrame([("A", x / 20) for x in range(0, 80)], "contract string, level_price double")
    got = price_range_join(d, lv, by="contract", tol=0.05).count()
    assert got == sum(1 for p in prices for x in range(0, 80) if x / 20 - 0.05 <= p <= x / 20 + 0.05)


# --- statistics -----------------------------------------------------------------------------------------------


def test_correlation(series):
    d = series(a=[1.0, 2, 3, 4], b=[2.0, 4, 6, 8], c=[5.0, 5, 5, 5], e=[1.0, 8, 27, 64])
    m = {r.column: r for r in S.correlation_matrix(d, ["a", "b", "c", "e"]).collect()}
    assert m["a"].b == pytest.approx(1.0) and m["a"].c == 0.0 and m["c"].c == 1.0 and m["a"].e < 1
    s = {r.column: r for r in S.correlation_matrix(d, ["a", "e"], "spearman").collect()}
    assert s["a"].e == pytest.approx(1.0)
    with pytest.raises(ParameterError):
        S.correlation_matrix(d, ["a"], "kendall")


def test_sharpe_without_movement(series):
    d = series(returns=[0.01, 0.01, 0.01])
    assert S.sharpe_ratio(d).first().sharpe == 0.0


def test_candles(series):
    d = series(open=[10.0, 10.0, 10.0, 10.0], high=[12.0, 10.15, 13.0, 14.0], low=[8.0, 8.0, 9.95, 10.0], close=[10.1, 10.1, 10.1, 14.0])
    r = A.candlestick_patterns(d).orderBy("ts").collect()
    assert r[0].doji and r[1].hammer and r[2].shooting_star and r[3].long_body and r[3].bullish_candle


def test_short_history_has_no_chart_patterns(series):
    assert A.chart_patterns(series(close=[1.0, 2.0, 1.0]), window=5).count() == 0


def test_profile_table(series):
    got = {r.column: (r.min, r.max, r.rows) for r in S.profile_table(series(a=[1.0, 3.0], b=[5, 7])).collect()}
    assert got["a"] == (1.0, 3.0, 2) and got["b"] == (5.0, 7.0, 2)


# --- portfolio, positions, orders -----------------------------------------------------------------------------------------------


def test_portfolio_fixture(spark):
    pnl = [500.0, -200, 750, -150, 300, -400, 600, 250]
    d = spark.createDataFrame([("x", at(minutes=i), i, p) for i, p in enumerate(map(float, pnl))], "account string, ts timestamp, seq long, pnl double")
    r = R.portfolio_metrics(d, 50000.0).first()
    assert (r.total_trades, r.total_pnl, r.total_return, r.win_rate) == (8, 1650.0, pytest.approx(0.033), 0.625)
    assert (r.gross_profit, r.gross_loss, r.profit_factor, r.avg_win, r.avg_loss) == (2400.0, 750.0, pytest.approx(3.2), 480.0, -250.0)
    assert r.expectancy == pytest.approx(206.25) and r.max_drawdown == pytest.approx(0.0078125) and r.max_drawdown_duration == 1
    won = R.portfolio_metrics(d.filter("pnl > 0"), 1.0).first()
    assert math.isinf(won.profit_factor) and won.max_drawdown == 0.0


@pytest.fixture(scope="module")
def held(spark):
    return spark.createDataFrame([(1, 7, "MGC", T0, 1, 2, 2045.0), (2, 7, "MES", T0, 2, 1, 5400.0), (3, 7, "NQ", T0, 1, 1, 100.0)], schemas.POSITIONS)


def test_pnl(spark, held):
    px = spark.createDataFrame([("MGC", 2050.0), ("MES", 5390.0)], "contractId string, price double")
    d = P.position_pnl(held, px)
    assert {r.contractId: r.unrealized_pnl for r in d.collect()} == {"MGC": 10.0, "MES": 10.0, "NQ": None}
    r = P.portfolio_pnl(d).first()
    assert (r.total_pnl, r.positions_count, r.positions_with_prices, r.positions_without_prices) == (20.0, 3, 2, 1)
    ins = spark.createDataFrame([("MGC", "MGC", "", 0.1, 10.0, True)], schemas.INSTRUMENTS)
    assert {r.contractId: r.unrealized_pnl for r in P.position_pnl(held, px, instruments=ins).collect()}["MGC"] == pytest.approx(1000.0)


def test_exposure(spark):
    d = spark.createDataFrame([(1, 7, "MGC", T0, 1, 5, 2045.0), (2, 7, "MES", T0, 2, 2, 5400.0)], schemas.POSITIONS)
    acc = spark.createDataFrame([(7,), (8,)], "accountId long")
    got = {r.accountId: r for r in P.exposure_risk(d, accounts=acc).collect()}
    assert got[7].total_exposure == 21025.0 and got[7].largest_position_risk == pytest.approx(0.513674, abs=1e-6)
    assert (got[8].diversification_score, got[8].position_count, got[8].total_exposure) == (1.0, 0, 0.0)


def test_closed_positions_disappear(spark):
    d = spark.createDataFrame([(1, 7, "MGC", T0, 1, 5, 2045.0), (2, 7, "MGC", at(1), 1, 0, 2045.0), (3, 7, "NQ", T0, 1, 1, 1.0)], schemas.POSITIONS)
    assert [r.contractId for r in P.latest_positions(d).collect()] == ["NQ"]
    assert [r.size_change for r in P.position_history(d).filter("contractId = 'MGC'").orderBy("id").collect()] == [0, -5]


def test_sizing(spark):
    acc = spark.createDataFrame([(1, "a", 50000.0, True, True, True), (2, "b", 10000.0, True, True, True)], schemas.ACCOUNTS)
    s = spark.createDataFrame([("x", 1, "MGC", 2045.0, 2040.0, 100.0), ("y", 2, "MGC", 2045.0, 2040.0, 5000.0), ("z", 1, "MGC", 5.0, 5.0, 1.0)],
                              "plan string, accountId long, contractId string, entry double, stop double, risk_amount double")
    got = {r.plan: r for r in P.size_positions(s, acc).collect()}
    assert (got["x"].suggested_size, got["x"].total_risk, got["x"].risk_percentage, got["x"].risk_warnings) == (20, 100.0, pytest.approx(0.2), ["large size"])
    assert got["y"].risk_percentage > 10 and "risk exceeds its limit" in got["y"].risk_warnings
    assert got["z"].error == "entry equals stop" and got["z"].suggested_size is None


def test_fills(spark):
    rows = [(0, 2, 2045.0), (0, 3, 2046.0), (1, 1, 2047.0)]
    d = spark.createDataFrame([("MGC", at(i), i, *r) for i, r in enumerate(rows)], "contract string, ts timestamp, seq long, side int, quantity int, price double")
    r = P.positions_from_fills(d).first()
    assert r.net_size == 4 and r.average_price == pytest.approx(2045.6)


def test_order_states(spark):
    rows = [(5, at(0), 1, 1, 0), (5, at(1), 2, 1, 1), (5, at(2), 3, 2, 2)]
    d = spark.createDataFrame([(i, 9, "MGC", t, q, s, 1, 0, 2, f, 1.0, None) for i, t, q, s, f in rows],
                              "id long, accountId long, contractId string, updateTimestamp timestamp, seq long, status int, type int, side int, size int, fillVolume int, limitPrice double, stopPrice double")
    last = O.latest_orders(d)
    assert last.first().status == 2 and O.order_stats(last).first().fill_ratio == 1.0 and O.open_orders(last).count() == 0


@pytest.mark.parametrize("price,tick,want", [(2045.23, 0.1, 2045.2), (2045.27, 0.1, 2045.3), (2045.25, 0.1, 2045.3), (5400.10, 0.25, 5400.00), (5400.30, 0.25, 5400.25),
                                             (5400.60, 0.25, 5400.50), (5400.90, 0.25, 5401.00), (7.77, 0.0, 7.77)])
def test_tick_alignment(spark, price, tick, want):
    d = spark.createDataFrame([(price, tick)], "p double, t double")
    assert d.select(O.align_half_up(F.col("p"), F.col("t"))).first()[0] == want


def test_symbols(spark):
    ids = {"CON.F.US.MGC.M25": "MGC", "MGC": "MGC", "invalid.contract": None, "CON.F.US.MGC.A25": None, "": None, "mgc": None}
    d = spark.createDataFrame([(x,) for x in ids], "c string")
    assert {r.c: r.s for r in d.select("c", O.contract_symbol(F.col("c")).alias("s")).collect()} == ids


def test_brackets_and_risk_reward(spark):
    d = spark.createDataFrame([(1, 0, 10.0, 9.0, 12.0), (2, 0, 10.0, 11.0, 12.0), (3, 1, 10.0, 11.0, 8.0), (4, 1, 10.0, 9.0, 8.0)], "k int, side int, entry double, stop double, target double")
    assert [r.valid for r in P.validate_brackets(d).orderBy("k").collect()] == [True, False, True, False]
    rr = [r.risk_reward for r in P.risk_reward(d).orderBy("k").collect()]
    assert rr == [2.0, None, 2.0, None]


def test_sessions(spark):
    stamps = {"2024-01-05 21:59:00": True, "2024-01-05 22:00:00": False, "2024-01-06 18:00:00": False, "2024-01-07 22:59:00": False, "2024-01-07 23:00:00": True, "2024-01-08 22:30:00": False,
              "2024-07-08 21:30:00": False, "2024-07-08 22:00:00": True}
    d = spark.createDataFrame([(s,) for s in stamps], "s string").withColumn("ts", F.col("s").cast("timestamp"))
    got = {r.s: r for r in C.session_flags(d).collect()}
    assert {s: r.is_open for s, r in got.items()} == stamps
    assert str(got["2024-01-05 22:00:00"].next_open) == "2024-01-07 23:00:00" and str(got["2024-01-07 23:00:00"].next_close) == "2024-01-08 22:00:00"


# --- sources -------------------------------------------------------------------------------------------------


def test_wire_bars(spark):
    rows = [("2024-01-01T09:45:00Z", 2045.8, 2046.5, 2045.5, 2046.2, 200), ("2024-01-01T09:30:00Z", 2045.5, 2046.0, 2045.0, 2045.8, 150)]
    d = readers.normalize_bars(spark.createDataFrame(rows, schemas.BARS_WIRE), "MGC").orderBy("ts")
    assert d.dtypes == [tuple(f.rsplit(" ", 1)) for f in schemas.BARS.split(", ")] and d.first().volume == 150


def test_bars_are_pruned_by_day(spark, tmp_path, series):
    readers.write_bars(series(open=[1.0] * 3, high=[1.0] * 3, low=[1.0] * 3, close=[1.0] * 3, volume=[1] * 3, seconds=86400).drop("seq"), str(tmp_path / "b"))
    d = readers.read_bars(spark, str(tmp_path / "b"), "parquet", wire=False).filter(F.col("date") == "2024-01-03")
    assert d.count() == 1 and "PartitionFilters: [isnotnull(date" in d._jdf.queryExecution().executedPlan().toString()


def test_row_limit():
    assert readers.row_limit(2, 5, 2) == 576 and readers.row_limit(1, 30, 1) == 2880 and readers.row_limit(3, 4, 3) == 18 and readers.row_limit(1, 1, 4) == 1440


def test_depth_times(spark):
    d = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("0001-01-01T00:00:00+00:00",), ("junk",), (None,), ("2024-01-01T01:00:00+01:00",)], "t string")
    got = [str(r[0]) for r in d.select(E.depth_time(F.col("t"), F.lit(T0).cast("timestamp"))).collect()]
    assert got == ["2024-01-01 00:00:00", str(T0), str(T0), str(T0), "2024-01-01 00:00:00"]


def test_merge_on_time(spark):
    a = spark.createDataFrame([("A", T0, 1.0), ("A", at(1), 2.0)], "contract string, ts timestamp, price double")
    b = spark.createDataFrame([("A", T0, 5), ("A", at(1), 6)], "contract string, ts timestamp, volume int")
    assert merge_on_time(a, b).columns == ["contract", "ts", "price", "volume"] and merge_on_time(a, b).count() == 2
