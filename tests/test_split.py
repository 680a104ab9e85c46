"""Cut histories give what uncut ones give, also with a contract that owns most rows, null keys and shuffled input."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import tapestry.operators  # noqa: F401
from tapestry.functions.history import Split, newest, number_rows, over_history, plan_split, running
from tapestry.functions.joins import asof_join
from tapestry.operators import book as B, patterns as P, portfolio as R, positions as Q, stats as S
from tapestry.operators.registry import REGISTRY

K = {"by": "contract", "order": ["ts", "seq"]}


@pytest.fixture(scope="module")
def frame(spark):
    """Three contracts, one with four fifths of the rows, gaps in time and several rows per instant."""
    rng = np.random.default_rng(7)
    parts = []
    for name, n in (("HOT", 1200), ("B", 250), ("C", 5)):
        gaps = rng.choice([0, 0, 1, 2, 60, 5000], n)
        close = 100 + np.cumsum(rng.normal(0, 1, n)).round(2)
        close[n // 3 : n // 2] = close[n // 3]  # a long flat stretch
        parts.append(pd.DataFrame({
            "contract": name, "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.cumsum(gaps), unit="s"), "seq": np.arange(n), "open": close,
            "high": close + rng.integers(0, 4, n), "low": close - rng.integers(0, 4, n), "close": close, "volume": rng.integers(0, 50, n)}))
    pdf = pd.concat(parts).sample(frac=1, random_state=3)
    return spark.createDataFrame(pdf).repartition(5).cache()


def rows(df, *extra):
    return df.toPandas().sort_values(["contract", "seq", *extra]).reset_index(drop=True)


def same(a, b, *extra):
    a, b = rows(a, *extra), rows(b, *extra)
    pd.testing.assert_frame_equal(a[sorted(a.columns)], b[sorted(b.columns)], check_dtype=False, rtol=1e-9, atol=1e-7)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_indicator(frame, name):
    params = {"period": 6} if "period" in REGISTRY[name].defaults and name != "vwap" else {}
    same(REGISTRY[name](frame, chunk=None, **params, **K), REGISTRY[name](frame, chunk=90, **params, **K))


def test_running(frame):
    maybe = F.when(F.col("volume") % 3 == 0, F.col("close"))
    args = dict(sums={"s": F.col("volume")}, maxes={"m": F.col("close")}, lasts={"l": maybe}, prevs={"p": maybe, "q": F.col("volume")})
    same(running(frame, chunk=None, **args, **K), running(frame, chunk=40, **args, **K))


def test_running_with_null_contract(frame):
    d = frame.withColumn("contract", F.when(F.col("contract") != "HOT", F.col("contract")))
    assert plan_split(d, "contract", ["ts"], 40).null_keys
    same(running(d, chunk=None, sums={"s": F.col("volume")}, **K), running(d, chunk=40, sums={"s": F.col("volume")}, **K))


def test_against_pandas_scan(frame):
    got = rows(running(frame, chunk=50, sums={"s": F.col("volume")}, **K))
    want = rows(frame)
    want["s"] = want.sort_values(["ts", "seq"]).groupby("contract")["volume"].cumsum()
    assert (got["s"] == want["s"]).all()


def test_positions_are_dense(frame):
    d = number_rows(frame, chunk=30, **K).groupBy("contract").agg(F.min("__rn").alias("a"), F.max("__rn").alias("z"), F.countDistinct("__rn").alias("n"))
    assert all(r.a == 0 and r.z == r.n - 1 for r in d.collect())


def test_look_ahead(frame):
    body = lambda d, t: d.withColumns({"n3": t.lead("close", 3), "m": F.max("close").over(t.frame(-4, 3))})
    run = lambda c: over_history(frame, body, lookback=4, lookahead=3, chunk=c, **K)
    same(run(None), run(25))


def test_blocks_are_bounded(frame):
    """No window group holds more than a block with its copies."""
    seen = {}

    def body(d, t):
        seen["largest"] = d.groupBy(*t.keys).count().agg(F.max("count")).first()[0]
        return d

    over_history(frame, body, lookback=10, chunk=50, **K).count()
    assert seen["largest"] <= 60


def test_bursts_and_single_time_stamps_are_cut_evenly(spark, monkeypatch):
    """A burst in a long even history, and rows of one time stamp, both give ranges of about the wanted size."""
    import datetime as dt

    import tapestry.functions.history as H

    start, seen = dt.datetime(2024, 1, 1), []
    real = H.settle
    monkeypatch.setattr(H, "settle", lambda df, label="stage": seen.append(real(df, label)) or seen[-1])
    even = [("A", start + dt.timedelta(seconds=60 * i), i, 1) for i in range(4000)] + [("A", start, 10_000 + i, 1) for i in range(2000)]
    for data in (even, [("B", start, i, 1) for i in range(6000)]):
        d = spark.createDataFrame(data, "contract string, ts timestamp, seq long, volume long").repartition(6)
        out = running(d, sums={"s": F.col("volume")}, chunk=500, **K)
        assert [r.s for r in out.orderBy("ts", "seq").collect()] == list(range(1, 6001))
        sizes = [r["count"] for r in seen[-1].groupBy("contract", "__bucket").count().collect()]
        assert max(sizes) <= 1000 and len(sizes) <= 13


def test_small_blocks_make_no_more_tasks(spark):
    """Blocks of a few rows in a long history: ranges stay as many as shuffle partitions, beyond them only at the session limit."""
    rows = spark.range(0, 20_000, 1, 4).select((F.col("id") % 3).alias("contract"), F.timestamp_seconds("id").alias("ts"), "id", F.col("id").cast("double").alias("close"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert plan_split(rows, "contract", "ts", 10).ranges == parts
    got = S.returns(rows, chunk=10).agg(F.count("returns"), F.round(F.sum("returns"), 9)).first()
    assert got == S.returns(rows, chunk=None).agg(F.count("returns"), F.round(F.sum("returns"), 9)).first()
    before = spark.conf.get("tapestry.maxGroupRows", None)
    spark.conf.set("tapestry.maxGroupRows", "500")
    try:
        assert plan_split(rows, "contract", "ts", "auto").ranges == 40 and plan_split(rows, "contract", "ts", 10).ranges == 40
    finally:
        spark.conf.unset("tapestry.maxGroupRows") if before is None else spark.conf.set("tapestry.maxGroupRows", before)


def test_plan_is_measured(frame):
    assert plan_split(frame, "contract", "ts", "auto").ranges is None
    assert plan_split(frame, "contract", "ts", 100).ranges is not None
    assert plan_split(frame, "contract", "ts", 100, bar_seconds=10**6).ranges is None
    assert plan_split(frame, "contract", "ts", Split(1, 5)) == Split(1, 5)


def test_session_limit(spark, frame):
    spark.conf.set("tapestry.maxGroupRows", "60")
    try:
        assert plan_split(frame, "contract", "ts").ranges is not None
    finally:
        spark.conf.unset("tapestry.maxGroupRows")


def test_drawdown_returns_patterns(frame):
    a, b = (S.max_drawdown(frame, chunk=c, **K).toPandas().sort_values("contract").reset_index(drop=True) for c in (None, 40))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)
    same(S.returns(frame, chunk=None, **K), S.returns(frame, chunk=40, **K))
    a, b = (P.chart_patterns(frame, window=6, chunk=c, **K) for c in (None, 40))
    same(a, b, "pattern")
    assert a.count() > 0


def test_drawdown_by_hand(frame):
    got = {r.contract: r for r in S.max_drawdown(frame, chunk=40, **K).collect()}
    for name, g in frame.toPandas().sort_values(["ts", "seq"]).groupby("contract"):
        dd = g["close"] / g["close"].cummax() - 1
        longest = cur = 0
        for v in dd:
            cur = cur + 1 if v < 0 else 0
            longest = max(longest, cur)
        assert got[name].max_drawdown == pytest.approx(dd.min()) and got[name].max_drawdown_duration == longest


def test_newest(spark, frame):
    want = frame.toPandas().sort_values(["ts", "seq"]).groupby("contract").tail(30)
    for limit in ("1000", "5"):  # with and without the limit pushed below the shuffle
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", limit)
        got = newest(frame, 30, **K).toPandas()
        assert sorted(zip(got.contract, got.seq)) == sorted(zip(want.contract, want.seq))
    spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


@pytest.mark.parametrize("fill", [False, True])
@pytest.mark.parametrize("strict", [False, True])
def test_asof_join_against_brute_force(spark, frame, fill, strict):
    trades = frame.select("contract", "ts", "seq", "close")
    quotes = frame.filter("volume % 4 = 0").select(
        "contract", F.col("ts"), F.col("seq"), F.when(F.col("volume") % 8 == 0, F.col("high")).alias("bid"), F.col("low").alias("ask"))
    got = [asof_join(trades, quotes, by="contract", values=["bid", "ask"], fill=fill, strict=strict, chunk=c) for c in (None, 50)]
    same(*got)
    q = quotes.toPandas().sort_values(["ts", "seq"])
    out = rows(got[0])
    for r in out.sample(60, random_state=1).itertuples():
        c = q[(q.contract == r.contract) & ((q.ts < r.ts) if strict else (q.ts <= r.ts))]
        bid = (c.bid.dropna() if fill else c.bid).iloc[-1:] if len(c) else c.bid
        want = bid.iloc[0] if len(bid) else np.nan
        assert (np.isnan(want) and (r.bid is None or np.isnan(r.bid))) or want == r.bid


def test_portfolio_and_fills(frame):
    d = frame.withColumns({"pnl": F.col("close") - 100, "side": (F.col("volume") % 2).cast("int"), "quantity": F.col("volume"), "price": F.col("close")})
    for run in (lambda c: R.portfolio_metrics(d, 500.0, chunk=c, **K), lambda c: Q.positions_from_fills(d.filter("quantity > 0"), chunk=c, **K)):
        a, b = (run(c).toPandas().sort_values("contract").reset_index(drop=True) for c in (None, 40))
        pd.testing.assert_frame_equal(a, b, check_dtype=False, rtol=1e-9)


def test_best_prices_against_a_scan(spark, frame):
    d = frame.select("contract", "ts", "seq", F.round("close").alias("price"), (F.col("volume") % 5).alias("volume"),
                     F.when(F.col("volume") % 3 == 0, 1).when(F.col("volume") % 3 == 1, 2).otherwise(5).alias("type"))
    want = {}
    for name, g in d.toPandas().sort_values(["ts", "seq"]).groupby("contract"):
        sides = {1: {}, 2: {}}
        for r in g.itertuples():
            if r.type in sides:
                sides[r.type][r.price] = r.volume
            bids, asks = ([p for p, v in sides[k].items() if v > 0] for k in (2, 1))
            want[name, r.seq] = (max(bids, default=None), min(asks, default=None))
    for chunk in (None, 60, 500):
        got = {(r.contract, r.seq): (r.best_bid, r.best_ask) for r in B.bbo_history(d, chunk=chunk).collect()}
        assert got == want
