"""Range scans and block walks against plain loops, for any number of ranges."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tapestry import schemas
from tapestry.functions.history import Split, running
from tapestry.functions.clock import day_number, from_wall, wall, wall_date, wall_hour, wall_weekday
from tapestry.operators import bars as B, book as K, flow as W, portfolio as R, positions as Q, stats as S
from tapestry.streaming import sinks, windows

T0 = dt.datetime(2024, 1, 1)
RANGES = [1, 3, 17]


def split(ranges):
    return Split(1, ranges)


@pytest.fixture(scope="module")
def walks(spark):
    """Random walks of three contracts (one null) with gaps in the values, equal peaks, and one value per contract with no others."""
    rng, rows = random.Random(4), []
    for name, n in (("A", 400), (None, 90), ("B", 7), ("C", 1)):
        x = 50
        for i in range(n):
            x = max(0, x + rng.choice([-3, -1, 0, 0, 1, 2]))
            rows.append((name, T0 + dt.timedelta(seconds=i // 3), i, None if rng.random() < 0.05 else float(x), rng.choice([None, {"k": i}])))
    rng.shuffle(rows)
    frame = spark.createDataFrame([(a, b, c, d, None if e is None else (e["k"],)) for a, b, c, d, e in rows], "contract string, ts timestamp, seq long, x double, s struct<k:int>")
    return frame.repartition(4).cache(), sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[2]))


def by_contract(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("ranges", RANGES)
def test_all_running_values(walks, ranges):
    frame, rows = walks
    got = running(
        frame, by="contract", order=["ts", "seq"], chunk=split(ranges), sums={"total": F.col("x"), "n": F.lit(1)}, peaks={"peak": "total"},
        maxes={"high": F.col("x")}, reigns={"reign": "high"}, lasts={"known": F.col("s"), "x0": F.col("x")}, prevs={"before": F.col("s"), "x1": F.col("x")},
    ).collect()
    got = {(r.contract, r.seq): r for r in got}
    assert len(got) == len(rows)
    for name, part in by_contract(rows).items():
        total = peak = high = known = x0 = None
        before, x1, reigns, reign = None, None, [], 0
        for i, (_, _, seq, x, s) in enumerate(part):
            if x is not None:
                total = (total or 0) + x
                peak = total if peak is None else max(peak, total)
                if high is None or x >= high:
                    reign += 1
                high = x if high is None else max(high, x)
                x0 = x
            known = s["k"] if s else known
            r = got[name, seq]
            assert (r.total, r.n, r.peak, r.high, r.x0, r.x1) == (total, i + 1, peak, high, x0, x1)
            assert (r.known and r.known.k) == known and (r.before and r.before.k) == before
            reigns.append((reign, tuple(r.reign) if r.reign else None))
            before, x1 = s["k"] if s else None, x
        named = {}
        for number, label in reigns[next((i for i, r in enumerate(reigns) if r[0]), len(reigns)):]:
            named.setdefault(number, set()).add(label)
        assert all(len(v) == 1 for v in named.values()) and len({min(v) for v in named.values()}) == len(named)


def test_running_without_groups_and_rows(spark, walks):
    frame, rows = walks
    got = running(frame.select("seq", "x"), by=[], order=["x", "seq"], sums={"n": F.lit(1)}, chunk=split(5)).agg(F.max("n"), F.count_distinct("n")).first()
    assert tuple(got) == (len(rows), len(rows))
    none = running(frame.limit(0), by="contract", order="ts", sums={"n": F.lit(1)}, prevs={"p": F.col("x")})
    assert none.count() == 0 and none.columns == [*frame.columns, "n", "p"]


def test_running_maximum_with_nan(spark):
    rows = [("A", i, x) for i, x in enumerate([1.0, float("nan"), 2.0])] + [("B", i, x) for i, x in enumerate([3.0, 1.0])]
    d = spark.createDataFrame(rows, "contract string, seq long, x double")
    for ranges in (1, 4):
        got = {(r.contract, r.seq): r.m for r in running(d, by="contract", order="seq", maxes={"m": F.col("x")}, chunk=split(ranges)).collect()}
        assert got["A", 0] == 1.0 and np.isnan(got["A", 1]) and np.isnan(got["A", 2]) and got["B", 1] == 3.0


@pytest.mark.parametrize("ranges", RANGES)
def test_drawdown(walks, ranges):
    frame, rows = walks
    got = {r.contract: (r.max_drawdown, r.max_drawdown_duration) for r in S.max_drawdown(frame, "x", order=["ts", "seq"], chunk=split(ranges)).collect()}
    for name, part in by_contract(rows).items():
        peak, deepest, run, longest = None, 0.0, 0, 0
        for *_, x, _ in part:
            if x is not None:
                peak = x if peak is None else max(peak, x)
            fall = None if x is None or not peak else x / peak - 1
            run = run + 1 if fall is not None and fall < 0 else 0
            deepest, longest = min(deepest, fall or 0.0), max(longest, run)
        assert got[name] == (pytest.approx(deepest), longest)


@pytest.mark.parametrize("ranges", RANGES)
def test_performance(walks, ranges):
    frame, rows = walks
    d = frame.select(F.coalesce("contract", F.lit("-")).alias("account"), "ts", "seq", (F.col("x") - 49).alias("pnl"))
    got = {r.account: r for r in R.portfolio_metrics(d, 100.0, chunk=split(ranges)).collect()}
    for name, part in by_contract(rows).items():
        equity = peak = 100.0
        deepest = run = longest = 0
        for *_, x, _ in part:
            equity += 0.0 if x is None else x - 49
            run = 0 if equity > peak else run + 1
            peak = max(peak, equity)
            deepest, longest = max(deepest, (peak - equity) / peak), max(longest, run)
        r = got[name or "-"]
        assert (r.max_drawdown, r.max_drawdown_duration, r.total_trades) == (pytest.approx(deepest), longest, len(part))


@pytest.mark.parametrize("ranges", RANGES)
def test_fills(walks, ranges):
    frame, rows = walks
    d = frame.filter("x is not null").select("contract", "ts", "seq", (F.col("seq") % 7 % 2).cast("int").alias("side"), (F.col("seq") % 5).alias("quantity"), F.col("x").alias("price"))
    got = {r.contract: (r.net_size, r.average_price) for r in Q.positions_from_fills(d, chunk=split(ranges)).collect()}
    for name, part in by_contract([r for r in rows if r[3] is not None]).items():
        net, paid, grown = 0, 0.0, 0
        for _, _, seq, price, _ in part:
            q = seq % 5 if seq % 7 % 2 == 0 else -(seq % 5)
            before, net = net, net + q
            if before == 0 or before * net < 0:
                paid, grown = abs(net) * price, abs(net)
            elif abs(net) > abs(before):
                paid, grown = paid + abs(q) * price, grown + abs(q)
        want = paid / grown if net else None
        assert got[name] == (net, want if want is None else pytest.approx(want))


@pytest.fixture(scope="module")
def depth(spark):
    rng = random.Random(9)
    rows = [("AB"[rng.random() < 0.2], T0 + dt.timedelta(seconds=i // 4), i, float(rng.randint(90, 110)), rng.randint(0, 3), rng.choice([1, 2, 2, 5, 9, 10, 3])) for i in range(700)]
    return spark.createDataFrame(rows, schemas.DEPTH).repartition(3).cache(), rows


@pytest.mark.parametrize("ranges", RANGES)
def test_books_on_a_grid(depth, ranges):
    frame, rows = depth
    routed = K.route_depth(frame)
    start, end = T0 + dt.timedelta(seconds=-10), T0 + dt.timedelta(seconds=200)
    got = {(r.contract, r.as_of, r.side, r.level): (r.price, r.volume) for r in K.book_at_grid(routed, start, end, 7, chunk=split(ranges)).collect()}
    top = {(r.contract, r.as_of, r.side, r.level): (r.price, r.volume) for r in K.book_at_grid(routed, start, end, 7, levels=2, chunk=split(ranges)).collect()}
    updates, want = sorted(routed.filter("side <> 'trade'").collect(), key=lambda r: r.seq), {}
    for k in range(31):
        at, live = start + dt.timedelta(seconds=7 * k), {}
        for u in updates:
            if u.ts <= at:
                live[u.contract, u.side, u.price] = u.volume
        for c in "AB":
            for side in ("bid", "ask"):
                levels = sorted([(p, v) for (cc, s, p), v in live.items() if cc == c and s == side and v > 0], reverse=side == "bid")
                want |= {(c, at, side, n): level for n, level in enumerate(levels, 1)}
    assert got == want and top == {k: v for k, v in want.items() if k[3] <= 2}


@pytest.mark.parametrize("ranges", [1, 6, 40])
def test_clusters_over_blocks(spark, ranges):
    """A side of many levels, cut where runs are, gives the runs of a fold; also if one run goes through several blocks."""
    rng = random.Random(ranges)
    prices = sorted({round(rng.uniform(0, 900), 2) for _ in range(2500)} | {2000 + i / 1000 for i in range(400)})
    frame = spark.createDataFrame([("A", "ask", p, 1 + i % 9) for i, p in enumerate(prices)], "contract string, side string, price double, volume long").repartition(5)
    got = sorted((r.low_price, r.high_price, r.order_count, r.total_volume) for r in K.order_clusters(frame, 0.5, 3, chunk=split(ranges)).collect())
    want, run = [], []
    for i, p in enumerate([*prices, float("inf")]):
        if run and p - run[0][0] > 0.5:
            if len(run) >= 3:
                want.append((run[0][0], run[-1][0], len(run), sum(v for _, v in run)))
            run = []
        run.append((p, 1 + i % 9))
    assert got == want and len(want) > 300


def test_spearman_in_groups(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "c"], 600, p=[0.7, 0.25, 0.05]), "x": rng.integers(0, 20, 600).astype(float), "y": rng.normal(size=600).round(1)})
    pdf["z"] = pdf.x * 2 + pdf.y
    pdf.loc[::17, "y"] = np.nan
    frame = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "g string, x double, y double, z double").repartition(4)
    got = {(r.g, r["column"]): r for r in S.correlation_matrix(frame, ["x", "y", "z"], "spearman", by="g").collect()}
    for g, part in pdf.dropna().groupby("g"):
        want = part[["x", "y", "z"]].corr("spearman")
        assert all(got[g, a][b] == pytest.approx(want.loc[a, b]) for a in "xyz" for b in "xyz")
    assert S.correlation_matrix(frame, ["x", "z"], "spearman").filter("column = 'x'").first().z == pytest.approx(pdf[["x", "z"]].corr("spearman").loc["x", "z"])


def test_median_of_very_many_spreads(spark):
    rng = random.Random(1)
    values = [rng.random() for _ in range(5001)] + [0.5] * 50
    frame = spark.createDataFrame([("A", 10.0, 10.0 + v) for v in values] + [("B", 1.0, 2.0)], "contract string, bid double, ask double")
    got = {r.contract: r for r in W.spread_stats(frame).collect()}
    assert got["A"].median_spread == pytest.approx(float(np.median([10.0 + v - 10.0 for v in values]))) and got["B"].median_spread == 1.0


def test_wall_clock(spark):
    """Zone arithmetic on numbers, over both changes of clock."""
    from zoneinfo import ZoneInfo

    zone, utc = ZoneInfo("America/Chicago"), dt.timezone.utc
    times = [dt.datetime(2024, m, d, h, 30, tzinfo=utc) for m, d in ((3, 9), (3, 10), (3, 11), (11, 2), (11, 3), (11, 4), (1, 1)) for h in range(24)] + [dt.datetime(1969, 12, 31, 23, 59, 59, tzinfo=utc)]
    d = spark.createDataFrame([(int(t.timestamp()),) for t in times], "s long").select("s", F.timestamp_seconds("s").alias("ts"))
    w = wall(F.col("ts"), "America/Chicago")
    rows = d.select("s", wall_date(w).alias("d"), wall_hour(w).alias("h"), wall_weekday(w).alias("wd"), day_number(w).alias("n"), F.unix_seconds(from_wall(w, "America/Chicago")).alias("back")).collect()
    for r in rows:
        local = dt.datetime.fromtimestamp(r.s, utc).astimezone(zone)
        assert (r.d, r.h, r.wd) == (local.date(), local.hour, local.weekday())
        assert r.n == (local.date() - dt.date(1970, 1, 1)).days
        assert r.back == r.s or local.fold  # an hour that a clock shows twice means the first one


@pytest.mark.parametrize("timeframe", ["4hr", "1day", "1week", "1month"])
def test_calendar_bars_on_a_stream(spark, tmp_path, timeframe):
    """Finished local days and weeks across a change of clock are those of the batch, each once."""
    start, path = dt.datetime(2024, 3, 1, 3), str(tmp_path / "ticks")
    rows = [("AB"[i % 5 == 0], start + dt.timedelta(minutes=47 * i), i, float(100 + i % 13), i % 4) for i in range(1500)]
    schema = "contract string, ts timestamp, seq long, price double, volume long"
    for k in range(5):
        spark.createDataFrame(rows[300 * k : 300 * k + 300], schema).coalesce(1).write.mode("append").parquet(f"{path}/part={k}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)
    got = [tuple(r) for r in sinks.drain(windows.stream_bars(stream, timeframe, by="contract", delay="0 seconds"), "t").collect()]
    end = B.bar_end(F.col("ts"), timeframe)
    batch = B.bars(spark.createDataFrame(rows, schema), timeframe, by="contract", order=["ts", "seq"])
    closed = {tuple(r) for r in batch.filter(end <= F.lit(rows[-1][1])).collect()}
    assert len(got) == len(set(got)) and set(got) == closed and closed


def test_routing_on_a_stream(spark, depth, tmp_path):
    """Batches that go on with the book of the batch before give the routing of the whole table; dead levels leave the state."""
    from tapestry.streaming import book as L

    frame, rows = depth
    path = str(tmp_path / "depth")
    for k in range(5):
        spark.createDataFrame(rows[140 * k : 140 * k + 140], schemas.DEPTH).coalesce(1).write.mode("append").parquet(f"{path}/part={k}")
    stream = spark.readStream.schema(schemas.DEPTH).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)
    routed, out = L.route_depth_stream(stream), str(tmp_path / "out")
    with L.map_state(spark):
        query = routed.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", out + "-c").trigger(availableNow=True).start()
        query.awaitTermination()
    got = {tuple(r) for r in spark.read.schema(routed.schema).parquet(out).collect()}
    whole = K.route_depth_exact(frame).select(routed.columns)
    assert got == {tuple(r) for r in whole.collect()} and len(query.recentProgress) >= 5
    live = K.book_asof(whole).count()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == live


def test_series_in_buckets(spark):
    """Indicators over a bucketed table shuffle nothing, at the second run as at the first."""
    from tapestry import with_indicators
    from tapestry.sources.readers import read_series, write_series

    rows = [(f"c{i % 7}", T0 + dt.timedelta(minutes=i), float(100 + i % 11), float(101 + i % 11), float(99 + i % 11), 100.0 + i % 13, i % 9) for i in range(700)]
    bars = spark.createDataFrame(rows, "contract string, ts timestamp, open double, high double, low double, close double, volume long")
    spark.sql("DROP TABLE IF EXISTS series_test")
    try:
        write_series(bars.repartition(5), "series_test", buckets=3)
        specs = ["rsi", ("sma", {"period": 5}), "trange"]
        out = with_indicators(read_series(spark, "series_test"), specs, by="contract", order="ts", chunk=None)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
        want = with_indicators(bars, specs, by="contract", order="ts", chunk=None)
        assert sorted(map(str, out.collect())) == sorted(map(str, want.select(out.columns).collect()))
    finally:
        spark.sql("DROP TABLE IF EXISTS series_test")
