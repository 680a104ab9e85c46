"""Streams over several micro-batches give what the batch operators give on the closed rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from catalog import streams
from tapestry.functions.history import newest
from tapestry.functions.joins import latest_state
from tapestry.operators import bars as B, book as K
from tapestry.sources.quotes import forward_fill_quotes
from tapestry.streaming import fold, sinks, state as S, windows as W

T0 = dt.datetime(2024, 1, 2)


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    """300 ticks of two contracts in six files, in time order, read one file per micro-batch."""
    path = str(tmp_path_factory.mktemp("ticks"))
    rows = [("AB"[i % 3 // 2], T0 + dt.timedelta(seconds=37 * i), i, float(100 + i % 13), i % 5, "bid" if i % 2 else "ask") for i in range(300)]
    schema = "contract string, ts timestamp, seq long, price double, volume long, side string"
    for k in range(6):
        spark.createDataFrame(rows[50 * k : 50 * k + 50], schema).coalesce(1).write.mode("append").parquet(f"{path}/part={k}")
    batch = spark.read.schema(schema).parquet(f"{path}/part=*")

    def stream():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)

    return batch, stream


def as_set(df, *cols):
    return {tuple(r) for r in df.select(*cols).collect()}


def test_bars(source):
    batch, stream = source
    cols = ["contract", "ts", "open", "high", "low", "close", "volume"]
    got = as_set(sinks.drain(W.stream_bars(stream(), "5min", by="contract", delay="0 seconds"), "t"), *cols)
    last = batch.agg(F.max("ts")).first()[0]
    want = as_set(B.bars(batch, "5min", by="contract", order=["ts", "seq"]).filter(F.col("ts") + F.expr("INTERVAL 5 MINUTES") <= F.lit(last)), *cols)
    assert got == want and len(got) > 10


def test_forward_fill(source):
    batch, stream = source
    quotes = lambda d: d.select("contract", "ts", "seq", F.when(F.col("volume") == 1, F.col("price")).alias("bid"), F.when(F.col("volume") == 2, F.col("price")).alias("ask"))
    rows = sinks.drain(S.fill_quotes(quotes(stream())), "q")
    cols = ["contract", "ts", "seq", "bid", "ask"]
    assert as_set(rows, *cols) == as_set(forward_fill_quotes(quotes(batch)), *cols)


def test_book(source):
    batch, stream = source
    key = dict(key=["contract", "side", "price"], order=["ts", "seq"])
    levels = S.drain_changes(S.newest(stream().withColumn("type", F.col("side")), **key), "b", **key)
    cols = ["contract", "side", "price", "volume", "ts"]
    want = as_set(K.book_asof(batch.withColumn("type", F.col("side"))), *cols)
    assert as_set(K.book_asof(levels), *cols) == want


def test_latest(source):
    batch, stream = source
    key = dict(key=["contract", "price"], order=["ts", "seq"])
    state = S.drain_changes(S.newest(stream(), **key), "l", **key)
    cols = ["contract", "price", "seq", "volume"]
    assert as_set(state, *cols) == as_set(latest_state(batch, key=["contract", "price"], order=["ts", "seq"]), *cols)


def test_retention(source):
    batch, stream = source
    rows, state = fold.run_to_end(stream(), fold.rolling_retention(keep=20, by="contract", order=["ts", "seq"]), "r")
    assert rows is None and {r["count"] for r in state.groupBy("contract").count().collect()} == {20}


def test_alert_is_raised_once(spark, source):
    _, stream = source
    rules = spark.createDataFrame([("A", 1e9, 1e9, 1e9)], "contract string, max_loss double, max_gain double, pnl_threshold double")
    events = stream().select("contract", "ts", "seq", F.lit(1).alias("type"), (F.floor(F.col("seq") / 70) + 1).cast("int").alias("size"), F.lit(1.0).alias("averagePrice"), "price")
    got = sinks.drain(S.alerts(events, rules, by="contract", order=["ts", "seq"]), "a").collect()
    assert len(got) == 1 and got[0].reason == "size_change" and got[0].size_change == 1 and got[0].seq >= 70


def test_retried_batch_starts_from_the_same_table(spark, source, tmp_path):
    """Running a batch again (as after a failure) reads the table before it, not its own."""
    batch, _ = source
    step = fold.rolling_retention(keep=3, by="contract", order=["ts", "seq"])
    path = str(tmp_path / "state")
    first, second = batch.filter("seq < 100"), batch.filter("seq >= 100")
    step(first, None)[1].write.parquet(f"{path}/slot=0")
    for _ in range(2):
        step(second, spark.read.parquet(f"{path}/slot=0"))[1].write.mode("overwrite").parquet(f"{path}/slot=1")
    want = newest(batch, 3, by="contract", order=["ts", "seq"])
    assert as_set(fold.current_state(spark, path, 1), "contract", "seq") == as_set(want, "contract", "seq")


def test_tracked_keys_expire(source):
    _, stream = source
    changes = S.tracked(stream().filter("seq < 90 or contract = 'A'").select("contract", "ts", "seq"), key="contract", order=["ts", "seq"], ttl_seconds=1800)
    got = {r.contract: r.expired for r in S.drain_changes(changes, "t", key="contract", order=["ts", "expired"]).collect()}
    assert got == {"A": False, "B": True}


def test_hooks_see_every_batch(source):
    _, stream = source
    seen = []
    fold.run_to_end(stream(), fold.rolling_retention(keep=5, by="contract", order=["ts", "seq"]), "h", hooks=[lambda rows, n: seen.append(n)])
    assert seen == list(range(6))


def test_late_rows_go_to_a_side_table(spark, tmp_path):
    """Every tick that the bar stream drops is in the side table."""
    path = str(tmp_path / "late")
    schema = "contract string, ts timestamp, seq long, price double, volume long"
    order = [0, 400, 30, 700, 290, 650, 1500]  # seconds; one file each
    for i, sec in enumerate(order):
        spark.createDataFrame([("A", T0 + dt.timedelta(seconds=sec), i, 1.0, 1)], schema).coalesce(1).write.parquet(f"{path}/part={i}")
    read = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)
    late, _ = fold.run_to_end(read(), fold.late_step("5min"), "late")
    late = sorted(r.seq for r in late.collect())
    assert late == [2, 4]
    kept = sinks.drain(W.stream_bars(read(), "5min", by="contract"), "bars")
    dropped = len(order) - 1 - kept.agg(F.sum("volume")).first()[0]  # the last bar is still open
    assert 1 <= dropped <= len(late)


def test_expired_on_arrival(spark, tmp_path):
    """A key whose time is over when it comes, and one whose older row comes late, expire all the same."""
    path = str(tmp_path / "late")
    batches = [[("A", 0, 0), ("C", 9000, 1)], [("B", 100, 2), ("A", 7900, 3), ("C", 8000, 4)], [("D", 20000, 5)], [("D", 20001, 6)]]
    for i, batch in enumerate(batches):
        rows = [(c, T0 + dt.timedelta(seconds=sec), n) for c, sec, n in batch]
        spark.createDataFrame(rows, "contract string, ts timestamp, seq long").coalesce(1).write.parquet(f"{path}/part={i}")
    stream = spark.readStream.schema("contract string, ts timestamp, seq long").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)
    changes = S.tracked(stream, key="contract", order=["ts", "seq"], ttl_seconds=1800)
    got = S.drain_changes(changes, "t", key="contract", order=["ts", "expired"]).collect()
    assert {r.contract: r.expired for r in got} == {"A": True, "B": True, "C": True, "D": False}
    assert {r.contract: r.ts for r in got}["C"] == T0 + dt.timedelta(seconds=9000)


@pytest.mark.parametrize("file_rows,files", [(1000, 1), (20, 4)])
def test_every_span_of_time_is_one_batch(spark, tmp_path, monkeypatch, file_rows, files):
    """However many files a table has, and where a span has no rows: four batches in time order, all rows once."""
    days = [d for d in range(300) if not 75 < d <= 150]
    rows = [(d, T0 + dt.timedelta(days=d)) for d in days] + [(300, T0 + dt.timedelta(days=300))]
    spark.createDataFrame(rows, "id long, ts timestamp").repartition(7).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(streams, "FILE_ROWS", file_rows, raising=False)
    base, seen = str(tmp_path / "stream"), []

    def note(batch, number):
        seen.append((sorted(r.id for r in batch.collect()), batch.select("file").distinct().count()))

    stream = streams.stream(spark, str(tmp_path), "events", "ts").select("id", F.col("_metadata.file_name").alias("file"))
    stream.writeStream.foreachBatch(note).option("checkpointLocation", base).trigger(availableNow=True).start().awaitTermination()
    assert [ids for ids, _ in seen] == [[i for i, _ in rows if lo < i <= lo + 75 or i == lo == 0] for lo in range(0, 300, 75)]
    assert max(n for _, n in seen) == files
