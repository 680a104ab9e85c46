"""Hard negatives against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapestry.llm import multi_index
from tapestry.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """All rows of the result, sorted; ``rows``: (vec_id, vector, label) with ids that differ."""
    held = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = int(math.fmod(label + 1, 10)) if i % 7 == 0 else label
        held.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    for a, va, la in held:
        if a % 100:
            continue
        scores = sorted((-sum(x * y for x, y in zip(va, v)), i, label) for i, v, label in held if i != a)
        for p, pid, _ in [s for s in scores if s[2] == la][:5]:
            fits = [(-s, i) for s, i, label in scores if label != la and 80 * -p <= 100 * -s <= 100 * -p][:5]
            out += [(a, pid, rank, n, -p, s) for rank, (s, n) in enumerate(fits, 1)]
    return sorted(out)


def result(df):
    return sorted(map(tuple, df.collect()))


def test_given_table(spark):
    rows = table(spark, "/root/testdata/sf0.1", "embeddings")
    want = brute([tuple(r) for r in rows.select("vec_id", "embedding", "label").collect()])
    assert len(want) > 200 and result(multi_index.hard_negatives(rows)) == want


@pytest.mark.parametrize("width,spread", [(1, 0.05), (7, 0.02), (16, 0.3)])
def test_groups_copies_and_small_blocks(spark, monkeypatch, width, spread):
    """Groups of near vectors, a third of all rows equal, ties in every score; many cells and blocks."""
    monkeypatch.setattr(multi_index, "BLOCK_ROWS", 100)
    monkeypatch.setattr(multi_index, "CELL_ROWS", 4)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, width))
    rows = [(int(i), (centres[i % 12] + spread * rng.normal(size=width)).round(2).tolist(), int(rng.integers(3))) for i in range(900)]
    rows = [(i, [0.5] * width, label) if i % 3 == 0 else (i, v, label) for i, v, label in rows]
    got = result(multi_index.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert got == brute(rows) and got


def test_walk_stops_early():
    """Far cells are not looked at once the windows are certain."""
    rng = np.random.default_rng(1)
    v = np.repeat(rng.normal(size=(40, 8)) * 1000, 50, axis=0).round().astype(np.int64)
    halves = multi_index.Halves(v, 16)
    part = {"row": np.arange(len(v)), "vec_id": np.arange(len(v)), "label": np.zeros(len(v), np.int64)}
    codes = [multi_index.nearest(p.astype(float), b) for p, b in zip(halves.split(v), halves.books)]
    order = np.lexsort(codes[::-1])
    import pyarrow as pa

    columns = {k: pa.array(x[order]) for k, x in part.items()} | {"v": pa.array(v[order].tolist(), pa.list_(pa.int64()))}
    for s, (p, b) in enumerate(zip(halves.split(v), halves.books)):
        columns[f"c{s + 1}"] = pa.array(codes[s][order])
        columns[f"r{s + 1}"] = pa.array(np.sqrt(((p - b[codes[s]]) ** 2).sum(1))[order])
    block = multi_index.Block([pa.RecordBatch.from_pydict(columns)], halves)
    looked, visits = [], block.visits
    block.visits = lambda q: (looked.append(x) or x for x in visits(q))
    found = block.search(-1, 0, v[0], True, [multi_index.TOP], [-multi_index.TOP], 5)
    scores = np.sort(v @ v[0])[::-1][:5]
    assert [s for _, s, *_ in found] == scores.tolist()
    assert 0 < len(looked) < len(block.cells) / 2
    bounds = [x[0] for x in visits(v[0].astype(float))]
    assert bounds == sorted(bounds, reverse=True) and len(bounds) == len(block.cells)
    assert all(high >= (v[order][a:b] @ v[0]).max() for high, a, b in visits(v[0].astype(float)))


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 0.5], 1), (100, [1.0, None], 1), (200, None, 1), (300, [float("nan"), 1.0], 1), (400, [float("inf"), 1.0], 1), (500, [1.0, 1.0], None),
        (None, [1.0, 1.0], 1), (1, [1.0, 0.5], 2), (2, [1.0, 0.4], 3), (3, [1.0], 2), (4, [], 2), (7, [1.0, 0.45], 9), (600, [-1.0, -1.0], 2), (5, [1.0, 0.5], 2),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    clash = frame
    for name in ("row", "v", "block", "k", "score", "same", "bad", "x"):
        clash = clash.withColumn(name, F.lit("extra"))
    want = brute([(i, v and v + [0.0] * (2 - len(v)), label) for i, v, label in rows if v != []] + [(4, [0.0, 0.0], 2)])
    assert result(multi_index.hard_negatives(frame)) == result(multi_index.hard_negatives(clash)) == want and want
    assert multi_index.hard_negatives(frame.limit(0)).collect() == []
    assert multi_index.hard_negatives(frame.filter("vec_id % 100 != 0")).collect() == []
    assert result(multi_index.hard_negatives(spark.createDataFrame([(0, [], 1), (1, [], 1), (2, [], 3), (3, [], 2)], SCHEMA))) == [(0, 3, 1, 1, 0, 0), (0, 3, 2, 2, 0, 0)]
    with pytest.raises(ValueError):
        multi_index.hard_negatives(spark.createDataFrame([(1, [1e30], 1)], SCHEMA))


def test_rows_of_one_id(spark):
    """Rows repeated whole are rows of their own: each is an anchor, and a positive of the other."""
    rows = [(100, [1.0, 0.0], 1), (100, [1.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [0.9, 0.0], 2)]
    got = result(multi_index.hard_negatives(spark.createDataFrame(rows, SCHEMA)))
    assert got == [(100, 100, 1, 3, 65536, 65536)] * 2 + [(100, 100, 2, 4, 65536, 58880)] * 2
