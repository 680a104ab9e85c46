"""Bottom-k sketches against brute-force Jaccard similarity."""

import random

import numpy as np
import pytest

from tapestry.llm import bottom_k
from tests.llm.test_jaccard import corpus as texts_with_copies


def brute(rows):
    """doc_id -> (shingles, smallest id reachable) for 4-word shingles; ``rows``: (doc_id, text)."""
    sets = {}
    for i, t in rows:
        words = (t or "").encode().lower().split()
        sets[i] = {tuple(words[k : k + 4]) for k in range(max(len(words) - 3, 1))} if words else set()
    out, left = {}, sorted(sets)
    while left:
        first = left.pop(0)
        waiting = [first]
        while waiting:
            here = waiting.pop()
            out[here] = (len(sets[here]), first)
            a = sets[here]
            near = [b for b in left if a and 100 * len(a & sets[b]) >= 80 * len(a | sets[b])]
            waiting += near
            left = [b for b in left if b not in near]
    return out


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_random_corpus(docs, corpus):
    got = bottom_k.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute([r[:2] for r in corpus])
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_copies_chains_and_passages(spark, monkeypatch):
    rows = texts_with_copies()
    want = brute(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(bottom_k.near_duplicates(frame)) == want
    # The sample only changes the order of values: nothing frequent, and everything frequent, give the same rows.
    monkeypatch.setattr(bottom_k, "FREQUENT", 1 << 40)
    assert result(bottom_k.near_duplicates(frame)) == want
    monkeypatch.setattr(bottom_k, "FREQUENT", 1)
    assert result(bottom_k.near_duplicates(frame)) == want


def test_edge_of_the_threshold(spark):
    """Sets of 9 shingles that share 8 of 10 in all are linked; 7 of 11 are not."""
    base = [f"w{i}" for i in range(12)]
    at_edge, below = [*base[:-1], "x"], [*base[:-2], "y", "z"]
    rows = [(1, " ".join(base)), (2, " ".join(at_edge)), (3, " ".join(below) + " q")]
    got = result(bottom_k.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute(rows) and got[1][1] == got[2][1] == 1 and got[3] == (10, 3)


def test_bound_never_drops_a_pair():
    """The place of the first shared value admits every pair at 4/5 or more."""
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(1, 60)
        a = set(rng.sample(range(500), n))
        b = set(list(a)[: n - rng.randint(0, n // 6)]) | set(rng.sample(range(500, 900), rng.randint(0, n // 8)))
        if 5 * len(a & b) < 4 * len(a | b):
            continue
        x, y = sorted(a), sorted(b)
        first = min(a & b)
        i, j = x.index(first), y.index(first)
        assert i <= len(x) // 5 and j <= len(y) // 5
        assert eval(bottom_k.most_shared("i j", "n m").replace("least", "min"), {"min": min, "i": i, "j": j, "n": len(x), "m": len(y)})


def test_union_sketch(spark):
    """The k smallest values of the union, under one hash function; its bound drops no pair at 4/5 and nearly all far below."""
    rng, rows, want = np.random.default_rng(3), [], []
    frequent = np.sort(rng.integers(0, 1 << 63, 40).astype("<u8"))
    times = rng.integers(2, 1 << 20, 40)
    for _ in range(200):
        a = rng.choice(rng.integers(0, 1 << 63, int(rng.integers(1, 300))).astype("<u8"), int(rng.integers(1, 300)))
        a = np.unique(np.r_[a, frequent[: rng.integers(0, 40)]])
        b = np.unique(np.r_[a[rng.random(len(a)) > rng.choice([0.02, 0.1, 0.5])], rng.integers(0, 1 << 63, int(rng.integers(0, 20))).astype("<u8")])
        if len(b):
            u, v = (bottom_k.hashed(x, frequent, times).tolist() for x in (a, b))
            low = u[: len(u) // 5 + 1], v[: len(v) // 5 + 1]
            union = [x for x in sorted(set(u) | set(v)) if x <= min(low[0][-1], low[1][-1])]
            rows.append((*low, len(u), len(v)))
            want.append((len(union), len(set(union) & set(u) & set(v)), len(set(u) & set(v)) / len(set(u) | set(v))))
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, lowu array<long>, lowv array<long>, nu int, nv int")
    got = {r.i: (r.k, r.shared) for r in bottom_k.union_sketched(frame).collect()}
    stay = {r.i for r in bottom_k.union_sketched(frame).filter(bottom_k.UNION_BOUND).collect()}
    assert all(got[i] == w[:2] for i, w in enumerate(want))
    assert {i for i, w in enumerate(want) if w[2] >= 0.8} <= stay
    assert sum(w[2] < 0.6 for i, w in enumerate(want) if i in stay) < 0.5 * sum(w[2] < 0.6 for w in want)


def test_frequent_shingles_come_last():
    found = np.array([1 << 20, 2 << 20, 3 << 20], "<u8")
    values = bottom_k.hashed(found, found[:2], np.array([4, 1 << 30]))
    assert (values & ((1 << 58) - 1)).tolist() == [3 << 14, 1 << 14, 2 << 14] and (values >= 0).all()


def test_large_group_and_long_text(spark):
    rng = random.Random(2)
    base = [f"b{rng.randrange(5000)}" for _ in range(200)]
    rows = []
    for i in range(400):
        words = list(base)
        words[rng.randrange(200)] = f"n{i}"
        rows.append((i, " ".join(words)))
    long = [f"l{i}" for i in range(60_000)]
    rows += [(1000, " ".join(long)), (1001, " ".join(long[:-3000])), (1002, "x" * 500_000), (1003, "X" * 500_000)]
    got = result(bottom_k.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    assert {got[i][1] for i in range(400)} == {0}
    assert got[1001] == (56_997, 1000) and got[1003] == (1, 1002)


def test_odd_rows(spark, odd, empty):
    got = bottom_k.near_duplicates(odd).collect()
    assert len(got) == 6 and sorted(r.component_id or -1 for r in got) == [-1, 7, 7, 7, 7, 7]
    assert [r.n_shingles for r in got if r.doc_id is None and r.component_id is None] == [0]
    assert sum(r.kept for r in got) == 3  # id 7 twice with the text, once with the other
    assert bottom_k.near_duplicates(empty).count() == 0
    assert bottom_k.near_copies(empty).columns == ["doc_id", "text_hash", "words", "n_shingles", "component_id", "component_key"]
    one = spark.createDataFrame([(3, "")], "doc_id long, text string")
    assert result(bottom_k.near_duplicates(one)) == {3: (0, 3)}


@pytest.mark.parametrize("text,n", [("", 1), ("a b", 1), ("a b c d e", 1), ("a b c d e f", 2), ("a a a a a a a", 1)])
def test_shingles(text, n):
    words, values = bottom_k.shingles(text)
    assert words == len(text.split()) and len(values) == n and (np.diff(values.astype(object)) > 0).all()


def test_sketches_are_written_once_and_unasked_ones_stay(spark, monkeypatch):
    """No table but that of the sets has sketches; those of texts without a near copy are not fetched."""
    rng, stored, fetched, store, marked = random.Random(5), {}, [], bottom_k.store, bottom_k._marked
    words = lambda: [f"w{rng.randrange(10**6)}" for _ in range(40)]
    near = words()
    rows = [(i, " ".join(words())) for i in range(60)] + [(100 + i, " ".join([*near, f"end{i}"])) for i in range(4)]

    def kept(df, label):
        stored.setdefault(label, []).append(df.columns)
        return store(df, label)

    def seen(frame, asked, key):
        out = marked(frame, asked, key)
        if "low" in frame.columns:
            fetched.append(out)
        return out

    monkeypatch.setattr(bottom_k, "store", kept)
    monkeypatch.setattr(bottom_k, "_marked", seen)
    got = result(bottom_k.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)))
    assert got == brute(rows) and {got[100 + i][1] for i in range(4)} == {100}
    assert [label for label, tables in stored.items() for columns in tables if "low" in columns] == ["sets"]
    assert 2 <= fetched[0].count() + fetched[1].count() <= 8
