"""SimHash, the Gray-order index and components against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from tapestry.llm import gray_index


def brute_print(text):
    words = [w for w in __import__("re").findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())]
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [b" ".join(words)] if words else []
    value = 0
    for bit in range(64):
        if 2 * sum(xxhash.xxh64_intdigest(s, 42) >> bit & 1 for s in shingles) > len(shingles):
            value |= 1 << bit
    return value


def brute_components(prints):
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def test_near_groups(docs, corpus):
    rows = sorted(corpus)
    prints = [brute_print(t) for _, t, *_ in rows]
    roots = brute_components(prints)
    got = {r.doc_id: r for r in gray_index.near_groups(docs).collect()}
    assert len(got) == len(rows)
    for (i, *_), p, r in zip(rows, prints, roots):
        assert (got[i].fingerprint, got[i].component_id) == (f"{p:016x}", rows[r][0])


def test_gray_rank():
    codes = np.arange(1 << 12, dtype=np.uint64)
    gray = codes ^ (codes >> np.uint64(1))
    assert (gray_index.gray_rank(gray) == codes).all()


def clustered(seed, n, centres):
    rng = random.Random(seed)
    out = set()
    for _ in range(centres):
        c = rng.getrandbits(64)
        for _ in range(n // centres):
            x = c
            for _ in range(rng.randint(0, 7)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("chunk", [8, 1024])
def test_links_connect_what_is_near(spark, chunk):
    """Also with buckets dealt out as many pairs of chunks."""
    prints = clustered(1, 300, 5)
    want = brute_components(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {r.node: r.root for r in gray_index.components(gray_index.links(frame, chunk=chunk)).collect()}
    groups, wanted = {}, {}
    for p, s, w in zip(prints, signed, want):
        groups.setdefault(found.get(s, s), set()).add(p)
        wanted.setdefault(w, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_linked_in_memory():
    for seed in range(6):
        prints = np.array(clustered(seed, 400, 3 + seed * 10), np.uint64)
        root = gray_index.linked(prints, np.zeros(len(prints), np.int64), np.zeros(len(prints), np.int64))
        want = brute_components([int(p) for p in prints])
        assert len(set(zip(root.tolist(), want))) == len(set(want)) == len(set(root.tolist()))


def test_components_of_a_path(spark):
    order = list(range(200))
    random.Random(0).shuffle(order)
    edges = spark.createDataFrame([(a, b) for a, b in zip(order, order[1:])] + [(1000, 1001), (5, 5)], "u long, v long")
    got = {r.node: r.root for r in gray_index.components(edges).collect()}
    assert len({got[i] for i in order}) == 1 and got[1000] == got[1001] != got[0]


def test_odd_rows(odd, empty):
    rows = gray_index.near_groups(odd).collect()
    assert len(rows) == 6
    assert {r.component_id for r in rows if r.doc_id == 7 and r.component_size > 1} == {7}
    assert gray_index.near_groups(empty).count() == 0
