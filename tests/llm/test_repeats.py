"""Suffix arrays and suffix trees against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from tapestry.llm import pieces, suffix_array, suffix_trees

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_bytes(rows, width):
    seen, out = set(), {}
    for i, t in sorted(rows):
        raw = (t or "").encode()
        gone = [False] * len(raw)
        fresh = []
        for s in range(len(raw) - width + 1):
            w = raw[s : s + width]
            if w in seen:
                gone[s : s + width] = [True] * width
            seen.add(w)
            fresh.append(w)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not p for g, p in zip(gone, [False] + gone))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def brute_words(rows, width):
    first, out = {}, {}
    for i, t in rows:
        words = WORD.findall((t or "").encode())
        for s in range(len(words) - width + 1):
            w = tuple(words[s : s + width])
            first[w] = min(first.get(w, i), i)
    for i, t in rows:
        words = WORD.findall((t or "").encode())
        gone = [False] * len(words)
        for s in range(len(words) - width + 1):
            if first[tuple(words[s : s + width])] < i:
                gone[s : s + width] = [True] * width
        out[i] = (len(words), sum(gone), hashlib.sha256(b" ".join(w for w, g in zip(words, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("width,gram", [(100, 24), (12, 5), (7, 7)])
def test_bytes(docs, corpus, width, gram):
    want = brute_bytes([(i, t) for i, t, *_ in corpus], width)
    got = suffix_array.remove_repeats(docs, length=width, gram=gram).collect()
    assert len(got) == len(corpus)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


@pytest.mark.parametrize("width,gram", [(13, 4), (3, 2), (2, 1)])
def test_words(docs, corpus, width, gram):
    want = brute_words([(i, t) for i, t, *_ in corpus], width)
    got = suffix_trees.remove_repeats(docs, words=width, gram=gram).collect()
    assert len(got) == len(corpus)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want


@pytest.mark.parametrize("piece", [3, 64])
def test_slices_and_runs_do_not_matter(monkeypatch, piece):
    """Pieces of cut texts still bring equal windows together."""
    rng = random.Random(3)
    windows = pieces.Windows(9, 4, words=False, strict=False)
    text = "".join(rng.choice("ab") for _ in range(400)).encode()
    raw = np.frombuffer(text, np.uint8)
    n = len(raw)
    for at in (0, 37):
        part = raw[at:]
        anchor, _, first, count, _ = windows.pieces(part, np.arange(len(part) + 1), np.full(len(part), len(part)))
        mine = {at + s + k: a for a, s, c in zip(anchor.tolist(), first.tolist(), count.tolist()) for k in range(c)}
        assert len(mine) == n - at - 8
        by_window: dict[bytes, set] = {}
        for p, a in mine.items():
            by_window.setdefault(text[p : p + 9], set()).add(a)
        assert all(len(x) == 1 for x in by_window.values())


def test_repeats_inside_a_piece_are_marked():
    """Wherever two windows of one piece are equal, the piece says so."""
    rng = random.Random(8)
    windows, found = pieces.Windows(12, 5, words=False, strict=False), 0
    for _ in range(300):
        text = b"".join(bytes(rng.choice(b"abcdef") for _ in range(rng.randint(1, 9))) * rng.randint(1, 9) for _ in range(4))
        if len(text) < 12:
            continue
        _, _, first, count, inner = windows.pieces(np.frombuffer(text, np.uint8), np.arange(len(text) + 1), np.full(len(text), len(text)))
        for s, c, x in zip(first.tolist(), count.tolist(), inner.tolist()):
            if len({text[p : p + 12] for p in range(s, s + c)}) < c:
                found += 1
                assert x
    assert found > 50


def test_maximal_repeats():
    text = b"abcabxabcaby"
    found = dict((text[places[0] : places[0] + n], places) for n, places in suffix_array.maximal_repeats(text, 2))
    assert found == {b"abcab": [0, 6], b"ab": [0, 3, 6, 9]}
    rng = random.Random(1)
    for _ in range(40):
        text = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 40)))
        want = []
        for n in range(2, len(text)):
            for w in {text[i : i + n] for i in range(len(text) - n + 1)}:
                at = [i for i in range(len(text) - n + 1) if text[i : i + n] == w]
                before, after = {text[i - 1 : i] if i else None for i in at}, {text[i + n : i + n + 1] or None for i in at}
                if len(at) > 1 and (len(before) > 1 or before == {None}) and (len(after) > 1 or after == {None}):
                    want.append((n, at))
        assert suffix_array.maximal_repeats(text, 2) == sorted(want)


def test_tree_is_complete():
    rng = random.Random(2)
    for _ in range(40):
        text = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 60)))
        order, lcp = pieces.sorted_suffixes(text, np.arange(len(text)), np.full(len(text), len(text)))
        groups = {frozenset(order[x.first : x.last + 1].tolist()) for x in suffix_trees.deep(suffix_trees.build(lcp.tolist()), 2)}
        want = {}
        for i in range(len(text) - 1):
            want.setdefault(text[i : i + 2], set()).add(i)
        assert groups == {frozenset(x) for x in want.values() if len(x) > 1}


def test_prefix_groups_are_bounded():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 3, 500).astype(np.uint32)
    first = np.arange(480)
    groups = list(suffix_trees.prefix_groups(first, np.full(480, 20), codes, 10, 8))
    assert sorted(np.concatenate(groups).tolist()) == first.tolist()
    assert all(len(g) <= 10 for g in groups)


def test_odd_rows(odd, empty):
    rows = sorted(suffix_trees.remove_repeats(odd, words=4, gram=2).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.n_words))
    assert [(r.doc_id, r.n_words, r.n_removed) for r in rows] == [(None, 0, 0), (None, 72, 0), (7, 1, 0), (7, 72, 72), (7, 72, 72), (8, 73, 72)]
    rows = suffix_array.remove_repeats(odd, length=20, gram=5, with_text=True).collect()
    assert len(rows) == 6
    both = [r for r in rows if r.doc_id == 7 and r.n_bytes > 10]
    assert len(both) == 2 and both[0] == both[1] and both[0].n_removed == both[0].n_bytes
    assert suffix_trees.remove_repeats(empty).count() == 0 and suffix_array.remove_repeats(empty).count() == 0
