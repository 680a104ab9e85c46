"""Packing: exact round trip of all ids, little padding, the same ids as the tokenizers library."""

import itertools
import random
import zlib

import numpy as np
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tapestry.llm import packing

BPE = packing.ByteBPE(packing.public_path("byte_bpe_50k.tiktoken"))
JSON = Tokenizer.from_file(packing.public_path("byte_bpe_50k.json"))
JSON.encode_special_tokens = True


def ids(text):
    return [*JSON.encode(text or "", add_special_tokens=False).ids, 1]


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t.,'s0é日  \x1c\x85"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_same_ids(text):
    assert BPE.encode(text).tolist() == ids(text)[:-1]


def check(rows, texts, window=2048):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for i, text in texts.items():
        want, at = ids(text), 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(want[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(want)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_round_trip(docs, corpus):
    texts = {i: t for i, t, *_ in corpus}
    check(packing.pack(docs).collect(), texts)
    check(packing.pack(docs, buffer=1).collect(), texts)


def test_little_padding(spark):
    rng = random.Random(4)
    texts = {i: " ".join("Words go on and on here." if rng.random() < 0.8 else "x1 " * 30 for _ in range(rng.randint(1, 300))) for i in range(120)}
    rows = packing.pack(spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1), buffer=1 << 15).collect()
    assert check(rows, texts) < 0.02 * sum(r.length for r in rows) + 2048


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 12), st.integers(0, 9)), min_size=1, max_size=9))
def test_cuts_are_best(steps):
    """Against all ways to cut."""
    at, penalty = [0, *itertools.accumulate(s for s, _ in steps)], [0, *(p for _, p in steps)]
    window, even = 12, (4, 8)

    def cost(path):
        total = 0
        for i, j in zip(path, path[1:]):
            n = at[j] - at[i]
            if n > window:
                return None
            total += min([window - n] + [packing.EVEN_PENALTY] * (n in even)) + penalty[j]
        return total

    inner = range(1, len(at) - 1)
    best = min(c for k in range(len(at)) for some in itertools.combinations(inner, k) if (c := cost([0, *some, len(at) - 1])) is not None)
    assert cost(packing.best_cuts(at, penalty, window, even)) == best


def test_long_word_and_document(spark):
    texts = {1: "x" * 30_000, 2: "word " * 20_000, 3: None}
    rows = packing.pack(spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1), buffer=4096).collect()
    assert check(rows, texts) <= 2 * 2048


def test_odd_rows(odd, empty):
    rows = packing.pack(odd).collect()
    assert sum(r.start == 0 for r in rows) == 6 and sum(r.doc_id is None for r in rows) >= 2
    assert packing.pack(empty).count() == 0
