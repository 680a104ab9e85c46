"""Rows of one id are told apart by the whole hash of their text."""

import random

import xxhash

from tapestry.llm import suffix_array, suffix_trees
from tests.llm.conftest import prose


def half(text):
    return xxhash.xxh64_intdigest(text.encode(), 42) >> 32


def alike():
    """Two texts without a common passage whose 64-bit hashes have equal upper halves."""
    rng = random.Random(8)
    one, other = prose(rng, 150), prose(rng, 150)
    seen = {half(f"{one} {i}"): i for i in range(1 << 17)}
    j = next(j for j in range(1 << 18) if half(f"{other} {j}") in seen)
    return f"{one} {seen[half(f'{other} {j}')]}", f"{other} {j}"


def test_equal_half_hashes(spark):
    one, other = alike()
    assert half(one) == half(other) and one != other
    d = spark.createDataFrame([(1, one), (5, one), (5, other), (None, "x")], "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in suffix_array.remove_repeats(d).collect())
    assert got == sorted([(0, 1, 0), (1, len(one), 0), (5, len(one), len(one)), (5, len(other), 0)])
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in suffix_trees.remove_repeats(d).collect())
    assert got == sorted([(0, 1, 0), (1, 151, 0), (5, 151, 151), (5, 151, 0)])
