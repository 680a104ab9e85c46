"""Substring deduplication over bytes with an enhanced suffix array.

Of each bucket of open pieces (see ``pieces``) the suffixes that begin a repeated window are sorted and get the common
prefix with their neighbour.  A stack scan over these lengths visits the intervals of the common-prefix tree: an interval of
length l holds all occurrences of one string of length l, not just neighbours.  Where the occurrences are preceded by
different bytes, the string is a maximal repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from .pieces import Open, Windows, repeated_stretches, rewrite, sorted_suffixes

LENGTH = 100
GRAM = 24
VARIOUS = -1


def intervals(lcp: list[int], left: list[int], least: int) -> Iterator[tuple[int, int, int, bool, bool]]:
    """(length, first, last, maximal, outermost) of the intervals of the common-prefix tree of at least ``least``.

    ``left``: the byte before each suffix (over 255: none).  Maximal: not all occurrences have the same byte before them.
    Outermost: the interval around it is shorter than ``least``; such intervals part the suffixes by their first ``least`` bytes.
    """
    stack: list[list[int]] = []  # length, first, byte before all (or VARIOUS)
    n = len(lcp)
    for i in range(1, n + 1):
        length = lcp[i] if i < n else 0
        begin, before = i - 1, left[i - 1] if left[i - 1] < 256 else VARIOUS
        while stack and stack[-1][0] > length:
            top, begin, seen = stack.pop()
            before = before if seen == before else VARIOUS
            yield top, begin, i - 1, before == VARIOUS, not stack and length < least
        if length >= least:
            if stack and stack[-1][0] == length:
                stack[-1][2] = before if stack[-1][2] == before else VARIOUS
            else:
                stack.append([length, begin, before])


def by_intervals(found: Open, windows: Windows) -> np.ndarray:
    """Which windows repeat an earlier one: in each outermost interval all but the first."""
    order, lcp = sorted_suffixes(found.raw, found.begin, found.stop)
    rank, repeated = found.rank(), np.zeros(len(order), bool)
    raw, p = np.frombuffer(found.raw, np.uint8), found.pieces
    left = np.where(found.offset > 0, raw[np.maximum(found.begin - 1, 0)] if len(raw) else 0, p["left"][found.piece])[order]
    place = rank[order]
    key = np.stack([p["doc"][found.piece], p["text"][found.piece].astype(np.int64), p["start"][found.piece] + found.offset])[:, order] if len(order) else None
    for _, a, b, _, outermost in intervals(lcp.tolist(), left.tolist(), windows.width):
        if outermost:
            first = a + int(place[a : b + 1].argmin())
            same = (key[:, a : b + 1] == key[:, first, None]).all(axis=0)
            repeated[order[a : b + 1]] = ~same
    return repeated


def maximal_repeats(text: bytes, least: int) -> list[tuple[int, list[int]]]:
    """(length, places) of the maximal repeats of one text: strings that cannot be longer on either side, all occurrences."""
    n = len(text)
    order, lcp = sorted_suffixes(text, np.arange(n), np.full(n, n))
    left = [text[i - 1] if i else 256 for i in order.tolist()]
    return sorted((length, sorted(order[a : b + 1].tolist())) for length, a, b, maximal, _ in intervals(lcp.tolist(), left, least) if maximal)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = LENGTH, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``).

    Removed is every byte in a ``length``-byte string that also starts earlier: in a row with a smaller id (null first; rows of
    one id in the order of a hash of their texts) or earlier in the same.  Rows repeated whole count as one document.  A null
    text is empty; other columns are ignored.
    """
    windows = Windows(length, min(gram, length), words=False, strict=False)
    rows, spans = repeated_stretches(docs, id_col, text_col, windows, by_intervals)
    return rewrite(rows, spans, windows, with_text).withColumnRenamed("n", "n_bytes")
