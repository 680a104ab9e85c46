"""Substring deduplication over words with prefix-partitioned suffix trees.

Within a bucket of open pieces (see ``pieces``) the suffixes that begin a repeated window are split by their first words; a
prefix that still has too many suffixes gets one word more, so that every group fits in memory whatever its size.  Each
group becomes a subtree, built from its sorted suffixes along the right-most path.  An internal node at the depth of a
window or more is a repeat; the highest of these on a path hold the occurrences of one window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame

from .pieces import Hashed, Open, Windows, repeated_stretches, rewrite, sorted_suffixes

WORDS = 13
GRAM = 4
GROUP = 1 << 14


@dataclass
class Node:
    depth: int  # symbols from the root
    first: int  # leaves below, as a range of sorted suffixes
    last: int = -1
    children: list[Node] = field(default_factory=list)


def build(lcp: list[int]) -> Node:
    """Suffix tree of sorted suffixes, from the common prefix of each with the one before; leaves are not nodes of their own."""
    root = Node(0, 0)
    path = [root]
    for i in range(1, len(lcp)):
        depth, low = lcp[i], None
        while path[-1].depth > depth:
            low = path.pop()
            low.last = i - 1
            if path[-1].depth > depth:
                path[-1].children.append(low)
        if path[-1].depth < depth:  # a new node on the right-most path, above what was closed
            path.append(Node(depth, low.first if low else i - 1, children=[low] if low else []))
        elif low:
            path[-1].children.append(low)
    while path:
        low = path.pop()
        low.last = len(lcp) - 1
        if path:
            path[-1].children.append(low)
    return root


def deep(node: Node, depth: int) -> Iterator[Node]:
    """The highest nodes of at least ``depth``."""
    waiting = [node]
    while waiting:
        x = waiting.pop()
        if x.depth >= depth:
            yield x
        else:
            waiting += x.children


def prefix_groups(first: np.ndarray, room: np.ndarray, codes: np.ndarray, limit: int, most: int) -> Iterator[np.ndarray]:
    """Split suffixes (places in ``codes``) by prefixes, extended word by word up to ``most`` while a group exceeds ``limit``."""
    waiting = [(np.arange(len(first)), 0)]
    while waiting:
        rows, known = waiting.pop()
        if len(rows) <= limit or known >= most:
            yield rows
            continue
        word = codes[first[rows] + known]
        order = np.argsort(word, kind="stable")
        for part in np.split(rows[order], np.flatnonzero(np.diff(word[order])) + 1):
            waiting.append((part, known + 1))


def by_subtrees(found: Open, windows: Windows, limit: int = GROUP) -> np.ndarray:
    """Which windows also start in a document with a smaller id: below each deep node, all but the smallest id's."""
    repeated = np.zeros(len(found.begin), bool)
    if not len(found.begin):
        return repeated
    raw = np.frombuffer(found.raw, np.uint8)
    bounds = np.r_[0, np.flatnonzero(raw == 32) + 1]
    # Words as numbers: places among the sorted distinct word hashes, four bytes each, so that order and depth are of words.
    codes = np.empty(len(bounds) - 1, np.uint32)
    prints = np.concatenate([Hashed(raw[bounds[a] : bounds[b]]).of(bounds[a:b] - bounds[a], bounds[a + 1 : b + 1] - bounds[a]) for a in range(0, len(codes), 1 << 18) for b in [min(len(codes), a + (1 << 18))]])
    codes[:] = np.unique(prints, return_inverse=True)[1]
    text = codes.astype(">u4").tobytes()
    first, stop = np.searchsorted(bounds, found.begin), np.searchsorted(bounds, found.stop)
    doc = found.pieces["doc"][found.piece]
    for rows in prefix_groups(first, stop - first, codes, limit, windows.width):
        if len(rows) < 2:
            continue
        order, lcp = sorted_suffixes(text, 4 * first[rows], 4 * stop[rows])
        rows = rows[order]
        for node in deep(build((lcp // 4).tolist()), windows.width):
            below = rows[node.first : node.last + 1]
            repeated[below] = doc[below] > doc[below].min()
    return repeated


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words: int = WORDS, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, n_spans, kept_sha256`` (and ``kept``).

    Removed is every word in a window of ``words`` words that also starts in a row with a smaller id (null is smallest); rows of
    one id never remove from each other.  A null text has no words; other columns are ignored.
    """
    windows = Windows(words, min(gram, words), words=True, strict=True)
    rows, spans = repeated_stretches(docs, id_col, text_col, windows, by_subtrees)
    return rewrite(rows, spans, windows, with_text).withColumnRenamed("n", "n_words")
