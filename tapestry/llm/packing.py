"""Order-preserving packing of token sequences by dynamic programming.

Documents stay in the order of the table.  Window cuts are chosen among document ends, sentence ends and, inside very long
sentences, fixed steps, so that padding plus penalties for cut documents is smallest:

    cost(j) = min over i within one window before j of  cost(i) + window - (t_j - t_i)  + penalty(j)

The minimum of cost(i) + t_i over the sliding range is kept in a monotone queue, so each cut is entered and left once.
Windows of 256, 512 or 1024 tokens need no padding and are tried as further transitions.  Each Spark partition is packed by
itself in buffers of bounded length; the open window at the end of a buffer moves on to the next.
"""

from __future__ import annotations

import base64
import json
import os
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import whole

WINDOW = 2048
END = 1  # the id after each document
SENTENCE_PENALTY, STEP_PENALTY = 12, 96  # in tokens of padding
STEP = 256
EVEN = (256, 512, 1024)  # lengths that are not padded
EVEN_PENALTY = 8
BUFFER = 1 << 19
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def added_tokens(json_path: str) -> dict[str, int]:
    """Tokens of a tokenizer file that are found in texts before the vocabulary is, and their ids."""
    with open(json_path, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"{json_path}: added tokens are matched literally only")
    return {t["content"]: t["id"] for t in added}


class ByteBPE:
    """Byte-level BPE of a rank file, with the added tokens of the JSON file beside it."""

    def __init__(self, ranks_path: str, pattern: str | None = None):
        import tiktoken
        from public_tokenizers import PATTERN

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=pattern or PATTERN, mergeable_ranks=ranks, special_tokens={})
        beside = os.path.splitext(ranks_path)[0] + ".json"
        self.added = added_tokens(beside) if os.path.exists(beside) else {}
        self.added_token = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.sentence_end = np.zeros(max([*ranks.values(), *self.added.values()]) + 1, bool)
        for token, rank in ranks.items():
            self.sentence_end[rank] = token.rstrip(b" ").endswith((b".", b"!", b"?", b"\n", "。".encode()))

    def encode(self, text: str) -> np.ndarray:
        if not (self.added_token and self.added_token.search(text)):
            return self._plain(text)
        parts, at = [], 0
        for found in self.added_token.finditer(text):
            parts += [self._plain(text[at : found.start()]), np.array([self.added[found.group()]], "<u4")]
            at = found.end()
        return np.concatenate([*parts, self._plain(text[at:])])

    def _plain(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(text), "<u4")


def best_cuts(at: list[int], penalty: list[int], window: int = WINDOW, even: tuple[int, ...] = EVEN) -> list[int]:
    """Indexes of the chosen cuts among the positions ``at`` (ascending, from 0; no gap above ``window``), first and last included."""
    t = np.asarray(at, np.int64)
    there = np.full(int(t[-1]) + 1, -1, np.int64)
    there[t] = np.arange(len(t))
    exact: dict[int, list[int]] = {}
    for length in even:
        if length < window:
            ends = np.flatnonzero(t >= length)
            begins = there[t[ends] - length]
            for j, i in zip(ends[begins >= 0].tolist(), begins[begins >= 0].tolist()):
                exact.setdefault(j, []).append(i)
    cost, back = [0] * len(at), [0] * len(at)
    queue = deque([(0, 0)])  # (cost + position, index), ascending
    for j in range(1, len(at)):
        while at[j] - at[queue[0][1]] > window:
            queue.popleft()
        best, i = queue[0][0] + window - at[j], queue[0][1]
        for x in exact.get(j, ()):
            if cost[x] + EVEN_PENALTY < best:
                best, i = cost[x] + EVEN_PENALTY, x
        cost[j], back[j] = best + penalty[j], i
        value = cost[j] + at[j]
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    path = [len(at) - 1]
    while path[-1]:
        path.append(back[path[-1]])
    return path[::-1]


class Packer:
    """Packs the documents of one partition; items are (doc_id, ids, start in the document, tokens of the document)."""

    def __init__(self, sentence_end: np.ndarray, partition: int, window: int = WINDOW, buffer: int = BUFFER):
        self.sentence_end, self.window, self.buffer = sentence_end, window, max(buffer, 2 * window)
        self.items: list[tuple] = []
        self.held, self.next_id = 0, partition << 32

    def add(self, doc_id, ids: np.ndarray) -> Iterator[pd.DataFrame]:
        ids = np.append(ids, END).astype("<u4")
        self.items.append((doc_id, ids, 0, len(ids)))
        self.held += len(ids)
        if self.held >= self.buffer:
            yield self.flush(False)

    def flush(self, last: bool) -> pd.DataFrame:
        ends, at, penalty, base = [], [0], [0], 0
        for _, ids, *_ in self.items:
            n = len(ids)
            inner = np.flatnonzero(self.sentence_end[ids[:-1]]) + 1
            stops = np.r_[0, inner, n]
            steps = [np.arange(a + STEP, b, STEP) for a, b in zip(stops[:-1], stops[1:]) if b - a > STEP]
            cuts = np.union1d(inner, np.concatenate(steps)) if steps else inner
            at += (cuts + base).tolist()
            penalty += np.where(np.isin(cuts, inner), SENTENCE_PENALTY, STEP_PENALTY).tolist() if steps else [SENTENCE_PENALTY] * len(cuts)
            base += n
            ends.append(base)
            at.append(base)
            penalty.append(0)
        windows = np.array([at[i] for i in best_cuts(at, penalty, self.window)])
        ends = np.array(ends)
        done = windows[-1] if last or len(windows) < 3 else windows[-2]
        cuts = np.union1d(windows[windows <= done], ends[ends <= done])
        starts = np.r_[0, cuts[cuts > 0][:-1]]
        stops = cuts[cuts > 0]
        doc = np.searchsorted(ends, starts, "right")
        window = np.searchsorted(windows, starts, "right") - 1
        rows = []
        for s, e, d, w in zip(starts.tolist(), stops.tolist(), doc.tolist(), window.tolist()):
            doc_id, ids, before, total = self.items[d]
            a = s - (int(ends[d]) - len(ids))
            rows.append((doc_id, before + a, e - s, zlib.crc32(ids[a : a + e - s].tobytes()), total, self.next_id + w, s - int(windows[w])))
        self.next_id += int(window[-1]) + 1
        left = []
        for d in range(int(np.searchsorted(ends, done, "right")), len(self.items)):
            doc_id, ids, before, total = self.items[d]
            cut = max(0, int(done) - (int(ends[d]) - len(ids)))
            left.append((doc_id, ids[cut:], before + cut, total))
        self.items, self.held = left, sum(len(x[1]) for x in left)
        frame = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        return frame


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, window: int = WINDOW, ranks_path: str | None = None, buffer: int = BUFFER) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Every input row is packed as a document of its own, null ids, null texts (empty: one token) and repeated rows included;
    other columns are ignored.  ``sequence_id`` is the number of the partition and of the sequence in it.
    """
    path = ranks_path or public_path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = ByteBPE(path)
        packer = Packer(bpe.sentence_end, TaskContext.get().partitionId(), window, buffer)
        for frame in batches:
            for doc_id, text in zip(frame["doc_id"].tolist(), frame["body"].tolist()):
                yield from packer.add(None if pd.isna(doc_id) else int(doc_id), bpe.encode(text))
        while packer.items:
            yield packer.flush(True)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("body")).mapInPandas(run, SCHEMA)
