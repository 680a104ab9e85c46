"""Where equal windows meet: cutting texts into pieces that depend on content only.

A window is ``width`` consecutive symbols (bytes or words) of one document.  Its anchor is the smallest hash among its
``gram``-symbol grams, so equal windows have equal anchors wherever they stand.  A run of windows with one anchor is a piece, and all
windows that could equal one of its windows lie in pieces of the same anchor.  Pieces are dealt out by anchor:

1. ``gather``: every task cuts its documents into pieces, settles equal pieces among its own documents and sends one of
   each to the bucket of its anchor (so a passage that a third of all documents share is one row per task).  The bucket
   finds the first of equal pieces; the others are repeated.  Anchors that are left with different pieces are open.
2. ``fetch``: the contents of the open pieces are cut out of their documents and sent to the buckets.
3. ``settle``: a bucket compares the windows of its open pieces.  How is the operator's method.
4. ``mark``: repeated stretches go home to their documents, which are rewritten there.

Rows carry packed columns, so that millions of pieces cross a shuffle as a few thousand rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import FIRST, partitions, store, whole

SLICE = 1 << 19  # symbols hashed together
HELD = 1 << 20  # pieces that a task settles together
LONGEST = 256  # windows of a piece
SETTLED = 1 << 20  # bytes of open pieces whose windows are compared together, one anchor at least
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
BYTES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

PIECE = {"anchor": "u8", "print": "u8", "doc": "i8", "text": "i8", "home": "u4", "start": "u4", "count": "u2", "inner": "u1"}
SPAN = {"doc": "i8", "text": "i8", "start": "u4", "count": "u4"}
OPEN = {"doc": "i8", "text": "i8", "bucket": "u4", "part": "u2", "start": "u4", "count": "u2"}
HELD_PIECE = {"doc": "i8", "text": "i8", "home": "u4", "part": "u2", "start": "u4", "count": "u2", "size": "u4", "left": "u2"}


def pack(columns: dict[str, np.ndarray], kinds: dict[str, str]) -> bytes:
    """Columns as bytes: the n-th bytes of all values of a column together, compressed."""
    n = len(next(iter(columns.values())))
    parts = [np.uint64(n).tobytes()]
    for name, kind in kinds.items():
        a = np.ascontiguousarray(columns[name], dtype="<" + kind)
        parts.append(a.view(np.uint8).reshape(n, a.dtype.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(blob: bytes, kinds: dict[str, str]) -> dict[str, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = int(np.frombuffer(raw[:8], "<u8")[0]), 8, {}
    for name, kind in kinds.items():
        size = np.dtype(kind).itemsize
        out[name] = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T.copy().view("<" + kind).reshape(n)
        at += n * size
    return out


def joined(blobs: list[bytes], kinds: dict[str, str]) -> dict[str, np.ndarray]:
    parts = [unpack(b, kinds) for b in blobs]
    return {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, v) for k, v in kinds.items()}


def packed_by(key: np.ndarray, columns: dict[str, np.ndarray], kinds: dict[str, str]) -> Iterator[tuple[int, bytes]]:
    """(key, blob) for each value of ``key``."""
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    cuts = np.flatnonzero(np.r_[True, sorted_key[1:] != sorted_key[:-1]]) if len(order) else []
    for a, b in zip(cuts, np.r_[cuts[1:], len(order)] if len(order) else []):
        yield int(sorted_key[a]), pack({k: columns[k][order[a:b]] for k in kinds}, kinds)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads the bits of a polynomial hash."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    one = np.ones(1, np.uint64)
    return np.cumprod(np.r_[one, np.full(n, BASE)]), np.cumprod(np.r_[one, np.full(n, BASE_INVERSE)])


class Hashed:
    """64-bit hashes of any stretch of some bytes, from prefix sums of a polynomial modulo 2^64."""

    def __init__(self, raw: np.ndarray):
        size = 1 << max(16, int(len(raw)).bit_length())
        power, self.inverse = _powers(size)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(BYTES[raw] * power[: len(raw)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.inverse[begin] + (end - begin).astype(np.uint64))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values (blocks with minima from both ends)."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


@dataclass(frozen=True)
class Windows:
    """What a window is: its ``width`` and the ``gram`` of its anchor in symbols, and whether symbols are words."""

    width: int
    gram: int
    words: bool
    strict: bool  # repeated only if it stands in a document with a smaller id, not if earlier in the same one

    def symbols(self, text: str) -> tuple[bytes, np.ndarray]:
        """Bytes of the symbols in a row (each word followed by a space) and the boundaries between them."""
        raw = text.encode("utf-8", "surrogatepass")
        if not self.words:
            return raw, np.arange(len(raw) + 1)
        found = raw.split()
        return b"".join([w + b" " for w in found]), np.concatenate([[0], np.cumsum([len(w) + 1 for w in found], dtype=np.int64)]) if found else np.zeros(1, np.int64)

    def pieces(self, raw: np.ndarray, bounds: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """(anchor, print, first window, windows, inner) of the pieces in ``raw``; ``ends``: where each symbol's document ends.

        ``inner``: the piece has its anchor's gram twice, so its own windows may be equal.
        """
        n, nothing = len(bounds) - 1, tuple(np.zeros(0, k) for k in ("u8", "u8", "i8", "i8", "u1"))
        if n < self.width:
            return nothing
        hashed = Hashed(raw)
        grams = hashed.of(bounds[: n - self.gram + 1], bounds[self.gram :])
        anchor = sliding_min(grams, self.width - self.gram + 1)
        at = np.flatnonzero(ends[: len(anchor)] - np.arange(len(anchor)) >= self.width)
        if not len(at):
            return nothing
        a = anchor[at]
        new = np.r_[True, (a[1:] != a[:-1]) | (at[1:] != at[:-1] + 1) | (ends[at[1:]] != ends[at[:-1]])]
        run = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        new |= (np.arange(len(at)) - run) % LONGEST == 0
        first = np.flatnonzero(new)
        count = np.diff(np.r_[first, len(at)])
        begin = at[first]
        inner = np.zeros(len(first), np.uint8) if self.strict else self._inner(grams, anchor, a[first], begin, count)
        return a[first], hashed.of(bounds[begin], bounds[begin + count - 1 + self.width]), begin, count, inner

    def _inner(self, grams: np.ndarray, anchor: np.ndarray, own: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Pieces in which the anchor's gram stands twice: no other smallest gram can stand between the two places."""
        width = self.width - self.gram + 1
        most = np.full(len(grams) + width - 1, np.uint64(0))
        most[width - 1 : width - 1 + len(anchor)] = anchor
        highest = ~sliding_min(~most, width)  # of the anchors of the windows that have the gram
        spots = np.flatnonzero(grams == highest)
        twice = np.flatnonzero(grams[spots[1:]] == grams[spots[:-1]])
        low, high, out = spots[twice], spots[twice + 1], np.zeros(len(begin), np.uint8)
        near = np.searchsorted(begin, low, "right") - 1
        for step in (-1, 0, 1):  # the pieces around the place; marking one too many does no harm
            k = np.clip(near + step, 0, len(begin) - 1)
            out[k[(own[k] == grams[low]) & (high <= begin[k] + count[k] + width)]] = 1
        return out


def _order(columns: dict[str, np.ndarray], *keys: str) -> np.ndarray:
    return np.lexsort([columns[k] for k in reversed(keys)])


def _first_of(columns: dict[str, np.ndarray], *keys: str) -> np.ndarray:
    new = np.zeros(len(columns[keys[0]]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= columns[k][1:] != columns[k][:-1]
    return new


def _settled(p: dict[str, np.ndarray], windows: Windows) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Sorted pieces, which of them stand for equal ones, and which are repeated."""
    order = _order(p, "anchor", "print", "count", "doc", "text", "start")
    p = {k: v[order] for k, v in p.items()}
    first = _first_of(p, "anchor", "print", "count")
    if not windows.strict:
        head = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
        same = (p["doc"] == p["doc"][head]) & (p["text"] == p["text"][head]) & (p["start"] == p["start"][head])
        return p, first, ~first & ~same  # a row repeated whole is the same document
    head = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
    return p, p["doc"] == p["doc"][head], p["doc"] > p["doc"][head]


def gather(rows: DataFrame, windows: Windows, buckets: int) -> DataFrame:
    """(home, kind, blob): repeated stretches (kind 0) and open pieces (kind 1) of the documents at home in ``home``."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: list[tuple[np.ndarray, ...]] = []
        held = 0

        def send() -> pd.DataFrame:
            p = {k: np.concatenate([f[i] for f in found]).astype(v) for i, (k, v) in enumerate(PIECE.items())}
            p, stays, repeated = _settled(p, windows)
            keep = {k: v[stays] for k, v in p.items()}
            out = [(b, 0, blob) for b, blob in packed_by((keep["anchor"] % np.uint64(buckets)).astype(np.int64), keep, PIECE)]
            spans = {k: v[repeated] for k, v in p.items()}
            out += [(b, 1, blob) for b, blob in packed_by(spans["home"].astype(np.int64), spans, SPAN)]
            return pd.DataFrame(out, columns=["bucket", "kind", "blob"])

        def pieces(group: list[tuple]) -> tuple[np.ndarray, ...]:
            """Of slices (doc, text, home, first symbol, bytes, bounds)."""
            raw = np.frombuffer(b"".join(g[4] for g in group), np.uint8)
            sizes = np.array([len(g[5]) - 1 for g in group])
            at = np.cumsum([0] + [len(g[4]) for g in group])
            bounds = np.concatenate([g[5][:-1] + a for g, a in zip(group, at)] + [at[-1:]])
            stops = np.cumsum(sizes)
            anchor, mark, begin, count, inner = windows.pieces(raw, bounds, np.repeat(stops, sizes))
            which = np.searchsorted(stops, begin, "right")
            of = lambda k, kind: np.array([g[k] for g in group], kind)[which]
            return anchor, mark, of(0, "i8"), of(1, "i8"), of(2, "u4"), begin - (stops - sizes)[which] + of(3, "i8"), count, inner

        group, size = [], 0
        for frame in batches:
            for doc, text, home, body in zip(frame["doc"].tolist(), frame["text"].tolist(), frame["home"].tolist(), frame["body"].tolist()):
                raw, bounds = windows.symbols(body)
                n = len(bounds) - 1
                for a in range(0, max(n - windows.width + 1, 0), SLICE):
                    b = min(n, a + SLICE + windows.width - 1)
                    group.append((doc, text, home, a, raw[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]))
                    size += int(bounds[b] - bounds[a])
                    if size >= SLICE:
                        found.append(pieces(group))
                        held += len(found[-1][0])
                        group, size = [], 0
                    if held >= HELD:
                        yield send()
                        found, held = [], 0
        if group:
            found.append(pieces(group))
        if found:
            yield send()

    def meet(bucket: int, blobs: list[tuple[int, bytes]]) -> Iterator[tuple[int, int, bytes]]:
        """Pieces (kind 0) meet; spans (kind 1) were sent to the bucket of their home and pass."""
        yield from ((bucket, 0, blob) for kind, blob in blobs if kind)
        p = joined([blob for kind, blob in blobs if not kind], PIECE)
        p, stays, repeated = _settled(p, windows)
        spans = {k: v[repeated] for k, v in p.items()}
        yield from ((home, 0, blob) for home, blob in packed_by(spans["home"].astype(np.int64), spans, SPAN))
        kinds = _first_of(p, "anchor", "print", "count")
        anchors = np.cumsum(_first_of(p, "anchor")) - 1
        some = np.bincount(anchors, kinds, anchors[-1] + 1 if len(anchors) else 0) > 1
        some |= np.bincount(anchors, p["inner"], len(some)) > 0
        unsure = {k: v[stays & some[anchors]] for k, v in p.items()}
        unsure |= {"bucket": np.full(len(unsure["doc"]), bucket), "part": mixed(unsure["anchor"]) >> np.uint64(48)}
        yield from ((home, 1, blob) for home, blob in packed_by(unsure["home"].astype(np.int64), unsure, OPEN))

    sent = rows.mapInPandas(cut, "bucket int, kind int, blob binary")
    return _grouped(sent, "bucket", buckets, lambda b, blobs: ((h, k, x) for h, k, x in meet(b, blobs)), "home int, kind int, blob binary")


def _grouped(sent: DataFrame, key: str, parts: int, work: Callable, schema: str) -> DataFrame:
    """Give ``work`` each value of ``key`` with its (kind, blob) rows."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, []
        for frame in batches:
            for k, kind, blob in zip(frame[key].tolist(), frame["kind"].tolist(), frame["blob"].tolist()):
                if k != at and held:
                    yield pd.DataFrame(list(work(at, held)), columns=names)
                    held = []
                at = k
                held.append((kind, blob))
        if held:
            yield pd.DataFrame(list(work(at, held)), columns=names)

    return sent.repartition(parts, key).sortWithinPartitions(key, "kind").mapInPandas(run, schema)


def _at_home(rows: DataFrame, blobs: DataFrame, parts: int, work: Callable, schema: str) -> DataFrame:
    """Give ``work`` an iterator over (home, blobs of the home, its documents one frame at a time)."""
    whole_ids = [F.lit(0).cast("long").alias(c) for c in ("doc", "text")]  # without nulls pandas keeps all 64 bits
    both = blobs.select("home", F.lit(0).alias("turn"), "blob", *whole_ids).unionByName(rows.withColumn("turn", F.lit(1)), allowMissingColumns=True)

    def frames(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, list[bytes], pd.DataFrame]]:
        at, held = None, []
        for frame in batches:
            for home, part in frame.groupby("home", sort=False):
                if home != at:
                    at, held = home, []
                held += [bytes(b) for b in part.loc[part["turn"] == 0, "blob"]]
                docs = part[part["turn"] == 1]
                if len(docs):
                    yield int(home), held, docs

    return both.repartition(parts, "home").sortWithinPartitions("home", "turn").mapInPandas(lambda batches: work(frames(batches)), schema)


class ByDoc:
    """Rows of packed columns by document."""

    def __init__(self, columns: dict[str, np.ndarray]):
        order = _order(columns, "doc", "text", "start")
        self.columns = {k: v[order] for k, v in columns.items()}
        cuts = np.flatnonzero(_first_of(self.columns, "doc", "text")) if len(order) else np.zeros(0, np.int64)
        keys = zip(self.columns["doc"][cuts].tolist(), self.columns["text"][cuts].tolist())
        self.at = dict(zip(keys, zip(cuts.tolist(), np.r_[cuts[1:], len(order)].tolist())))

    def of(self, doc: int, text: int) -> dict[str, np.ndarray] | None:
        span = self.at.get((doc, text))
        return {k: v[span[0] : span[1]] for k, v in self.columns.items()} if span else None


def fetch(rows: DataFrame, unsure: DataFrame, windows: Windows, buckets: int) -> DataFrame:
    """(bucket, kind, blob): the open pieces with their contents and the symbol before them."""

    def work(homes) -> Iterator[pd.DataFrame]:
        at, known, out, size = None, None, [], 0

        def send() -> pd.DataFrame:
            sent = []
            by_bucket: dict[int, list[tuple]] = {}
            for x in out:
                by_bucket.setdefault(x[0], []).append(x)
            for b, xs in by_bucket.items():
                columns = {k: np.array([x[i + 1] for x in xs], v) for i, (k, v) in enumerate(HELD_PIECE.items())}
                head = pack(columns, HELD_PIECE)
                body = zstandard.ZstdCompressor(level=1).compress(b"".join(x[-1] for x in xs))
                sent.append((b, 0, len(head).to_bytes(8, "little") + head + body))
            return pd.DataFrame(sent, columns=["bucket", "kind", "blob"])

        for home, blobs, docs in homes:
            if home != at:
                at, known = home, ByDoc(joined(blobs, OPEN))
            for doc, text, body in zip(docs["doc"].tolist(), docs["text"].tolist(), docs["body"].tolist()):
                mine = known.of(int(doc), int(text))
                if mine is None:
                    continue
                raw, bounds = windows.symbols(body)
                for b, part, s, c in dict.fromkeys(zip(*(mine[k].tolist() for k in ("bucket", "part", "start", "count")))):
                    x, y = int(bounds[s]), int(bounds[s + c - 1 + windows.width])
                    left = 256 if s == 0 else raw[x - 1] if not windows.words else 0
                    out.append((b, doc, text, home, part, s, c, y - x, left, raw[x:y]))
                    size += y - x
                if size >= 1 << 24:
                    yield send()
                    out, size = [], 0
        if out:
            yield send()

    return _at_home(rows, unsure, partitions(rows.sparkSession), work, "bucket int, kind int, blob binary")


def contents(blobs: list[bytes]) -> tuple[dict[str, np.ndarray], bytes]:
    """Columns and bytes of fetched pieces, each piece once."""
    heads, bodies = [], []
    for blob in blobs:
        n = int.from_bytes(blob[:8], "little")
        heads.append(blob[8 : 8 + n])
        bodies.append(zstandard.ZstdDecompressor().decompress(blob[8 + n :]))
    p = joined(heads, HELD_PIECE)
    return p, b"".join(bodies)


@dataclass
class Open:
    """Windows of the open pieces of a bucket that stand there more than once, by hash; contents decide."""

    pieces: dict[str, np.ndarray]
    raw: bytes
    piece: np.ndarray  # of each window
    offset: np.ndarray  # of the window in its piece, in symbols
    begin: np.ndarray  # of the window in raw
    stop: np.ndarray  # of the window's piece in raw

    def rank(self) -> np.ndarray:
        """Order in which documents and places count as earlier."""
        p, w = self.pieces, self.piece
        order = np.lexsort([p["start"][w] + self.offset, p["text"][w], p["doc"][w]])
        out = np.empty(len(order), np.int64)
        out[order] = np.arange(len(order))
        return out


def open_windows(blobs: list[bytes], windows: Windows) -> Iterator[Open]:
    """The open windows of a bucket, some anchors at a time, so that memory does not grow with the bucket's windows."""
    p, raw = contents(blobs)
    order = np.argsort(p["part"], kind="stable")
    size = p["size"].astype(np.int64)
    begin = (np.cumsum(size) - size)[order]
    p = {k: v[order] for k, v in p.items()}
    cuts = np.flatnonzero(_first_of(p, "part")) if len(order) else np.zeros(0, np.int64)
    before = np.cumsum(size[order]) - size[order]
    a = 0
    for b in [*cuts[1:].tolist(), len(order)]:
        if b > a and (b == len(order) or before[b] - before[a] >= SETTLED):
            some = b"".join([raw[x : x + n] for x, n in zip(begin[a:b].tolist(), p["size"][a:b].tolist())])
            yield _open_windows({k: v[a:b] for k, v in p.items()}, some, windows)
            a = b


def _open_windows(p: dict[str, np.ndarray], raw: bytes, windows: Windows) -> Open:
    count = p["count"].astype(np.int64)
    at = np.cumsum(p["size"].astype(np.int64)) - p["size"]
    array = np.frombuffer(raw, np.uint8)
    if windows.words:
        bounds = np.r_[0, np.flatnonzero(array == 32) + 1]
        first = np.searchsorted(bounds, at)
    else:
        bounds, first = np.arange(len(array) + 1), at
    piece = np.repeat(np.arange(len(count)), count)
    offset = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
    symbol = first[piece] + offset
    begin = bounds[symbol]
    # Hashes of slices of pieces, so that powers stay short.
    prints = np.empty(len(piece), np.uint64)
    for a in range(0, len(count), 1 << 13):
        b = min(len(count), a + (1 << 13))
        lo, hi = int(at[a]), int(at[b - 1] + p["size"][b - 1])
        some = slice(*np.searchsorted(piece, [a, b]))
        prints[some] = Hashed(array[lo:hi]).of(begin[some] - lo, bounds[symbol[some] + windows.width] - lo)
    _, inverse, times = np.unique(prints, return_inverse=True, return_counts=True)
    often = times[inverse] > 1
    stop = at + p["size"]
    return Open(p, raw, piece[often], offset[often], begin[often], stop[piece[often]])


def spans_of(found: Open, repeated: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(home, blob) of the repeated windows, neighbours joined."""
    piece, offset = found.piece[repeated], found.offset[repeated]
    order = np.lexsort([offset, piece])
    piece, offset = piece[order], offset[order]
    if not len(piece):
        return
    new = np.r_[True, (piece[1:] != piece[:-1]) | (offset[1:] != offset[:-1] + 1)]
    first = np.flatnonzero(new)
    p = {k: v[piece[first]] for k, v in found.pieces.items()}
    spans = {"doc": p["doc"], "text": p["text"], "start": p["start"] + offset[first], "count": np.diff(np.r_[first, len(piece)])}
    yield from packed_by(p["home"].astype(np.int64), spans, SPAN)


def sorted_suffixes(raw: bytes, begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes ``raw[begin:stop]`` and the common prefix, in bytes, of each with the one before (0 for the first)."""
    keys = [raw[a:b] for a, b in zip(begin.tolist(), stop.tolist())]
    order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
    array, lcp = np.frombuffer(raw, np.uint8), np.zeros(len(order), np.int64)
    size = np.minimum((stop - begin)[order[1:]], (stop - begin)[order[:-1]])
    a, b = begin[order[1:]], begin[order[:-1]]
    live, done = np.arange(len(size)), 0
    while len(live):  # 32 bytes at a time, of the pairs that agree so far
        step = np.arange(done, done + 32)
        inside = step[None, :] < size[live, None]
        x, y = np.where(inside, a[live, None] + step, 0), np.where(inside, b[live, None] + step, 0)
        differ = ~inside | (array[x] != array[y])
        hit = differ.any(axis=1)
        lcp[1 + live[hit]] = done + differ[hit].argmax(axis=1)
        live, done = live[~hit], done + 32
    return order, lcp


def repeated_stretches(docs: DataFrame, id_col: str, text_col: str, windows: Windows, method: Callable[[Open, Windows], np.ndarray]) -> tuple[DataFrame, DataFrame]:
    """Documents (doc, text, home, body) and, as (home, blob), the windows in them that are repeated.

    ``method`` says which windows of a bucket's open pieces are repeated.  Rows of one id are told apart by a hash of their
    text; rows repeated whole are the same document.
    """
    spark = docs.sparkSession
    buckets = partitions(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("body")).select(
        F.coalesce("doc_id", F.lit(FIRST)).alias("doc"), F.xxhash64("body").alias("text"),
        F.pmod(F.xxhash64("doc_id", "body"), F.lit(buckets)).cast("int").alias("home"), "body",  # rows of one id spread out
    )
    gathered = store(gather(rows, windows, buckets), "pieces")

    def settle(bucket: int, blobs: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        for found in open_windows([b for _, b in blobs], windows):
            yield from spans_of(found, method(found, windows))

    fetched = fetch(rows, gathered.filter("kind = 1"), windows, buckets)
    settled = store(_grouped(fetched, "bucket", buckets, settle, "home int, blob binary"), "repeats")
    return rows, gathered.filter("kind = 0").select("home", "blob").unionByName(settled)


def rewrite(rows: DataFrame, spans: DataFrame, windows: Windows, with_text: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n, n_removed, n_spans, kept_sha256`` after every repeated window is taken out."""
    schema = "doc_id long, n long, n_removed long, n_spans long, kept_sha256 string" + (", kept string" if with_text else "")

    def work(homes) -> Iterator[pd.DataFrame]:
        at, known = None, None
        for home, blobs, docs in homes:
            if home != at:
                at, known = home, ByDoc(joined(blobs, SPAN))
            out = []
            for doc, text, body in zip(docs["doc"].tolist(), docs["text"].tolist(), docs["body"].tolist()):
                raw, bounds = windows.symbols(body)
                mine, n = known.of(int(doc), int(text)), len(bounds) - 1
                if mine is None:
                    kept, removed, runs = raw, 0, 0
                else:
                    edge = np.zeros(n + 1, np.int64)
                    begin = mine["start"].astype(np.int64)
                    np.add.at(edge, begin, 1)
                    np.add.at(edge, begin + mine["count"] - 1 + windows.width, -1)
                    out_of = np.cumsum(edge[:-1]) > 0
                    removed, change = int(out_of.sum()), np.flatnonzero(np.diff(np.r_[False, out_of, False]))
                    runs = len(change) // 2
                    stay = np.r_[0, change, n]
                    kept = b"".join([raw[bounds[a] : bounds[b]] for a, b in zip(stay[::2].tolist(), stay[1::2].tolist())])
                if windows.words:
                    kept = kept[:-1]
                row = (None if doc == FIRST else int(doc), n, removed, runs, hashlib.sha256(kept).hexdigest())
                out.append(row + ((kept.decode("utf-8", "replace"),) if with_text else ()))
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return _at_home(rows, spans, partitions(rows.sparkSession), work, schema)
