"""Prefix scans inside the sorted partitions of a range shuffle, on Arrow batches.

A task sees its rows in order and knows nothing of the ranges before it, so every value is that of the group's rows in this
range.  The last row of a range holds all that the next range has to know of its last group (``AT_END`` marks it).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

AT_END, AT_START = "__at_end", "__at_start"


class Rows:
    """A batch as numbered groups; ``open`` rows at the top continue the last group of the batch before."""

    def __init__(self, batch: pa.RecordBatch, by: Sequence[str], before: tuple | None):
        self.batch, self.n = batch, len(batch)
        self.start = np.zeros(self.n, bool)
        for c in by:
            codes = pc.dictionary_encode(batch.column(c), null_encoding="encode").indices.to_numpy()
            self.start[1:] |= codes[1:] != codes[:-1]
        self.start[0] = self.key(by, 0) != before
        self.group = np.cumsum(self.start)
        self.first = np.maximum.accumulate(np.where(self.start, np.arange(self.n), 0))
        self.open = int(self.start.argmax()) if self.start.any() else self.n

    def key(self, by: Sequence[str], row: int) -> tuple:
        return tuple(self.batch.column(c)[row].as_py() for c in by)

    def values(self, name: str) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of a column, 0 where null, and where it is not null."""
        column = self.batch.column(name)
        return pc.fill_null(column, 0).to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)

    def total(self, x: np.ndarray) -> np.ndarray:
        return np.cumsum(x) if self.group[0] == self.group[-1] else pd.Series(x).groupby(self.group).cumsum().to_numpy()

    def highest(self, x: np.ndarray) -> np.ndarray:
        """Running maximum; as in Spark nothing is larger than NaN."""
        if self.group[0] == self.group[-1]:
            return np.maximum.accumulate(x)
        nan = np.isnan(x)
        high = pd.Series(np.where(nan, np.inf, x) if nan.any() else x).groupby(self.group).cummax().to_numpy()
        return np.where(self.highest(nan.astype(np.int8)) > 0, np.nan, high) if nan.any() else high

    def any(self, flags: np.ndarray) -> np.ndarray:
        """Has a row of the group been flagged so far?"""
        return np.maximum.accumulate(np.where(flags, np.arange(self.n), -1)) >= self.first


Scan = Callable[[Rows, dict], dict[str, pa.Array]]


def _number(values: np.ndarray, known: np.ndarray) -> pa.Array:
    return pa.array(values, mask=~known)


def running_sum(name: str, source: str, peak: str | None = None) -> Scan:
    """Sum so far, null before the first value; ``peak``: also the highest sum so far."""

    def scan(rows: Rows, state: dict) -> dict[str, pa.Array]:
        x, valid = rows.values(source)
        out, seen = rows.total(x), rows.any(valid)
        before, was = state.get(name, (0, False))
        if rows.open:
            out[: rows.open] += before
            seen[: rows.open] |= was
        state[name] = (out[-1], seen[-1])
        result = {name: _number(out, seen)}
        if peak:
            result[peak] = _high(rows, state, peak, out, seen)
        return result

    return scan


def _high(rows: Rows, state: dict, name: str, x: np.ndarray, valid: np.ndarray) -> pa.Array:
    lowest = np.iinfo(x.dtype).min if x.dtype.kind == "i" else -np.inf
    out, seen = rows.highest(np.where(valid, x, lowest)), rows.any(valid)
    if rows.open and name in state and state[name][1]:
        out[: rows.open] = np.maximum(out[: rows.open], state[name][0])
        seen[: rows.open] = True
    state[name] = (out[-1], seen[-1])
    return _number(out, seen)


def running_max(name: str, source: str, reached: str | None = None) -> Scan:
    """Maximum so far; ``reached``: also how many rows have been at the maximum when they came."""

    def scan(rows: Rows, state: dict) -> dict[str, pa.Array]:
        x, valid = rows.values(source)
        high = _high(rows, state, name, x, valid)
        result = {name: high}
        if reached:
            at_top = valid & (x == pc.fill_null(high, 0).to_numpy(zero_copy_only=False))
            count = rows.total(at_top.astype(np.int64))
            count[: rows.open] += state.get(reached, 0)
            state[reached] = count[-1]
            result[reached] = pa.array(count)
        return result

    return scan


def running_last(name: str, source: str) -> Scan:
    """Last value that is not null, of any type."""

    def scan(rows: Rows, state: dict) -> dict[str, pa.Array]:
        column = rows.batch.column(source)
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        at = np.maximum.accumulate(np.where(valid, np.arange(rows.n), -1))
        known = at >= rows.first
        before = state.get(name)
        at, known = at + 1, known.copy()
        if rows.open and before is not None:
            late = np.arange(rows.n) < rows.open
            at = np.where(late & ~known, 0, at)
            known |= late
        out = pa.concat_arrays([column.slice(0, 1) if before is None else before, column]).take(pa.array(at, mask=~known))
        state[name] = out.slice(rows.n - 1, 1) if known[-1] else None
        return {name: out}

    return scan


def previous(name: str, source: str) -> Scan:
    """Value of the row before, null on the first row."""

    def scan(rows: Rows, state: dict) -> dict[str, pa.Array]:
        column = rows.batch.column(source)
        before = state.get(name)
        at, known = np.arange(rows.n), ~rows.start
        out = pa.concat_arrays([column.slice(0, 1) if before is None else before, column]).take(pa.array(at, mask=~known))
        state[name] = column.slice(rows.n - 1, 1)
        return {name: out}

    return scan


def scanner(by: Sequence[str], scans: Sequence[Scan], columns: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function for ``mapInArrow`` over sorted partitions: the named ``columns``, among them what the scans add."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, waiting = None, {}, None
        for batch in batches:
            if not len(batch):
                continue
            rows = Rows(batch, by, key)
            if rows.start[0]:
                state = {}
            found: Mapping[str, pa.Array] = {}
            kept = state
            for scan in scans:
                found = found | scan(rows, kept)
            key = rows.key(by, rows.n - 1)
            if waiting is not None:
                yield finish(*waiting, False)
            waiting = (rows, found)
        if waiting is not None:
            yield finish(*waiting, True)

    def finish(rows: Rows, found: Mapping[str, pa.Array], last: bool) -> pa.RecordBatch:
        end = np.zeros(rows.n, bool)
        end[-1] = last
        flags = {AT_START: pa.array(rows.start), AT_END: pa.array(end)}
        pick = lambda c: found[c] if c in found else flags[c] if c in flags else rows.batch.column(c)
        return pa.RecordBatch.from_arrays([pick(c) for c in columns], list(columns))

    return run
