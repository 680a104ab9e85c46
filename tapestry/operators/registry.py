"""Indicator definitions: one object per indicator, callable on its own or many in one pass.

An indicator is written as a generator over a timeline.  It yields what must be computed next: a dict of plain
or windowed columns, :class:`Sums` (running totals) or :class:`Means` (exponential means).  Indicators of one pass
advance together, so that their windows land in the same window operators.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from ..functions.checks import ParameterError, need_columns, need_rows
from ..functions.ewm import Mean, ewm, shareable, sub_length, with_sub_blocks
from ..functions.history import Timeline, names, over_history, plan_split
from ..session import settle

REGISTRY: dict[str, "Indicator"] = {}
CUSTOM: dict[str, Callable[..., DataFrame]] = {}
CUSTOM_GROUPS: dict[str, str] = {}


@dataclass(frozen=True)
class Sums:
    """Running totals over the whole history."""

    columns: dict[str, Column]


@dataclass(frozen=True)
class Means:
    """Exponential means; ``first`` if their inputs do not themselves depend on exponential means."""

    columns: dict[str, Mean]
    first: bool = True


Step = dict | Sums | Means


@dataclass(frozen=True)
class Indicator:
    """``steps(t, x, **params)`` yields steps; ``x(name)`` gives a private column name, dropped at the end.

    ``needs``: input columns; ``lookback``: rows before a row that can change it; ``alphas``: decay factors
    of its exponential means (empty for the others).
    """

    name: str
    group: str
    steps: Callable[..., Iterator[Step]]
    defaults: dict
    needs: Callable[..., list[str]]
    lookback: Callable[..., int]
    alphas: Callable[..., list[float]]
    check: Callable[..., None]
    min_rows: Callable[..., int]
    doc: str = field(default="", compare=False)

    def resolve(self, df: DataFrame, params: dict) -> dict:
        unknown = set(params) - set(self.defaults)
        if unknown:
            raise ParameterError(f"{self.name}: unknown parameter(s) {sorted(unknown)}")
        p = {**self.defaults, **params}
        self.check(**p)
        need_columns(df, *self.needs(**p))
        return p

    def __call__(self, df: DataFrame, *, by, order, chunk="auto", strict: bool = False, **params) -> DataFrame:
        return _apply(df, [(self, self.resolve(df, params))], by, order, chunk, strict)


def register(
    name: str, group: str, defaults: dict | None = None, *, needs=("close",), lookback=None, alphas=None, check=None, min_rows=None
):
    """Decorator turning a step generator into a registered, callable :class:`Indicator`."""

    def wrap(steps) -> Indicator:
        ind = Indicator(
            name,
            group,
            steps,
            dict(defaults or {}),
            needs if callable(needs) else (lambda **_: list(needs)),
            lookback or (lambda **_: 0),
            alphas or (lambda **_: []),
            check or (lambda **_: None),
            min_rows or (lambda **_: 1),
            steps.__doc__ or "",
        )
        REGISTRY[name] = ind
        return ind

    return wrap


def available(group: str | None = None) -> list[str]:
    """Names of the registered indicators, optionally of one group."""
    return [n for n, i in REGISTRY.items() if group in (None, i.group)] + [n for n, g in CUSTOM_GROUPS.items() if group in (None, g)]


def register_custom(name: str, fn: Callable[..., DataFrame], group: str = "custom") -> None:
    """Make ``fn(df, *, by, order, **params) -> DataFrame`` usable by name in :func:`with_indicators`."""
    CUSTOM[name] = fn
    CUSTOM_GROUPS[name] = group


def with_indicators(df: DataFrame, specs: Iterable, *, by, order, chunk="auto", strict: bool = False) -> DataFrame:
    """Apply many indicators, given as names or ``(name, params)``, in one pass over one exchange and sort.

    One may read a column that another makes: those whose inputs are there run together, then those that wait for them.
    The history is measured once, for all.  Custom indicators run afterwards, in the order given.
    """
    waiting, custom = [], []
    for spec in specs:
        name, params = (spec, {}) if isinstance(spec, str) else spec
        if name in CUSTOM:
            custom.append((name, params))
        elif name in REGISTRY:
            waiting.append((REGISTRY[name], params))
        else:
            raise ParameterError(f"unknown indicator {name!r}; have {available()}")
    chunk = plan_split(df, by, order, chunk) if waiting else chunk
    while waiting:
        ready = [(i, p) for i, p in waiting if set(i.needs(**{**i.defaults, **p})) <= set(df.columns)] or waiting
        waiting = [s for s in waiting if s not in ready]
        df = _apply(df, [(i, i.resolve(df, p)) for i, p in ready], by, order, chunk, strict)
    for name, params in custom:
        df = CUSTOM[name](df, by=by, order=order, **params)
    return df


def _apply(df: DataFrame, plan, by, order, chunk, strict) -> DataFrame:
    by, order = names(by), names(order)
    if not plan:
        return df
    if strict:
        need_rows(df, by, max(i.min_rows(**p) for i, p in plan))
    split = plan_split(df, by, order, chunk)
    for part in _passes(plan):
        df = _one_pass(df, part, by, order, split)
    return df


def _passes(plan):
    """Group indicators so that the exponential ones of a pass can share their sub-blocks."""
    passes: list[tuple[list[float], list]] = []
    for ind, p in plan:
        mine = ind.alphas(**p)
        for alphas, members in passes:
            if shareable(alphas + mine):
                alphas.extend(mine)
                members.append((ind, p))
                break
        else:
            passes.append((list(mine), [(ind, p)]))
    return [members for _, members in passes]


def _one_pass(df: DataFrame, part, by, order, split) -> DataFrame:
    alphas = [a for i, p in part for a in i.alphas(**p)]

    def body(d: DataFrame, t: Timeline) -> DataFrame:
        if alphas:
            d = with_sub_blocks(d, t, alphas)
        return _advance_together(d, t, sub_length(alphas), part)

    lookback = max(i.lookback(**p) for i, p in part)
    return over_history(df, body, by=by, order=order, lookback=lookback, chunk=split, positions=bool(alphas))


def _advance_together(d: DataFrame, t: Timeline, length: int, part) -> DataFrame:
    private: list[str] = []

    def namer(i: int):
        def x(name: str) -> str:
            private.append(f"__{i}_{name}")
            return private[-1]

        return x

    running = [ind.steps(t, namer(i), **p) for i, (ind, p) in enumerate(part)]
    todo = {g: next(g, None) for g in running}

    def take(kind, merge):
        nonlocal d
        due = [g for g, step in todo.items() if isinstance(step, kind)]
        if due:
            d = merge([todo[g] for g in due])
            todo.update({g: next(g, None) for g in due})
        return bool(due)

    def columns(steps):
        return d.withColumns({n: c for s in steps for n, c in s.items()})

    def sums(steps):
        return t.cumsum(d, {n: c for s in steps for n, c in s.columns.items()})

    def means(steps):
        out = d
        for first in (True, False):
            due = {n: m for s in steps if s.first == first for n, m in s.columns.items()}
            if due:
                # A later stage reads the one before twice: for the states of the blocks and for its rows.
                out = ewm(out if first else settle(out, "means"), t, length, due)
        return out

    def plain_means(steps):
        return ewm(d, t, length, {n: m for s in steps for n, m in s.columns.items()})

    # Exponential means wait until everything else is done, so that they share their two windows.
    while take(dict, columns) or take(Sums, sums) or take(Means, plain_means if t.split is None else means):
        pass
    return d.drop(*private)
