"""Exponentially weighted means as a blocked scan.

``y_t = q*y_(t-1) + a*x_t`` is evaluated inside sub-blocks of consecutive positions by the closed form
``q^k * sum(x_j * q^-j)``; the sub-block length keeps ``q^-k`` inside a double, and is long enough that only
the preceding sub-block still matters.  One sort serves both the sub-block sums and the carry.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from .history import BLK, K, RN, SUB, Timeline, same_keys

MAX_EXPONENT = 300.0  # q^-k stays below e^300
FADED = 40.0  # weights below e^-40 do not change a double


def decay(alpha: float) -> float:
    return -math.log1p(-alpha)


def span_alpha(period: int) -> float:
    return 2.0 / (period + 1)


def wilder_alpha(period: int) -> float:
    return 1.0 / period


def sub_length(alphas: Iterable[float]) -> int:
    rates = [decay(a) for a in alphas if a < 1]
    return max(2, int(MAX_EXPONENT / max(rates))) if rates else 1 << 20


def shareable(alphas: Iterable[float]) -> bool:
    """True if one sub-block length suits all: short enough for the fastest, long enough for the slowest."""
    rates = [decay(a) for a in alphas if a < 1]
    return not rates or MAX_EXPONENT / max(rates) * min(rates) >= FADED


def with_sub_blocks(df: DataFrame, t: Timeline, alphas: Iterable[float]) -> DataFrame:
    n = sub_length(alphas)
    t.order = [SUB, RN]
    return df.withColumns({SUB: F.floor(F.col(RN) / n), K: F.col(RN) % n})


@dataclass(frozen=True)
class Mean:
    """Exponential mean of a column; ``adjust`` corrects for the missing weight at the start of the history."""

    column: str
    alpha: float
    adjust: bool = True

    @property
    def weight(self) -> str:
        return "1D" if self.adjust else f"if({RN} = 0, 1D, {self.alpha!r}D)"


def ewm(df: DataFrame, t: Timeline, length: int, outputs: Mapping[str, Mean]) -> DataFrame:
    """Add the named means; ``df`` carries sub-blocks of ``length`` rows.

    Where the history is cut into blocks, each gets the exact state before it: the sums of all earlier blocks, decayed by the
    rows in between.  That holds for every stage of a chain, whose input is exact in each block; ``df`` is read twice then, so
    a stage that is expensive to compute is written out first.

    Null inputs have no weight and a null mean.  An adjusted mean is divided by the weight that its non-null rows have
    gathered, which is a mean of ones and zeros through the same windows.
    """
    final, weights = dict(outputs), {}
    for name, m in outputs.items():
        if m.adjust and m.alpha < 1:
            weights[name] = f"__w_{m.column}_{m.alpha!r}".replace(".", "_")
            df = df.withColumn(f"__one_{m.column}", F.when(F.col(m.column).isNotNull(), 1.0).otherwise(0.0))
            outputs = {**outputs, weights[name]: Mean(f"__one_{m.column}", m.alpha)}
    out = _ewm(df, t, length, outputs)
    means = {
        n: F.when(F.col(m.column).isNotNull(), F.col(n) / F.col(weights[n]) if n in weights else F.col(n)) for n, m in final.items()
    }
    return out.withColumns(means).drop(*set(weights.values()), *{f"__one_{final[n].column}" for n in weights})


def _ewm(df: DataFrame, t: Timeline, length: int, outputs: Mapping[str, Mean]) -> DataFrame:
    """The weighted sums themselves; for means that are not adjusted, the weights add up to one."""
    keys = ", ".join(f"`{k}`" for k in t.keys)
    inside = f"(PARTITION BY {keys}, {SUB} ORDER BY {RN} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    earlier = f"(PARTITION BY {keys} ORDER BY {SUB}, {RN} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    live = {n: m for n, m in outputs.items() if m.alpha < 1}
    carried = t.split is not None and bool(live)
    if carried:
        df = _with_block_state(df, t, live)
    sums, ends, result = {}, {}, {n: F.col(m.column).cast("double") for n, m in outputs.items() if m.alpha >= 1}
    for name, m in live.items():
        q, s, p = f"{1.0 - m.alpha!r}D", f"__s_{name}", f"__p_{name}"
        x = f"if({RN} >= {_entry(t)}, `{m.column}`, 0D)" if carried else f"`{m.column}`"
        sums[s] = F.expr(f"power({q}, {K}) * sum({m.weight} * {x} * power({q}, -{K})) OVER {inside}")
        # Newest finished sub-block that holds anything: after a long run of zeros an older one still counts.
        done = f"if({K} = {length - 1} AND `{s}` != 0, struct(`{s}` AS v, {RN} AS at), NULL)"
        ends[p] = F.expr(f"last({done}, true) OVER {earlier}")
        y = f"`{s}` + coalesce(`{p}`.v * power({q}, {RN} - `{p}`.at), 0D)"
        if carried:
            y += f" + coalesce(`__b_{name}`.v * power({q}, {RN} - `__b_{name}`.at), 0D)"
        result[name] = F.expr(y)
    if sums:
        df = df.withColumns(sums).withColumns(ends)
    return df.withColumns(result).drop(*sums, *ends, *[f"__b_{n}" for n in live if carried])


def _entry(t: Timeline, ahead: int = 0) -> str:
    """Position from which a block (or the one ``ahead``) accumulates; its first copied row has no predecessor."""
    size, lookback = t.split
    return f"(({BLK} + {ahead}) * {size} - {max(lookback - 1, 0)})"


def _with_block_state(df: DataFrame, t: Timeline, live: Mapping[str, Mean]) -> DataFrame:
    """Join the state just before each block's first row, summarised from the preceding blocks."""
    size, last = t.split[0], f"({_entry(t, 1)} - 1)"
    upto = Window.partitionBy(*t.by).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    inside = f"{RN} >= {_entry(t)} AND {RN} <= {last}"
    ends = df.groupBy(*t.keys).agg(
        *[
            F.expr(f"sum(if({inside}, {m.weight} * `{m.column}` * power({1.0 - m.alpha!r}D, {last} - {RN}), 0D))").alias(f"__e_{n}")
            for n, m in live.items()
        ]
    )
    # Fold the block sums of the group in order (few per group).  A state keeps the row that it belongs to, so that it does not
    # fade to nothing over long runs of zeros.
    folded = {
        f"__b_{n}": F.expr(f"""aggregate(`__list_{n}`, CAST(NULL AS struct<v: double, at: bigint>), (acc, x) -> if(
            x.e != 0, named_struct('v', x.e + coalesce(acc.v * power({1.0 - m.alpha!r}D, x.at - acc.at), 0D), 'at', x.at), acc))""")
        for n, m in live.items()
    }
    lists = {f"__list_{n}": F.collect_list(F.struct(F.col(f"__e_{n}").alias("e"), F.expr(f"CAST({last} AS bigint) AS at"))).over(upto) for n in live}
    state = ends.withColumns(lists).select(*t.keys, *[c.alias(n) for n, c in folded.items()])
    return same_keys(df, state, t.keys, t.null_keys)
