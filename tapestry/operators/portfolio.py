"""Performance of closed trades."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.history import names, newest, running


def portfolio_metrics(trades: DataFrame, initial_balance: float = 100_000.0, *, by="account", order=("ts", "seq"), pnl="pnl", chunk="auto") -> DataFrame:
    """Per account: totals, win rate, profit factor, and the drawdown of the equity curve (peaks include the start).

    One scan in order gives the curve and its peaks; everything else is aggregated.
    """
    by, order = names(by), names(order)
    start = F.lit(float(initial_balance))
    slim = trades.select(*by, *order, F.coalesce(F.col(pnl), F.lit(0.0)).alias("__pnl"))
    d = running(slim, by=by, order=order, chunk=chunk, sums={"__sum": F.col("__pnl")}, peaks={"__high": "__sum"})
    d = d.withColumns({"__equity": start + F.col("__sum"), "__peak": F.greatest(start, start + F.col("__high"))})
    x = F.col("__pnl")
    # Every new peak is higher than the one before, so one row per peak and account holds the run that it starts.
    runs = d.groupBy(*by, "__peak").agg(
        (F.count(F.lit(1)) - F.when(F.col("__peak") > start, 1).otherwise(0)).alias("below"), F.max((F.col("__peak") - F.col("__equity")) / F.col("__peak")).alias("dd"),
        F.count(F.lit(1)).alias("n"), F.sum(x).alias("pnl"), F.count_if(x > 0).alias("wins"), F.count_if(x < 0).alias("losses"),
        F.coalesce(F.sum(F.when(x > 0, x)), F.lit(0.0)).alias("gain"), F.coalesce(F.sum(F.when(x < 0, -x)), F.lit(0.0)).alias("loss"),
        F.max(x).alias("best"), F.min(x).alias("worst"),
    )
    out = runs.groupBy(*by).agg(
        F.sum("n").alias("total_trades"), F.sum("pnl").alias("total_pnl"), F.sum("wins").alias("__wins"), F.sum("losses").alias("__losses"),
        F.sum("gain").alias("gross_profit"), F.sum("loss").alias("gross_loss"), F.greatest(F.max("dd"), F.lit(0.0)).alias("max_drawdown"),
        F.max("below").alias("max_drawdown_duration"), F.max("best").alias("largest_win"), F.min("worst").alias("largest_loss"),
    )
    win_rate = F.col("__wins") / F.col("total_trades")
    avg_win = F.when(F.col("__wins") > 0, F.col("gross_profit") / F.col("__wins")).otherwise(0.0)
    avg_loss = F.when(F.col("__losses") > 0, -F.col("gross_loss") / F.col("__losses")).otherwise(0.0)
    return out.withColumns({
        "total_return": F.col("total_pnl") / start, "win_rate": win_rate,
        "profit_factor": F.when(F.col("gross_loss") > 0, F.col("gross_profit") / F.col("gross_loss")).otherwise(F.lit(float("inf"))),
        "avg_win": avg_win, "avg_loss": avg_loss, "expectancy": win_rate * avg_win + (1.0 - win_rate) * avg_loss,
    }).drop("__wins", "__losses")


def trade_history(executions: DataFrame, *, start=None, end=None, contract=None, account=None, limit: int | None = None, by="accountId",
                  order=("creationTimestamp", "id")) -> DataFrame:
    """Executions in a period, of a contract or account; newest ``limit`` per account."""
    ts, d = names(order)[0], executions
    if start is not None:
        d = d.filter(F.col(ts) >= F.lit(start).cast("timestamp"))
    if end is not None:
        d = d.filter(F.col(ts) <= F.lit(end).cast("timestamp"))
    if contract is not None:
        d = d.filter(F.col("contractId") == contract)
    if account is not None:
        d = d.filter(F.col("accountId") == account)
    return d if limit is None else newest(d, limit, by=by, order=order)


def performance(executions: DataFrame, initial_balance: float = 100_000.0, *, by="accountId", order=("creationTimestamp", "id"), chunk="auto") -> DataFrame:
    """Metrics of the round trips: voided executions and half-turns (no pnl) do not count."""
    closed = executions.filter(~F.coalesce(F.col("voided"), F.lit(False)) & F.col("profitAndLoss").isNotNull())
    return portfolio_metrics(closed, initial_balance, by=by, order=order, pnl="profitAndLoss", chunk=chunk)
