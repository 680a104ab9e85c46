"""Positions: latest state, profit and loss, exposure, alerts, sizing and risk checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clock import wall, wall_date
from ..functions.exprs import safe_div
from ..functions.history import names, newest, running, same_keys
from ..functions.joins import dimension_join, latest_state
from ..schemas import BUY, LONG

KEY = ["accountId", "contractId"]
ORDER = ["creationTimestamp", "id"]
# Risk limits.
MAX_PORTFOLIO_RISK, MAX_POSITION_RISK, MAX_CORRELATION = 0.02, 0.01, 0.7


def latest_positions(events: DataFrame, *, key=KEY, order=ORDER) -> DataFrame:
    """Newest state per account and contract; closed positions (size 0) are gone."""
    return latest_state(events, key=key, order=order).filter(F.col("size") != 0)


def position_history(events: DataFrame, limit: int = 100, *, key=KEY, order=ORDER, chunk="auto") -> DataFrame:
    """Newest ``limit`` updates with the change in size; 0 on a position's first update."""
    d = running(events, by=key, order=order, prevs={"__size": F.col("size")}, chunk=chunk)
    d = d.withColumn("size_change", F.coalesce(F.col("size") - F.col("__size"), F.lit(0))).drop("__size")
    return newest(d, limit, by=key, order=order)


def direction() -> Column:
    return F.when(F.col("type") == LONG, "LONG").otherwise("SHORT")


def position_pnl(positions: DataFrame, prices: DataFrame, *, on="contractId", price="price", instruments: DataFrame | None = None) -> DataFrame:
    """Unrealised profit and market value; null where no price is known.

    With ``instruments`` the profit is in currency (ticks times tick value), else in points.
    """
    d = dimension_join(positions, prices.select(on, F.col(price).alias("current_price")), on)
    scale = F.lit(1.0)
    if instruments is not None:
        ticks = instruments.select(F.col("id").alias(on), F.try_divide("tickValue", "tickSize").alias("__scale"))
        d = dimension_join(d, ticks, on)
        scale = F.coalesce(F.col("__scale"), F.lit(1.0))
    gap = F.when(F.col("type") == LONG, F.col("current_price") - F.col("averagePrice")).otherwise(F.col("averagePrice") - F.col("current_price"))
    return d.withColumns({
        "pnl_per_contract": gap, "unrealized_pnl": gap * F.col("size") * scale, "market_value": F.col("current_price") * F.col("size"),
        "direction": direction(),
    }).drop("__scale")


def portfolio_pnl(pnl: DataFrame, *, by="accountId") -> DataFrame:
    """Profit per account; positions without a price count as such."""
    priced = F.col("unrealized_pnl").isNotNull()
    return pnl.groupBy(*names(by)).agg(
        F.coalesce(F.sum("unrealized_pnl"), F.lit(0.0)).alias("total_pnl"), F.count(F.lit(1)).alias("positions_count"),
        F.count_if(priced).alias("positions_with_prices"), F.count_if(~priced).alias("positions_without_prices"),
    )


def exposure_risk(positions: DataFrame, *, by="accountId", accounts: DataFrame | None = None) -> DataFrame:
    """Total exposure, share of the largest position, diversification and warnings; listed ``accounts`` without positions score 1."""
    by = names(by)
    held = F.abs(F.col("size") * F.col("averagePrice"))
    d = positions.groupBy(*by).agg(F.sum(held).alias("total_exposure"), F.max(held).alias("__top"), F.count(F.lit(1)).alias("position_count"))
    if accounts is not None:
        d = accounts.select(*by).distinct().join(d, by, "left").na.fill(0, ["total_exposure", "__top", "position_count"])
    d = d.withColumn("largest_position_risk", safe_div(F.col("__top"), F.col("total_exposure"))).drop("__top")
    top, n = F.col("largest_position_risk"), F.col("position_count")
    return d.withColumns({
        "diversification_score": F.when(n == 0, 1.0).when(top < 1.0, 1.0 - top).otherwise(0.0),
        "risk_warnings": F.array_compact(F.array(
            F.when(top > MAX_POSITION_RISK, F.lit("largest position exceeds its limit")), F.when(n == 1, F.lit("single position")),
        )),
    })


def account_rollup(accounts: DataFrame, positions: DataFrame, *, group=(), id="id", account="accountId") -> DataFrame:
    """Balance and number of open positions over all accounts, or per ``group`` of them."""
    held = positions.groupBy(F.col(account).alias(id)).agg(F.count(F.lit(1)).alias("__n"))
    return accounts.join(held, id, "left").groupBy(*names(group)).agg(
        F.count(F.lit(1)).alias("accounts"), F.sum("balance").alias("total_balance"), F.coalesce(F.sum("__n"), F.lit(0)).alias("total_positions")
    )


def position_alerts(events: DataFrame, rules: DataFrame, *, by="contractId", order=ORDER, price="price", chunk="auto") -> DataFrame:
    """First update that triggers each contract's alert.

    Triggers: a change in size, a loss of ``max_loss``, a gain of ``max_gain``, or an absolute profit of ``pnl_threshold``.
    """
    by = names(by)
    d = running(events, by=by, order=order, prevs={"__size": F.col("size")}, chunk=chunk)
    d = dimension_join(d, rules.withColumn("__rule", F.lit(True)), by).filter(F.col("__rule"))
    change = F.col("size") - F.col("__size")
    gap = F.when(F.col("type") == LONG, F.col(price) - F.col("averagePrice")).otherwise(F.col("averagePrice") - F.col(price))
    pnl = gap * F.col("size")
    reason = (
        F.when(change != 0, "size_change").when(pnl <= -F.col("max_loss"), "max_loss").when(pnl >= F.col("max_gain"), "max_gain")
        .when(F.abs(pnl) >= F.col("pnl_threshold"), "pnl_threshold")
    )
    d = d.withColumns({"reason": reason, "size_change": F.coalesce(change, F.lit(0)), "pnl": pnl}).filter(F.col("reason").isNotNull())
    first = F.min_by(F.struct(*names(order), "reason", "size", "size_change", "pnl"), F.struct(*names(order)))
    return d.groupBy(*by).agg(first.alias("s")).select(*by, "s.*")


def size_positions(signals: DataFrame, accounts: DataFrame, instruments: DataFrame | None = None, *, account="accountId", contract="contractId") -> DataFrame:
    """Whole contracts whose loss at the stop stays within ``risk_amount``, or ``risk_fraction`` of the balance where given."""
    d = dimension_join(signals, accounts.select(F.col("id").alias(account), "balance"), account)
    scale = F.lit(1.0)
    if instruments is not None:
        d = dimension_join(d, instruments.select(F.col("id").alias(contract), F.try_divide("tickValue", "tickSize").alias("__m")), contract)
        scale = F.coalesce(F.col("__m"), F.lit(1.0))
    gap = F.abs(F.col("entry") - F.col("stop"))
    budget = F.col("risk_amount")
    if "risk_fraction" in signals.columns:
        budget = F.coalesce(budget, F.col("balance") * F.col("risk_fraction"))
    d = d.withColumns({"risk_per_contract": gap * scale, "risk_budget": budget})
    size = F.when(gap != 0, F.floor(safe_div(F.col("risk_budget"), F.col("risk_per_contract"))).cast("long"))
    d = d.withColumn("suggested_size", size)
    d = d.withColumn("total_risk", F.col("suggested_size") * F.col("risk_per_contract"))
    d = d.withColumn("risk_percentage", F.when(F.col("balance") > 0, F.col("total_risk") / F.col("balance") * 100.0).otherwise(0.0))
    n, pct = F.col("suggested_size"), F.col("risk_percentage")
    return d.withColumns({
        "error": F.when(gap == 0, F.lit("entry equals stop")),
        "risk_warnings": F.array_compact(F.array(
            F.when(pct > MAX_POSITION_RISK * 100, F.lit("risk exceeds its limit")), F.when(n == 0, F.lit("size is 0")), F.when(n > 10, F.lit("large size")),
        )),
    }).drop("__m")


def risk_reward(signals: DataFrame) -> DataFrame:
    """Reward per risk of ``entry, stop, target``; an unusable line gets a reason instead."""
    e, s, t = F.col("entry"), F.col("stop"), F.col("target")
    reason = (
        F.when(e == s, "entry equals stop").when((s < e) & (t <= e), "target not above entry").when((s > e) & (t >= e), "target not below entry")
    )
    return signals.withColumn("invalid_reason", reason).withColumn(
        "risk_reward", F.when(F.col("invalid_reason").isNull(), F.try_divide(F.abs(t - e), F.abs(e - s)))
    )


def validate_brackets(orders: DataFrame) -> DataFrame:
    """Check stop < entry < target for buys and the reverse for sells."""
    e, s, t, buy = F.col("entry"), F.col("stop"), F.col("target"), F.col("side") == BUY
    reason = (
        F.when(buy & (s >= e), "stop must be below entry").when(buy & (t <= e), "target must be above entry")
        .when(~buy & (s <= e), "stop must be above entry").when(~buy & (t >= e), "target must be below entry")
    )
    return orders.withColumn("reject_reason", reason).withColumn("valid", F.col("reject_reason").isNull())


def positions_from_fills(fills: DataFrame, *, by="contract", order=("ts", "seq"), chunk="auto") -> DataFrame:
    """Net size and average entry price from fills (``side, quantity, price``).

    The average covers the fills that enlarged the position since it was last flat; a fill that turns it over opens a
    new position with its remainder.
    """
    by, order = names(by), names(order)
    signed = F.when(F.col("side") == BUY, F.col("quantity")).otherwise(-F.col("quantity"))
    d = running(fills.select(*by, *order, "price", signed.alias("__q")), by=by, order=order, chunk=chunk, sums={"__net": F.col("__q"), "__nth": F.lit(1)})
    net, before = F.col("__net"), F.col("__net") - F.col("__q")
    opens = (before == 0) | (F.signum(net.cast("double")) == -F.signum(before.cast("double")))
    grown = F.when(net == 0, 0).when(opens, F.abs(net)).when(F.abs(net) > F.abs(before), F.abs(F.col("__q"))).otherwise(0)
    d = d.withColumns({"__grown": grown, "__opens": F.when(opens, F.col("__nth"))})
    # Where the newest position was opened, and what it gathered since.
    newest_position = d.groupBy(*by).agg(F.max_by("__net", "__nth").alias("__size"), F.max("__opens").alias("__opened"))
    since = same_keys(d.drop("__opens").filter("__grown != 0"), newest_position, by, True).filter(F.col("__nth") >= F.col("__opened"))
    paid = since.groupBy(*by).agg(F.sum(F.col("__grown") * F.col("price")).alias("__paid"), F.sum("__grown").alias("__all"))
    out = same_keys(newest_position, paid, by, True)
    return out.select(*by, F.col("__size").alias("net_size"), F.when(F.col("__size") != 0, F.try_divide("__paid", "__all")).alias("average_price"))


def daily_loss(executions: DataFrame, limit: float, *, account="accountId", ts="creationTimestamp", pnl="profitAndLoss", tz: str = "UTC") -> DataFrame:
    """Realised profit per account and day (of zone ``tz``) against a loss limit."""
    d = executions.groupBy(account, wall_date(wall(F.col(ts).cast("timestamp"), tz)).alias("day")).agg(F.coalesce(F.sum(pnl), F.lit(0.0)).alias("realized_pnl"))
    return d.withColumn("limit_reached", F.col("realized_pnl") <= -float(limit))


def group_exposure(positions: DataFrame, groups: DataFrame, max_share: float = 0.3, *, by="accountId", contract="contractId") -> DataFrame:
    """Exposure share of each correlation group (``groups``: contract, group) in its account."""
    by = names(by)
    held = F.abs(F.col("size") * F.col("averagePrice"))
    total = positions.groupBy(*by).agg(F.sum(held).alias("__total"))
    per = dimension_join(positions, groups.select(F.col("contract").alias(contract), "group"), contract).filter(F.col("group").isNotNull())
    per = per.groupBy(*by, "group").agg(F.sum(held).alias("exposure"), F.countDistinct(contract).alias("contracts"))
    return per.join(total, by).withColumn("exposure_share", safe_div(F.col("exposure"), F.col("__total"))).withColumn(
        "exceeds", F.col("exposure_share") > max_share
    ).drop("__total")
