"""Fixed schemas of the market tables (nothing is inferred)."""

from __future__ import annotations

BARS = "contract string, ts timestamp, open double, high double, low double, close double, volume bigint"
BARS_WIRE = "t string, o double, h double, l double, c double, v bigint"
TICKS = "contract string, ts timestamp, seq bigint, price double, volume bigint, side string"
TICKS_WIRE = "timestamp string, price double, volume bigint, side string"
LIVE_TICKS = "contract string, ts timestamp, seq bigint, price double, volume bigint, type string"
QUOTES = "contract string, ts timestamp, seq bigint, bid double, ask double, last double, volume bigint"
DEPTH = "contract string, ts timestamp, seq bigint, price double, volume bigint, type int"
BOOK = "contract string, side string, price double, volume bigint, ts timestamp, type string"
TRADES = "contract string, ts timestamp, seq bigint, price double, volume bigint, side string"
INSTRUMENTS = "id string, name string, description string, tickSize double, tickValue double, activeContract boolean"
ACCOUNTS = "id bigint, name string, balance double, canTrade boolean, isVisible boolean, simulated boolean"
ORDERS = (
    "id bigint, accountId bigint, contractId string, creationTimestamp timestamp, updateTimestamp timestamp, "
    "status int, type int, side int, size int, fillVolume int, limitPrice double, stopPrice double"
)
POSITIONS = (
    "id bigint, accountId bigint, contractId string, creationTimestamp timestamp, type int, size int, averagePrice double"
)
EXECUTIONS = (
    "id bigint, accountId bigint, contractId string, creationTimestamp timestamp, price double, profitAndLoss double, "
    "fees double, side int, size int, voided boolean, orderId bigint"
)

# Fixed wire codes.
DEPTH_ASK, DEPTH_BID, DEPTH_TRADE, DEPTH_CHANGES = 1, 2, 5, (9, 10)
LONG, SHORT = 1, 2
BUY, SELL = 0, 1
ORDER_OPEN, ORDER_FILLED = 1, 2
ORDER_LIMIT, ORDER_MARKET, ORDER_STOP = 1, 2, 4
EXCHANGE_TZ = "America/Chicago"
