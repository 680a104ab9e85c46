"""Market-data analytics on Spark: bars, indicators, order book, trade flow, risk and reports."""

from .operators import momentum, overlap, volatility, volume  # noqa: F401
from .operators.registry import REGISTRY, available, register_custom, with_indicators  # noqa: F401

__version__ = "0.1.0"
