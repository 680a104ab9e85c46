from . import momentum, overlap, volatility, volume  # noqa: F401  (register the indicators)
