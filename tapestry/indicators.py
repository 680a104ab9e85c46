"""The indicators under their short upper-case names, as callables ``RSI(df, by=.., order=.., period=14)``.

They also work in ``DataFrame.transform``: ``bars.transform(RSI, by="contract", order="ts")``.
"""

from .operators import momentum, overlap, volatility, volume  # noqa: F401  (register the indicators)
from .operators.registry import REGISTRY

globals().update({name.upper(): indicator for name, indicator in REGISTRY.items()})
__all__ = [name.upper() for name in REGISTRY]
