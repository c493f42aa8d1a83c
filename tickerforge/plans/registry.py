"""All queries of the analytics library by name, with their SQL equivalents."""

from tickerforge.plans import prices, quality, reference  # noqa: F401
from tickerforge.plans.register import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
