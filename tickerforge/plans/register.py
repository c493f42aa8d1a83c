"""Where queries are entered by name, with their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickerforge.sources import market

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: The derived tables that an oracle may name.
TABLES = {"bars": market.BARS_SQL, "actions": market.ACTIONS_SQL, "securities": market.SECURITIES_SQL, "curve": market.CURVE_SQL, "dirty": market.DIRTY_SQL}


def query(oracle: str | None = None, uses: str = "", name: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, and its SQL over the derived tables that it ``uses`` (by their names, in order)."""

    def add(f: Query) -> Query:
        key = name or f.__name__
        QUERIES[key] = f
        if oracle:
            head = ", ".join(f"{t} AS ({TABLES[t]})" for t in uses.split())
            body = oracle.strip()
            if head:
                body = f"WITH RECURSIVE {head}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {head} {body}"
            ORACLES[key] = body
        return f

    return add
