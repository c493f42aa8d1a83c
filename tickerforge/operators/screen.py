"""The screening snapshot, screens, listings, and ticker resolution."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerforge.functions.periods import bounds
from tickerforge.functions.scalars import name_hash

#: The names that a screen's users see.
RENAMED = {"company_name": "companyName", "market_cap_usd": "marketCap", "last_close": "price", "last_volume": "volume", "sector_name": "sector", "industry_name": "industry", "exchange_code": "exchangeShortName", "is_etf": "isEtf", "is_fund": "isFund", "is_actively_trading": "isActivelyTrading"}
RANGES = {"market_cap": "market_cap_usd", "price": "last_close", "beta": "beta", "volume": "last_volume"}
EQUALS = {"exchange": "exchange_code", "country": "country", "is_etf": "is_etf", "is_fund": "is_fund", "active": "is_actively_trading"}


def security_latest(securities: DataFrame, bars: DataFrame) -> DataFrame:
    """Each security with its last bar's date, close and volume; nulls without a bar."""
    last = bars.groupBy("security_id").agg(F.max_by(F.struct(F.col("trade_date").alias("last_trade_date"), F.col("close").alias("last_close"), F.col("volume").alias("last_volume")), "trade_date").alias("_b"))
    return securities.join(last, "security_id", "left").select(*securities.columns, "_b.last_trade_date", "_b.last_close", "_b.last_volume")


def with_names(securities: DataFrame, sectors: DataFrame, industries: DataFrame) -> DataFrame:
    """Securities with the names of their sector and industry; both lists are short, which the optimizer sees by their size."""
    return securities.join(sectors.select("sector_id", "sector_name"), "sector_id", "left").join(industries.select("industry_id", "industry_name"), "industry_id", "left")


def screen(snapshot: DataFrame, ranges: Mapping[str, tuple[float | None, float | None]] = {}, equals: Mapping[str, object] = {}, sectors: list[str] | None = None, industries: list[str] | None = None, limit: int | None = None, **ignored) -> DataFrame:
    """Rows that meet all predicates, under their public names, by symbol.

    ``ranges`` are (more than, less than), both strict; nulls meet none. Sector and industry must
    both match if both are given. Dividend filters are accepted and have no column to act on.
    """
    conditions = [c for name, (more, less) in ranges.items() for c in bounds(RANGES[name], more, less)]
    conditions += [F.col(EQUALS[name]) == value for name, value in equals.items() if value is not None]
    conditions += [F.col("sector_name").isin(sectors)] if sectors else []
    conditions += [F.col("industry_name").isin(industries)] if industries else []
    rows = snapshot.where(reduce(lambda a, b: a & b, conditions)) if conditions else snapshot
    rows = rows.withColumnsRenamed(RENAMED)
    return rows.orderBy("symbol").limit(limit) if limit else rows.orderBy("symbol")


def screen_any(snapshot: DataFrame, sectors: list[str], industries: list[str], limit: int | None = None, **filters) -> DataFrame:
    """The union of one screen per sector and one per industry, each limited by itself; a symbol's first leg counts; by name."""
    legs = [screen(snapshot, sectors=[s], limit=limit, **filters) for s in sectors] + [screen(snapshot, industries=[i], limit=limit, **filters) for i in industries]
    if not legs:
        raise ValueError("a sector or an industry is needed")
    numbered = [leg.withColumn("_leg", F.lit(k)) for k, leg in enumerate(legs)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy("symbol").orderBy("_leg"))).where("_n = 1")
    return first.drop("_n", "_leg").orderBy("companyName")


def listing(names: DataFrame, column: str) -> DataFrame:
    """(id, name, hash): names in alphabetical order, numbered from 1, with their short public id.

    A list of names is small: it is numbered in one task.
    """
    order = Window.orderBy(column)
    return names.where(F.col(column).isNotNull()).select(F.row_number().over(order).alias("id"), F.col(column).alias("name"), name_hash(column).alias("hash"))


def pick(listed: DataFrame, ids: list[int] | None = None, hashes: list[str] | None = None) -> DataFrame:
    """Listed names by their numbers or by their short ids."""
    if (ids is None) == (hashes is None):
        raise ValueError("give either ids or hashes")
    return listed.where(F.col("id").isin(ids) if ids is not None else F.col("hash").isin(hashes))


def active_symbols(snapshot: DataFrame, limit: int | None = None) -> DataFrame:
    rows = snapshot.where("is_actively_trading").select("symbol", "company_name") if "company_name" in snapshot.columns else snapshot.where("is_actively_trading").select("symbol")
    return rows.orderBy("symbol").limit(limit) if limit else rows.orderBy("symbol")


def resolve(symbols: DataFrame, xref: DataFrame, securities: DataFrame, source: str) -> DataFrame:
    """(symbol, security_id) of each symbol: by its open ticker period, else by its primary symbol, else null.

    Of several open periods the primary and then the newest counts; of several securities the one
    of ``source``, then a listed one, then the smallest id.
    """
    wanted = symbols.select("symbol").distinct()
    w = Window.partitionBy("symbol")
    open_now = xref.where("valid_to IS NULL").withColumn("_n", F.row_number().over(w.orderBy(F.desc("is_primary"), F.desc("valid_from")))).where("_n = 1").select("symbol", F.col("security_id").alias("_a"))
    p = securities.withColumnRenamed("primary_symbol", "symbol")
    best = w.orderBy(F.desc(F.coalesce(F.col("source") == source, F.lit(False))), F.desc(F.col("delisted_date").isNull()), "security_id")
    primary = p.withColumn("_n", F.row_number().over(best)).where("_n = 1").select("symbol", F.col("security_id").alias("_b"))
    return wanted.join(open_now, "symbol", "left").join(primary, "symbol", "left").select("symbol", F.coalesce("_a", "_b").alias("security_id"))
