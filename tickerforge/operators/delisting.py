"""The sweep over the vendor's delistings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerforge.functions.scalars import is_us, norm_exchange, parse_date
from tickerforge.operators.merge import mark_delisted
from tickerforge.operators.screen import resolve


def known_delistings(feed: DataFrame, xref: DataFrame, securities: DataFrame, source: str) -> DataFrame:
    """(symbol, security_id, delisted_date) of the feed's dated rows on US venues whose ticker is known."""
    code = norm_exchange(F.lit(None).cast("string"), F.col("exchange"))
    rows = feed.where(is_us(F.coalesce(code, F.lit("")))).select("symbol", parse_date(F.col("delistedDate").cast("string")).alias("delisted_date")).where("delisted_date IS NOT NULL")
    return rows.join(resolve(rows.select("symbol"), xref, securities, source).where("security_id IS NOT NULL"), "symbol").select("symbol", "security_id", "delisted_date")


def sweep(feed: DataFrame, xref: DataFrame, securities: DataFrame, source: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Securities and ticker periods after the sweep, and one row of counts (seen, marked)."""
    found = known_delistings(feed, xref, securities, source)
    after, periods = mark_delisted(securities, xref, found)
    fresh = found.join(securities.where("delisted_date IS NULL").select("security_id"), "security_id", "left_semi").select("security_id").distinct()
    counts = feed.agg(F.count(F.lit(1)).alias("seen")).crossJoin(fresh.agg(F.count(F.lit(1)).alias("marked")))
    return after, periods, counts
