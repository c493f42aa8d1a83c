"""Trading days of US venues: weekdays less the market's holidays."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_VENUES = ("NASDAQ", "NYSE", "AMEX")
MONDAY, THURSDAY = 0, 3


def easter(year: int) -> date:
    """Easter Sunday, from the golden number and the epact."""
    golden, century = year % 19 + 1, year // 100 + 1
    dropped, moon = 3 * century // 4 - 12, (8 * century + 5) // 25 - 5
    epact = (11 * golden + 20 + moon - dropped) % 30
    if epact == 24 or (epact == 25 and golden > 11):
        epact += 1
    full = 44 - epact
    if full < 21:
        full += 30
    weekday = 5 * year // 4 - dropped - 10
    day = full + 7 - (weekday + full) % 7
    return date(year, 3, 1) + timedelta(days=day - 1)


def nth_weekday(year: int, month: int, weekday: int, n: int) -> date:
    """The n-th such weekday (Monday is 0) of a month; n = -1 is the last."""
    days = [d for d in (date(year, month, 1) + timedelta(days=i) for i in range(31)) if d.month == month and d.weekday() == weekday]
    return days[n - 1 if n > 0 else n]


def observed(day: date) -> date:
    """A Saturday's holiday is kept on Friday, a Sunday's on Monday."""
    return day + timedelta(days={5: -1, 6: 1}.get(day.weekday(), 0))


def holidays(year: int) -> set[date]:
    """The market holidays listed under a year. New Year's Day of a Saturday falls into the year before, where it isn't listed."""
    fixed = [(1, 1), (7, 4), (12, 25)] + ([(6, 19)] if year >= 2022 else [])
    floating = [(1, MONDAY, 3), (2, MONDAY, 3), (5, MONDAY, -1), (9, MONDAY, 1), (11, THURSDAY, 4)]
    return {observed(date(year, m, d)) for m, d in fixed} | {nth_weekday(year, *f) for f in floating} | {easter(year) - timedelta(days=2)}


def trading_days(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """(trade_date) of all open days of the years."""
    closed = sorted({d for y in range(first_year, last_year + 1) for d in holidays(y) if d.year == y})
    days = spark.range(1).select(F.explode(F.sequence(F.lit(date(first_year, 1, 1)), F.lit(date(last_year, 12, 31)))).alias("trade_date"))
    weekdays = days.where(F.weekday("trade_date") < 5)
    return weekdays.join(F.broadcast(spark.createDataFrame([(d,) for d in closed], "trade_date date")), "trade_date", "left_anti")  # ten days a year


def trading_calendar(spark: SparkSession, first_year: int, last_year: int, exchanges: DataFrame | None = None) -> DataFrame:
    """(exchange_code, trade_date, is_open) for the US venues of ``exchanges`` (exchange_code, country), or the usual three."""
    if exchanges is not None:
        exchanges = exchanges.where("country = 'US'").select("exchange_code")
    if exchanges is None or exchanges.isEmpty():
        exchanges = spark.createDataFrame([(c,) for c in DEFAULT_VENUES], "exchange_code string")
    codes = exchanges.agg(F.sort_array(F.collect_set("exchange_code")).alias("_codes"))  # a handful of venues
    return trading_days(spark, first_year, last_year).crossJoin(F.broadcast(codes)).select(F.explode("_codes").alias("exchange_code"), "trade_date", F.lit(True).alias("is_open"))


def extend(calendar: DataFrame, last_year: int) -> DataFrame:
    """The calendar with the years after its last one up to ``last_year``."""
    have = calendar.agg(F.max(F.year("trade_date"))).first()[0]
    if have is None or have >= last_year:
        return calendar
    venues = calendar.select("exchange_code", F.lit("US").alias("country")).distinct()
    return calendar.unionByName(trading_calendar(calendar.sparkSession, have + 1, last_year, venues).select(*calendar.columns))
