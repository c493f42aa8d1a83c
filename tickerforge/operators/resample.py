"""Bars of a coarser frequency, and the head-or-tail rule of price requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FREQUENCIES = ("day", "week", "month", "quarter", "semi-annual", "annual")
VALUES = ["open", "high", "low", "close", "volume"]


def label(frequency: str, day: Column, first_month: Column | None = None) -> Column:
    """The last day of the bucket that a day falls into.

    Weeks end on Sunday. Half-years are counted from the month end of a series' first day
    (``first_month``): the first bucket is that month alone.
    """
    if frequency == "day":
        return day
    if frequency == "week":
        return F.date_add(day, F.pmod(8 - F.dayofweek(day), F.lit(7)))
    if frequency == "month":
        return F.last_day(day)
    if frequency == "quarter":
        return F.last_day(F.add_months(F.trunc(day, "quarter"), 2))
    if frequency == "semi-annual":
        months = 12 * (F.year(day) - F.year(first_month)) + F.month(day) - F.month(first_month)
        return F.last_day(F.add_months(first_month, (F.ceil(months / 6) * 6).cast("int")))
    if frequency == "annual":
        return F.make_date(F.year(day), F.lit(12), F.lit(31))
    raise ValueError(f"frequency must be one of {', '.join(FREQUENCIES)}, not {frequency!r}")


def _next_label(frequency: str, first: Column, steps: Column) -> Column:
    if frequency in ("day", "week"):
        return F.date_add(first, steps * (7 if frequency == "week" else 1))
    months = {"month": 1, "quarter": 3, "semi-annual": 6, "annual": 12}[frequency]
    return F.last_day(F.add_months(first, steps * months))


def resample(bars: DataFrame, frequency: str, key: str = "security_id", date: str = "trade_date", keep_empty: bool = False) -> DataFrame:
    """OHLCV per bucket: first open, highest high, lowest low, last close, total volume; nulls are passed over.

    ``keep_empty`` adds the buckets without a bar between a series' first and last, with null prices
    and volume 0.
    """
    placed = bars
    if frequency == "semi-annual":
        placed = placed.withColumn("_m0", F.min(F.last_day(date)).over(Window.partitionBy(key)))
    placed = placed.withColumn("_label", label(frequency, F.col(date), F.col("_m0") if frequency == "semi-annual" else None))

    def where_known(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.col(date))

    out = placed.groupBy(key, F.col("_label").alias(date)).agg(
        F.min_by("open", where_known("open")).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", where_known("close")).alias("close"), F.sum("volume").alias("volume")
    )
    if not keep_empty:
        return out
    span = out.groupBy(key).agg(F.min(date).alias("_a"), F.max(date).alias("_b"))
    if frequency in ("day", "week"):
        count = F.floor(F.datediff("_b", "_a") / (7 if frequency == "week" else 1))
    else:
        count = F.floor(F.months_between("_b", "_a") / {"month": 1, "quarter": 3, "semi-annual": 6, "annual": 12}[frequency] + 0.01)
    buckets = span.select(key, "_a", F.explode(F.sequence(F.lit(0), count.cast("int"))).alias("_k")).select(key, _next_label(frequency, F.col("_a"), F.col("_k")).alias(date))
    return buckets.join(out, [key, date], "left").withColumn("volume", F.coalesce("volume", F.lit(0).cast(dict(out.dtypes)["volume"])))


def select_fields(frame: DataFrame, fields: list[str], strict: bool, keys: tuple[str, ...] = ("security_id", "trade_date")) -> DataFrame:
    """The known ones of ``fields``; if none is known, all columns, or only the keys if ``strict``."""
    known = [f for f in fields if f in frame.columns and f not in keys]
    rest = [c for c in frame.columns if c not in keys]
    return frame.select(*keys, *(known or ([] if strict else rest)))


def limited(frame: DataFrame, limit: int | None, start_given: bool, end_given: bool, key: str = "security_id", date: str = "trade_date") -> DataFrame:
    """Each series' first ``limit`` rows if a start without an end was asked for, else its last; no limit at 0 or less."""
    if not limit or limit <= 0:
        return frame
    order = F.asc(date) if start_given and not end_given else F.desc(date)
    return frame.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where(F.col("_n") <= limit).drop("_n")
