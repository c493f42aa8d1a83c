"""Data-quality checks over whole tables; each returns flags (check_name, severity, security_id, record_date, detail)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _flags(rows: DataFrame, check: str, severity: str, record_date: str, detail: list[str]) -> DataFrame:
    return rows.select(F.lit(check).alias("check_name"), F.lit(severity).alias("severity"), "security_id", F.col(record_date).alias("record_date"), F.to_json(F.struct(*detail)).alias("detail"))


#: Days in a word of a bitmap.
BITS = 64


def present(days: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, word, days): the dates there are, as a bitmap of 64 days a row, about six rows a year."""
    day = "datediff(trade_date, DATE '1970-01-01')"
    rows = days.where("trade_date IS NOT NULL").select(*keys, F.expr(f"floor({day} / {BITS})").cast("long").alias("word"), F.expr(f"shiftleft(1L, pmod({day}, {BITS}))").alias("days"))
    return rows.groupBy(*keys, "word").agg(F.bit_or("days").alias("days"))


def merged_presence(stored: DataFrame, news: DataFrame) -> DataFrame:
    """The bitmaps of securities after a load; ``news`` are the bitmaps of the loaded bars alone."""
    return stored.unionByName(news).groupBy("security_id", "word").agg(F.bit_or("days").alias("days"))


def _filled(x: Column, shift: Callable[[Column, int], Column]) -> Column:
    """With all bits beside those set, in the direction of the shift."""
    for k in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseOR(shift(x, k))
    return x


def gaps_of(presence: DataFrame, calendar: DataFrame, exchange: str = "NASDAQ") -> DataFrame:
    """(security_id, trade_date) of the exchange's open days between the first and the last day of a security's bitmap that are not in it.

    Words of 64 days are compared, so a security costs six rows a year and one more for each day that is missing.
    The calendar's words go along as one map, six entries a year.
    """
    open_days = present(calendar.where((F.col("exchange_code") == exchange) & F.col("is_open")), []).agg(F.map_from_entries(F.collect_list(F.struct("word", "days"))).alias("_open"))
    spans = presence.groupBy("security_id").agg(F.min("word").alias("_a"), F.max("word").alias("_b"), F.min_by("days", "word").alias("_first"), F.max_by("days", "word").alias("_last"))
    words = spans.crossJoin(F.broadcast(open_days)).select("*", F.explode(F.sequence("_a", "_b")).alias("_w"))
    every, first, last = F.lit(-1).cast("long"), F.col("_first"), F.col("_last")
    since = F.when(F.col("_w") == F.col("_a"), _filled(first, F.shiftleft)).otherwise(every)
    until = F.when(F.col("_w") == F.col("_b"), _filled(last, F.shiftrightunsigned)).otherwise(every)
    due = words.select(F.col("security_id").alias("_s"), "_w", F.coalesce(F.element_at("_open", F.col("_w")), F.lit(0).cast("long")).bitwiseAND(since).bitwiseAND(until).alias("_due")).where("_due <> 0")
    met = due.join(presence, F.col("_s").eqNullSafe(F.col("security_id")) & (F.col("_w") == F.col("word")), "left")
    missing = met.select(F.col("_s").alias("security_id"), "_w", F.col("_due").bitwiseAND(F.bitwise_not(F.coalesce("days", F.lit(0).cast("long")))).alias("_m")).where("_m <> 0")
    bits = F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda k: F.call_function("bit_get", F.col("_m"), k) == 1)
    return missing.select("security_id", "_w", F.explode(bits).alias("_k")).select("security_id", F.date_add(F.lit("1970-01-01").cast("date"), (F.col("_w") * BITS + F.col("_k")).cast("int")).alias("trade_date"))


def gaps(bars: DataFrame, calendar: DataFrame, exchange: str = "NASDAQ") -> DataFrame:
    """(security_id, trade_date) of the exchange's open days between a security's first and last bar that have no bar."""
    return gaps_of(present(bars, ["security_id"]), calendar, exchange)


def outliers(bars: DataFrame, actions: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(security_id, trade_date, close, previous, change) of closes that moved by more than the threshold, splits' ex-dates aside."""
    before = F.lag("close").over(Window.partitionBy("security_id").orderBy("trade_date"))
    moved = bars.select("security_id", "trade_date", "close", before.alias("previous")).where("previous > 0").withColumn("change", F.abs(F.col("close") - F.col("previous")) / F.col("previous"))
    splits = actions.where("action_type = 'split'").select("security_id", F.col("ex_date").alias("trade_date"))
    return moved.where(F.col("change") > threshold).join(splits, ["security_id", "trade_date"], "left_anti")


def stale(bars: DataFrame, securities: DataFrame) -> DataFrame:
    """(security_id, last_date, market_date) of active securities whose last bar is older than the newest of all."""
    newest = bars.agg(F.max("trade_date").alias("market_date"))
    active = securities.where("is_actively_trading").select("security_id")
    last = bars.join(active, "security_id", "left_semi").groupBy("security_id").agg(F.max("trade_date").alias("last_date"))
    return last.crossJoin(F.broadcast(newest)).where("last_date < market_date")


def run_all(bars: DataFrame, actions: DataFrame, securities: DataFrame, calendar: DataFrame, exchange: str = "NASDAQ", threshold: float = 0.5) -> DataFrame:
    """The flags of all checks. Runs don't know each other: what is found twice is flagged twice."""
    a = _flags(gaps(bars, calendar, exchange), "missing_trading_day", "warn", "trade_date", ["trade_date"])
    b = _flags(outliers(bars, actions, threshold), "price_outlier", "warn", "trade_date", ["close", "previous", "change"])
    c = _flags(stale(bars, securities), "stale_price", "info", "last_date", ["last_date", "market_date"])
    return a.unionByName(b).unionByName(c)


def open_flags(flags: DataFrame) -> DataFrame:
    """Unresolved flags by check and severity, most frequent first."""
    rows = flags.where("resolved_at IS NULL") if "resolved_at" in flags.columns else flags
    return rows.groupBy("check_name", "severity").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "check_name", "severity")


def reconcile(one: DataFrame, other: DataFrame, column: str = "close", key: str = "security_id", order: str = "trade_date") -> DataFrame:
    """Where two sources' series differ, a value missing on one side included."""
    b = other.select(F.col(key).alias("_k"), F.col(order).alias("_o"), F.col(column).alias("other"))
    joined = one.select(key, order, F.col(column).alias("one")).join(b, (F.col(key) == F.col("_k")) & (F.col(order) == F.col("_o")), "full")
    return joined.where(~F.col("one").eqNullSafe(F.col("other"))).select(F.coalesce(key, "_k").alias(key), F.coalesce(order, "_o").alias(order), "one", "other")
