"""High-water marks of incremental loads, run records, and the snapshot of what is stored."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A date that was quarantined so often no longer holds the mark back.
HOLDS = 5
OVERLAP_DAYS = 5
NEW_ENDPOINT, OLD_ENDPOINT = "historical-price-eod/non-split-adjusted", "historical-price-eod/full"


def advance(clean: DataFrame, quarantined: DataFrame, history: DataFrame, holds: int = HOLDS) -> DataFrame:
    """(security_id, watermark): the last clean date before the earliest date that holds it back.

    ``quarantined`` are this run's (security_id, trade_date); ``history`` all flags so far, this
    run's included. A date flagged ``holds`` times lets the mark pass.
    """
    return advance_counted(clean, quarantined, history.groupBy("security_id", "trade_date").agg(F.count(F.lit(1)).alias("n")), holds)


def counted_holds(stored: DataFrame, quarantined: DataFrame) -> DataFrame:
    """How often each (security_id, trade_date) has been flagged: ``stored`` (with n) and this run's flags."""
    news = quarantined.where("trade_date IS NOT NULL").select("security_id", "trade_date", F.lit(1).cast("long").alias("n"))
    return stored.select("security_id", "trade_date", "n").unionByName(news).groupBy("security_id", "trade_date").agg(F.sum("n").alias("n"))


def advance_counted(clean: DataFrame, quarantined: DataFrame, counts: DataFrame, holds: int = HOLDS) -> DataFrame:
    """As ``advance``, from the counts (security_id, trade_date, n) of the flags so far, which need hold no more than this run's dates."""
    seen = counts.select("security_id", "trade_date", F.col("n").alias("_n"))
    holding = quarantined.where("trade_date IS NOT NULL").select("security_id", "trade_date").distinct().join(seen, ["security_id", "trade_date"], "left").where(F.coalesce("_n", F.lit(0)) < holds)
    cut = holding.groupBy("security_id").agg(F.min("trade_date").alias("_cut"))
    rows = clean.select("security_id", "trade_date").join(cut, "security_id", "left")
    return rows.where("_cut IS NULL OR trade_date < _cut").groupBy("security_id").agg(F.max("trade_date").alias("watermark"))


def advance_checked(checked: DataFrame, holds: int = HOLDS) -> DataFrame:
    """As ``advance`` for a load whose own flags are all there are: good and bad rows (those with a ``reason``) in one scan, brought down to days before they meet."""
    days = checked.groupBy("security_id", "trade_date").agg(F.bool_or(F.col("reason").isNull()).alias("_clean"), F.count("reason").alias("_n"))
    holding = F.col("security_id").isNotNull() & (F.col("_n") > 0) & (F.col("_n") < holds)
    cut = days.withColumn("_cut", F.min(F.when(holding, F.col("trade_date"))).over(Window.partitionBy("security_id")))
    return cut.where("_clean AND (_cut IS NULL OR trade_date < _cut)").groupBy("security_id").agg(F.max("trade_date").alias("watermark"))


def merged_watermarks(stored: DataFrame, news: DataFrame) -> DataFrame:
    """Watermarks (source, endpoint, security_id, watermark) that never go back."""
    keys = ["source", "endpoint", "security_id"]
    return stored.select(*keys, "watermark").unionByName(news.select(*keys, "watermark")).groupBy(*keys).agg(F.max("watermark").alias("watermark"))


def windows(watermarks: DataFrame, overlap_days: int = OVERLAP_DAYS) -> DataFrame:
    """Where each security's next load starts."""
    return watermarks.withColumn("start_date", F.date_sub("watermark", overlap_days))


def guard_changeover(watermarks: DataFrame, start: date | None) -> None:
    """Refuses an incremental load where only marks of the old endpoint exist: most history would stay as it was."""
    if start is not None:
        return
    counts = {r["endpoint"]: r["n"] for r in watermarks.where(F.col("endpoint").isin(OLD_ENDPOINT, NEW_ENDPOINT)).groupBy("endpoint").agg(F.count(F.lit(1)).alias("n")).collect()}
    if counts.get(OLD_ENDPOINT) and not counts.get(NEW_ENDPOINT):
        raise RuntimeError("prices of the old endpoint are stored; give a start date to load them anew")


def guard_load(symbols: int, unknown: int, bars: int, explicit_window: bool) -> None:
    """Raises where a load that looks successful can't have been."""
    if not symbols:
        raise RuntimeError("no symbols to load")
    if unknown == symbols:
        raise RuntimeError("none of the symbols is known; load securities first")
    if explicit_window and not bars:
        raise RuntimeError("no bars at all in the window asked for")


def finished_run(started: DataFrame, inserted: int, quarantined: int, error: str | None = None) -> DataFrame:
    """The run's record at its end: failed with an error, partial with quarantined rows, else success."""
    status = "failed" if error else "partial" if quarantined else "success"
    return started.withColumns({"status": F.lit(status), "ended_at": F.current_timestamp(), "rows_inserted": F.lit(inserted).cast("long"), "rows_quarantined": F.lit(quarantined).cast("long"), "error": F.lit(error).cast("string")})


def status_counts(securities: DataFrame, bars: DataFrame, actions: DataFrame, flags: DataFrame) -> DataFrame:
    """One row of totals."""
    a = securities.agg(F.count(F.lit(1)).alias("securities"), F.count_if(F.col("is_actively_trading")).alias("active"), F.count_if(F.col("delisted_date").isNotNull()).alias("delisted"))
    b = bars.agg(F.count(F.lit(1)).alias("price_rows"), F.max("trade_date").alias("latest"))
    c = actions.agg(F.count(F.lit(1)).alias("actions"))
    d = flags.agg(F.count(F.lit(1)).alias("open_flags"))
    return a.crossJoin(b).crossJoin(c).crossJoin(d)


def bars_per_month(bars: DataFrame) -> DataFrame:
    """Loaded rows and volume by month."""
    return bars.groupBy(F.date_trunc("month", "trade_date").cast("date").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.sum("volume").alias("volume"))
