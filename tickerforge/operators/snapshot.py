"""The snapshot of securities and the totals by month, kept up by each load from the bars that it touched.

A load's bars, one for each key, are met with the stored bars of the same keys alone. That tells new keys from
corrections, so counts and sums move by differences and the latest bar by comparison with the one kept: nothing else
that is stored is read. Bars are never taken away by a load; where they are, ``rebuilt`` makes the touched
securities anew from their own bars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerforge.operators.merge import replace_groups

KEYS = ["security_id", "trade_date"]
LATEST = "security_id long, n_bars long, last_trade_date date, last_close double, last_volume long"
MONTHS = "month date, n long, volume long"


def changes(stored: DataFrame, news: DataFrame) -> DataFrame:
    """The news, which have one bar for each key, with ``added`` (1 if the key is new, else 0) and ``more``, by how much the volume grows.

    ``stored`` are the bars before the load and need hold no more than the keys of the news. A volume that is null counts as 0.
    """
    before = stored.select(*KEYS, F.coalesce("volume", F.lit(0)).cast("long").alias("_was"))
    rows = news.select(*KEYS, "close", F.col("volume").cast("long").alias("volume")).join(before, KEYS, "left")
    return rows.select(*KEYS, "close", "volume", F.when(F.col("_was").isNull(), 1).otherwise(0).cast("long").alias("added"), (F.coalesce("volume", F.lit(0)) - F.coalesce("_was", F.lit(0))).alias("more"))


def latest_of(changed: DataFrame) -> DataFrame:
    """(security_id, n_bars, last_trade_date, last_close, last_volume) of the changes of one load."""
    last = F.max_by(F.struct(F.col("trade_date").alias("last_trade_date"), F.col("close").alias("last_close"), F.col("volume").alias("last_volume")), "trade_date")
    return changed.groupBy("security_id").agg(F.sum("added").alias("n_bars"), last.alias("_b")).select("security_id", "n_bars", "_b.*")


def merged_latest(kept: DataFrame, delta: DataFrame) -> DataFrame:
    """The kept rows after a load; on one date the load's bar is the newer one."""
    columns = ["security_id", "n_bars", "last_trade_date", "last_close", "last_volume"]
    both = kept.select(*columns, F.lit(0).alias("_s")).unionByName(delta.select(*columns, F.lit(1).alias("_s")))
    last = F.max_by(F.struct(*columns[2:]), F.struct("last_trade_date", "_s"))
    return both.groupBy("security_id").agg(F.sum("n_bars").alias("n_bars"), last.alias("_b")).select("security_id", "n_bars", "_b.*")


def months_of(changed: DataFrame) -> DataFrame:
    """(month, n, volume): by how much a load moves the bars and the volume of each month."""
    return changed.groupBy(F.date_trunc("month", "trade_date").cast("date").alias("month")).agg(F.sum("added").alias("n"), F.sum("more").alias("volume"))


def merged_months(kept: DataFrame, delta: DataFrame) -> DataFrame:
    return kept.select("month", "n", "volume").unionByName(delta.select("month", "n", "volume")).groupBy("month").agg(F.sum("n").alias("n"), F.sum("volume").alias("volume"))


def whole(bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Latest bars and months of a whole table of bars, which has one row for each key."""
    changed = changes(bars.limit(0), bars)
    return latest_of(changed), months_of(changed)


def rebuilt(kept: DataFrame, bars: DataFrame, touched: DataFrame) -> DataFrame:
    """The kept rows, those of the ``touched`` securities made anew from their bars; one without bars goes."""
    again = bars.join(touched.select("security_id").distinct(), "security_id", "left_semi")
    return replace_groups(kept, whole(again)[0], "security_id", touched)


def security_latest(securities: DataFrame, kept: DataFrame) -> DataFrame:
    """Each security with its kept row; nulls without a bar, and no bars counted."""
    last = ["last_trade_date", "last_close", "last_volume"]
    return securities.join(kept.select("security_id", "n_bars", *last), "security_id", "left").select(*securities.columns, F.coalesce("n_bars", F.lit(0)).cast("long").alias("n_bars"), *last)
