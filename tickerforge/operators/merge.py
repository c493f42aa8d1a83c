"""Upserts as read-merge-write: each function takes the stored table and the news and returns the new table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def insert_missing(stored: DataFrame, news: DataFrame, keys: list[str]) -> DataFrame:
    """The stored rows and those of the news whose key isn't there; existing rows stay as they are."""
    return stored.unionByName(news.select(*stored.columns).dropDuplicates(keys).join(stored.select(*keys), keys, "left_anti"))


def last_write(frame: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """One row per key, that of the highest ordinal."""
    order = Window.partitionBy(*keys).orderBy(F.desc(ordinal))
    return frame.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def upsert(stored: DataFrame, news: DataFrame, keys: list[str], ordinal: str | None = None) -> DataFrame:
    """The table after the news: the last write to a key wins, within the news by ``ordinal``."""
    fresh = last_write(news, keys, ordinal) if ordinal else news.dropDuplicates(keys)
    fresh = fresh.select(*stored.columns)
    return stored.join(fresh.select(*keys), keys, "left_anti").select(*stored.columns).unionByName(fresh)


def replace_groups(stored: DataFrame, news: DataFrame, key: str, affected: DataFrame | None = None) -> DataFrame:
    """The stored rows of other keys, and the news.

    The rows of all ``affected`` keys go, also of those that have no news (without it: the keys of the news).
    """
    gone = (news if affected is None else affected.select(key).unionByName(news.select(key))).select(key).distinct()
    return stored.join(gone, key, "left_anti").select(*stored.columns).unionByName(news.select(*stored.columns))


def upsert_profile(stored: DataFrame, news: DataFrame, ordinal: str | None = None) -> DataFrame:
    """Company profiles by security: a new description replaces the stored one, a null one too."""
    return upsert(stored, news, ["security_id"], ordinal)


#: Fields that keep their stored value where the news have none.
PRESERVED = ["market_cap_usd", "beta", "ipo_date", "cik", "isin", "cusip"]
IDENTITY = ["source", "primary_symbol", "exchange_code"]


def upsert_securities(stored: DataFrame, news: DataFrame) -> DataFrame:
    """The security master after a load.

    Only listed rows can be met, so a ticker that is used again gets an id of its own. New ids
    follow the highest one in the order of their keys. All but PRESERVED fields are overwritten,
    sector and industry too, which a load without them blanks.
    """
    fields = [c for c in stored.columns if c not in ("security_id", *IDENTITY)]
    listed, gone = stored.where("delisted_date IS NULL"), stored.where("delisted_date IS NOT NULL")
    fresh = news.dropDuplicates(IDENTITY).select(*[F.col(c).alias(f"_{c}") for c in IDENTITY], *[(F.col(c) if c in news.columns else F.lit(None).cast(dict(stored.dtypes)[c])).alias(f"_{c}") for c in fields], F.lit(True).alias("_new"))
    same = (F.col("source") == F.col("_source")) & (F.col("primary_symbol") == F.col("_primary_symbol")) & (F.coalesce("exchange_code", F.lit("")) == F.coalesce("_exchange_code", F.lit("")))
    merged = listed.join(fresh, same, "full")
    values = [F.when(F.col("_new").isNull(), F.col(c)).otherwise(F.coalesce(f"_{c}", c) if c in PRESERVED else F.col(f"_{c}")).alias(c) for c in fields]
    rows = merged.select("security_id", *[F.coalesce(c, f"_{c}").alias(c) for c in IDENTITY], *values)
    known = rows.where("security_id IS NOT NULL").select(*stored.columns)
    return known.unionByName(gone).unionByName(minted(rows.where("security_id IS NULL"), stored).select(*stored.columns))


def minted(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """``rows`` with ids after the highest stored one, in the order of their keys.

    Ids are dense: the keys are ranged and each range's count added up, so no task sees all rows.
    """
    highest = stored.agg(F.coalesce(F.max("security_id"), F.lit(0)).alias("_top"))
    part = F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in IDENTITY]), 256), 1, 3)
    placed = rows.drop("security_id").withColumn("_part", part)
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))  # 4096 rows at most
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*IDENTITY))
    return placed.withColumn("_in", inside).join(starts, F.col("_part") == F.col("_p")).crossJoin(F.broadcast(highest)).withColumn("security_id", (F.col("_top") + F.col("_start") + F.col("_in")).cast("long"))


def upsert_xref(stored: DataFrame, news: DataFrame) -> DataFrame:
    """Ticker periods after new ones (security_id, symbol, valid_from, is_primary).

    Without a ``valid_from`` a period starts the day after the ticker's last closed one, or in 1900.
    A period that is there already is changed only while it is open.
    """
    closed = stored.where("valid_to IS NOT NULL").groupBy("symbol").agg(F.max("valid_to").alias("_last"))
    start = F.coalesce("valid_from", F.date_add("_last", 1), F.lit("1900-01-01").cast("date"))
    fresh = news.join(closed, "symbol", "left").select("security_id", "symbol", start.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), "is_primary").dropDuplicates(["symbol", "valid_from"])
    shut = stored.where("valid_to IS NOT NULL")
    allowed = fresh.join(shut.select("symbol", "valid_from"), ["symbol", "valid_from"], "left_anti")
    return upsert(stored, allowed, ["symbol", "valid_from"])


def mark_delisted(securities: DataFrame, xref: DataFrame, delisted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables after the delistings (security_id, delisted_date); a delisting is never changed again."""
    d = delisted.groupBy("security_id").agg(F.min("delisted_date").alias("_d"))
    joined = securities.join(d, "security_id", "left")
    now = F.col("delisted_date").isNull() & F.col("_d").isNotNull()
    changed = joined.withColumn("is_actively_trading", F.when(now, False).otherwise(F.col("is_actively_trading"))).withColumn("delisted_date", F.coalesce("delisted_date", "_d"))
    fresh = joined.where(now).select(F.col("security_id").alias("_s"), "_d")
    periods = xref.join(fresh, F.col("security_id") == F.col("_s"), "left")
    shut = periods.withColumn("valid_to", F.when(F.col("valid_to").isNull() & (F.col("valid_from") <= F.col("_d")), F.col("_d")).otherwise(F.col("valid_to")))
    return changed.select(*securities.columns), shut.select(*xref.columns)


def enriched(stored: DataFrame, profiles: DataFrame) -> DataFrame:
    """Securities with market value and beta of their profiles, where a profile has either."""
    p = profiles.where("market_cap_usd IS NOT NULL OR beta IS NOT NULL").select(F.col("security_id").alias("_s"), F.col("market_cap_usd").alias("_m"), F.col("beta").alias("_b"))
    joined = stored.join(p, F.col("security_id") == F.col("_s"), "left")
    hit = F.col("_s").isNotNull()
    return joined.withColumn("market_cap_usd", F.when(hit, F.col("_m")).otherwise(F.col("market_cap_usd"))).withColumn("beta", F.when(hit, F.col("_b")).otherwise(F.col("beta"))).select(*stored.columns)
