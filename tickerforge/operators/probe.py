"""Is a price feed adjusted? Two feeds and the recorded splits give a verdict per security."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How far two ratios may be apart, relative to the expected one.
TOLERANCE = 0.02


def split_ratio_after(splits: DataFrame, day: Column | str) -> DataFrame:
    """(security_id, split_ratio): the product of numerator/denominator of the splits after ``day``; invalid ones don't count."""
    d = F.lit(day).cast("date") if isinstance(day, str) else day
    valid = splits.where((F.col("ex_date") > d) & (F.col("split_numerator") > 0) & (F.col("split_denominator") > 0))
    return valid.groupBy("security_id").agg(F.product(F.col("split_numerator") / F.col("split_denominator")).alias("split_ratio"))


def _close_to(value: Column, goal: Column | float) -> Column:
    goal = F.lit(goal) if isinstance(goal, (int, float)) else goal
    return F.abs(value - goal) / goal <= TOLERANCE


def price_verdict(raw: Column, adjusted: Column, ratio: Column) -> Column:
    implied = raw / adjusted
    return (
        F.when(raw.isNull() | adjusted.isNull() | (adjusted <= 0) | (ratio == 1), "inconclusive")
        .when(_close_to(implied, ratio), "unadjusted_confirmed")
        .when(F.abs(implied - 1) <= TOLERANCE, "feeds_agree")
        .otherwise("ratio_mismatch")
    )


def volume_verdict(raw: Column, adjusted: Column, raw_unadjusted: Column, adjusted_unadjusted: Column, ratio: Column) -> Column:
    """Texts in, as feeds give them: is the unadjusted feed's volume raw?"""
    given = F.nullif(raw_unadjusted, F.lit(""))
    own, other = given.try_cast("double"), F.coalesce(raw_unadjusted, adjusted_unadjusted).try_cast("double")
    r, a = raw.try_cast("double"), adjusted.try_cast("double")
    implied = a / r
    return (
        F.when(own >= 0, "volume_raw_confirmed")
        .when(given.isNotNull(), "volume_unusable")
        .when(r.isNull() | a.isNull() | (r <= 0) | (a <= 0), "inconclusive")
        .when((ratio != 1) & _close_to(implied, ratio), "volume_raw_confirmed")
        .when(F.abs(implied - 1) <= TOLERANCE, F.when(other > 0, F.when(_close_to(r, other), "volume_raw_confirmed").otherwise("volume_adjusted")).otherwise("volume_ambiguous"))
        .otherwise("volume_ratio_mismatch")
    )


def probe(raw: DataFrame, adjusted: DataFrame, splits: DataFrame, day: str, window_days: int = 10) -> DataFrame:
    """Per security: the raw feed's first bar from ``day`` on, the other feed's bar of that very date, and the verdict."""
    start = F.lit(day).cast("date")
    anchor = raw.where((F.col("trade_date") >= start) & (F.col("trade_date") <= F.date_add(start, window_days))).groupBy("security_id").agg(F.min("trade_date").alias("compared_date"), F.min_by("close", "trade_date").alias("unadjusted_close"))
    same = adjusted.select(F.col("security_id").alias("_s"), F.col("trade_date").alias("_t"), F.col("close").alias("split_adjusted_close"))
    pairs = anchor.join(same, (F.col("security_id") == F.col("_s")) & (F.col("compared_date") == F.col("_t")), "left").drop("_s", "_t")
    rows = pairs.join(split_ratio_after(splits, day), "security_id", "left").withColumn("split_ratio", F.coalesce("split_ratio", F.lit(1.0)))
    implied = F.when(F.col("split_adjusted_close") > 0, F.col("unadjusted_close") / F.col("split_adjusted_close"))
    return rows.withColumn("implied_ratio", implied).withColumn("verdict", price_verdict(F.col("unadjusted_close"), F.col("split_adjusted_close"), F.col("split_ratio")))


def report(row: dict) -> str:
    """A probe's row as text."""
    return "\n".join(f"{name.replace('_', ' ')}: {row.get(name)}" for name in ("security_id", "compared_date", "unadjusted_close", "split_adjusted_close", "split_ratio", "implied_ratio", "verdict"))
