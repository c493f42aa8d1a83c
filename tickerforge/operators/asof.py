"""As-of joins, strict on both sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerforge.operators.blocks import BLOCK, WIDTH, block_of, carried


def _not_after(steps: Column, time: Column) -> Column:
    """How many of the sorted steps are not after the time, by binary search."""
    halves = F.transform(F.sequence(F.floor(F.log2(F.greatest(F.size(steps), F.lit(1)))).cast("int"), F.lit(0), F.lit(-1)), lambda k: F.pow(F.lit(2), k).cast("int"))
    return F.aggregate(halves, F.lit(0), lambda n, half: F.when(F.get(steps, n + half - 1)["_at"] <= time, n + half).otherwise(n))


def asof_next(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, values: list[str], width: int = WIDTH) -> DataFrame:
    """Each left row with ``values`` of the key's right row of the smallest ``right_time`` after ``left_time``; nulls if there is none.

    The right side becomes one sorted array for each key and block of ``width`` days, with the first step after the block
    beside it; blocks without steps get a row too, from the left side's first block to the key's last. The left side is
    joined once on key and block, and looks as often as the size of its array has binary digits: one row stays one
    row, a hot key is split, and a small right side needs no shuffle of the left.
    """
    steps = right.where(F.col(right_time).isNotNull())
    at = F.struct(F.col(right_time).alias("_at"), *values)
    held = steps.withColumn("_b", block_of(right, right_time, width)).groupBy(F.col(key).alias("_k"), "_b").agg(F.array_sort(F.collect_list(at)).alias("_steps"))
    rows = left.withColumn(BLOCK, block_of(left, left_time, width))
    in_key = Window.partitionBy("_k").orderBy("_b")
    first = rows.agg(F.min(BLOCK).alias("_low"))
    around = held.crossJoin(F.broadcast(first)).select("_k", "_b", "_steps", F.lead(F.col("_steps")[0]).over(in_key).alias("_then"), F.coalesce(F.lag("_b").over(in_key) + 1, F.least("_low", "_b")).alias("_from"))
    own = F.struct(F.col("_b").alias("_b"), F.col("_steps").alias("_steps"), F.col("_then").alias("_then"))
    empty = F.transform(F.filter(F.sequence("_from", "_b"), lambda b: b < F.col("_b")), lambda b: F.struct(b.alias("_b"), F.slice("_steps", 1, 0).alias("_steps"), F.col("_steps")[0].alias("_then")))
    table = around.select("_k", F.explode(F.concat(F.array(own), empty)).alias("_x")).select("_k", "_x.*")
    after = F.coalesce(F.get("_steps", _not_after(F.col("_steps"), F.col(left_time))), F.col("_then"))
    joined = rows.join(table, (F.col(key) == F.col("_k")) & (F.col(BLOCK) == F.col("_b")), "left").withColumn("_hit", after)
    return joined.select(*[F.col(c) for c in left.columns], *[F.col("_hit")[v].alias(v) for v in values])


def asof_prev(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, values: list[str], width: int = WIDTH) -> DataFrame:
    """Each left row with ``values`` of the key's right row of the largest ``right_time`` before ``left_time``; nulls if there is none.

    Both sides are laid end to end and cut into blocks of ``width`` days; in a block the last right row is carried
    forward, and into it the last one of the blocks before. At equal times left rows come first, which makes
    the comparison strict.
    """
    seen = right.select(key, F.col(right_time).alias("_at"), F.lit(1).alias("_side"), F.struct(*values).alias("_value"), F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType).alias("_row"))
    asks = left.select(key, F.col(left_time).alias("_at"), F.lit(0).alias("_side"), F.lit(None).cast(seen.schema["_value"].dataType).alias("_value"), F.struct(*left.columns).alias("_row"))
    both = asks.unionByName(seen)
    both = both.withColumn(BLOCK, block_of(both, "_at", width))
    last = both.groupBy(key, BLOCK).agg(F.max_by("_value", F.when(F.col("_side") == 1, F.col("_at"))).alias("_last"))
    before = Window.partitionBy(key).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(key, BLOCK, F.last("_last", ignorenulls=True).over(before).alias("_last"))
    inside = Window.partitionBy(key, BLOCK).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = carried(both.withColumn("_value", F.last("_value", ignorenulls=True).over(inside)).where("_side = 0"), carry, key).withColumn("_value", F.coalesce("_value", "_last"))
    return found.select("_row.*", *[F.col("_value")[v].alias(v) for v in values])
