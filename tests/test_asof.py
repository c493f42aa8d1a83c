"""As-of joins against plain search, over blocks and with very many steps of one key."""

import bisect
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tickerforge.operators import asof

DAY = date(2000, 1, 1)


def frames(spark, rng):
    left = [(rng.choice([1, 2, 3, None]), rng.choice([None, *[DAY + timedelta(rng.randrange(3000)) for _ in range(20)]]), k) for k in range(600)]
    right = [(s, DAY + timedelta(d), float(d)) for s in (1, 2) for d in rng.sample(range(0, 3000, 1 + s), 200)]
    return left, right, spark.createDataFrame(left, "k int, t date, n int"), spark.createDataFrame(right, "k int, at date, v double")


@pytest.mark.parametrize("width", [3650, 100, 7])
def test_both_ways_are_plain_search(spark, width):
    left, right, l, r = frames(spark, random.Random(width))
    steps = {s: sorted((a, v) for k, a, v in right if k == s) for s in (1, 2)}

    def plain(k, t, forward):
        found = steps.get(k, []) if t else []
        at = bisect.bisect_right([a for a, _ in found], t) if forward else bisect.bisect_left([a for a, _ in found], t) - 1
        return found[at][1] if 0 <= at < len(found) else None

    after = asof.asof_next(l, r, "k", "t", "at", ["v"], width)
    before = asof.asof_prev(l, r, "k", "t", "at", ["v"], width)
    assert after.columns == before.columns == ["k", "t", "n", "v"]
    for frame, forward in ((after, True), (before, False)):
        assert sorted((x["n"], x["v"]) for x in frame.collect()) == [(n, plain(k, t, forward)) for k, t, n in left]


def test_a_key_with_a_million_steps(spark):
    """By number: every step is even, and every row asks at an odd place or on a step."""
    steps = spark.range(1_000_000).select(F.lit(1).alias("k"), (F.col("id") * 2).alias("at"), F.col("id").alias("v"))
    asks = spark.range(0, 2_000_000, 997).select(F.lit(1).alias("k"), F.col("id").alias("t"))
    wrong = asof.asof_next(asks, steps, "k", "t", "at", ["v"], 1000).where(~F.col("v").eqNullSafe(F.when(F.col("t") < 1_999_998, F.floor(F.col("t") / 2) + 1)))
    assert wrong.count() == 0
    found = asof.asof_prev(asks, steps, "k", "t", "at", ["v"], width=10_000)
    assert found.where(~F.col("v").eqNullSafe(F.when(F.col("t") > 0, F.floor((F.col("t") - 1) / 2)))).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "_block" in plan and found.count() == asks.count()
