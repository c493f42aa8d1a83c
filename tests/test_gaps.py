"""Gaps from bitmaps of days, whole and kept up by loads, against plain sets of dates."""

import random
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import functions as F

from tickerforge.operators import dq, trading_calendar


def test_gaps_are_those_of_sets_and_of_any_order_of_loads(spark):
    rng = random.Random(9)
    cal = trading_calendar.trading_calendar(spark, 1969, 1972)
    open_days = sorted(r["trade_date"] for r in cal.where("exchange_code = 'NASDAQ'").collect())
    rows = []
    for s, share in ((1, 0.95), (2, 0.02), (3, 0.5), (None, 0.9)):
        low = rng.randrange(300)
        rows += [(s, d) for d in open_days[low : low + 600] if rng.random() < share]
    rows += [(4, date(1970, 5, 4)), (5, date(1970, 5, 2)), (5, date(1970, 5, 10)), (6, date(1969, 12, 31)), (6, date(1972, 12, 29)), (7, None)]  # one day, weekends, years without a bar, no date
    rows += [(8, date(1970, 1, 1) + timedelta(64 * k + 63)) for k in range(-5, 6)]  # last days of words
    bars = spark.createDataFrame(rows, "security_id int, trade_date date")
    want = set()
    for s in {s for s, _ in rows}:
        have = {d for t, d in rows if t == s and d}
        want |= {(s, d) for d in open_days if have and min(have) <= d <= max(have)} - {(s, d) for d in have}
    got = [tuple(r) for r in dq.gaps(bars, cal).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 1000

    shuffled = bars.withColumn("load", F.floor(F.rand(4) * 5)).cache()
    kept = reduce(dq.merged_presence, [dq.present(shuffled.where(F.col("load") == k), ["security_id"]) for k in range(5)])
    assert {tuple(r) for r in dq.gaps_of(kept, cal).collect()} == want
    assert kept.count() < 60 * 6 and dq.gaps(bars.limit(0), cal).count() == 0
