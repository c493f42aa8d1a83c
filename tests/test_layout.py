"""Tables laid out in years and buckets: what their plans shuffle and read."""

from datetime import date
from uuid import uuid4

import pytest
from helpers import rows_of

from tickerforge.operators import adjust, dq
from tickerforge.sources import layout, market


@pytest.fixture
def tables(spark, sf_dir):
    """Bars and actions as they are, and laid out; joins by hash or by sorting, as of large tables."""
    before = {k: spark.conf.get(k) for k in (layout.CO_PARTITION, "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set(layout.CO_PARTITION, "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    names, frames = [f"t{uuid4().hex}" for _ in range(2)], [market.bars(spark, sf_dir), market.actions(spark, sf_dir)]
    yield frames, [layout.lay_out(f, n, t) for f, n, t in zip(frames, names, ("trade_date", "ex_date"))]
    for n in names:
        spark.sql(f"DROP TABLE {n}")
    for k, v in before.items():
        spark.conf.set(k, v)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_windows_and_joins_take_the_buckets_as_they_lie(tables):
    (bars, actions), (laid_bars, laid_actions) = tables
    found = dq.outliers(laid_bars, laid_actions)
    assert "Exchange" not in plan(found) and "Exchange" in plan(dq.outliers(bars, actions))
    assert rows_of(found) == rows_of(dq.outliers(bars, actions))

    factors = adjust.adjustment_factors_exact(actions, bars).cache()
    adjusted = adjust.adjusted_bars(laid_bars, factors)
    assert plan(adjusted).count("Exchange hashpartitioning") < plan(adjust.adjusted_bars(bars, factors)).count("Exchange hashpartitioning")
    assert rows_of(adjusted) == rows_of(adjust.adjusted_bars(bars, factors))


def test_only_the_years_asked_for_are_read(spark, tables):
    (bars, _), (laid, _) = tables
    some = layout.between(laid, date(1996, 3, 1), date(1997, 2, 28)).select("security_id", "close")
    text = plan(some)
    assert "PartitionFilters: [isnotnull(year" in text and "volume" not in text.split("ReadSchema")[1]
    assert {f.split("year=")[1][:4] for f in some.inputFiles()} == {"1996", "1997"}
    assert rows_of(some) == rows_of(bars.where("trade_date BETWEEN DATE '1996-03-01' AND DATE '1997-02-28'").select("security_id", "close"))
    none = layout.lay_out(bars.limit(0), f"t{uuid4().hex}")
    assert none.count() == 0
