"""Scans in blocks against scans of whole series."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickerforge.operators import blocks, indicators, returns


@pytest.fixture(scope="module")
def long_series(spark):
    """One hot series over some fifty blocks of 40 days, two short ones, and one of nulls; a run of nulls covers whole blocks."""
    rng = np.random.default_rng(12)
    rows = []
    for s, n in ((1, 2000), (2, 30), (3, 1), (4, 90), (None, 100)):
        x = 50 + np.cumsum(rng.normal(size=n))
        x[rng.random(n) < 0.1] = np.nan
        if s == 1:
            x[300:500], x[:3] = np.nan, np.nan
            x[700:720] = x[700]
        if s == 4:
            x[:] = np.nan
        days = pd.Timestamp("2000-01-01") + pd.to_timedelta(np.arange(n), "D")
        rows += [(s, d.date(), None if np.isnan(v) else float(v)) for d, v in zip(days, x)]
    return spark.createDataFrame(rows, "security_id int, trade_date date, close double").repartition(7)


def by_series(frame):
    pdf = frame.toPandas()
    pdf["security_id"] = pdf["security_id"].fillna(-1)
    pdf = pdf.sort_values(["security_id", "trade_date"])
    return {k: g.reset_index(drop=True) for k, g in pdf.groupby("security_id")}


def same(found, want):
    for k, g in by_series(found).items():
        for c, values in want(by_series_of[k]).items():
            assert np.allclose(g[c].to_numpy(float), values.to_numpy(float), rtol=1e-9, atol=1e-9, equal_nan=True), (k, c)


by_series_of = {}


@pytest.fixture(scope="module", autouse=True)
def plain(long_series):
    by_series_of.update(by_series(long_series))


def ewm(x, alpha, warm, adjust=False):
    return x.ewm(alpha=alpha, adjust=adjust, min_periods=warm, ignore_na=False).mean()


@pytest.mark.parametrize("adjust", [False, True])
@pytest.mark.parametrize("width", [40, 7, 100_000])
def test_ema(long_series, adjust, width):
    found = indicators.ema(long_series, ["close"], 5, adjust, width=width)
    assert found.columns == ["security_id", "trade_date", "close_ema_5"]
    same(found, lambda g: {"close_ema_5": ewm(g["close"], 2 / 6, 5, adjust)})


def test_rsi(long_series):
    def want(g):
        step = g["close"].diff()
        gain, loss = ewm(step.clip(lower=0), 1 / 14, 14), ewm((-step).clip(lower=0), 1 / 14, 14)
        return {"close_rsi_14": (100 - 100 / (1 + gain / loss.replace(0, np.nan))).mask((loss == 0) & (gain > 0), 100.0)}

    same(indicators.rsi(long_series, ["close"], width=40), want)


def test_macd(long_series):
    def want(g):
        line = ewm(g["close"], 2 / 13, 12) - ewm(g["close"], 2 / 27, 26)
        mean = ewm(line, 2 / 10, 9)
        return {"close_macd": line, "close_macd_signal": mean, "close_macd_hist": line - mean}

    same(indicators.macd(long_series, ["close"], width=40), want)


def test_cumulative_returns(long_series):
    def want(g):
        r = g["close"] / g["close"].shift() - 1
        return {"close_simple_ret": r, "close_simple_ret_cum": ((1 + r).cumprod() - 1), "close_log_ret_cum": np.log(1 + r).cumsum()}

    found = returns.cumulative(returns.cumulative(long_series, ["close"], "simple", width=40), ["close"], "log", width=40)
    same(found, want)


def test_previous_and_counts(long_series):
    same(blocks.previous(long_series, ["close"], width=40), lambda g: {"close_before": g["close"].shift()})
    same(blocks.running(long_series, {"n": ("close", "count"), "s": ("close", "sum")}, width=40), lambda g: {"n": g["close"].expanding().count(), "s": g["close"].cumsum().ffill()})


def test_a_hot_series_is_split(spark, long_series):
    """Rows are dealt by series and block, and only summaries by series."""
    found = indicators.ema(long_series.where("security_id = 1"), ["close"], 5, width=40)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(security_id" in plan and "_block" in plan
    spread = long_series.where("security_id = 1").withColumn("b", blocks.block_of(long_series, "trade_date", 40)).groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    assert spread.count() >= 50 and spread.agg(F.max("n")).first()[0] <= 40
    assert indicators.ema(long_series.limit(0), ["close"]).count() == 0


@pytest.mark.parametrize("adjust", [False, True])
@pytest.mark.parametrize("width, rows", [(40, 7), (100_000, 7), (7, 10_000), (100, 3)])
def test_blocks_go_on_from_batch_to_batch(spark, long_series, adjust, width, rows):
    """Batches end within blocks, within runs of nulls and at their edges; several means of one column have states of their own."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        made = {"a": ("close", 0.2, 3), "b": ("close", 0.5, 1), "c": ("other", 1 / 14, 14)}
        found = blocks.exponential_means(long_series.withColumn("other", -F.col("close")), made, adjust, ("close",), width=width)
        same(found, lambda g: {"a": ewm(g["close"], 0.2, 3, adjust), "b": ewm(g["close"], 0.5, 1, adjust), "c": ewm(-g["close"], 1 / 14, 14, adjust), "close": g["close"]})
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_series_are_scanned_many_at_a_time_and_dealt_once(spark, long_series):
    """No call a series, and a mean of means reads what the first one made once: its rows are dealt once for both of their scans."""
    found = indicators.macd(long_series, ["close"], width=40)
    found.write.format("noop").mode("overwrite").save()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan and "MapInArrow" in plan
    found.collect()
    final = found._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in final.split("== Initial Plan ==")[0]


def test_an_ema_makes_no_call_a_series(spark, sf_dir):
    from tickerforge.plans import prices

    assert "FlatMapGroupsInPandas" not in prices.ema(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("width, rows", [(40, 7), (7, 10_000), (100, 3), (100_000, 50)])
def test_a_mean_of_means_goes_through_the_rows_as_they_were_dealt(spark, long_series, width, rows):
    """No row that holds a mean is dealt again: below the last scan there are closes and summaries of blocks alone."""

    def want(g):
        line = ewm(g["close"], 2 / 13, 12) - ewm(g["close"], 2 / 27, 26)
        mean = ewm(line, 2 / 10, 9)
        return {"close_macd": line, "close_macd_signal": mean, "close_macd_hist": line - mean}

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        found = indicators.macd(long_series, ["close"], width=width)
        same(found, want)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    dealt = found._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression", 1)[1]
    assert "fast" not in dealt and "macd" not in dealt


def test_rows_are_not_sorted_to_meet_what_enters_their_block(spark, long_series):
    """The carries, a row a block, are looked up by hash: rows are sorted for the scans alone."""
    for found, joins in ((indicators.ema(long_series, ["close"], width=40), 1), (indicators.macd(long_series, ["close"], width=40), 2)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ShuffledHashJoin [struct(") == joins and "SortMergeJoin [struct(" not in plan
