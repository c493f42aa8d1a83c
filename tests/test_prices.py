import datetime as dt
import math
from decimal import Decimal

import pytest
from helpers import duck, rows_of
from pyspark.sql import functions as F

from tickerforge.operators import adjust, indicators, resample, returns
from tickerforge.operators.asof import asof_next
from tickerforge.plans import prices
from tickerforge.sources import market

D = dt.date


def series(spark, values, start=D(2023, 1, 1)):
    rows = [(1, start + dt.timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "security_id long, trade_date date, close double")


def values(frame, column):
    return [r[column] for r in frame.orderBy("trade_date").collect()]


def bars(spark, closes, start=D(2023, 5, 31)):
    rows = [(1, start + dt.timedelta(days=i), Decimal(str(c)), Decimal(str(c)), Decimal(str(c)), Decimal(str(c)), 1000) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "security_id long, trade_date date, open decimal(20,6), high decimal(20,6), low decimal(20,6), close decimal(20,6), volume long")


ACTION = "security_id long, ex_date date, action_type string, split_numerator double, split_denominator double, dividend_amount double"


def test_split_halves_what_came_before(spark):
    b, a = bars(spark, [100, 100, 50]), spark.createDataFrame([(1, D(2023, 6, 2), "split", 2.0, 1.0, None)], ACTION)
    out = adjust.adjusted_bars_exact(b, adjust.adjustment_factors_exact(a, b))
    assert values(out, "close") == [50, 50, 50]
    assert values(out, "volume") == [2000, 2000, 1000]


def test_dividend_uses_the_close_before(spark):
    b, a = bars(spark, [100, 99]), spark.createDataFrame([(1, D(2023, 6, 1), "dividend", None, None, 1.0)], ACTION)
    assert values(adjust.adjusted_bars_exact(b, adjust.adjustment_factors_exact(a, b)), "close") == [99, 99]


def test_dividends_without_a_price_or_above_it_are_skipped(spark):
    b = bars(spark, [100, 99])
    a = spark.createDataFrame([(1, D(2023, 5, 31), "dividend", None, None, 1.0), (1, D(2023, 6, 1), "dividend", None, None, 100.0)], ACTION)
    events = adjust.event_factors(a, b)
    assert sorted(r["skipped"] for r in events.collect()) == ["dividend_exceeds_price", "dividend_no_prior_close"]
    assert adjust.adjustment_factors(a, b).count() == 0


def test_four_splits_make_112(spark):
    b = bars(spark, ["39.2"], D(1990, 1, 2))
    a = spark.createDataFrame([(1, D(y, 6, 1), "split", n, 1.0, None) for y, n in ((2000, 2.0), (2005, 2.0), (2014, 7.0), (2020, 4.0))], ACTION)
    row = adjust.adjusted_bars_exact(b, adjust.adjustment_factors_exact(a, b)).first()
    assert abs(row["close"] - Decimal("0.35")) < Decimal("1e-8") and row["volume"] == 112000


def test_adjusted_volume_may_exceed_64_bits(spark):
    b = bars(spark, [100]).withColumn("volume", F.lit(9 * 10**18))
    a = spark.createDataFrame([(1, D(2023, 6, 2), "split", 2.0, 1.0, None)], ACTION)
    assert adjust.adjusted_bars_exact(b, adjust.adjustment_factors_exact(a, b)).first()["volume"] == 18 * 10**18


def test_asof_is_strict(spark):
    left = spark.createDataFrame([(1, D(2023, 1, d)) for d in (1, 2, 3)], "k long, t date")
    right = spark.createDataFrame([(1, D(2023, 1, 2), "a"), (1, D(2023, 1, 3), "b")], "k long, e date, v string")
    assert [r["v"] for r in asof_next(left, right, "k", "t", "e", ["v"]).orderBy("t").collect()] == ["a", "b", None]


def test_adjusted_view_at_scale_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    c = duck(sf)
    got = rows_of(prices.price_history_adjusted(spark, sf).select("security_id", "trade_date", "close"))
    from tickerforge.plans.registry import ORACLES

    assert got == sorted(c.execute(f"SELECT close, security_id, trade_date FROM ({ORACLES['price_history_adjusted']})").fetchall(), key=repr)


def test_half_years_count_from_the_first_month(spark):
    days = [D(2023, 1, 31), D(2023, 2, 15), D(2023, 7, 31), D(2023, 8, 1), D(2024, 3, 5)]
    rows = spark.createDataFrame([(1, d, 1.0, 1.0, 1.0, 1.0, 1) for d in days], "security_id long, trade_date date, open double, high double, low double, close double, volume long")
    out = resample.resample(rows, "semi-annual").orderBy("trade_date").collect()
    assert [r["trade_date"] for r in out] == [D(2023, 1, 31), D(2023, 7, 31), D(2024, 1, 31), D(2024, 7, 31)]
    weeks = resample.resample(rows, "week", keep_empty=True)
    assert weeks.count() == 58 and weeks.where("close IS NULL AND volume = 0").count() == 54


def test_unknown_frequency_and_limits(spark):
    with pytest.raises(ValueError):
        resample.label("hour", F.current_date())
    b = series(spark, range(10))
    assert values(resample.limited(b, 3, True, False), "close") == [0, 1, 2]
    assert values(resample.limited(b, 3, True, True), "close") == [7, 8, 9]
    assert resample.limited(b, 0, False, False).count() == 10


def test_simple_return_passes_nulls_on(spark):
    out = series(spark, [100, None, 105, 110]).withColumn("r", returns.simple("close"))
    assert [None if v is None else round(v, 6) for v in values(out, "r")] == [None, None, None, 0.047619]


def test_cumulative_returns_pass_over_nulls(spark):
    out = series(spark, [None, 0.1, None, 0.1]).withColumn("c", returns.cumulative_simple(F.col("close"))).withColumn("l", returns.cumulative_log(F.col("close")))
    assert [None if v is None else round(v, 6) for v in values(out, "c")] == [None, 0.1, None, 0.21]
    assert [None if v is None else round(v, 6) for v in values(out, "l")] == [None, 0.1, None, 0.2]


def test_division_by_zero_and_logs_of_nothing_are_null(spark):
    out = series(spark, [0, 5, -5]).withColumn("r", returns.simple("close")).withColumn("l", returns.log("close"))
    assert values(out, "r")[1] is None and values(out, "l") == [None, None, None]


def test_annualized_needs_a_known_kind():
    with pytest.raises(ValueError):
        returns.annualized(F.lit(1.0), 252, "other")


@pytest.mark.parametrize("gap, ppy", [(1, 252), (3, 52), (7, 12), (30, 4), (91, 2), (182, 1)])
def test_periods_per_year(spark, gap, ppy):
    rows = spark.createDataFrame([(1, D(2020, 1, 1) + dt.timedelta(days=gap * i)) for i in range(5)], "security_id long, trade_date date")
    assert returns.periods_per_year(rows).first()["ppy"] == ppy


def test_ema_decays_over_nulls(spark):
    out = values(indicators.ema(series(spark, [10, None, 12, 13, 14]), ["close"], 3), "close_ema_3")
    assert out[:3] == [None, None, None] and [round(v, 5) for v in out[3:]] == [12.16667, 13.08333]


def test_rsi_cases(spark):
    up = values(indicators.rsi(series(spark, range(1, 21)), ["close"]), "close_rsi_14")
    assert up[13] is None and up[14] == 100
    flat = values(indicators.rsi(series(spark, [5] * 20), ["close"]), "close_rsi_14")
    assert set(flat) == {None}


def test_macd_is_the_difference_of_its_lines(spark):
    out = indicators.macd(series(spark, [math.sin(i) + i for i in range(60)]), ["close"]).orderBy("trade_date").collect()
    assert out[24]["close_macd"] is None and out[25]["close_macd"] is not None
    assert out[32]["close_macd_signal"] is None and out[33]["close_macd_signal"] is not None
    assert all(abs(r["close_macd"] - r["close_macd_signal"] - r["close_macd_hist"]) < 1e-12 for r in out[33:])


def test_indicator_arguments(spark):
    b = series(spark, [1, 2])
    for call in (lambda: indicators.sma("close", 0), lambda: indicators.ema(b, ["none"]), lambda: indicators.macd(b, ["close"], 26, 12), lambda: indicators.ema(b, [])):
        with pytest.raises(ValueError):
            call()


def test_exact_factors_agree_with_double_ones(spark, sf_dir):
    b, a = market.bars(spark, sf_dir), market.actions(spark, sf_dir)
    one = {(r[0], r[1]): r[2] for r in adjust.adjustment_factors(a, b).collect()}
    for r in adjust.adjustment_factors_exact(a, b).collect():
        assert abs(one[r[0], r[1]] - float(r[2])) < 1e-7


def annual_rates(closes):
    """(security_id, trade_date) to yearly rate of every bar, in plain Python."""
    want = {}
    for key in {k for k, _ in closes}:
        days = sorted(d for k, d in closes if k == key)
        gap = (days[-1] - days[0]).days // (len(days) - 1) if len(days) > 1 else None
        ppy = None if gap is None else next((n for top, n in ((1, 252), (5, 52), (20, 12), (70, 4), (150, 2)) if gap <= top), 1)
        growth, n = 1.0, 0
        want[key, days[0]] = None
        for before, day in zip(days, days[1:]):
            growth, n = growth * (closes[key, day] / closes[key, before]), n + 1
            want[key, day] = growth ** (ppy / n) - 1
    return want


def same_rates(frame, closes):
    got = {(r["security_id"], r["trade_date"]): r["close_annual_simple"] for r in frame.collect()}
    want = annual_rates(closes)
    assert set(got) == set(want)
    for k, rate in want.items():
        assert (got[k] is None) == (rate is None) and (rate is None or math.isclose(got[k], rate, rel_tol=1e-9, abs_tol=1e-4))
    return got


def test_every_bar_has_a_yearly_rate(spark, sf_dir):
    closes = {(r["security_id"], r["trade_date"]): r["close"] for r in market.bars(spark, sf_dir).collect()}
    got = same_rates(prices.annualized_simple_all(spark, sf_dir), closes)
    shown = {(r["security_id"], r["trade_date"]): r["close_annual_simple"] for r in prices.annualized_simple(spark, sf_dir).collect()}
    assert set(shown) == set(got) and all(got[k] is rate is None or math.isclose(got[k], rate, rel_tol=1e-6, abs_tol=1e-4) for k, rate in shown.items())


def test_short_series_have_yearly_rates(spark, sf_dir, monkeypatch):
    rows = [(1, D(2023, 1, 2), 10.0), (1, D(2023, 1, 3), 30.0), (1, D(2023, 1, 4), 12.0), (2, D(2023, 1, 2), 5.0), (3, D(2023, 1, 2), 8.0), (3, D(2023, 3, 2), 9.0)]
    frame = spark.createDataFrame(rows, "security_id long, trade_date date, close double")
    monkeypatch.setattr(market, "bars", lambda *_: frame)
    same_rates(prices.annualized_simple_all(spark, sf_dir), {(k, d): c for k, d, c in rows})


def test_yearly_rates_deal_bars_by_blocks_once(spark, sf_dir):
    """No window over whole series, and one kind of return alone is made."""
    import re

    plan = prices.annualized_log(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"windowspecdefinition\(security_id#\d+L?, trade_date", plan) and "simple_ret" not in plan


@pytest.mark.parametrize("width", [3650, 20])
def test_returns_are_counted_with_their_growth(spark, width):
    rows = spark.createDataFrame([(s, dt.date(2024, 1, 1) + dt.timedelta(k), None if k % 7 == 3 else 10.0 + k) for s in (1, None) for k in range(90)], "security_id int, trade_date date, close double")
    got = sorted(((r["security_id"] or 0, r["trade_date"], r["close_log_ret"], r["close_log_ret_n"]) for r in returns.cumulative(rows, ["close"], "log", width=width, counted=True).collect()), key=lambda r: r[:2])
    n, before = 0, None
    for s, _, r, found in got:
        n = (n if s == before else 0) + (r is not None)
        before = s
        assert found == n


def test_exact_factors_go_on_from_batch_to_batch(spark):
    """One scan of sorted actions, no call a security; batches end within securities and days."""
    rows = [(s, D(2024, 1, 1 + k // 2), "split", 2.0 + k % 2, 1.0, None) for s in (1, 2, None) for k in range(5)]
    found = adjust.adjustment_factors_exact(spark.createDataFrame(rows, ACTION), bars(spark, [50.0]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        got = {(r["security_id"], r["effective_date"].day): (r["price_factor"], r["volume_factor"]) for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {1: 72, 2: 12, 3: 2}
    unit = Decimal("1e-10")
    assert got == {(s, d): ((Decimal(1) / v).quantize(unit), Decimal(v).quantize(unit)) for s in (1, 2, None) for d, v in want.items()}
    assert "FlatMapGroupsInPandas" not in found._jdf.queryExecution().optimizedPlan().toString()
