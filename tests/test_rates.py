import datetime as dt

import numpy as np
import pytest

from tickerforge.operators import rates

DAY = dt.date(2024, 1, 2)


def curve(spark, points, day=DAY):
    return spark.createDataFrame([(day, t, r) for t, r in points], "curve_date date, tenor string, rate double")


@pytest.mark.parametrize("n", [2, 3, 4, 5, 9])
def test_spline_reproduces_polynomials(n):
    x = np.sort(np.random.default_rng(n).uniform(0, 30, n))
    c = np.random.default_rng(1).normal(size=min(n, 4))
    at = np.linspace(x[0], x[-1], 50)
    assert np.allclose(rates.spline(x, np.polyval(c, x), at), np.polyval(c, at), rtol=1e-6, atol=1e-6)


def test_flat_curves_stay_flat(spark):
    c = curve(spark, [("month6", 5.0), ("year1", 5.0), ("year5", 5.0), ("year10", 5.0)])
    zero = rates.yield_curve(c, zero=True).collect()
    assert zero and all(abs(r["rate"] - 5.0) < 1e-9 for r in zero)


def test_interpolation_keeps_given_values_and_bounds(spark):
    other = dt.date(2024, 1, 3)
    c = curve(spark, [("month1", None), ("month3", 4.0), ("year1", 4.5), ("year2", 4.2)]).unionByName(curve(spark, [("year1", 4.0)], other))
    out = {(r["curve_date"], r["months"]): r["rate"] for r in rates.interpolate(c, "quarter").collect()}
    assert {d for d, _ in out} == {DAY}  # one point makes no curve
    assert out[DAY, 1.0] is None and out[DAY, 3.0] == 4.0 and out[DAY, 24.0] == 4.2
    assert 4.0 < out[DAY, 7.0] < 5.0


def test_short_tenors_are_zero_rates_already():
    assert rates.bootstrap_rates([(3, 4.0), (12, 4.5), (24, None)]) == [(3, 4.0), (12, 4.5), (24, None)]


def test_a_negative_discount_factor_falls_back_to_par():
    out = dict(rates.bootstrap_rates([(12, 1.0), (360, 60.0)]))
    assert out[360] == 60.0


def test_single_date_and_errors(spark):
    out = rates.single_date(rates.with_months(curve(spark, [("year1.5", 4.0), ("nonsense", 1.0)]))).collect()
    assert [(r["years"], r["date"], r["par_rate"]) for r in out] == [(1.5, dt.date(2025, 7, 2), 4.0)]
    with pytest.raises(ValueError):
        rates.interval_months("hour")
