"""Yield curves in long form (curve_date, tenor, rate): spline interpolation and zero-rate bootstrapping."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerforge.functions.scalars import months_tenor, tenor_months

#: Months between the points of each grid.
INTERVALS = {"day": 1 / 30, "week": 1 / 4, "month": 1.0, "quarter": 3.0, "semi-annual": 6.0, "annual": 12.0}
#: Tenors, in years, that risk is usually reported at.
KEY_RATES = (1, 5, 10, 20, 30)


def interval_months(interval: str) -> float:
    if interval not in INTERVALS:
        raise ValueError(f"interval must be one of {', '.join(INTERVALS)}, not {interval!r}")
    return INTERVALS[interval]


def with_months(curve: DataFrame) -> DataFrame:
    """The curve with its tenors in months; other columns than tenors are left out."""
    return curve.withColumn("months", tenor_months("tenor")).where("months IS NOT NULL")


def tenor_range(curve: DataFrame, least: float | None = None, most: float | None = None) -> DataFrame:
    """Tenors within the months given, ends included."""
    rows = with_months(curve)
    if least is not None:
        rows = rows.where(F.col("months") >= least)
    return rows if most is None else rows.where(F.col("months") <= most)


def key_rates(curve: DataFrame) -> DataFrame:
    return with_months(curve).where(F.col("months").isin([12.0 * y for y in KEY_RATES]))


def target_tenors(curve: DataFrame, interval: str) -> DataFrame:
    """(months) of the grid from the smallest tenor up to the largest, together with the tenors there are."""
    step = interval_months(interval)
    have = with_months(curve).select(F.round("months", 6).alias("months")).distinct()
    span = have.agg(F.min("months").alias("a"), F.max("months").alias("b")).where("a IS NOT NULL")
    grid = span.select(F.explode(F.sequence(F.lit(0), F.floor((F.col("b") - F.col("a")) / step + 1e-9).cast("int"))).alias("k"), "a").select(F.round(F.col("a") + F.col("k") * step, 6).alias("months"))
    return have.unionByName(grid).distinct()


def spline(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The cubic spline through the points, evaluated at ``at``; its third derivative is continuous at the second and the last but one (not-a-knot).

    Two points make a line, three a parabola.
    """
    n = len(x)
    if n < 4:
        return np.polyval(np.polyfit(x - x[0], y, n - 1), at - x[0])
    h, d = np.diff(x), np.diff(y) / np.diff(x)
    # second derivatives m: continuity of the slope inside, of the third derivative next to the ends
    a, b = np.zeros((n, n)), np.zeros(n)
    for i in range(1, n - 1):
        a[i, i - 1 : i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
        b[i] = 6 * (d[i] - d[i - 1])
    a[0, :3] = h[1], -(h[0] + h[1]), h[0]
    a[-1, -3:] = h[-1], -(h[-2] + h[-1]), h[-2]
    m = np.linalg.solve(a, b)
    k = np.clip(np.searchsorted(x, at, side="right") - 1, 0, n - 2)
    left, right = at - x[k], x[k + 1] - at
    return (m[k] * right**3 + m[k + 1] * left**3) / (6 * h[k]) + (y[k] / h[k] - m[k] * h[k] / 6) * right + (y[k + 1] / h[k] - m[k + 1] * h[k] / 6) * left


@lru_cache(maxsize=1024)
def spline_weights(x: tuple[float, ...], at: tuple[float, ...]) -> np.ndarray:
    """What each point's value weighs at each of ``at``: a spline is linear in the values, so one matrix serves all curves with these points. Null outside the points."""
    inside = np.array([x[0] <= t <= x[-1] for t in at])
    columns = [spline(np.array(x), e, np.array(at)) for e in np.eye(len(x))]
    return np.where(inside[:, None], np.stack(columns, axis=1), np.nan)


def interpolate(curve: DataFrame, interval: str = "semi-annual") -> DataFrame:
    """(curve_date, months, rate) at all tenors of the curves and the grid between.

    A tenor that exists keeps its value, null too; between, the date's spline; outside the date's
    own points, null. A date with fewer than two points is left out. Dates of a batch that have the same tenors are
    one matrix product.
    """
    rows = with_months(curve)
    # One row of as many numbers as there are tenors; it goes along with the few points of each date.
    tenors = target_tenors(curve, interval).agg(F.sort_array(F.collect_set("months")).alias("_grid"))
    existing = rows.agg(F.collect_set("months").alias("_existing"))
    point = F.struct("months", F.col("rate").cast("double").alias("rate"))
    dates = rows.groupBy("curve_date").agg(F.array_sort(F.collect_list(F.when(F.col("rate").isNotNull() & ~F.isnan("rate"), point))).alias("_p")).where(F.size("_p") > 1)
    known = dates.select("curve_date", F.transform("_p", lambda p: p["months"]).alias("x"), F.transform("_p", lambda p: p["rate"]).alias("y")).crossJoin(F.broadcast(tenors)).crossJoin(F.broadcast(existing))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for x, group in pdf.groupby(pdf["x"].map(tuple)):
                grid = tuple(group["_grid"].iloc[0])
                values = np.stack(group["y"].to_list()) @ spline_weights(x, grid).T
                for k in np.flatnonzero(np.isin(grid, group["_existing"].iloc[0])):
                    values[:, k] = np.stack(group["y"].to_list())[:, x.index(grid[k])] if grid[k] in x else np.nan
                flat = pd.Series(values.ravel())
                yield pd.DataFrame({"curve_date": np.repeat(group["curve_date"].to_numpy(), len(grid)), "months": np.tile(grid, len(group)), "rate": flat.astype(object).where(flat.notna(), None)})

    return known.mapInPandas(run, "curve_date date, months double, rate double")


def zero_at(months: float, known: list[tuple[float, float]]) -> float | None:
    """A zero rate between known ones by a straight line, flat beyond them."""
    if not known:
        return None
    x, y = zip(*sorted(known))
    return float(np.interp(months, x, y))


def bootstrap_rates(points: list[tuple[float, float | None]]) -> list[tuple[float, float | None]]:
    """Zero rates of par rates (months, percent) in order of tenor, semi-annual coupons beyond a year."""
    known: dict[float, float] = {}
    out: list[tuple[float, float | None]] = []
    for months, par in sorted(points):
        if par is None or np.isnan(par):
            out.append((months, None))
            continue
        zero = par
        if months > 12:
            coupon, years = par / 200, months / 12
            times = np.arange(0.5, years - 1e-12, 0.5)
            rates = [known[12 * t] if 12 * t in known else zero_at(12 * t, list(known.items())) for t in times]
            paid = sum(coupon / (1 + z / 200) ** (2 * t) for t, z in zip(times, rates) if z is not None)
            last = (1 - paid) / (1 + coupon)
            if last > 0:
                zero = 200 * (last ** (-1 / (2 * years)) - 1)
        known[months] = zero
        out.append((months, zero))
    return out


def bootstrap(curve: DataFrame) -> DataFrame:
    """(curve_date, months, rate): zero rates of each date's par curve (curve_date, months, rate)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        zero = bootstrap_rates([(float(m), None if pd.isna(r) else float(r)) for m, r in zip(pdf["months"], pdf["rate"])])
        return pd.DataFrame({"curve_date": pdf["curve_date"].iloc[0], "months": [m for m, _ in zero], "rate": pd.Series([z for _, z in zero], dtype=object)})

    return curve.select("curve_date", "months", "rate").groupBy("curve_date").applyInPandas(run, "curve_date date, months double, rate double")


def yield_curve(curve: DataFrame, start: str | None = None, end: str | None = None, limit: int | None = None, zero: bool = False, interval: str | None = None, least: float | None = None, most: float | None = None) -> DataFrame:
    """(curve_date, tenor, months, rate): dates, then the limit, zero rates, interpolation, and the tenors kept.

    A start without an end keeps the first ``limit`` dates, anything else the last.
    """
    rows = with_months(curve).select("curve_date", "tenor", "months", "rate")
    if start:
        rows = rows.where(F.col("curve_date") >= F.lit(start).cast("date"))
    if end:
        rows = rows.where(F.col("curve_date") <= F.lit(end).cast("date"))
    if limit and limit > 0:
        dates = rows.select("curve_date").distinct().orderBy(F.asc("curve_date") if start and not end else F.desc("curve_date")).limit(limit)
        rows = rows.join(dates, "curve_date", "left_semi")
    if zero:
        rows = bootstrap(interpolate(rows, "semi-annual")).withColumn("tenor", months_tenor(F.col("months")))
    if interval:
        rows = interpolate(rows.select("curve_date", months_tenor(F.col("months")).alias("tenor"), "rate"), interval).withColumn("tenor", months_tenor(F.col("months")))
    if least is not None:
        rows = rows.where(F.col("months") >= least)
    if most is not None:
        rows = rows.where(F.col("months") <= most)
    return rows.select("curve_date", "tenor", "months", "rate")


def single_date(curve: DataFrame, zero: bool = False) -> DataFrame:
    """One date's curve by tenor: years, the day it matures, and the rate."""
    years = F.col("months") / 12
    return curve.select("tenor", years.alias("years"), F.date_add("curve_date", F.floor(years * 365).cast("int")).alias("date"), F.col("rate").alias("zero_rate" if zero else "par_rate"))


def wide(curve: DataFrame, tenors: list[str]) -> DataFrame:
    """One row per date, one column per tenor."""
    return curve.groupBy("curve_date").pivot("tenor", tenors).agg(F.first("rate"))


def latest(curve: DataFrame) -> DataFrame:
    """The rows of the last date."""
    return curve.join(curve.agg(F.max("curve_date").alias("curve_date")), "curve_date", "left_semi")
