"""Returns of price series. A null price makes null returns; nothing is filled forward.

Series are given by ``key`` and ``order``. Divisions by zero and logarithms of nothing are null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickerforge.operators.blocks import WIDTH, previous, running


def series(key: str = "security_id", order: str = "trade_date") -> WindowSpec:
    return Window.partitionBy(key).orderBy(order)


def so_far(key: str = "security_id", order: str = "trade_date") -> WindowSpec:
    return series(key, order).rowsBetween(Window.unboundedPreceding, 0)


def named(column: str, suffix: str, lookback: int) -> str:
    """The output column of a return: its suffix, and the lookback unless it is 1."""
    return f"{column}_{suffix}" + (f"_l{lookback}" if lookback != 1 else "")


def simple(price: Column | str, lookback: int = 1, w: WindowSpec | None = None) -> Column:
    p = F.col(price) if isinstance(price, str) else price
    return F.try_divide(p, F.lag(p, lookback).over(w or series())) - 1


def log(price: Column | str, lookback: int = 1, w: WindowSpec | None = None) -> Column:
    p = F.col(price) if isinstance(price, str) else price
    ratio = F.try_divide(p, F.lag(p, lookback).over(w or series()))
    return F.when(ratio > 0, F.ln(ratio))


def difference(price: Column | str, lookback: int = 1, w: WindowSpec | None = None) -> Column:
    p = F.col(price) if isinstance(price, str) else price
    return p - F.lag(p, lookback).over(w or series())


def dividend_adjusted(price: Column, dividend: Column, lookback: int = 1, w: WindowSpec | None = None) -> Column:
    before = F.lag(price, lookback).over(w or series())
    return F.try_divide(price + dividend - before, before)


def cumulative_simple(r: Column, w: WindowSpec | None = None) -> Column:
    """Growth so far less 1; null where the return is, which later rows pass over."""
    return F.when(r.isNotNull(), F.product(1 + r).over(w or so_far()) - 1)


def cumulative_log(r: Column, w: WindowSpec | None = None) -> Column:
    return F.when(r.isNotNull(), F.sum(r).over(w or so_far()))


def cumulative(frame: DataFrame, columns: list[str], kind: str = "simple", key: str = "security_id", order: str = "trade_date", width: int = WIDTH, counted: bool = False) -> DataFrame:
    """The frame with {c}_{kind}_ret and its growth so far, {c}_{kind}_ret_cum, scanned in blocks of a series.

    Of the same values as ``cumulative_simple`` and ``cumulative_log`` over whole series. If ``counted``, also
    {c}_{kind}_ret_n, the returns so far.
    """
    if kind not in ("simple", "log"):
        raise ValueError(f"a return is simple or log, not {kind!r}")
    rows, names = previous(frame, columns, key, order, width), {c: f"{c}_{kind}_ret" for c in columns}

    def of(c: str) -> Column:
        ratio = F.try_divide(F.col(c), F.col(f"{c}_before"))
        return ratio - 1 if kind == "simple" else F.when(ratio > 0, F.ln(ratio))

    rows = rows.withColumns({n: of(c) for c, n in names.items()}).drop(*[f"{c}_before" for c in columns])
    grown = rows.withColumns({f"_g_{n}": 1 + F.col(n) if kind == "simple" else F.col(n) for n in names.values()})
    counts = {f"{n}_n": (f"_g_{n}", "count") for n in names.values()} if counted else {}
    done = running(grown, {f"{n}_cum": (f"_g_{n}", "product" if kind == "simple" else "sum") for n in names.values()} | counts, key, order, width)
    return done.withColumns({f"{n}_cum": F.when(F.col(n).isNotNull(), F.col(f"{n}_cum") - (1 if kind == "simple" else 0)) for n in names.values()}).select(*frame.columns, *[x for n in names.values() for x in (n, f"{n}_cum", *([f"{n}_n"] if counted else []))])


def annualized(cumulative: Column, periods_per_year: Column | int, kind: str, w: WindowSpec | None = None, n: Column | None = None) -> Column:
    """The yearly rate that a cumulative return stands for, over the observations so far (``n``, if they are counted already)."""
    n = F.count(cumulative).over(w or so_far()) if n is None else n
    per_year = F.lit(periods_per_year) if isinstance(periods_per_year, int) else periods_per_year
    if kind == "simple":
        return F.when(cumulative > -1, F.pow(1 + cumulative, per_year / n) - 1)
    if kind == "log":
        return cumulative * per_year / n
    raise ValueError(f"a return is simple or log, not {kind!r}")


def excess(one: DataFrame, other: DataFrame, columns: list[str], key: str = "security_id", order: str = "trade_date") -> DataFrame:
    """Differences of two frames' returns, aligned on the union of their dates."""
    missing = [c for c in columns if c not in one.columns or c not in other.columns]
    if missing:
        raise ValueError(f"both sides need {', '.join(missing)}")
    b = other.select(F.col(key).alias("_k"), F.col(order).alias("_o"), *[F.col(c).alias(f"_{c}") for c in columns])
    joined = one.select(key, order, *columns).join(b, (F.col(key) == F.col("_k")) & (F.col(order) == F.col("_o")), "full")
    return joined.select(F.coalesce(key, "_k").alias(key), F.coalesce(order, "_o").alias(order), *[(F.col(c) - F.col(f"_{c}")).alias(c) for c in columns])


def periods_per_year(frame: DataFrame, key: str = "security_id", order: str = "trade_date") -> DataFrame:
    """(key, ppy) from the mean whole-day gap between observations.

    The cut-offs are the users' known ones: a gap of 7 days counts as 12 a year, 30 as 4, 91 as 2.
    Gaps add up to the span from first to last, so that no series has to be put in order.
    """
    days = frame.groupBy(key).agg(F.floor(F.datediff(F.max(order), F.min(order)) / F.nullif(F.count(order) - 1, F.lit(0))).alias("_d")).where("_d IS NOT NULL")
    steps = F.when(F.col("_d") <= 1, 252).when(F.col("_d") <= 5, 52).when(F.col("_d") <= 20, 12).when(F.col("_d") <= 70, 4).when(F.col("_d") <= 150, 2).otherwise(1)
    return days.select(key, steps.alias("ppy"))


def numeric_columns(frame: DataFrame, besides: tuple[str, ...] = ("security_id",)) -> list[str]:
    return [c for c, t in frame.dtypes if c not in besides and (t in ("double", "float", "int", "bigint", "smallint", "tinyint") or t.startswith("decimal"))]
