"""Technical indicators. Moving averages are windows; exponential ones recur and run on a block of a series at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerforge.operators.blocks import BLOCK, WIDTH, exponential_means, previous


def _positive(**windows: int) -> None:
    for name, n in windows.items():
        if n <= 0:
            raise ValueError(f"{name} must be above zero, not {n}")


def sma(column: str, n: int = 20, key: str = "security_id", order: str = "trade_date") -> Column:
    """The mean of the last n values; null until there are n without a null."""
    _positive(window=n)
    w = Window.partitionBy(key).orderBy(order).rowsBetween(1 - n, 0)
    return F.when(F.count(column).over(w) == n, F.avg(column).over(w)).alias(f"{column}_sma_{n}")


def _known(frame: DataFrame, columns: list[str]) -> None:
    missing = [c for c in columns if c not in frame.columns]
    if missing or not columns:
        raise ValueError(f"no such columns: {', '.join(missing)}" if missing else "no columns given")


def ema(frame: DataFrame, columns: list[str], n: int = 20, adjust: bool = False, key: str = "security_id", order: str = "trade_date", width: int = WIDTH) -> DataFrame:
    """(key, order, {c}_ema_{n}) with weight 2/(n+1) on the newest value."""
    _positive(window=n)
    _known(frame, columns)
    made = {f"{c}_ema_{n}": (c, 2 / (n + 1), n) for c in columns}
    return exponential_means(frame.select(key, order, *columns), made, adjust, (), key, order, width).drop(BLOCK)


def rsi(frame: DataFrame, columns: list[str], n: int = 14, key: str = "security_id", order: str = "trade_date", width: int = WIDTH) -> DataFrame:
    """(key, order, {c}_rsi_{n}) by Wilder: 100 without losses, null without any move."""
    _positive(window=n)
    _known(frame, columns)
    values = frame.select(key, order, *[F.nullif(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in columns])
    steps = previous(values, columns, key, order, width)
    moves = steps.select(key, order, BLOCK, *[F.when((F.col(c) - F.col(f"{c}_before")).isNotNull(), F.greatest(sign * (F.col(c) - F.col(f"{c}_before")), F.lit(0.0))).alias(f"{c}_{side}") for c in columns for side, sign in (("gain", 1), ("loss", -1))])
    means = exponential_means(moves, {f"{c}_{side}": (f"{c}_{side}", 1 / n, n) for c in columns for side in ("gain", "loss")}, False, (), key, order, width)

    def index(c: str) -> Column:
        gain, loss = F.col(f"{c}_gain"), F.col(f"{c}_loss")
        return F.when((loss == 0) & (gain > 0), F.lit(100.0)).when(loss != 0, 100 - 100 / (1 + gain / loss)).alias(f"{c}_rsi_{n}")

    return means.select(key, order, *[index(c) for c in columns])


def macd(frame: DataFrame, columns: list[str], fast: int = 12, slow: int = 26, signal: int = 9, key: str = "security_id", order: str = "trade_date", width: int = WIDTH) -> DataFrame:
    """(key, order, {c}_macd, {c}_macd_signal, {c}_macd_hist)."""
    _positive(fast=fast, slow=slow, signal=signal)
    if fast >= slow:
        raise ValueError("fast must be below slow")
    _known(frame, columns)
    made = {f"{c}_{name}": (c, 2 / (n + 1), n) for c in columns for name, n in (("fast", fast), ("slow", slow))}
    signals = {f"{c}_macd_signal": ((f"{c}_fast", f"{c}_slow"), 2 / (signal + 1), signal) for c in columns}
    means = exponential_means(frame.select(key, order, *columns), made, False, (), key, order, width, signals).withColumns({f"{c}_macd": F.col(f"{c}_fast") - F.col(f"{c}_slow") for c in columns})
    return means.select(key, order, *[x for c in columns for x in (f"{c}_macd", f"{c}_macd_signal", (F.col(f"{c}_macd") - F.col(f"{c}_macd_signal")).alias(f"{c}_macd_hist"))])
