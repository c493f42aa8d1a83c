"""Adjustment factors from corporate actions, and adjusted prices computed on read."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_EVEN, Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerforge.operators.asof import asof_next, asof_prev

PRICES = ["open", "high", "low", "close"]


def securities_with_actions(actions: DataFrame) -> DataFrame:
    """(security_id) of all securities that have an action, once each: those whose factors are to be made."""
    return actions.where("security_id IS NOT NULL").select("security_id").distinct()


def dividend_reference(actions: DataFrame, bars: DataFrame) -> DataFrame:
    """Dividends with ``prior_close``, the raw close of the last bar before the ex-date."""
    dividends = actions.where("action_type = 'dividend'")
    return asof_prev(dividends, bars.select("security_id", "trade_date", F.col("close").alias("prior_close")), "security_id", "ex_date", "trade_date", ["prior_close"])


def event_factors(actions: DataFrame, bars: DataFrame) -> DataFrame:
    """One row per action: its price and volume factor, or why it has none (``skipped``).

    A split multiplies earlier prices by denominator/numerator and volumes by the inverse; a
    dividend D after a close P multiplies prices by (P-D)/P.
    """
    splits = actions.where("action_type = 'split'").select(
        "security_id", "ex_date", "action_type", (F.col("split_denominator") / F.col("split_numerator")).alias("price_factor"),
        (F.col("split_numerator") / F.col("split_denominator")).alias("volume_factor"), F.lit(None).cast("string").alias("skipped"),
        F.lit(None).cast(dict(bars.dtypes)["close"]).alias("prior_close"), F.lit(None).cast(dict(actions.dtypes)["dividend_amount"]).alias("dividend_amount"),
    )
    p, d = F.col("prior_close"), F.col("dividend_amount")
    dividends = dividend_reference(actions, bars).where(d > 0).select(
        "security_id", "ex_date", "action_type", F.when((p > 0) & (d < p), (p - d) / p).alias("price_factor"), F.lit(1.0).alias("volume_factor"),
        F.when(p.isNull() | (p <= 0), F.lit("dividend_no_prior_close")).when(d >= p, F.lit("dividend_exceeds_price")).alias("skipped"),
        "prior_close", "dividend_amount",
    )
    return splits.unionByName(dividends)


def skipped_flags(actions: DataFrame, bars: DataFrame) -> DataFrame:
    """Flags of the actions that give no factor: a dividend without a close before it, or one that is no less than that."""
    missing = F.col("skipped") == "dividend_no_prior_close"
    skipped = event_factors(actions, bars).where("skipped IS NOT NULL")
    return skipped.select(F.col("skipped").alias("check_name"), F.when(missing, "info").otherwise("warn").alias("severity"), "security_id", F.col("ex_date").alias("record_date"), F.to_json(F.struct("prior_close", "dividend_amount")).alias("detail"))


def adjustment_factors(actions: DataFrame, bars: DataFrame) -> DataFrame:
    """Cumulative factors (security_id, effective_date, price_factor, volume_factor) in double: for each ex-date the product of its own and all later actions."""
    applied = event_factors(actions, bars).where("skipped IS NULL")
    daily = applied.groupBy("security_id", F.col("ex_date").alias("effective_date")).agg(F.product("price_factor").alias("p"), F.product("volume_factor").alias("v"))
    later = Window.partitionBy("security_id").orderBy(F.desc("effective_date")).rowsBetween(Window.unboundedPreceding, 0)
    return daily.select("security_id", "effective_date", F.product("p").over(later).alias("price_factor"), F.product("v").over(later).alias("volume_factor"))


_FACTORS = pa.schema([("security_id", pa.int64()), ("effective_date", pa.date32()), ("price_factor", pa.decimal128(20, 10)), ("volume_factor", pa.decimal128(20, 10))])


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The factors of actions that are sorted by security and from the last ex-date to the first; securities go on from batch to batch."""
    unit, price, volume, at = Decimal("1e-10"), Decimal(1), Decimal(1), None

    def done() -> tuple:
        return (*at, price.quantize(unit, ROUND_HALF_EVEN), volume.quantize(unit, ROUND_HALF_EVEN))

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _FACTORS)], schema=_FACTORS)

    for batch in batches:
        rows = []
        for security, ex_date, kind, numerator, denominator, amount, prior in zip(*[c.to_pylist() for c in batch.columns]):
            if at is not None and at != (security, ex_date):
                rows.append(done())
            if at is None or at[0] != security:
                price, volume = Decimal(1), Decimal(1)
            at = (security, ex_date)
            if kind == "split":
                price, volume = price * denominator / numerator, volume * numerator / denominator
            else:
                price = price * (prior - amount) / prior
        if rows:
            yield made(rows)
    if at is not None:
        yield made([done()])


def adjustment_factors_exact(actions: DataFrame, bars: DataFrame) -> DataFrame:
    """The cumulative factors in exact decimals, rounded once to 10 places when stored.

    Spark's decimals would round every step of the product, so a security's few actions are
    multiplied in Python's decimals.
    """
    d, p = F.col("dividend_amount"), F.col("prior_close")
    columns = [F.col("security_id").cast("long").alias("security_id"), "ex_date", "action_type", F.col("split_numerator").cast("decimal(20,10)"), F.col("split_denominator").cast("decimal(20,10)"), d.cast("decimal(20,10)")]
    splits = actions.where("action_type = 'split' AND split_numerator > 0 AND split_denominator > 0").select(*columns, F.lit(None).cast("decimal(20,6)").alias("prior_close"))
    dividends = dividend_reference(actions, bars).where((d > 0) & (p > 0) & (d < p)).select(*columns, p.cast("decimal(20,6)").alias("prior_close"))
    dealt = splits.unionByName(dividends).where("ex_date IS NOT NULL").repartition("security_id").sortWithinPartitions("security_id", F.desc("ex_date"))
    return dealt.mapInArrow(_exact, "security_id long, effective_date date, price_factor decimal(20,10), volume_factor decimal(20,10)")


def with_factors(bars: DataFrame, factors: DataFrame) -> DataFrame:
    """Bars with the factors of the first effective date after each; 1 if there is none."""
    joined = asof_next(bars, factors, "security_id", "trade_date", "effective_date", ["price_factor", "volume_factor"])
    one = F.lit(1)
    return joined.withColumns({c: F.coalesce(F.col(c), one.cast(dict(joined.dtypes)[c])) for c in ("price_factor", "volume_factor")})


def adjusted_bars(bars: DataFrame, factors: DataFrame) -> DataFrame:
    """Adjusted OHLCV with the raw close and the factors; double in, double out."""
    rows = with_factors(bars, factors)
    prices = [(F.col(c) * F.col("price_factor")).alias(c) for c in PRICES]
    return rows.select("security_id", "trade_date", *prices, (F.col("volume") * F.col("volume_factor")).alias("volume"), F.col("close").alias("close_raw"), "price_factor", "volume_factor")


def adjusted_bars_exact(bars: DataFrame, factors: DataFrame) -> DataFrame:
    """The same on decimals: prices to 10 places, volumes to whole shares of up to 38 digits.

    Operands are narrowed first, so that the product is exact and rounded once.
    """
    rows = with_factors(bars, factors)
    f = F.col("price_factor").cast("decimal(18,10)")
    prices = [F.round(F.col(c).cast("decimal(18,6)") * f, 10).alias(c) for c in PRICES]
    volume = F.round(F.col("volume").cast("decimal(19,0)") * F.col("volume_factor").cast("decimal(18,10)"), 0).cast("decimal(38,0)")
    return rows.select("security_id", "trade_date", *prices, volume.alias("volume"), F.col("close").alias("close_raw"), "price_factor", "volume_factor")
