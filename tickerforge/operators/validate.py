"""Row-level validation at the border of the warehouse: good rows pass, bad ones carry their reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerforge import schemas
from tickerforge.functions.scalars import bounded, is_us, norm_exchange, out_of_range, parse_date, split_ratio, to_double

# The spellings of each field in order of preference.
PRICE_FIELDS = {"open": ("open", "adjOpen"), "high": ("high", "adjHigh"), "low": ("low", "adjLow"), "close": ("close", "adjClose")}
VOLUME_FIELDS = ("unadjustedVolume", "volume")


def _given(frame: DataFrame, names: tuple[str, ...]) -> list[Column]:
    """The fields that the payload has, as text, blanks as null."""
    return [F.nullif(F.col(n).cast("string"), F.lit("")) for n in names if n in frame.columns]


def _first(columns: list[Column]) -> Column:
    return F.coalesce(*columns) if columns else F.lit(None).cast("string")


#: Types whose values are the numbers that their text would be read as.
_EXACT = ("double", "bigint", "int", "smallint", "tinyint")


def _numbers(frame: DataFrame, names: tuple[str, ...]) -> list[Column] | None:
    """The fields that the payload has, if all of them are numbers already: writing and reading them as text takes far longer than the rules do."""
    types = dict(frame.dtypes)
    found = [n for n in names if n in types]
    return [F.col(n).cast("double") for n in found] if all(types[n] in _EXACT for n in found) else None


def first_number(frame: DataFrame, names: tuple[str, ...]) -> Column:
    """The number in the first field that holds anything; null if that isn't one."""
    numbers = _numbers(frame, names)
    if numbers is None:
        return to_double(_first(_given(frame, names)))
    return F.coalesce(*numbers) if numbers else F.lit(None).cast("double")


def price_field(frame: DataFrame, field: str) -> Column:
    """The first spelling that holds a price above zero, else the first that holds anything."""
    names = PRICE_FIELDS[field]
    found = _numbers(frame, names)
    found = [to_double(c) for c in _given(frame, names)] if found is None else found
    return F.coalesce(*[F.when(c > 0, c) for c in found], first_number(frame, names)) if len(found) > 1 else first_number(frame, names)


def day_field(frame: DataFrame, name: str) -> Column:
    """A field's date by its text; a date is one already, of the years that the text can give."""
    c = F.col(name)
    return F.when(c.between(F.lit("0000-01-01").cast("date"), F.lit("9999-12-31").cast("date")), c) if dict(frame.dtypes)[name] == "date" else parse_date(c.cast("string"))


def checked_bars(bars: DataFrame, date: str = "date") -> DataFrame:
    """All rows with ``trade_date``, typed OHLCV and vwap, and ``reason``: the first rule that a row breaks, or null."""
    keep = [c for c in bars.columns if c not in ("open", "high", "low", "close", "volume", "vwap", "trade_date", "reason")]
    volume = F.coalesce(*numbers, F.lit(0.0)) if (numbers := _numbers(bars, VOLUME_FIELDS)) is not None else to_double(F.coalesce(_first(_given(bars, VOLUME_FIELDS)), F.lit("0")))
    typed = bars.select(*keep, day_field(bars, date).alias("trade_date"), *[price_field(bars, f).alias(f) for f in PRICE_FIELDS], volume.alias("_v"), first_number(bars, ("vwap",)).alias("vwap"))
    o, h, l, c, v = (F.col(x) for x in ("open", "high", "low", "close", "_v"))
    finite = F.abs(v) < 9.2e18
    whole = F.when(finite, F.when(v < 0, F.ceil(v)).otherwise(F.floor(v))).cast("long")
    reason = (
        F.when(F.col("trade_date").isNull(), "unparseable_date")
        .when(o.isNull() | h.isNull() | l.isNull() | c.isNull(), "missing_or_nonnumeric_ohlc")
        .when(v.isNull() | F.isnan(v) | ~finite, "nonnumeric_volume")
        .when(F.least(o, h, l, c) <= 0, "non_positive_price")
        .when((h < l) | (h < o) | (h < c) | (l > o) | (l > c), "cross_field_violation")
        .when(whole < 0, "negative_volume")
    )
    return typed.withColumn("volume", whole).withColumn("reason", reason).drop("_v")


def good_and_bad(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and flags of the others."""
    bad = checked.where("reason IS NOT NULL")
    flags = bad.select(F.concat(F.lit("price_"), "reason").alias("check_name"), F.lit("warn").alias("severity"), "security_id", F.col("trade_date").alias("record_date"), F.to_json(F.struct("reason")).alias("detail"))
    return checked.where("reason IS NULL").drop("reason"), flags


def good_and_bad_actions(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid actions, and flags of the others, named by their reason."""
    bad = checked.where("reason IS NOT NULL")
    flags = bad.select(F.col("reason").alias("check_name"), F.lit("warn").alias("severity"), "security_id", F.col("ex_date").alias("record_date"), F.to_json(F.struct("action_type", "split_numerator", "split_denominator", "dividend_amount")).alias("detail"))
    return checked.where("reason IS NULL").drop("reason"), flags


def checked_actions(splits: DataFrame | None, dividends: DataFrame | None) -> DataFrame:
    """Corporate actions from both feeds with ``reason``; splits need both parts above zero, dividends an amount of zero or more."""
    parts = []
    if splits is not None:
        num, den = (to_double(_first(_given(splits, f))) for f in (("numerator", "splitTo"), ("denominator", "splitFrom")))
        rows = splits.select("security_id", F.lit("split").alias("action_type"), parse_date(F.col("date").cast("string")).alias("ex_date"), num.alias("split_numerator"), den.alias("split_denominator"), F.lit(None).cast("double").alias("dividend_amount"))
        parts.append(rows.withColumn("reason", F.when(F.col("ex_date").isNull() | split_ratio(F.col("split_numerator"), F.col("split_denominator")).isNull(), "split_invalid")))
    if dividends is not None:
        amount = to_double(_first(_given(dividends, ("dividend", "adjDividend"))))
        rows = dividends.select("security_id", F.lit("dividend").alias("action_type"), parse_date(F.col("date").cast("string")).alias("ex_date"), F.lit(None).cast("double").alias("split_numerator"), F.lit(None).cast("double").alias("split_denominator"), amount.alias("dividend_amount"))
        parts.append(rows.withColumn("reason", F.when(F.col("ex_date").isNull() | F.col("dividend_amount").isNull() | (F.col("dividend_amount") < 0), "dividend_invalid")))
    if not parts:
        raise ValueError("splits or dividends are needed")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def bounded_numerics(securities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Securities with numbers that their columns can't hold set to null, and flags of those."""
    limits = {"market_cap_usd": (24, 2), "beta": (12, 6)}
    flags = None
    for c, (p, s) in limits.items():
        part = securities.where(out_of_range(F.col(c), p, s)).select(F.lit(f"security_{c}_out_of_range").alias("check_name"), "symbol", F.col(c).cast("string").alias("value"))
        flags = part if flags is None else flags.unionByName(part)
    return securities.withColumns({c: bounded(F.col(c), p, s) for c, (p, s) in limits.items()}), flags


def us_universe(screened: DataFrame, etfs: bool = True, order: str = "ordinal") -> DataFrame:
    """The US securities of a screen over several venues: each symbol's first row by ``order``; without funds' ETFs if asked."""
    code = norm_exchange(F.col("exchangeShortName"), F.col("exchange") if "exchange" in screened.columns else F.lit(None).cast("string"))
    rows = screened.withColumn("symbol", F.trim("symbol")).withColumn("exchange_code", code).where(is_us(F.coalesce(code, F.lit(""))) & (F.col("symbol") != ""))
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy("symbol").orderBy(order))).where("_n = 1").drop("_n")
    is_etf = F.coalesce(F.col("isEtf").cast("boolean"), F.lit(False))
    out = first.withColumn("is_etf", is_etf).withColumn("asset_type", F.when(is_etf, "etf").otherwise("equity"))
    return out if etfs else out.where("NOT is_etf")


def with_etfs(stocks: DataFrame, etfs: DataFrame) -> DataFrame:
    """A stock list and an ETF list as one: symbols of both are ETFs, those of the ETF list alone are added."""
    known = etfs.select(F.col("symbol").alias("_e")).distinct()
    flagged = stocks.join(known, F.col("symbol") == F.col("_e"), "left").withColumn("is_etf", F.col("_e").isNotNull()).drop("_e")
    extra = etfs.join(stocks.select(F.col("symbol").alias("_s")), F.col("symbol") == F.col("_s"), "left_anti").withColumn("is_etf", F.lit(True))
    return flagged.unionByName(extra, allowMissingColumns=True).withColumn("asset_type", F.when(F.col("is_etf"), "etf").otherwise("equity"))


def violations(table: str, frame: DataFrame) -> DataFrame:
    """Rows that break one of a table's checks, with its name in ``check``; null operands don't."""
    broken = F.filter(F.array(*[F.when(~F.expr(rule), F.lit(name)) for name, rule in schemas.CHECKS[table].items()]), lambda x: x.isNotNull())
    return frame.withColumn("check", F.explode(broken))
