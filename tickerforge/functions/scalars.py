"""Column expressions for the vendor's fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Venues that count as US, venues known by another code, and query parameters that hold secrets.
US_EXCHANGES = ("NASDAQ", "NYSE", "AMEX", "NYSEAMERICAN", "BATS", "CBOE", "OTC")
ALIASES = {"NYSEAMERICAN": "AMEX"}
SECRETS = ("apikey", "api_key", "token", "access_key", "secret")


def to_double(c: Column | str) -> Column:
    """A number, or null for what isn't one."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string").try_cast("double")


def parse_date(c: Column | str) -> Column:
    """A date from the first ten characters, or null; single-digit months and days are accepted."""
    head = F.substring(F.col(c) if isinstance(c, str) else c, 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), head.try_cast("date"))


def norm_exchange(short_name: Column, exchange: Column) -> Column:
    """A venue's code: the short name if given, in upper case, with aliases resolved; null if blank."""
    blank = F.lit("")
    raw = F.upper(F.trim(F.coalesce(F.nullif(F.trim(short_name), blank), F.nullif(F.trim(exchange), blank))))
    known = reduce(lambda acc, kv: F.when(raw == kv[0], F.lit(kv[1])).otherwise(acc), ALIASES.items(), raw)
    return F.nullif(known, blank)


def is_us(code: Column) -> Column:
    """By equality: foreign venues may carry a US one's name inside theirs."""
    return F.coalesce(code.isin(*US_EXCHANGES), F.lit(False))


def redact(c: Column | str) -> Column:
    """Values of secret query parameters masked."""
    return F.regexp_replace(c, rf"(?i)\b({'|'.join(SECRETS)})=([^&\s'\"]+)", "$1=***")


def name_hash(name: Column | str) -> Column:
    """The short public id of a sector or industry name."""
    return F.substring(F.sha2(F.col(name) if isinstance(name, str) else name, 256), 1, 5)


def tenor_months(tenor: Column | str) -> Column:
    """Months of a tenor such as ``month3`` or ``year1.5``; null for anything else."""
    t = F.lower(F.col(tenor) if isinstance(tenor, str) else tenor)
    unit, size = F.regexp_extract(t, r"^(month|year)(\d+(?:\.\d+)?)$", 1), F.regexp_extract(t, r"^(month|year)(\d+(?:\.\d+)?)$", 2)
    return F.when(unit == "month", size.try_cast("double")).when(unit == "year", size.try_cast("double") * 12)


def months_tenor(months: Column) -> Column:
    """The name of a tenor: months below a year, else years, to three decimals."""
    m = F.round(months, 3)
    years = F.round(months / 12, 3)

    def number(x: Column) -> Column:
        return F.when(x == F.floor(x), F.floor(x).cast("string")).otherwise(F.regexp_replace(F.format_string("%.3f", x), r"0+$", ""))

    return F.when(months < 12, F.concat(F.lit("month"), number(m))).otherwise(F.concat(F.lit("year"), number(years)))


def bounded(value: Column, precision: int, scale: int) -> Column:
    """The value, or null if a DECIMAL(precision, scale) can't hold it."""
    limit = 10.0 ** (precision - scale)
    return F.when(~F.isnan(value) & (F.abs(value) < limit), value)


def out_of_range(value: Column, precision: int, scale: int) -> Column:
    return value.isNotNull() & bounded(value, precision, scale).isNull()


def split_ratio(numerator: Column, denominator: Column) -> Column:
    """Shares after a split for each before; null unless both parts are above zero."""
    return F.when((numerator > 0) & (denominator > 0), numerator / denominator)
