"""The vendor's side of a load: requests in windows and pages, limits and retries, and the shape of payloads.

The transport is given by the caller, so that a load can be replayed from files.
"""

from __future__ import annotations

import json
import random
import re
import time
from collections import deque
from collections.abc import Callable, Iterator
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tickerforge.functions.scalars import SECRETS
from tickerforge.operators.merge import last_write

# Fixed values of the vendor's interface: days of a window, bars of an answer, seconds that a wait may last.
WINDOW_DAYS, MOST_BARS, MOST_WAIT = 5475, 5000, 120
_SECRET = re.compile(rf"(?i)\b({'|'.join(SECRETS)})=[^&\s'\"]+")


class SourceError(Exception):
    """A request that failed for good."""


def redact(text: str) -> str:
    return _SECRET.sub(r"\1=***", text)


class RateLimiter:
    """At most ``calls`` in any ``period`` seconds."""

    def __init__(self, calls: int, period: float = 60.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.calls, self.period, self.clock, self.sleep = max(1, calls), period, clock, sleep
        self.made: deque[float] = deque()

    def acquire(self) -> None:
        while True:
            now = self.clock()
            while self.made and now - self.made[0] > self.period:
                self.made.popleft()
            if len(self.made) < self.calls:
                self.made.append(now)
                return
            self.sleep(self.period - (now - self.made[0]) + 0.01)


def retry_after(value: str | None) -> float | None:
    """Seconds that a server asks to wait, within reason."""
    try:
        return min(float(value), MOST_WAIT) if value is not None and float(value) >= 0 else None
    except ValueError:
        return None


def backoff(attempt: int, draw: Callable[[], float] = random.random) -> float:
    """Doubling waits with some chance in them."""
    return min(2.0**attempt + draw(), MOST_WAIT)


def fetch(get: Callable[[], tuple[int, str, dict]], limiter: RateLimiter, retries: int = 4, sleep: Callable[[float], None] = time.sleep):
    """The parsed answer of ``get`` (status, body, headers): waits on 429 and 5xx, raises on any other failure or an error message."""
    for attempt in range(retries):
        limiter.acquire()
        status, body, headers = get()
        if status == 429 or status >= 500:
            sleep(retry_after(headers.get("Retry-After")) or backoff(attempt))
            continue
        if status != 200:
            raise SourceError(redact(f"status {status}: {body[:200]}"))
        answer = json.loads(body)
        if isinstance(answer, dict) and "Error Message" in answer:
            raise SourceError(redact(str(answer["Error Message"])))
        return answer
    raise SourceError(f"no answer after {retries} attempts")


def pages(page: Callable[[int], list[dict]], size: int) -> Iterator[dict]:
    """Rows of all pages: ends with an empty or short page, or one that starts like the page before."""
    number, first = 0, None
    while True:
        rows = page(number)
        if not rows or rows[0].get("symbol") == first:
            return
        yield from rows
        if len(rows) < size:
            return
        number, first = number + 1, rows[0].get("symbol")


def date_windows(start: date, end: date, days: int = WINDOW_DAYS) -> list[tuple[date, date]]:
    """The dates of a long request in slices short enough for one answer."""
    out = []
    while start <= end:
        last = min(start + timedelta(days=days - 1), end)
        out.append((start, last))
        start = last + timedelta(days=1)
    return out


def windows_of(spans: DataFrame, start: str, end: str, days: int = WINDOW_DAYS) -> DataFrame:
    """The slices (window_start, window_end) of each row's dates, beside its other columns; none where the end is before the start."""
    a, b = F.col(start), F.col(end)
    steps = F.when(b >= a, F.sequence(F.lit(0), F.floor(F.datediff(b, a) / days).cast("int")))
    rest = [c for c in spans.columns if c not in (start, end)]
    each = spans.select(*rest, F.explode(F.transform(steps, lambda k: F.struct(F.date_add(a, k * days).alias("window_start"), F.least(F.date_add(a, k * days + (days - 1)), b).alias("window_end")))).alias("_w"))
    return each.select(*rest, "_w.*")


def windows_frame(spark: SparkSession, start: str, end: str, days: int = WINDOW_DAYS) -> DataFrame:
    """The same slices of two dates as rows."""
    return windows_of(spark.range(1).select(F.lit(start).cast("date").alias("a"), F.lit(end).cast("date").alias("b")), "a", "b", days)


def stitched(slices: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """Bars of overlapping slices as one series, the last answer for a date winning."""
    return last_write(slices, keys, ordinal)


def flatten(payload: object) -> list[dict]:
    """The records of an answer: a list, or the list under ``historical``."""
    if isinstance(payload, dict):
        payload = payload.get("historical") or []
    return payload if isinstance(payload, list) else []


def flatten_frame(raw: DataFrame, schema: str, column: str = "payload") -> DataFrame:
    """Records of landed answers in either shape, one row each, beside the other columns."""
    listed, nested = F.from_json(column, f"array<struct<{schema}>>"), F.from_json(column, f"struct<historical:array<struct<{schema}>>>")
    rest = [c for c in raw.columns if c != column]
    rows = F.when(F.substring(F.ltrim(column), 1, 1) == "[", listed).otherwise(nested["historical"])
    return raw.select(*rest, F.explode(rows).alias("_r")).select(*rest, "_r.*")


def plain_names(feed: DataFrame) -> DataFrame:
    """Columns in lower case, and ``adjclose`` as ``close`` unless there is one; of names that fall together all but the first are left out."""
    names = [c.lower() for c in feed.columns]
    short = [c.removeprefix("adj").strip() for c in names]
    found = [s if s and s not in names else c for c, s in zip(names, short)]
    return feed.select(*[F.col(f"`{c}`").alias(n) for i, (c, n) in enumerate(zip(feed.columns, found)) if n not in found[:i]])


def names_of(payload: list, field: str) -> list[str]:
    """Names from a list of texts or of records with the field; blanks are left out."""
    found = (x.get(field) if isinstance(x, dict) else x for x in payload)
    return [x.strip() for x in found if isinstance(x, str) and x.strip()]


@F.pandas_udf(StringType())
def canonical_json(payload: pd.Series) -> pd.Series:
    """JSON with its keys sorted at every level and no white space of its own; what isn't JSON stays as it is, null is null."""

    def one(text: str | None) -> str | None:
        try:
            return None if text is None else json.dumps(json.loads(text), sort_keys=True)
        except ValueError:
            return text

    return payload.map(one, na_action="ignore")


def landed(answers: DataFrame) -> DataFrame:
    """Raw answers with the hash of their canonical JSON, by which an answer is known that comes again with other key order or spacing, and their size."""
    return answers.withColumn("payload_hash", F.sha2(canonical_json("payload"), 256)).withColumn("n_bytes", F.octet_length("payload").cast("long"))


_BAR = "symbol string, date string, open double, high double, low double, close double, volume double, vwap double"
_PARTS = "adjOpen double, adjHigh double, adjLow double, adjClose double, unadjustedVolume double"
# The vendor's fields of each endpoint.
ENDPOINTS = {
    "stock_list": "symbol string, companyName string, name string, exchangeShortName string, exchange string, type string, price double",
    "etf_list": "symbol string, name string, exchangeShortName string, exchange string, price double",
    "company_screener": "symbol string, companyName string, marketCap double, sector string, industry string, beta double, price double, lastAnnualDividend double, volume double, exchange string, exchangeShortName string, country string, isEtf boolean, isFund boolean, isActivelyTrading boolean",
    "delisted_companies": "symbol string, companyName string, exchange string, ipoDate string, delistedDate string",
    "profile": "symbol string, companyName string, marketCap double, mktCap double, beta double, sector string, industry string, description string, cik string, isin string, cusip string, ipoDate string, exchange string, exchangeShortName string",
    "eod_raw": f"{_BAR}, {_PARTS}",
    "eod_split_adjusted": f"{_BAR}, {_PARTS}",
    "splits": "symbol string, date string, numerator double, denominator double, splitTo double, splitFrom double",
    "dividends": "symbol string, date string, recordDate string, paymentDate string, declarationDate string, dividend double, adjDividend double",
    "sectors": "sector string",
    "industries": "industry string",
    "treasury_rates": "date string, month1 double, month2 double, month3 double, month6 double, year1 double, year2 double, year3 double, year5 double, year7 double, year10 double, year20 double, year30 double",
    "actively_trading": "symbol string, name string",
}


class FileSource:
    """The vendor's datasets as files of answers in a folder, one per endpoint, read by name with the endpoint's schema.

    A field that the file lacks, or whose value is of another type, is null.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def read(self, endpoint: str, schema: str | None = None) -> DataFrame:
        if endpoint not in ENDPOINTS:
            raise SourceError(f"no endpoint {endpoint!r}")
        return self.spark.read.option("multiLine", True).schema(schema or ENDPOINTS[endpoint]).json(f"{self.folder}/{endpoint}.json")
