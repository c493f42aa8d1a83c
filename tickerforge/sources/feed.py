"""The vendor as a Spark source: ``spark.read.format("tickerforge_vendor")``.

Partitions are requests: a symbol and a window of dates, a symbol, or the pages of a list. They are planned from the
options alone, so a backfill of any length is spread over the cluster, and a lost task asks again for its own
requests only. Each partition keeps its share of the rate limit, waits and retries on its own. An answer that is as
long as answers may be has lost its oldest bars: its window is cut in two and asked for again.

The transport is named by the option ``transport`` ("package.module:factory"): the factory gets the options, on the
executor, and returns a function from (endpoint, parameters) to (status, body, headers). ``recorded`` replays answers
from a folder that all executors see.

Options: endpoint; symbols (separated by commas); start and end (dates); days of a window; calls a minute; parallel
(partitions at most); retries; page (rows of a page); most (bars of an answer at most).

Rows have the endpoint's fields, ``symbol`` as it was asked for, and ``slice``: which request of its symbol, or page, they
come from, so that ``vendor.stitched`` can make one series of them. A field that an answer lacks, or that
has a value of another kind, is null.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BooleanType, DoubleType, StructType

from tickerforge.sources import vendor

NAME = "tickerforge_vendor"
#: Which parameters an endpoint's requests have.
WINDOWED, BY_SYMBOL = ("eod_raw", "eod_split_adjusted"), ("profile", "splits", "dividends")
PAGED = ("company_screener", "delisted_companies")
Transport = Callable[[str, dict], tuple[int, str, dict]]


def recorded(options: dict) -> Transport:
    """Answers from files of the folder in ``answers``: endpoint[_symbol][_start][_page].json; 404 if there is none."""

    def get(endpoint: str, asked: dict) -> tuple[int, str, dict]:
        name = "_".join([endpoint, *[str(asked[k]) for k in ("symbol", "from", "page") if k in asked]])
        path = Path(options["answers"]) / f"{name}.json"
        return (200, path.read_text(), {}) if path.exists() else (404, f"no answer {name}", {})

    return get


def transport_of(options: dict) -> Transport:
    module, _, factory = options.get("transport", f"{__name__}:recorded").partition(":")
    return getattr(importlib.import_module(module), factory)(options)


class Requests(InputPartition):
    """Some requests (slice, parameters), and the calls a minute that they may make."""

    def __init__(self, asked: list[tuple[int, dict]], calls: int) -> None:
        self.asked, self.calls = asked, calls


class VendorReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType) -> None:
        self.options, self.schema, self.endpoint = options, schema, options["endpoint"]

    def partitions(self) -> list[Requests]:
        o, symbols = self.options, [s.strip() for s in self.options.get("symbols", "").split(",") if s.strip()]
        asked: list[tuple[int, dict]] = [(0, {})]
        if self.endpoint in WINDOWED + BY_SYMBOL:
            asked = [(0, {"symbol": s}) for s in symbols]
        if self.endpoint in WINDOWED and o.get("start"):
            end = date.fromisoformat(o["end"]) if o.get("end") else date.today()
            windows = vendor.date_windows(date.fromisoformat(o["start"]), end, int(o.get("days", vendor.WINDOW_DAYS)))
            asked = [(k, {"symbol": s, "from": str(a), "to": str(b)}) for s in symbols for k, (a, b) in enumerate(windows)]
        elif self.endpoint in WINDOWED and o.get("end"):
            asked = [(k, r | {"to": o["end"]}) for k, r in asked]
        parts = max(1, min(len(asked), int(o.get("parallel", 32))))
        calls = max(1, int(o.get("calls", 280)) // parts)
        return [Requests(asked[len(asked) * i // parts : len(asked) * (i + 1) // parts], calls) for i in range(parts)]

    def read(self, partition: Requests) -> Iterator[tuple]:
        o, get = self.options, transport_of(self.options)
        limiter = vendor.RateLimiter(partition.calls)

        def answer(asked: dict) -> list[dict]:
            return vendor.flatten(vendor.fetch(lambda: get(self.endpoint, asked), limiter, int(o.get("retries", 4)), time.sleep))

        for number, asked in partition.asked:
            if self.endpoint in PAGED:
                size = int(o.get("page", 100))
                rows = enumerate(vendor.pages(lambda n: answer({"page": n}), size))
                yield from (self.row(r, i // size, asked) for i, r in rows)
            else:
                yield from (self.row(r, number, asked) for r in self.whole(answer, asked))

    def whole(self, answer: Callable[[dict], list[dict]], asked: dict) -> list[dict]:
        """The bars of a window, in two halves if an answer is as long as it may be."""
        rows = answer(asked)
        if "from" not in asked or len(rows) < int(self.options.get("most", vendor.MOST_BARS)):
            return rows
        low, high = date.fromisoformat(asked["from"]), date.fromisoformat(asked["to"])
        if low >= high:
            return rows
        middle = low + (high - low) // 2
        return [r for a, b in ((low, middle), (middle + timedelta(days=1), high)) for r in self.whole(answer, asked | {"from": str(a), "to": str(b)})]

    def row(self, record: dict, number: int, asked: dict) -> tuple:
        return tuple(number if f.name == "slice" else asked["symbol"] if f.name == "symbol" and "symbol" in asked else _value(record.get(f.name), f.dataType) for f in self.schema)


def _value(value: object, kind: object):
    if value is None:
        return None
    if isinstance(kind, DoubleType):
        try:
            return None if isinstance(value, bool) else float(value)
        except (TypeError, ValueError):
            return None
    if isinstance(kind, BooleanType):
        return value if isinstance(value, bool) else None
    return value if isinstance(value, str) else json.dumps(value)


class VendorSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        endpoint = self.options.get("endpoint", "")
        if endpoint not in vendor.ENDPOINTS:
            raise vendor.SourceError(f"no endpoint {endpoint!r}")
        fields = vendor.ENDPOINTS[endpoint]
        return f"{fields if fields.startswith('symbol ') else f'symbol string, {fields}'}, slice int"

    def reader(self, schema: StructType) -> VendorReader:
        return VendorReader(dict(self.options), schema)


def read(spark: SparkSession, endpoint: str, **options: object) -> DataFrame:
    """The rows of an endpoint, with the options given; None is none."""
    spark.dataSource.register(VendorSource)
    return spark.read.format(NAME).options(endpoint=endpoint, **{k: str(v) for k, v in options.items() if v is not None}).load()


def bars(spark: SparkSession, symbols: list[str], endpoint: str = "eod_raw", **options: object) -> DataFrame:
    """Bars as the feed has them, one for each symbol and date, of which the latest request's counts."""
    rows = read(spark, endpoint, symbols=",".join(symbols), **options)
    return vendor.stitched(rows.where("date IS NOT NULL"), ["symbol", "date"], "slice").drop("slice")
