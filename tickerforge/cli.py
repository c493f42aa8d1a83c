"""Command line: prices (ph), yield curves (yc), listings and screens (ls), returns (rc), indicators (ti), data quality (dq), status."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerforge.functions.periods import DAYS, date_range, parse_bounds, parse_day
from tickerforge.operators import adjust, dq, indicators, rates, resample, returns, screen, stats, validate
from tickerforge.sources import feed, files, vendor
from tickerforge.sources.settings import Settings

#: Field choices of price requests; one at most.
FIELD_SETS = {"ohlc": ["open", "high", "low", "close"], "hlc": ["high", "low", "close"], "close": ["close"], "hlcv": ["high", "low", "close", "volume"], "cv": ["close", "volume"]}
RETURNS = {"simple": ("simple_ret", returns.simple), "log": ("log_ret", returns.log), "diff": ("diff", returns.difference)}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tickerforge", description=__doc__)
    p.add_argument("-S", "--source", help="live or db")
    p.add_argument("--config", help="a TOML file of settings")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name, help=text)
        c.add_argument("-o", "--output")
        c.add_argument("--json", action="store_true")
        c.add_argument("--stats", action="store_true", help="summary statistics instead of rows")
        c.add_argument("--precision", type=int)
        return c

    def dates(c: argparse.ArgumentParser) -> None:
        c.add_argument("-s", "--start")
        c.add_argument("-e", "--end")
        c.add_argument("-n", "--limit", type=int)

    ph = command("ph", "price history")
    ph.add_argument("symbol")
    dates(ph)
    ph.add_argument("-f", "--frequency", choices=list(DAYS), default="day")
    ph.add_argument("--adj", action="store_true")
    fields = ph.add_mutually_exclusive_group()
    for name in FIELD_SETS:
        fields.add_argument(f"--{name}", action="store_true")
    yc = command("yc", "yield curves")
    dates(yc)
    yc.add_argument("--zero", action="store_true")
    yc.add_argument("--interval", choices=list(rates.INTERVALS))
    yc.add_argument("--key-rates", action="store_true")
    ls = command("ls", "listings and screens")
    ls.add_argument("--sectors", action="store_true")
    ls.add_argument("--industries", action="store_true")
    ls.add_argument("--sector", type=lambda s: s.split(","))
    ls.add_argument("--industry", type=lambda s: s.split(","))
    ls.add_argument("-n", "--limit", type=int)
    for name in ("market-cap", "price", "beta", "volume", "dividend"):
        ls.add_argument(f"--{name}", action="append", default=[], help="such as '>50'; twice for a range")
    for name in ("exchange", "country"):
        ls.add_argument(f"--{name}")
    rc = command("rc", "returns of a price file")
    rc.add_argument("-i", "--input", required=True)
    rc.add_argument("--kind", choices=list(RETURNS), default="simple")
    rc.add_argument("--lookback", type=int, default=1)
    rc.add_argument("--cumulative", action="store_true")
    rc.add_argument("--annualized", action="store_true", help="yearly rates of the growth so far")
    rc.add_argument("--periods", type=int, help="periods in a year; by default from the dates")
    rc.add_argument("--append", action="store_true")
    ti = command("ti", "technical indicators of a price file")
    ti.add_argument("indicator", choices=("sma", "ema", "rsi", "macd"))
    ti.add_argument("-i", "--input", required=True)
    ti.add_argument("-c", "--column", action="append")
    ti.add_argument("-w", "--window", type=int)
    command("dq", "all data-quality checks of the warehouse")
    command("status", "what the warehouse holds")
    return p


def _table(spark: SparkSession, settings: Settings, name: str) -> DataFrame:
    if not settings.warehouse:
        raise SystemExit("no warehouse is set")
    return spark.read.parquet(f"{settings.warehouse}/{name}")


def price_history(spark: SparkSession, settings: Settings, a: argparse.Namespace) -> DataFrame:
    start, end = date_range(a.start, a.end, a.limit, a.frequency)
    if settings.source == "live":
        return _live_history(spark, settings, a, start, end)
    securities, xref = _table(spark, settings, "securities"), _table(spark, settings, "symbol_xref")
    found = screen.resolve(spark.createDataFrame([(a.symbol,)], "symbol string"), xref, securities, "vendor").first()
    if found is None or found["security_id"] is None:
        raise SystemExit(f"unknown symbol {a.symbol}")
    key = found["security_id"]
    bars = files.price_history(spark, f"{settings.warehouse}/daily_price", key, start, end)
    if a.adj:
        bars = adjust.adjusted_bars(bars, _table(spark, settings, "adjustment_factor").where(F.col("security_id") == key))
    return _shown(bars, settings, a)


def _live_history(spark: SparkSession, settings: Settings, a: argparse.Namespace, start: date | None, end: date | None) -> DataFrame:
    """Bars from the vendor: raw ones as they traded, or with --adj its split-adjusted ones."""
    folder = {"answers": settings.vendor_folder, "transport": settings.vendor_transport, "calls": settings.rate_per_minute}
    asked = feed.bars(spark, [a.symbol.strip().upper()], "eod_split_adjusted" if a.adj else "eod_raw", start=start, end=end, **folder)
    typed = validate.checked_bars(asked.withColumn("security_id", F.lit(0).cast("long"))).where("trade_date IS NOT NULL")
    bars = typed.select("security_id", "trade_date", "open", "high", "low", "close", "volume", "vwap")
    if start:
        bars = bars.where(F.col("trade_date") >= F.lit(start))
    if end:
        bars = bars.where(F.col("trade_date") <= F.lit(end))
    return _shown(bars, settings, a)


def _shown(bars: DataFrame, settings: Settings, a: argparse.Namespace) -> DataFrame:
    if a.frequency != "day":
        bars = resample.resample(bars, a.frequency, keep_empty=settings.source == "db")
    chosen = next((f for n, f in FIELD_SETS.items() if getattr(a, n)), FIELD_SETS["ohlc"] + ["volume"])
    rows = resample.limited(bars, a.limit, parse_day(a.start) is not None, parse_day(a.end) is not None)
    return resample.select_fields(rows, chosen, strict=settings.source != "db").drop("security_id").orderBy("trade_date")


def yield_curves(spark: SparkSession, settings: Settings, a: argparse.Namespace) -> DataFrame:
    wide = vendor.FileSource(spark, settings.vendor_folder or ".").read("treasury_rates")
    tenors = [c for c in wide.columns if c != "date"]
    curve = wide.unpivot("date", tenors, "tenor", "rate").select(F.col("date").cast("date").alias("curve_date"), "tenor", F.col("rate").cast("double").alias("rate"))
    rows = rates.yield_curve(curve, a.start, a.end, a.limit, a.zero, a.interval)
    if a.key_rates:
        rows = rates.key_rates(rows)
    if rows.select("curve_date").distinct().limit(2).count() == 1:
        return rates.single_date(rows, a.zero).orderBy("years")
    names = [r["tenor"] for r in rows.select("tenor", "months").distinct().orderBy("months").collect()]
    return rates.wide(rows, names).orderBy("curve_date")


def listing(spark: SparkSession, settings: Settings, a: argparse.Namespace) -> DataFrame:
    snapshot = _table(spark, settings, "security_latest")
    if a.sectors or a.industries:
        column = "sector_name" if a.sectors else "industry_name"
        return screen.listing(snapshot.select(column).distinct(), column)
    ranges = {n: parse_bounds(getattr(a, n), whole=n == "volume") for n in ("market_cap", "price", "beta", "volume") if getattr(a, n)}
    equals = {n: getattr(a, n) for n in ("exchange", "country") if getattr(a, n)}
    if not (ranges or equals or a.sector or a.industry):
        return screen.active_symbols(snapshot, a.limit)
    if settings.source == "db":
        return screen.screen(snapshot, ranges, equals, a.sector, a.industry, a.limit)
    if a.sector or a.industry:
        return screen.screen_any(snapshot, a.sector or [], a.industry or [], a.limit, ranges=ranges, equals=equals)
    return screen.screen(snapshot, ranges, equals, limit=a.limit)


def _series(spark: SparkSession, path: str) -> DataFrame:
    """A price file as one series, in order of its dates."""
    frame = files.read_table(spark, path)
    if "date" not in frame.columns:
        raise SystemExit("the file needs a date column")
    return frame.withColumn("date", F.col("date").cast("date")).withColumn("series", F.lit(0))


def file_returns(spark: SparkSession, settings: Settings, a: argparse.Namespace) -> DataFrame:
    frame = _series(spark, a.input)
    suffix, kind = RETURNS[a.kind]
    w, so_far = returns.series("series", "date"), returns.so_far("series", "date")
    columns = returns.numeric_columns(frame, ("series",))
    out = frame.select("date", "series", *columns, *[kind(c, a.lookback, w).alias(returns.named(c, suffix, a.lookback)) for c in columns])
    if (a.cumulative or a.annualized) and a.kind != "diff":
        fold = returns.cumulative_simple if a.kind == "simple" else returns.cumulative_log
        out = out.withColumns({returns.named(c, f"cum_{a.kind}", a.lookback): fold(F.col(returns.named(c, suffix, a.lookback)), so_far) for c in columns})
        if a.annualized:
            per_year = out.join(returns.periods_per_year(frame, "series", "date"), "series", "left")
            out = per_year.withColumns({returns.named(c, f"ann_{a.kind}", a.lookback): returns.annualized(F.col(returns.named(c, f"cum_{a.kind}", a.lookback)), F.col("ppy") if a.periods is None else a.periods, a.kind, so_far) for c in columns}).drop("ppy")
            if not a.cumulative:
                out = out.drop(*[returns.named(c, f"cum_{a.kind}", a.lookback) for c in columns])
    return (out if a.append else out.drop(*columns)).drop("series").orderBy("date")


def file_indicators(spark: SparkSession, settings: Settings, a: argparse.Namespace) -> DataFrame:
    frame = _series(spark, a.input)
    columns = a.column or returns.numeric_columns(frame, ("series",))
    window = {"n": a.window} if a.window else {}
    if a.indicator == "sma":
        out = frame.select("date", "series", *[indicators.sma(c, a.window or 20, "series", "date") for c in columns])
    else:
        out = getattr(indicators, a.indicator)(frame, columns, key="series", order="date", **(window if a.indicator != "macd" else {}))
    return out.drop("series").orderBy("date")


def quality(spark: SparkSession, settings: Settings, a: argparse.Namespace) -> DataFrame:
    t = {n: _table(spark, settings, n) for n in ("daily_price", "corporate_action", "securities", "trading_calendar")}
    return dq.open_flags(dq.run_all(t["daily_price"], t["corporate_action"], t["securities"], t["trading_calendar"], threshold=settings.outlier_threshold))


def status(spark: SparkSession, settings: Settings, a: argparse.Namespace) -> DataFrame:
    from tickerforge.operators.state import status_counts

    return status_counts(*[_table(spark, settings, n) for n in ("securities", "daily_price", "corporate_action", "dq_flag")])


COMMANDS = {"ph": price_history, "yc": yield_curves, "ls": listing, "rc": file_returns, "ti": file_indicators, "dq": quality, "status": status}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> str:
    """Runs a command; returns (and prints) what it shows."""
    a = parser().parse_args(argv)
    settings = Settings.load(a.config)
    if a.source:
        from tickerforge.sources.settings import choose_source

        settings.source = choose_source(a.source, settings.warehouse)
    frame = COMMANDS[a.command](spark or SparkSession.builder.getOrCreate(), settings, a)
    if a.precision is not None:
        frame = frame.select(*[F.bround(c, a.precision).alias(c) if t in ("double", "float") or t.startswith("decimal") else F.col(c) for c, t in frame.dtypes])
    if a.stats:
        day = "trade_date" if "trade_date" in frame.columns else "date"
        text = stats.report(stats.summary(frame, day).collect(), a.precision if a.precision is not None else 4)
    else:
        text = files.as_text(frame, "json" if a.json else "csv")
    name = getattr(a, "symbol", a.command)
    path = files.output_path(a.output, name, parse_day(getattr(a, "start", None)), parse_day(getattr(a, "end", None)), "json" if a.json else "csv")
    if path:
        with open(path, "w") as f:
            f.write(text)
    else:
        print(text)
    return text


if __name__ == "__main__":
    main()
