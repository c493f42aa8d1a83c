import datetime as dt
import json
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerforge import schemas
from tickerforge.functions import scalars
from tickerforge.functions.periods import date_range, parse_bounds
from tickerforge.operators import dq, merge, probe, screen, state, trading_calendar, validate
from tickerforge.sources import files, settings, vendor
from tickerforge.streaming import loader

D = dt.date
T = D(2024, 6, 1)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "args, want",
    [
        ({"start": D(2024, 1, 1)}, (D(2024, 1, 1), T)), ({"end": "2023-12-31"}, (None, D(2023, 12, 31))), ({"start": D(2024, 1, 1), "limit": 10}, (D(2024, 1, 1), D(2024, 1, 11))),
        ({"start": D(2024, 5, 30), "limit": 10}, (D(2024, 5, 30), T)), ({"end": D(2023, 12, 31), "limit": 10, "frequency": "week"}, (D(2023, 10, 22), D(2023, 12, 31))),
        ({"limit": 30}, (D(2024, 4, 2), T)), ({}, (None, None)), ({"start": D(2023, 1, 1), "end": D(2023, 2, 1)}, (D(2023, 1, 1), D(2023, 2, 1))),
    ],
)
def test_date_range(args, want):
    assert date_range(**args, today=T) == want


def test_date_range_errors():
    with pytest.raises(ValueError):
        date_range(D(2023, 1, 1), D(2023, 2, 1), 3)
    with pytest.raises(ValueError):
        date_range(limit=1, frequency="hour")


def test_bounds():
    assert parse_bounds((">50", "<100")) == (50.0, 100.0)
    assert parse_bounds((">1e3",), whole=True) == (1000, None)
    for bad in ((">1", ">2"), ("5",), (">x",)):
        with pytest.raises(ValueError):
            parse_bounds(bad)


def test_scalars(spark):
    assert one(spark, scalars.parse_date(F.lit("2023-6-1"))) == D(2023, 6, 1)
    assert one(spark, scalars.parse_date(F.lit("2023-02-30"))) is None
    assert one(spark, scalars.tenor_months(F.lit("Year1.5"))) == 18 and one(spark, scalars.tenor_months(F.lit("days3"))) is None
    assert [one(spark, scalars.months_tenor(F.lit(m))) for m in (1.0, 6.0, 12.0, 18.0, 1.25)] == ["month1", "month6", "year1", "year1.5", "month1.25"]
    assert one(spark, scalars.redact(F.lit("u?ApiKey=abc&x=1"))) == "u?ApiKey=***&x=1"
    assert one(spark, scalars.norm_exchange(F.lit(""), F.lit(" nyseamerican"))) == "AMEX"
    assert one(spark, scalars.bounded(F.lit(1e22), 24, 2)) is None and one(spark, scalars.bounded(F.lit(1e21), 24, 2)) == 1e21


BARS = [
    ({"date": "2023-06-01", "adjOpen": "39", "adjHigh": 40, "adjLow": 38, "adjClose": 39.2, "volume": "10.9"}, None), ({"date": "x", "open": 1, "high": 1, "low": 1, "close": 1}, "unparseable_date"),
    ({"date": "2023-06-01", "open": 1, "high": 1, "low": 1}, "missing_or_nonnumeric_ohlc"), ({"date": "2023-06-01", "open": 1, "high": 1, "low": 1, "close": 1, "volume": "many"}, "nonnumeric_volume"),
    ({"date": "2023-06-01", "open": 0, "high": 1, "low": 1, "close": 1}, "non_positive_price"), ({"date": "2023-06-01", "open": 0, "adjOpen": 1, "high": 1, "low": 1, "close": 1}, None),
    ({"date": "2023-06-01", "open": 1, "high": 1, "low": 2, "close": 1}, "cross_field_violation"), ({"date": "2023-06-01", "open": 1, "high": 1, "low": 1, "close": 1, "volume": -1}, "negative_volume"),
    ({"date": "2023-06-01", "open": 1, "high": 1, "low": 1, "close": 1, "volume": -1, "unadjustedVolume": 5, "vwap": "junk"}, None),
]


@pytest.mark.parametrize("bar, reason", BARS)
def test_bar_rules(spark, bar, reason):
    frame = spark.read.json(spark.sparkContext.parallelize([json.dumps(bar | {"security_id": 1})]))
    row = validate.checked_bars(frame).first()
    assert row["reason"] == reason
    if bar.get("volume") == "10.9":
        assert row["volume"] == 10 and row["open"] == 39.0


def test_actions_are_checked(spark):
    s = spark.createDataFrame([(1, "2023-06-01", 2.0, 1.0), (1, "2023-06-01", 0.0, 1.0), (1, "bad", 2.0, 1.0)], "security_id long, date string, splitTo double, splitFrom double")
    d = spark.createDataFrame([(1, "2023-06-01", 0.5), (1, "2023-06-01", -0.5), (1, "2023-06-01", None)], "security_id long, date string, adjDividend double")
    assert sorted(str(r["reason"]) for r in validate.checked_actions(s, d).collect()) == ["None", "None", "dividend_invalid", "dividend_invalid", "split_invalid", "split_invalid"]


def test_table_checks(spark):
    rows = spark.createDataFrame([(1.0, 2.0, 0.5, 1.0, 5), (1.0, 0.9, 0.5, 1.0, -1)], "open double, high double, low double, close double, volume long")
    assert sorted(r["check"] for r in validate.violations("daily_price", rows).collect()) == ["high_close", "high_open", "volume"]


def marks(spark, good, bad, runs):
    g = spark.createDataFrame([(1, d) for d in good], "security_id long, trade_date date")
    b = spark.createDataFrame([(1, d) for d in bad], "security_id long, trade_date date")
    history = b
    for _ in range(runs - 1):
        history = history.unionByName(b)
    found = state.advance(g, b, history).first()
    return found and found["watermark"]


def test_a_bad_date_holds_the_mark_until_its_fifth_run(spark):
    good, bad = [D(2023, 6, 1), D(2023, 6, 5)], [D(2023, 6, 2)]
    assert [marks(spark, good, bad, n) for n in (1, 4, 5)] == [D(2023, 6, 1), D(2023, 6, 1), D(2023, 6, 5)]


def test_load_guards(spark):
    m = spark.createDataFrame([("vendor", state.OLD_ENDPOINT, 1, D(2023, 1, 1))], loader.MARKS)
    with pytest.raises(RuntimeError):
        state.guard_changeover(m, None)
    state.guard_changeover(m, D(2020, 1, 1))
    for args in ((0, 0, 0, False), (2, 2, 5, False), (2, 0, 0, True)):
        with pytest.raises(RuntimeError):
            state.guard_load(*args)


def test_runs_end_with_a_status(spark):
    run = spark.createDataFrame([("r1", "vendor")], "run_id string, source string")
    assert [state.finished_run(run, 1, q, e).first()["status"] for q, e in ((0, None), (2, None), (0, "x"))] == ["success", "partial", "failed"]


MASTER = "security_id long, source string, primary_symbol string, exchange_code string, company_name string, beta double, delisted_date date"


def test_a_reused_ticker_gets_an_id_of_its_own(spark):
    stored = spark.createDataFrame([(1, "v", "AAA", "NYSE", "old", 1.0, D(2020, 1, 1)), (2, "v", "BBB", None, "b", 2.0, None)], MASTER)
    news = spark.createDataFrame([("v", "AAA", "NYSE", "new", None), ("v", "BBB", None, "b2", None), ("v", "CCC", None, "c", 3.0)], "source string, primary_symbol string, exchange_code string, company_name string, beta double")
    out = {(r["primary_symbol"], r["company_name"]): (r["security_id"], r["beta"]) for r in merge.upsert_securities(stored, news).collect()}
    assert out["AAA", "old"] == (1, 1.0) and out["BBB", "b2"] == (2, 2.0)
    assert {out["AAA", "new"][0], out["CCC", "c"][0]} == {3, 4}


def test_upserts_are_idempotent(spark):
    stored = spark.createDataFrame([(1, D(2023, 1, 1), 1.0)], "k long, d date, v double")
    news = spark.createDataFrame([(1, D(2023, 1, 1), 2.0), (2, D(2023, 1, 1), 3.0)], "k long, d date, v double")
    once = merge.upsert(stored, news, ["k", "d"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, merge.upsert(once, news, ["k", "d"]).collect()))
    assert sorted(map(tuple, merge.replace_groups(stored, news, "k").collect())) == sorted(map(tuple, news.collect()))
    assert [r["k"] for r in merge.replace_groups(stored.unionByName(news.withColumn("k", F.col("k") + 10)), news.limit(0), "k", stored).orderBy("k").collect()] == [11, 12]


def test_endpoints_are_read_by_their_schema(spark, tmp_path):
    (tmp_path / "splits.json").write_text('[{"symbol": "A", "date": "2023-01-02", "numerator": 2, "denominator": 1, "label": "x"}]')
    (tmp_path / "sectors.json").write_text("[]")
    source = vendor.FileSource(spark, str(tmp_path))
    row = source.read("splits").first()
    assert (row["numerator"], row["splitTo"]) == (2.0, None) and "label" not in row
    assert source.read("sectors").columns == ["sector"] and source.read("sectors").count() == 0
    with pytest.raises(vendor.SourceError):
        source.read("nothing")


def test_calendar(spark):
    days = [r["trade_date"] for r in trading_calendar.trading_days(spark, 2021, 2023).collect()]
    assert sum(d.year == 2023 for d in days) == 250
    assert D(2021, 12, 31) in days and D(2023, 6, 19) not in days and D(2023, 4, 7) not in days
    assert [trading_calendar.easter(y) for y in (1990, 2000, 2024, 2025, 2038)] == [D(1990, 4, 15), D(2000, 4, 23), D(2024, 3, 31), D(2025, 4, 20), D(2038, 4, 25)]


def test_gap_and_outlier(spark):
    b = spark.createDataFrame([(1, D(2023, 6, 1), 100.0), (1, D(2023, 6, 5), 200.0)], "security_id long, trade_date date, close double")
    cal = trading_calendar.trading_calendar(spark, 2023, 2024)
    assert [r["trade_date"] for r in dq.gaps(b, cal).collect()] == [D(2023, 6, 2)]
    none = spark.createDataFrame([], "security_id long, ex_date date, action_type string")
    assert dq.outliers(b, none).count() == 1
    assert dq.outliers(b, spark.createDataFrame([(1, D(2023, 6, 5), "split")], none.schema)).count() == 0


def test_screen_needs_a_leg(spark):
    s = spark.createDataFrame([("A", "a", "x", "y", 1.0)], "symbol string, company_name string, sector_name string, industry_name string, beta double")
    with pytest.raises(ValueError):
        screen.screen_any(s, [], [])
    assert screen.screen(s, {"beta": (1.0, None)}, dividend=(1, None)).count() == 0
    with pytest.raises(ValueError):
        screen.pick(s)


def test_universe(spark):
    rows = [(0, "AAA ", "NASDAQ", False), (1, "BBB", "NASDAQ DUBAI", False), (2, "AAA", "NYSE", True), (3, "CCC", "BATS", True), (4, "", "NYSE", False)]
    s = spark.createDataFrame(rows, "ordinal int, symbol string, exchangeShortName string, isEtf boolean")
    assert sorted((r["symbol"], r["asset_type"]) for r in validate.us_universe(s).collect()) == [("AAA", "equity"), ("CCC", "etf")]
    assert validate.us_universe(s, etfs=False).count() == 1
    both = validate.with_etfs(s.select("symbol"), spark.createDataFrame([("CCC",), ("DDD",)], "symbol string"))
    assert {r["symbol"]: r["is_etf"] for r in both.collect()}["DDD"]


def test_probe_report():
    assert "verdict: feeds_agree" in probe.report({"verdict": "feeds_agree"})


def test_vendor_pieces(spark):
    calls = iter([(429, "", {"Retry-After": "999"}), (200, '[{"a": 1}]', {})])
    waits = []
    limiter = vendor.RateLimiter(5)
    assert vendor.fetch(lambda: next(calls), limiter, sleep=waits.append) == [{"a": 1}] and waits == [120]
    with pytest.raises(vendor.SourceError, match=r"apikey=\*\*\*"):
        vendor.fetch(lambda: (200, '{"Error Message": "apikey=abc"}', {}), limiter)
    clock = iter([0.0, 0.0, 0.0, 61.0]).__next__
    slept = []
    slow = vendor.RateLimiter(2, clock=clock, sleep=slept.append)
    for _ in range(3):
        slow.acquire()
    assert len(slept) == 1
    data = [[{"symbol": "A"}, {"symbol": "B"}], [{"symbol": "C"}]]
    assert [r["symbol"] for r in vendor.pages(lambda n: data[n], 2)] == ["A", "B", "C"]
    assert len(list(vendor.pages(lambda n: data[0], 2))) == 2
    assert vendor.flatten({"historical": [1]}) == [1] and vendor.flatten({}) == [] and vendor.flatten([2]) == [2]
    assert vendor.names_of(["X", {"sector": "Y"}, None, " "], "sector") == ["X", "Y"]
    assert vendor.date_windows(D(1990, 1, 1), D(2024, 6, 30))[0] == (D(1990, 1, 1), D(2004, 12, 27))
    raw = spark.createDataFrame([("a", '[{"c": 1}]'), ("b", '{"historical": [{"c": 2}, {"c": 3}]}')], "s string, payload string")
    assert sorted(map(tuple, vendor.flatten_frame(raw, "c: int").collect())) == [("a", 1), ("b", 2), ("b", 3)]


def test_files(spark, tmp_path):
    rows = spark.createDataFrame([(1, D(2022, 12, 30), 1.0), (1, D(2023, 1, 3), 2.0), (2, D(2023, 1, 3), 3.0)], "security_id long, trade_date date, close double")
    files.write_prices(rows, str(tmp_path / "p"))
    got = files.price_history(spark, str(tmp_path / "p"), 1, D(2023, 1, 1))
    assert [r["close"] for r in got.collect()] == [2.0]
    files.write_table(rows, str(tmp_path / "t.JSON"))
    assert spark.read.json(str(tmp_path / "t.JSON")).count() == 3
    assert files.output_path(str(tmp_path), "AAA", None, D(2023, 1, 1), "csv").endswith("AAA_earliest_2023-01-01.csv")


def test_settings(tmp_path):
    (tmp_path / "c.toml").write_text('overlap_days = 7\nwarehouse = "w"\n')
    s = settings.Settings.load(str(tmp_path / "c.toml"), {"TICKERFORGE_OVERLAP_DAYS": "9"})
    assert (s.overlap_days, s.warehouse, s.source) == (9, "w", "db")
    with pytest.raises(ValueError):
        settings.choose_source("other", None)


def test_cli(spark, tmp_path, monkeypatch):
    from tickerforge import cli

    (tmp_path / "p.csv").write_text("date,close\n2023-01-02,100\n2023-01-03,110\n")
    text = cli.main(["rc", "-i", str(tmp_path / "p.csv"), "--precision", "3"], spark)
    assert "close_simple_ret" in text and "0.1" in text
    assert "close_sma_2" in cli.main(["ti", "sma", "-i", str(tmp_path / "p.csv"), "-w", "2", "--json"], spark)
    home = tmp_path / "w"
    D_ = "decimal(20,6)"
    rows = [(1, D(2023, 1, 2), Decimal(1), Decimal(2), Decimal(1), Decimal(2), 5), (1, D(2023, 1, 3), Decimal(2), Decimal(3), Decimal(2), Decimal(3), 6)]
    files.write_prices(spark.createDataFrame(rows, f"security_id long, trade_date date, open {D_}, high {D_}, low {D_}, close {D_}, volume long"), str(home / "daily_price"))
    spark.createDataFrame([(1, "AAA", "vendor", None, True)], "security_id long, primary_symbol string, source string, delisted_date date, is_actively_trading boolean").write.parquet(str(home / "securities"))
    spark.createDataFrame([], "security_id long, symbol string, valid_from date, valid_to date, is_primary boolean").write.parquet(str(home / "symbol_xref"))
    monkeypatch.setenv("TICKERFORGE_WAREHOUSE", str(home))
    assert cli.main(["ph", "AAA", "-s", "2023-01-01", "-n", "1", "--close"], spark).split() == ["trade_date,close", "2023-01-02,2.000000"]
    assert "max 3" in cli.main(["ph", "AAA", "-s", "2023-01-01", "-e", "2023-02-01", "--stats", "--precision", "0"], spark)


def test_nightly_update_and_reset(spark):
    from tickerforge.plans import daily

    day, price = D(2023, 6, 1), "open double, high double, low double, close double, volume long, vwap double"
    tables = {
        "security": spark.createDataFrame([(1, "v", "AAA", True, None)], "security_id long, source string, primary_symbol string, is_actively_trading boolean, delisted_date date"),
        "symbol_xref": spark.createDataFrame([(1, "AAA", D(2000, 1, 1), None, True)], "security_id long, symbol string, valid_from date, valid_to date, is_primary boolean"),
        "trading_calendar": trading_calendar.trading_calendar(spark, 2022, 2022), "daily_price": spark.createDataFrame([(1, day, 100.0, 100.0, 100.0, 100.0, 10, None)], f"security_id long, trade_date date, {price}"),
        "corporate_action": spark.createDataFrame([], "security_id long, action_type string, ex_date date, split_numerator double, split_denominator double, dividend_amount double"),
        "dq_flag": spark.createDataFrame([], loader.FLAGS), "watermark": spark.createDataFrame([], loader.MARKS),
    }
    bars = spark.createDataFrame([(1, "2023-06-02", 50.0, 51.0, 50.0, 50.0, 20.0, None, 1), (1, "2023-06-05", 50.0, 40.0, 50.0, 50.0, 20.0, None, 2)], "security_id long, date string, open double, high double, low double, close double, volume double, vwap double, ordinal int")
    splits = spark.createDataFrame([(1, "2023-06-02", 2.0, 1.0)], "security_id long, date string, numerator double, denominator double")
    dividends = spark.createDataFrame([], "security_id long, date string, dividend double")
    delisted = spark.createDataFrame([("AAA", "LSE", "2023-07-01")], "symbol string, exchange string, delistedDate string")
    out = daily.update(tables, bars, splits, dividends, delisted, 2023, "v")
    assert out["daily_price"].count() == 2 and out["adjustment_factor"].first()["price_factor"] == Decimal("0.5")
    assert out["watermark"].first()["watermark"] == D(2023, 6, 2) and out["security_latest"].first()["last_close"] == 50.0
    assert [r["check_name"] for r in out["dq_flag"].collect()] == ["price_cross_field_violation"]

    # Bad actions and actions without a factor are flagged, runs recorded, loads that can't be right refused.
    tables["ingestion_run"] = spark.createDataFrame([], schemas.INGESTION_RUN)
    bad = splits.unionByName(spark.createDataFrame([(1, "2023-06-03", 0.0, 1.0)], splits.schema))
    paid = spark.createDataFrame([(1, "2023-06-01", 1.0), (1, "2023-06-05", 500.0), (1, "soon", 1.0)], dividends.schema)
    night = daily.update(tables, bars, bad, paid, delisted, 2023, "v")
    assert sorted((r["check_name"], r["severity"]) for r in night["dq_flag"].collect()) == [("dividend_exceeds_price", "warn"), ("dividend_invalid", "warn"), ("dividend_no_prior_close", "info"), ("price_cross_field_violation", "warn"), ("split_invalid", "warn")]
    assert [(r["status"], r["rows_inserted"], r["rows_quarantined"]) for r in night["ingestion_run"].collect()] == [("partial", 1, 3)]
    unknown = spark.createDataFrame([("ZZZ",)], "symbol string")
    for args in ({"symbols": unknown}, {"symbols": unknown.limit(0)}):
        with pytest.raises(RuntimeError):
            daily.update(tables, bars, splits, dividends, delisted, 2023, "v", **args)
    with pytest.raises(RuntimeError):
        daily.update(tables, bars.limit(0), splits, dividends, delisted, 2023, "v", start=D(2023, 6, 1))

    assert daily.reset(out, "prices")[1] == ("daily_price", "watermark") and out["daily_price"].count() == 2
    assert daily.reset(out, "prices", dry_run=False)[0]["daily_price"].count() == 0
    with pytest.raises(ValueError):
        daily.reset(out, "nothing")


def test_quantiles_are_exact(spark):
    from tickerforge.operators import stats

    rng = np.random.default_rng(4)
    fields = {
        "normal": rng.normal(size=999), "ties": rng.integers(0, 5, 400).astype(float), "wide": np.exp(rng.normal(size=501) * 50) * rng.choice([-1, 1], 501), "one": np.array([3.5]), "two": np.array([-1.0, 2.0]),
        "close": 1e6 + rng.random(300) * 1e-6, "edge": np.array([-np.inf, -1.0, 0.0, 0.0, 1e-310, 1.0, np.inf, np.inf]),
    }
    frame = spark.createDataFrame([(f, float(v)) for f, vs in fields.items() for v in vs], "field string, x double")
    ps = (0.0, 0.25, 0.5, 0.9, 1.0)
    got = {(r["field"], r["p"]): r["value"] for r in stats.quantiles(frame, ps).collect()}
    assert len(got) == len(fields) * len(ps)
    for f, vs in fields.items():
        for p in ps:
            v, at = np.sort(vs), p * (len(vs) - 1)
            a, b = v[int(np.floor(at))], v[int(np.ceil(at))]
            assert got[f, p] == pytest.approx(a if a == b else a + (b - a) * (at - np.floor(at)), rel=1e-12)


def test_summary_of_nulls_and_nothing(spark):
    from tickerforge.operators import stats

    frame = spark.createDataFrame([(D(2023, 1, 1), 1.0, None), (D(2023, 1, 2), float("nan"), None)], "date date, a double, b double")
    rows = {r["field"]: r for r in stats.summary(frame).collect()}
    assert (rows["a"]["n"], rows["a"]["median"], rows["a"]["max"]) == (2, 1.0, 1.0) and rows["b"]["p25"] is None
    assert stats.summary(frame.limit(0)).count() == 0


def test_quantiles_of_many_rows_take_two_scans(spark, monkeypatch):
    """Brackets narrower than the data; and brackets that miss their ranks, which the counts find out."""
    from tickerforge.operators import stats

    rng = np.random.default_rng(8)
    v = np.concatenate([rng.lognormal(size=12_000), np.full(5_000, 1.25)])
    frame = spark.createDataFrame([("a", float(x)) for x in v], "field string, x double").cache()
    want = {p: float(np.quantile(v, p)) for p in (0.001, 0.25, 0.5, 0.75, 0.999)}
    for misses in (False, True):
        if misses:  # the first brackets lie beside their ranks
            calls, plain = [], stats._within
            monkeypatch.setattr(stats, "_within", lambda values, brackets: plain(values, brackets if calls else brackets.withColumns({"lo": F.lit(-2.0), "hi": F.lit(calls.append(1) or -1.0)})))
        got = {r["p"]: r["value"] for r in stats.quantiles(frame, tuple(want)).collect()}
        assert got == pytest.approx(want, rel=1e-12)
    assert calls == [1]


@pytest.mark.parametrize("kind", ["double", "long", "string"])
def test_numbers_are_checked_as_their_text_is(spark, kind):
    """Fields that are numbers already aren't written and read as text, and give what their text gives."""
    rows = [(k, D(2023, 6, 1 + k), *[None if k == 3 else 40 + k] * 4, v) for k, v in enumerate((7, -3, None, 5, 0))] + [(9, None, 1, 1, 1, 1, 1)]
    typed = spark.createDataFrame(rows, "security_id long, date date, open int, adjOpen int, high int, close int, volume int").withColumn("low", F.col("high"))
    typed = typed.select("security_id", "date", *[F.col(c).cast(kind).alias(c) for c in ("open", "adjOpen", "high", "low", "close", "volume")])
    if kind == "double":
        odd = [(10, D(2023, 6, 1), 0.0, 0.1, 0.3, 0.05, 0.2, float("nan")), (11, D(2023, 6, 1), 1 / 3, None, float("inf"), 1e-300, 1.0, 9.9e18), (12, D(2023, 6, 1), float("nan"), 2.0, 3.0, 1.0, 2.0, -0.5)]
        typed = typed.unionByName(spark.createDataFrame(odd, typed.schema))
    as_text = typed.select("security_id", *[F.col(c).cast("string").alias(c) for c in typed.columns if c != "security_id"])
    found = validate.checked_bars(typed)
    given = ("date", "adjOpen")
    assert sorted(map(repr, found.drop(*given).collect())) == sorted(map(repr, validate.checked_bars(as_text).drop(*given).collect()))
    assert kind == "string" or "as string)" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_a_years_days_are_those_of_their_text(spark):
    days = spark.sql("SELECT DATE'0001-02-03' AS date UNION ALL SELECT DATE'9999-12-31' UNION ALL SELECT DATE'9999-12-31' + 1 UNION ALL SELECT DATE'0000-01-01' - 1")
    typed, text = (x.select(validate.day_field(x, "date").cast("string").alias("d")) for x in (days, days.select(F.col("date").cast("string"))))
    assert sorted(map(repr, typed.collect())) == sorted(map(repr, text.collect())) and typed.where("d IS NULL").count() == 2


def test_marks_of_checked_rows_are_those_of_their_flags(spark):
    """One scan gives what clean rows and flags apart give, bad dates flagged few and many times and missing keys and dates among them."""
    rows = [(s, d and D(2023, 6, d), None if good else "x") for s, d, good, n in ((1, 1, 1, 2), (1, 2, 0, 4), (1, 5, 1, 1), (2, 1, 1, 1), (2, 2, 0, 5), (2, 5, 1, 1), (2, 5, 0, 6), (3, 3, 1, 1), (3, 3, 0, 1), (4, None, 0, 1), (4, 7, 1, 1), (None, 2, 0, 1), (None, 4, 1, 1), (5, 1, 0, 1)) for _ in range(n)]
    checked = spark.createDataFrame(rows, "security_id long, trade_date date, reason string")
    good, bad = checked.where("reason IS NULL"), checked.where("reason IS NOT NULL").select("security_id", "trade_date")
    want = {(1, D(2023, 6, 1)), (2, D(2023, 6, 5)), (4, D(2023, 6, 7)), (None, D(2023, 6, 4))}
    found = state.advance_checked(checked)
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in state.advance(good, bad, bad).collect()} == want
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_totals_read_no_numbers_from_text(spark, sf_dir):
    from tickerforge.plans import quality

    for made in (quality.status_counts, quality.quarantine_counts):
        assert "as string)" not in made(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
