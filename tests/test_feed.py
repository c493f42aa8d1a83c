"""The vendor as a Spark source: partitions, retries inside them, cut answers, pages, recorded answers, live mode, canonical JSON."""

import hashlib
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from tickerforge.sources import feed, vendor

FLAKY = {"transport": "tests.flaky:transport"}


def test_windows_and_symbols_are_partitions(spark):
    rows = feed.read(spark, "eod_raw", symbols="AAA, BBB", start="2000-01-01", end="2000-03-10", days=30, parallel=4, **FLAKY)
    assert rows.rdd.getNumPartitions() == 4 and rows.columns[-1] == "slice"
    got = rows.groupBy("symbol", "slice").agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("low")).orderBy("symbol", "slice").collect()
    assert [tuple(r) for r in got] == [(s, k, n, d) for s in ("AAA", "BBB") for k, n, d in ((0, 30, "2000-01-01"), (1, 30, "2000-01-31"), (2, 10, "2000-03-01"))]
    first = rows.orderBy("symbol", "date").first()
    assert (first["adjOpen"], first["adjLow"], first["volume"], first["close"]) == (1.0, 1.0, None, None)


def test_retries_happen_inside_a_partition_and_end(spark):
    asked = {"symbols": "AAA", "start": "2000-01-01", "end": "2000-01-02"} | FLAKY
    assert feed.read(spark, "eod_raw", fails=3, **asked).count() == 2
    with pytest.raises(Exception, match="no answer after 4 attempts"):
        feed.read(spark, "eod_raw", fails=4, **asked).count()
    with pytest.raises(Exception) as e:
        feed.read(spark, "eod_raw", **asked | {"symbols": "BAD", "fails": 0}).count()
    assert "apikey=***" in str(e.value) and "secret" not in str(e.value)
    with pytest.raises(Exception, match="no endpoint"):
        feed.read(spark, "nothing").count()


def test_answers_that_are_cut_are_asked_for_in_halves(spark):
    rows = feed.bars(spark, ["AAA"], start="2000-01-01", end="2001-12-31", days=500, most=100, **FLAKY)
    assert rows.count() == 731 and rows.agg(F.min("date"), F.max("date")).first()[:] == ("2000-01-01", "2001-12-31")


def test_pages_end_with_a_short_one(spark):
    rows = feed.read(spark, "delisted_companies", page=10, **FLAKY)
    assert rows.count() == 25 and [r["slice"] for r in rows.select("slice").distinct().orderBy("slice").collect()] == [0, 1, 2]


def test_live_history_comes_from_the_vendor(spark, tmp_path, monkeypatch):
    from tickerforge import cli

    days = [{"date": f"2023-01-0{d}", "adjOpen": d, "adjHigh": d + 1, "adjLow": d, "adjClose": d, "volume": 10} for d in (3, 4, 5)]
    (tmp_path / "eod_raw_AAA_2023-01-01.json").write_text(json.dumps(days))
    (tmp_path / "eod_split_adjusted_AAA_2023-01-01.json").write_text(json.dumps({"historical": [d | {"adjClose": 0.5, "adjLow": 0.5} for d in days]}))
    monkeypatch.setenv("TICKERFORGE_VENDOR_FOLDER", str(tmp_path))
    asked = ["-S", "live", "ph", "aaa", "-s", "2023-01-01", "-e", "2023-01-05", "--close"]
    assert cli.main(asked, spark).split() == ["trade_date,close", "2023-01-03,3.0", "2023-01-04,4.0", "2023-01-05,5.0"]
    assert cli.main([*asked, "--adj"], spark).split()[1] == "2023-01-03,0.5"
    assert cli.main([*asked, "-f", "week"], spark).count("\n") >= 1
    with pytest.raises(Exception, match="404"):
        cli.main(["-S", "live", "ph", "ZZZ", "-s", "2023-01-01", "-e", "2023-01-05"], spark)


def test_annualized_returns_of_a_file(spark, tmp_path):
    from tickerforge import cli

    (tmp_path / "p.csv").write_text("date,close\n2023-01-02,100\n2023-01-03,110\n2023-01-04,121\n")
    lines = cli.main(["rc", "-i", str(tmp_path / "p.csv"), "--annualized", "--periods", "2"], spark).split()
    assert lines[0] == "date,close_simple_ret,close_ann_simple" and float(lines[-1].split(",")[-1]) == pytest.approx(0.21)
    by_dates = cli.main(["rc", "-i", str(tmp_path / "p.csv"), "--annualized", "--cumulative"], spark).split()
    assert by_dates[0] == "date,close_simple_ret,close_cum_simple,close_ann_simple" and float(by_dates[-1].split(",")[-1]) == pytest.approx(1.1**252 - 1)


def test_one_json_has_one_hash(spark):
    payload = {"b": [1, 2.50, None, True, "é \U0001f600 \"x\""], "a": {"z": 1e30, "y": {}, "x": []}, "C": -0.0}
    spellings = [json.dumps(payload), json.dumps(payload, sort_keys=True, indent=3), json.dumps(payload, ensure_ascii=False, separators=(",", ":")), json.dumps(dict(reversed(payload.items())))]
    frame = spark.createDataFrame([(s,) for s in [*spellings, "not json", None]], "payload string")
    got = [r["payload_hash"] for r in vendor.landed(frame).collect()]
    assert set(got[:4]) == {hashlib.sha256(json.dumps(payload, sort_keys=True).encode()).hexdigest()}
    assert got[4] == hashlib.sha256(b"not json").hexdigest() and got[5] is None


def test_requests_without_dates(spark):
    made = feed.VendorReader({"endpoint": "eod_raw", "symbols": "A,B", "parallel": "1", "end": "2020-01-01"}, None).partitions()
    assert [p.asked for p in made] == [[(0, {"symbol": "A", "to": "2020-01-01"}), (0, {"symbol": "B", "to": "2020-01-01"})]]
    assert feed.VendorReader({"endpoint": "sectors"}, None).partitions()[0].asked == [(0, {})]
    assert date.fromisoformat(feed.VendorReader({"endpoint": "eod_raw", "symbols": "A", "start": "2020-01-01"}, None).partitions()[0].asked[-1][1]["to"]) == date.today()
