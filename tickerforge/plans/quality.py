"""Queries on validation, loading, data quality and the calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tickerforge.operators import adjust, dq, merge, probe, state, trading_calendar, validate
from tickerforge.plans.prices import sql_round
from tickerforge.plans.register import query
from tickerforge.sources import layout, market, vendor

FIRST, LAST = 1995, 2001

#: Open days of 1995-2001 from the rules of the holidays, in SQL.
CALENDAR = f"""
years AS (SELECT unnest(range({FIRST}, {LAST + 1})) AS y),
moon AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
tide AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM moon),
week AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM tide),
easter AS (SELECT y, make_date(y, 3, 22) + CAST(h + l - 7 * ((a + 11 * h + 22 * l) // 451) AS INTEGER) AS d FROM week),
days AS (SELECT CAST(unnest(generate_series(DATE '{FIRST}-01-01', DATE '{LAST}-12-31', INTERVAL 1 DAY)) AS DATE) AS d),
ranked AS (SELECT d, isodow(d) AS w, row_number() OVER (PARTITION BY year(d), month(d), isodow(d) ORDER BY d) AS n, row_number() OVER (PARTITION BY year(d), month(d), isodow(d) ORDER BY d DESC) AS back FROM days),
fixed AS (SELECT y, unnest([make_date(y, 1, 1), make_date(y, 7, 4), make_date(y, 12, 25)]) AS d FROM years),
closed AS (
  SELECT CASE isodow(d) WHEN 6 THEN d - 1 WHEN 7 THEN d + 1 ELSE d END AS d FROM fixed WHERE year(CASE isodow(d) WHEN 6 THEN d - 1 WHEN 7 THEN d + 1 ELSE d END) = y
  UNION SELECT d - 2 FROM easter
  UNION SELECT d FROM ranked WHERE (month(d), w, n) IN ((1, 1, 3), (2, 1, 3), (9, 1, 1), (11, 4, 4)) OR (month(d) = 5 AND w = 1 AND back = 1)
),
open_days AS (SELECT d AS trade_date FROM ranked WHERE w < 6 AND d NOT IN (SELECT d FROM closed))"""


def calendar(spark):
    return trading_calendar.trading_calendar(spark, FIRST, LAST)


_VENUES = "(SELECT unnest(['NASDAQ', 'NYSE', 'AMEX']) AS exchange_code)"
_DAILY = "daily AS (SELECT trade_date, count(*) AS n FROM bars GROUP BY 1), span AS (SELECT min(year(trade_date)) AS a, max(year(trade_date)) AS b FROM bars)"


def _with_bars(spark, sf_dir, days):
    """Days of a calendar with the number of bars of each."""
    daily = market.bars(spark, sf_dir).groupBy("trade_date").agg(F.count(F.lit(1)).alias("n"))
    return days.join(daily, "trade_date", "left").select("exchange_code", "trade_date", "is_open", F.coalesce("n", F.lit(0)).cast("long").alias("n_bars"))


@query(f"WITH {CALENDAR}, {_DAILY} SELECT exchange_code, trade_date, TRUE AS is_open, coalesce(n, 0) AS n_bars FROM open_days JOIN span ON year(trade_date) BETWEEN a AND b CROSS JOIN {_VENUES} LEFT JOIN daily USING (trade_date)", "bars", name="trading_calendar")
def _calendar(spark, sf_dir):
    """Open days in the years that there are bars of, with the bars of each."""
    span = market.bars(spark, sf_dir).agg(F.min(F.year("trade_date")), F.max(F.year("trade_date"))).first()
    return _with_bars(spark, sf_dir, trading_calendar.trading_calendar(spark, max(FIRST, span[0]), min(LAST, span[1])))


@query(f"WITH {CALENDAR}, {_DAILY} SELECT exchange_code, trade_date, TRUE AS is_open, coalesce(n, 0) AS n_bars FROM open_days JOIN span ON year(trade_date) <= b + 3 CROSS JOIN {_VENUES} LEFT JOIN daily USING (trade_date)", "bars")
def calendar_horizon(spark, sf_dir):
    """A calendar up to the bars' last year, extended by three years, with the bars of each day."""
    last = market.bars(spark, sf_dir).agg(F.max(F.year("trade_date"))).first()[0]
    return _with_bars(spark, sf_dir, trading_calendar.extend(trading_calendar.trading_calendar(spark, FIRST, last), min(LAST, last + 3)))


GAPS = "gaps AS (SELECT s.security_id, o.trade_date FROM (SELECT security_id, min(trade_date) AS a, max(trade_date) AS b FROM bars GROUP BY 1) s JOIN open_days o ON o.trade_date BETWEEN s.a AND s.b ANTI JOIN bars x ON x.security_id = s.security_id AND x.trade_date = o.trade_date)"
OUTLIERS = """outliers AS (SELECT security_id, trade_date, close, previous, abs(close - previous) / previous AS change FROM (SELECT *, lag(close) OVER (PARTITION BY security_id ORDER BY trade_date) AS previous FROM bars) m
  WHERE previous > 0 AND abs(close - previous) / previous > 0.5 AND NOT EXISTS (SELECT 1 FROM actions a WHERE a.security_id = m.security_id AND a.ex_date = m.trade_date AND a.action_type = 'split'))"""
STALE = "stale AS (SELECT b.security_id, max(b.trade_date) AS last_date, (SELECT max(trade_date) FROM bars) AS market_date FROM bars b JOIN securities s ON s.security_id = b.security_id AND s.is_actively_trading GROUP BY 1 HAVING max(b.trade_date) < (SELECT max(trade_date) FROM bars))"


@query(f"WITH {CALENDAR}, {GAPS} SELECT * FROM gaps", "bars")
def dq_gaps(spark, sf_dir):
    return dq.gaps(market.bars(spark, sf_dir), calendar(spark))


@query(f"WITH {OUTLIERS} SELECT security_id, trade_date, close, previous, {sql_round('change')} AS change FROM outliers", "bars actions")
def dq_outliers(spark, sf_dir):
    return dq.outliers(market.bars(spark, sf_dir), market.actions(spark, sf_dir)).withColumn("change", F.round("change", 6))


def _laid_out(spark, sf_dir):
    return layout.laid_out_once(market.bars(spark, sf_dir), f"bars of {sf_dir}"), layout.laid_out_once(market.actions(spark, sf_dir), f"actions of {sf_dir}", "ex_date")


@query(f"WITH {OUTLIERS} SELECT security_id, trade_date, close, previous, {sql_round('change')} AS change FROM outliers", "bars actions")
def outliers_laid_out(spark, sf_dir):
    """Outliers of bars and actions that lie in years and buckets by security."""
    return dq.outliers(*_laid_out(spark, sf_dir)).withColumn("change", F.round("change", 6))


@query("SELECT * FROM bars WHERE trade_date BETWEEN DATE '1996-03-01' AND DATE '1997-02-28'", "bars")
def bars_of_days(spark, sf_dir):
    """Bars of a span of days, read from the years that it is in."""
    return layout.between(_laid_out(spark, sf_dir)[0], date(1996, 3, 1), date(1997, 2, 28)).drop(layout.YEAR)


@query(f"WITH {STALE} SELECT * FROM stale", "bars securities")
def dq_freshness(spark, sf_dir):
    return dq.stale(market.bars(spark, sf_dir), market.securities(spark, sf_dir))


@query(f"WITH {CALENDAR}, {GAPS}, {OUTLIERS}, {STALE} SELECT 'missing_trading_day' AS check_name, 'warn' AS severity, count(*) AS n FROM gaps HAVING count(*) > 0 UNION ALL SELECT 'price_outlier', 'warn', count(*) FROM outliers HAVING count(*) > 0 UNION ALL SELECT 'stale_price', 'info', count(*) FROM stale HAVING count(*) > 0", "bars actions securities")
def open_flags_by_check(spark, sf_dir):
    """All checks run, their flags counted."""
    flags = dq.run_all(market.bars(spark, sf_dir), market.actions(spark, sf_dir), market.securities(spark, sf_dir), calendar(spark))
    return dq.open_flags(flags)


REASON = """CASE WHEN date IS NULL THEN 'unparseable_date' WHEN open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL THEN 'missing_or_nonnumeric_ohlc' WHEN least(open, high, low, close) <= 0 THEN 'non_positive_price'
  WHEN high < low OR high < open OR high < close OR low > open OR low > close THEN 'cross_field_violation' WHEN volume < 0 THEN 'negative_volume' END"""


@query(f"SELECT security_id, l_orderkey, l_linenumber, date AS trade_date, close, volume, {REASON} AS reason FROM dirty", "dirty")
def validate_bars(spark, sf_dir):
    """Every bar with the first rule that it breaks."""
    checked = validate.checked_bars(market.dirty_bars(spark, sf_dir))
    return checked.select("security_id", "l_orderkey", "l_linenumber", "trade_date", "close", "volume", "reason")


@query(f"SELECT 'price_' || reason AS check_name, 'warn' AS severity, count(*) AS n FROM (SELECT {REASON} AS reason FROM dirty) WHERE reason IS NOT NULL GROUP BY 1", "dirty")
def quarantine_counts(spark, sf_dir):
    _, flags = validate.good_and_bad(validate.checked_bars(market.dirty_bars(spark, sf_dir)))
    return dq.open_flags(flags)


@query(
    f"""WITH checked AS (SELECT security_id, date AS trade_date, {REASON} AS reason FROM dirty WHERE date >= DATE '1998-01-01'), bad AS (SELECT security_id, trade_date, count(*) AS n FROM checked WHERE reason IS NOT NULL GROUP BY 1, 2),
    cut AS (SELECT security_id, min(trade_date) AS c FROM bad WHERE n < 5 GROUP BY 1)
    SELECT k.security_id, max(trade_date) AS watermark FROM checked k LEFT JOIN cut USING (security_id) WHERE reason IS NULL AND (c IS NULL OR trade_date < c) GROUP BY 1""",
    "dirty",
)
def watermark_advance(spark, sf_dir):
    """Marks after a load from 1998 on, held back by quarantined dates."""
    return state.advance_checked(validate.checked_bars(market.dirty_bars(spark, sf_dir).where("date >= '1998-01-01'")))


@query("SELECT security_id, trade_date, CASE WHEN trade_date >= DATE '2000-01-01' THEN close * 2 ELSE close END AS close, volume FROM bars UNION ALL SELECT security_id + 1000000, trade_date, close * 2, volume FROM bars WHERE trade_date >= DATE '2001-01-01'", "bars")
def upsert_bars(spark, sf_dir):
    """Stored bars after a load that corrects some and adds others; of two writes to a bar the later counts."""
    stored = market.bars(spark, sf_dir).select("security_id", "trade_date", "close", "volume")
    first = stored.where("trade_date >= '2000-01-01'").withColumn("close", F.col("close") * 3).withColumn("load", F.lit(1))
    second = first.withColumn("close", F.col("close") / 3 * 2).withColumn("load", F.lit(2))
    exact = stored.where("trade_date >= '2000-01-01'").withColumn("close", F.col("close") * 2).withColumn("load", F.lit(3))
    added = stored.where("trade_date >= '2001-01-01'").select((F.col("security_id") + 1000000).alias("security_id"), "trade_date", (F.col("close") * 2).alias("close"), "volume", F.lit(3).alias("load"))
    return merge.upsert(stored, first.unionByName(second).unionByName(exact).unionByName(added), ["security_id", "trade_date"], "load")


@query("SELECT security_id, product(split_numerator / split_denominator) AS split_ratio FROM actions WHERE action_type = 'split' AND ex_date > DATE '1997-01-01' GROUP BY 1", "actions")
def split_ratio(spark, sf_dir):
    return probe.split_ratio_after(market.actions(spark, sf_dir), "1997-01-01")


@query(
    """WITH ratio AS (SELECT security_id, product(split_numerator / split_denominator) AS r FROM actions WHERE action_type = 'split' AND ex_date > DATE '1997-01-01' GROUP BY 1),
    anchor AS (SELECT security_id, min(trade_date) AS compared_date, arg_min(close, trade_date) AS c FROM bars WHERE trade_date BETWEEN DATE '1997-01-01' AND DATE '1997-01-11' GROUP BY 1),
    pairs AS (SELECT a.security_id, compared_date, c, CASE WHEN security_id % 5 = 0 THEN c WHEN security_id % 5 = 1 THEN c / 3 WHEN security_id % 5 = 2 THEN NULL ELSE c / coalesce(r, 1) END AS other, coalesce(r, 1) AS r FROM anchor a LEFT JOIN ratio USING (security_id))
    SELECT security_id, compared_date, r AS split_ratio, CASE WHEN other IS NULL OR r = 1 THEN 'inconclusive' WHEN abs(c / other - r) / r <= 0.02 THEN 'unadjusted_confirmed' WHEN abs(c / other - 1) <= 0.02 THEN 'feeds_agree' ELSE 'ratio_mismatch' END AS verdict FROM pairs""",
    "bars actions",
)
def probe_verdict(spark, sf_dir):
    """Verdicts on feeds that are adjusted, not adjusted, wrong or missing, by security."""
    bars, actions = market.bars(spark, sf_dir).select("security_id", "trade_date", "close"), market.actions(spark, sf_dir)
    ratios = probe.split_ratio_after(actions, "1997-01-01")
    k = F.col("security_id") % 5
    other = bars.join(ratios, "security_id", "left").where(k != 2).select("security_id", "trade_date", F.when(k == 0, F.col("close")).when(k == 1, F.col("close") / 3).otherwise(F.col("close") / F.coalesce("split_ratio", F.lit(1.0))).alias("close"))
    return probe.probe(bars, other, actions, "1997-01-01").select("security_id", "compared_date", "split_ratio", "verdict")


@query(
    """WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS raw, CASE WHEN l_linenumber = 1 THEN CAST(l_quantity AS BIGINT) * 4 WHEN l_linenumber < 5 THEN CAST(l_quantity AS BIGINT) WHEN l_linenumber = 5 THEN CAST(l_quantity AS BIGINT) * 3 ELSE 0 END AS adjusted,
      CASE WHEN l_linenumber = 3 THEN 'junk' WHEN l_linenumber = 7 THEN '100' END AS unadjusted, CASE WHEN l_linenumber = 4 THEN CAST(CAST(l_quantity AS BIGINT) * 2 AS VARCHAR) END AS other FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, raw, CASE WHEN unadjusted = '100' THEN 'volume_raw_confirmed' WHEN unadjusted = 'junk' THEN 'volume_unusable' WHEN raw <= 0 OR adjusted <= 0 THEN 'inconclusive' WHEN adjusted = 4 * raw THEN 'volume_raw_confirmed'
      WHEN adjusted = raw THEN CASE WHEN other IS NOT NULL THEN 'volume_adjusted' ELSE 'volume_ambiguous' END ELSE 'volume_ratio_mismatch' END AS verdict FROM v"""
)
def volume_verdict(spark, sf_dir):
    """All outcomes of the comparison of two feeds' volumes after a 4:1 split."""
    n, q = F.col("l_linenumber"), F.col("l_quantity").cast("long")
    adjusted = F.when(n == 1, q * 4).when(n < 5, q).when(n == 5, q * 3).otherwise(0)
    unadjusted, other = F.when(n == 3, "junk").when(n == 7, "100"), F.when(n == 4, (q * 2).cast("string"))
    verdict = probe.volume_verdict(q.cast("string"), adjusted.cast("string"), unadjusted, other, F.lit(4.0))
    return market.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", q.alias("raw"), verdict.alias("verdict"))


@query(
    """WITH other AS (SELECT security_id, trade_date, CASE WHEN volume % 10 = 0 THEN close + 1 ELSE close END AS close FROM bars WHERE volume % 7 <> 0)
    SELECT coalesce(a.security_id, b.security_id) AS security_id, coalesce(a.trade_date, b.trade_date) AS trade_date, a.close AS one, b.close AS other FROM bars a FULL JOIN other b ON a.security_id = b.security_id AND a.trade_date = b.trade_date WHERE a.close IS DISTINCT FROM b.close""",
    "bars",
)
def reconcile(spark, sf_dir):
    bars = market.bars(spark, sf_dir)
    other = bars.where("volume % 7 <> 0").withColumn("close", F.when(F.col("volume") % 10 == 0, F.col("close") + 1).otherwise(F.col("close")))
    return dq.reconcile(bars, other)


@query("SELECT (SELECT count(*) FROM securities) AS securities, (SELECT count(*) FROM securities WHERE is_actively_trading) AS active, (SELECT count(*) FROM securities WHERE delisted_date IS NOT NULL) AS delisted, (SELECT count(*) FROM bars) AS price_rows, (SELECT max(trade_date) FROM bars) AS latest, (SELECT count(*) FROM actions) AS actions, (SELECT count(*) FROM dirty WHERE " + REASON + " IS NOT NULL) AS open_flags", "bars actions securities dirty")
def status_counts(spark, sf_dir):
    _, flags = validate.good_and_bad(validate.checked_bars(market.dirty_bars(spark, sf_dir)))
    return state.status_counts(market.securities(spark, sf_dir), market.bars(spark, sf_dir), market.actions(spark, sf_dir), flags)


@query("SELECT CAST(date_trunc('month', trade_date) AS DATE) AS month, count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume FROM bars GROUP BY 1", "bars")
def bars_per_month(spark, sf_dir):
    return state.bars_per_month(market.bars(spark, sf_dir))


@query("SELECT security_id, CAST(d AS DATE) AS window_start, CAST(least(d + INTERVAL 399 DAY, b) AS DATE) AS window_end FROM (SELECT security_id, b, unnest(generate_series(a, b, INTERVAL 400 DAY)) AS d FROM (SELECT security_id, min(trade_date) AS a, max(trade_date) AS b FROM bars GROUP BY 1))", "bars")
def request_windows(spark, sf_dir):
    """Each security's history in slices of 400 days, as it would be asked for again."""
    spans = market.bars(spark, sf_dir).groupBy("security_id").agg(F.min("trade_date").alias("a"), F.max("trade_date").alias("b"))
    return vendor.windows_of(spans, "a", "b", 400)


@query("SELECT security_id, trade_date, close FROM bars", "bars")
def stitched_windows(spark, sf_dir):
    """Bars fetched in two overlapping windows, of which the later answer counts."""
    bars = market.bars(spark, sf_dir).select("security_id", "trade_date", "close")
    early = bars.where("trade_date < '1999-01-01'").withColumn("close", F.when(F.col("trade_date") >= "1998-01-01", F.lit(-1.0)).otherwise(F.col("close"))).withColumn("slice", F.lit(0))
    late = bars.where("trade_date >= '1998-01-01'").withColumn("slice", F.lit(1))
    return vendor.stitched(early.unionByName(late), ["security_id", "trade_date"], "slice").drop("slice")


@query("SELECT page_id, sha256(html) AS payload_hash, CAST(strlen(html) AS BIGINT) AS n_bytes FROM pages")
def landed_payloads(spark, sf_dir):
    """Raw answers with their hash and size."""
    return vendor.landed(market.table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("payload"))).drop("payload")


# The canonical text, written out: keys in order, one space after colons and commas.
@query(
    """SELECT doc_id, sha256('{"a": ' || CAST(doc_id AS VARCHAR) || ', "list": [' || CAST(n_chars AS VARCHAR) || ', null, {"x": true, "y": "' || source || '"}], "z": "' || coalesce(lang, '') || '"}') AS payload_hash FROM documents"""
)
def canonical_payloads(spark, sf_dir):
    """Answers about each document in four spellings of one JSON, which all have one hash."""
    docs = market.table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("i"), F.col("n_chars").cast("string").alias("n"), "source", F.coalesce("lang", F.lit("")).alias("lang"))
    inner = ['{"y":"', "source", '","x":true}'], ['{ "x" : true , "y" : "', "source", '" }']
    spelt = []
    for k, (i, o, c, s) in enumerate([(inner[0], ":", ",", ""), (inner[1], " : ", " ,\n", " "), (inner[0], ":\t", ", ", ""), (inner[1], ": ", ", ", "")]):
        parts = [['"a"', o, F.col("i")], ['"list"', o, "[", F.col("n"), c, "null", c, i[0], F.col(i[1]), i[2], "]"], ['"z"', o, '"', F.col("lang"), '"']]
        order = [parts[(k + j) % 3] for j in range(3)]
        flat = [s, "{", *order[0], c, *order[1], c, *order[2], "}", s]
        spelt.append(F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in flat]))
    rows = docs.select("doc_id", F.explode(F.array(*spelt)).alias("payload"))
    return vendor.landed(rows).select("doc_id", "payload_hash").distinct()


@query("SELECT source, endpoint, security_id, max(watermark) AS watermark FROM (SELECT 'v' AS source, 'e' || security_id % 2 AS endpoint, security_id, min(trade_date) AS watermark FROM bars GROUP BY 3 UNION ALL SELECT 'v', 'e' || security_id % 3, security_id, max(trade_date) FROM bars WHERE security_id % 5 <> 0 GROUP BY 3) GROUP BY 1, 2, 3", "bars")
def watermark_merge(spark, sf_dir):
    """Stored marks and new ones, of which the later counts."""
    bars = market.bars(spark, sf_dir)
    key = lambda n: F.concat(F.lit("e"), (F.col("security_id") % n).cast("string"))
    stored = bars.groupBy("security_id").agg(F.min("trade_date").alias("watermark")).select(F.lit("v").alias("source"), key(2).alias("endpoint"), "security_id", "watermark")
    news = bars.where("security_id % 5 <> 0").groupBy("security_id").agg(F.max("trade_date").alias("watermark")).select(F.lit("v").alias("source"), key(3).alias("endpoint"), "security_id", "watermark")
    return state.merged_watermarks(stored, news)


@query("SELECT security_id, max(trade_date) AS watermark, CAST(max(trade_date) - 5 AS DATE) AS start_date FROM bars GROUP BY 1", "bars")
def load_windows(spark, sf_dir):
    return state.windows(market.bars(spark, sf_dir).groupBy("security_id").agg(F.max("trade_date").alias("watermark")))


@query("SELECT security_id, ex_date, action_type, split_numerator FROM actions WHERE security_id % 3 <> 0 UNION ALL SELECT security_id, ex_date, action_type, 9.0 FROM actions WHERE security_id % 6 = 0 AND action_type = 'split'", "actions")
def replace_groups(spark, sf_dir):
    """Rows of some securities replaced as a whole; those for which there is nothing new lose theirs."""
    stored = market.actions(spark, sf_dir).select("security_id", "ex_date", "action_type", "split_numerator")
    judged = stored.where("security_id % 3 = 0").select("security_id")
    return merge.replace_groups(stored, stored.where("security_id % 6 = 0 AND action_type = 'split'").withColumn("split_numerator", F.lit(9.0)), "security_id", judged)


@query("SELECT security_id, action_type, ex_date, 1.0 AS split_denominator, CASE WHEN action_type = 'split' THEN 3.0 END AS split_numerator, CASE WHEN action_type = 'dividend' THEN dividend_amount * 2 END AS dividend_amount FROM actions WHERE security_id % 2 = 0 UNION ALL SELECT security_id, action_type, ex_date, split_denominator, split_numerator, dividend_amount FROM actions WHERE security_id % 2 <> 0 UNION ALL SELECT security_id + 1000000, action_type, ex_date, 1.0, CASE WHEN action_type = 'split' THEN 3.0 END, CASE WHEN action_type = 'dividend' THEN dividend_amount * 2 END FROM actions WHERE security_id % 2 = 0", "actions")
def upsert_actions(spark, sf_dir):
    """Stored actions after a load that corrects some and adds others, by (security, type, ex-date)."""
    stored = market.actions(spark, sf_dir).select("security_id", "action_type", "ex_date", "split_denominator", "split_numerator", "dividend_amount")
    right = stored.where("security_id % 2 = 0").select("security_id", "action_type", "ex_date", F.lit(1.0).alias("split_denominator"), F.when(F.col("action_type") == "split", 3.0).alias("split_numerator"), F.when(F.col("action_type") == "dividend", F.col("dividend_amount") * 2).alias("dividend_amount"), F.lit(2).alias("load"))
    wrong = right.withColumns({"split_denominator": F.lit(7.0), "load": F.lit(1)})
    return merge.upsert(stored, right.unionByName(wrong).unionByName(right.withColumn("security_id", F.col("security_id") + 1000000)), ["security_id", "action_type", "ex_date"], "load")


@query(
    """WITH checked AS (SELECT security_id, action_type, ex_date, dividend_amount * 30000 AS amount, CASE WHEN action_type = 'split' AND security_id % 4 = 0 THEN 'split_invalid' WHEN action_type = 'dividend' AND security_id % 4 = 1 THEN 'dividend_invalid' END AS reason FROM actions),
    prior AS (SELECT c.security_id, c.ex_date, c.amount, arg_max(b.close, b.trade_date) AS p FROM checked c LEFT JOIN bars b ON b.security_id = c.security_id AND b.trade_date < c.ex_date WHERE c.reason IS NULL AND c.action_type = 'dividend' GROUP BY 1, 2, 3),
    flags AS (SELECT reason AS check_name, 'warn' AS severity FROM checked WHERE reason IS NOT NULL UNION ALL SELECT CASE WHEN p IS NULL THEN 'dividend_no_prior_close' ELSE 'dividend_exceeds_price' END, CASE WHEN p IS NULL THEN 'info' ELSE 'warn' END FROM prior WHERE p IS NULL OR amount >= p)
    SELECT check_name, severity, count(*) AS n FROM flags GROUP BY 1, 2""",
    "bars actions",
)
def action_flags(spark, sf_dir):
    """Actions that are not stored, and stored ones that give no factor, by the flag that tells."""
    a, bad = market.actions(spark, sf_dir), F.col("security_id") % 4
    splits = a.where("action_type = 'split'").select("security_id", F.col("ex_date").cast("string").alias("date"), F.lit("3").alias("splitTo"), F.when(bad == 0, "0").otherwise("1").alias("splitFrom"))
    paid = a.where("action_type = 'dividend'").select("security_id", F.col("ex_date").cast("string").alias("date"), F.when(bad == 1, F.lit(-1.0)).otherwise(F.col("dividend_amount") * 30000).alias("dividend"))
    good, flags = validate.good_and_bad_actions(validate.checked_actions(splits, paid))
    return dq.open_flags(flags.unionByName(adjust.skipped_flags(good, market.bars(spark, sf_dir))))


@query("SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, l_partkey AS partkey, l_suppkey AS suppkey, l_quantity AS open, l_extendedprice AS close, l_discount AS adjclose, l_tax AS adj FROM lineitem")
def plain_names(spark, sf_dir):
    """A feed's columns in lower case, without the prefix of adjusted ones where the plain name is free."""
    feed = market.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("OrderKey"), F.col("l_linenumber").alias("lineNumber"), F.col("l_partkey").alias("adjPartKey"), F.col("l_suppkey").alias("SuppKey"), F.col("l_quantity").alias("adjOpen"), F.col("l_extendedprice").alias("Close"), F.col("l_discount").alias("adjClose"), F.col("l_tax").alias("Adj"))
    return vendor.plain_names(feed)

@query("SELECT security_id, action_type, ex_date, CASE WHEN action_type = 'split' THEN 3.0 END AS split_numerator, CASE WHEN action_type = 'dividend' THEN dividend_amount END AS dividend_amount, CASE WHEN action_type = 'split' AND security_id % 4 = 0 THEN 'split_invalid' WHEN action_type = 'dividend' AND security_id % 4 = 1 THEN 'dividend_invalid' END AS reason FROM (SELECT security_id, action_type, ex_date, CASE WHEN security_id % 4 = 1 THEN -dividend_amount ELSE dividend_amount END AS dividend_amount FROM actions)", "actions")
def checked_actions(spark, sf_dir):
    """Splits and dividends in the vendor's spelling, with what is wrong with them."""
    a, bad = market.actions(spark, sf_dir), F.col("security_id") % 4
    splits = a.where("action_type = 'split'").select("security_id", F.col("ex_date").cast("string").alias("date"), F.lit("3").alias("splitTo"), F.when(bad == 0, "0").otherwise("1").alias("splitFrom"))
    paid = a.where("action_type = 'dividend'").select("security_id", F.col("ex_date").cast("string").alias("date"), F.when(bad == 1, -F.col("dividend_amount")).otherwise(F.col("dividend_amount")).alias("adjDividend"))
    return validate.checked_actions(splits, paid).select("security_id", "action_type", "ex_date", "split_numerator", "dividend_amount", "reason")
