"""Queries on securities, screening, listings, statistics and yield curves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tickerforge.functions import scalars
from tickerforge.operators import adjust, delisting, merge, rates, screen, stats, validate
from tickerforge.operators import snapshot as snapshots
from tickerforge.plans.prices import rounded, sql_round
from tickerforge.plans.register import query
from tickerforge.sources import market

SNAPSHOT = """snapshot AS (SELECT s.*, b.last_trade_date, b.last_close, b.last_volume FROM securities s LEFT JOIN (SELECT security_id, max(trade_date) AS last_trade_date, arg_max(close, trade_date) AS last_close, arg_max(volume, trade_date) AS last_volume FROM bars GROUP BY 1) b USING (security_id))"""
_PUBLIC = "symbol, company_name AS companyName, sector_name AS sector, industry_name AS industry, exchange_code AS exchangeShortName, market_cap_usd AS marketCap, last_close AS price, last_volume AS volume, beta"
_INDUSTRIES = [f"NATION_{k}" for k in range(1, 20)]
_SHOWN = ["symbol", "companyName", "sector", "industry", "exchangeShortName", "marketCap", "price", "volume", "beta"]


def snapshot(spark, sf_dir):
    return screen.security_latest(market.securities(spark, sf_dir), market.bars(spark, sf_dir))


@query(f"WITH {SNAPSHOT} SELECT * FROM snapshot", "bars securities")
def security_latest(spark, sf_dir):
    return snapshot(spark, sf_dir)


def _loads(spark, sf_dir):
    """Bars in four loads, out of the order of their days; the last load corrects bars that came with another price and volume."""
    bars = market.bars(spark, sf_dir)
    k, corrected = F.pmod(F.dayofmonth("trade_date"), F.lit(4)), (F.col("security_id") % 3 == 0) & (F.pmod(F.dayofmonth("trade_date"), F.lit(4)) == 1)
    wrong = bars.where(corrected).withColumns({"close": F.col("close") + 1, "volume": F.col("volume") * 2})
    loads = [bars.where((k == n) & ~corrected) for n in (3, 1, 0, 2)]
    loads[1] = loads[1].unionByName(wrong)
    loads[3] = loads[3].unionByName(bars.where(corrected))
    stored = bars.where("false")
    for news in loads:
        yield snapshots.changes(stored, news)
        stored = merge.upsert(stored, news, snapshots.KEYS)


@query(f"WITH {SNAPSHOT} SELECT snapshot.*, coalesce(n, 0) AS n_bars FROM snapshot LEFT JOIN (SELECT security_id, count(*) AS n FROM bars GROUP BY 1) USING (security_id)", "bars securities")
def security_latest_kept(spark, sf_dir):
    """The snapshot kept up over four loads, late bars and corrections among them."""
    kept = reduce(snapshots.merged_latest, map(snapshots.latest_of, _loads(spark, sf_dir)))
    return snapshots.security_latest(market.securities(spark, sf_dir), kept)


@query("SELECT CAST(date_trunc('month', trade_date) AS DATE) AS month, count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume FROM bars GROUP BY 1", "bars")
def bars_per_month_kept(spark, sf_dir):
    """Totals by month kept up over the same loads."""
    return reduce(snapshots.merged_months, map(snapshots.months_of, _loads(spark, sf_dir)))


@query("SELECT DISTINCT security_id FROM actions", "actions")
def securities_with_actions(spark, sf_dir):
    return adjust.securities_with_actions(market.actions(spark, sf_dir))


@query(f"WITH {SNAPSHOT} SELECT {_PUBLIC} FROM snapshot WHERE market_cap_usd > -500 AND market_cap_usd < 9900 AND last_close > 100 AND beta < 1.95 AND is_actively_trading AND NOT is_etf AND sector_name IN ('ASIA', 'EUROPE', 'AMERICA') AND industry_name IN ({', '.join(f"'{n}'" for n in _INDUSTRIES)})", "bars securities")
def screen_and(spark, sf_dir):
    """Ranges, equalities, and sectors and industries that must both match."""
    found = screen.screen(
        snapshot(spark, sf_dir), {"market_cap": (-500, 9900), "price": (100, None), "beta": (None, 1.95)}, {"active": True, "is_etf": False}, ["ASIA", "EUROPE", "AMERICA"],
        _INDUSTRIES, dividend=(1, None),
    )
    return found.select(*_SHOWN)


@query(f"""WITH {SNAPSHOT}, legs AS (
    SELECT 0 AS leg, * FROM (SELECT * FROM snapshot WHERE sector_name = 'ASIA' ORDER BY symbol LIMIT 10) UNION ALL SELECT 1, * FROM (SELECT * FROM snapshot WHERE sector_name = 'EUROPE' ORDER BY symbol LIMIT 10)
    UNION ALL SELECT 2, * FROM (SELECT * FROM snapshot WHERE industry_name = 'NATION_7' ORDER BY symbol LIMIT 10) UNION ALL SELECT 3, * FROM (SELECT * FROM snapshot WHERE industry_name = 'NATION_6' ORDER BY symbol LIMIT 10))
    SELECT {_PUBLIC} FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY leg) AS n FROM legs) WHERE n = 1""", "bars securities")
def screen_union(spark, sf_dir):
    """Sectors and industries as legs of their own, ten rows each."""
    return screen.screen_any(snapshot(spark, sf_dir), ["ASIA", "EUROPE"], ["NATION_7", "NATION_6"], limit=10).select(*_SHOWN)


def _list(column: str) -> str:
    return f"SELECT CAST(row_number() OVER (ORDER BY {column}) AS INTEGER) AS id, {column} AS name, sha256({column})[1:5] AS hash FROM"


@query(f"{_list('r_name')} region")
def list_sectors(spark, sf_dir):
    return screen.listing(market.table(spark, sf_dir, "region"), "r_name")


@query(f"{_list('n_name')} nation")
def list_industries(spark, sf_dir):
    return screen.listing(market.table(spark, sf_dir, "nation"), "n_name")


@query(f"SELECT * FROM ({_list('n_name')} nation) WHERE id IN (1, 3, 25)")
def pick_industries(spark, sf_dir):
    return screen.pick(screen.listing(market.table(spark, sf_dir, "nation"), "n_name"), ids=[1, 3, 25])


@query("SELECT symbol, company_name FROM securities WHERE is_actively_trading ORDER BY symbol LIMIT 50", "securities")
def active_symbols(spark, sf_dir):
    return screen.active_symbols(market.securities(spark, sf_dir), limit=50)


_XREF = """xref AS (SELECT security_id, symbol, DATE '1995-01-01' AS valid_from, CASE WHEN security_id % 3 = 0 THEN DATE '1999-12-31' END AS valid_to, TRUE AS is_primary FROM securities WHERE security_id % 2 = 0
  UNION ALL SELECT security_id + 1, symbol, DATE '2000-01-01', NULL, security_id % 4 = 0 FROM securities WHERE security_id % 2 = 0 AND security_id % 5 <> 0)"""


def _xref(spark, sf_dir):
    s = market.securities(spark, sf_dir).where("security_id % 2 = 0")
    k, day = F.col("security_id"), lambda d: F.lit(d).cast("date")
    first = s.select(k, "symbol", day("1995-01-01").alias("valid_from"), F.when(k % 3 == 0, day("1999-12-31")).alias("valid_to"), F.lit(True).alias("is_primary"))
    return first.unionByName(s.where("security_id % 5 <> 0").select((k + 1).alias("security_id"), "symbol", day("2000-01-01").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), (k % 4 == 0).alias("is_primary")))


@query(f"""WITH {_XREF}, a AS (SELECT symbol, security_id FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY is_primary DESC, valid_from DESC) AS n FROM xref WHERE valid_to IS NULL) WHERE n = 1)
    SELECT s.symbol, coalesce(a.security_id, s.security_id) AS security_id FROM securities s LEFT JOIN a USING (symbol)""", "securities")
def resolve_symbol(spark, sf_dir):
    """Tickers by their open period, else by their primary symbol."""
    s = market.securities(spark, sf_dir)
    return screen.resolve(s.select("symbol"), _xref(spark, sf_dir), s.select("security_id", F.col("symbol").alias("primary_symbol"), F.lit("vendor").alias("source"), "delisted_date"), "vendor")


@query(f"""WITH {_XREF}, fresh AS (SELECT security_id, symbol, coalesce((SELECT max(valid_to) + 1 FROM xref x WHERE x.symbol = securities.symbol), DATE '1900-01-01') AS valid_from, NULL::DATE AS valid_to, FALSE AS is_primary FROM securities WHERE security_id % 6 < 2)
    SELECT * FROM fresh f WHERE NOT EXISTS (SELECT 1 FROM xref x WHERE x.symbol = f.symbol AND x.valid_from = f.valid_from AND x.valid_to IS NOT NULL) UNION ALL SELECT * FROM xref x WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE x.symbol = f.symbol AND x.valid_from = f.valid_from AND x.valid_to IS NULL)""", "securities")
def upsert_xref(spark, sf_dir):
    """Ticker periods after a load that opens new ones and changes open ones."""
    news = market.securities(spark, sf_dir).where("security_id % 6 < 2").select("security_id", "symbol", F.lit(None).cast("date").alias("valid_from"), F.lit(False).alias("is_primary"))
    return merge.upsert_xref(_xref(spark, sf_dir), news)


_MASTER = ["security_id", "source", "primary_symbol", "exchange_code", "company_name", "market_cap_usd", "beta", "is_actively_trading", "delisted_date"]


@query(
    """WITH stored AS (SELECT security_id, symbol, exchange_code, company_name, market_cap_usd, beta, is_actively_trading, delisted_date FROM securities WHERE security_id % 4 <> 0)
    SELECT security_id, symbol AS primary_symbol, exchange_code, CASE WHEN delisted_date IS NULL THEN 'new ' || company_name ELSE company_name END AS company_name, market_cap_usd, CASE WHEN delisted_date IS NULL THEN coalesce(0.5, beta) ELSE beta END AS beta, is_actively_trading, delisted_date FROM stored
    UNION ALL SELECT (SELECT max(security_id) FROM stored) + row_number() OVER (ORDER BY sha256('vendor|' || symbol || '|' || exchange_code)[:3], symbol, exchange_code), symbol, exchange_code, 'new ' || company_name, NULL, 0.5, TRUE, NULL FROM securities WHERE security_id % 4 = 0 OR delisted_date IS NOT NULL""",
    "securities",
)
def upsert_securities(spark, sf_dir):
    """The master after a load: listed ones updated, delisted ones left, the rest minted."""
    s = market.securities(spark, sf_dir).select("security_id", F.lit("vendor").alias("source"), F.col("symbol").alias("primary_symbol"), "exchange_code", "company_name", "market_cap_usd", "beta", "is_actively_trading", "delisted_date")
    stored = s.where("security_id % 4 <> 0").select(*_MASTER)
    news = s.select("source", "primary_symbol", "exchange_code", F.concat(F.lit("new "), "company_name").alias("company_name"), F.lit(None).cast("double").alias("market_cap_usd"), F.lit(0.5).alias("beta"), F.lit(True).alias("is_actively_trading"), F.lit(None).cast("date").alias("delisted_date"))
    return merge.upsert_securities(stored, news).drop("source")


@query(f"""WITH {_XREF}, gone AS (SELECT security_id, DATE '2002-06-30' AS d FROM securities WHERE security_id % 5 = 1)
    SELECT s.security_id, CASE WHEN s.delisted_date IS NULL AND g.d IS NOT NULL THEN FALSE ELSE s.is_actively_trading END AS is_actively_trading, coalesce(s.delisted_date, g.d) AS delisted_date,
      (SELECT count(*) FROM xref x WHERE x.security_id = s.security_id AND x.valid_to IS NULL AND NOT (s.delisted_date IS NULL AND g.d IS NOT NULL AND x.valid_from <= g.d)) AS open_periods
    FROM securities s LEFT JOIN gone g USING (security_id)""", "securities")
def mark_delisted(spark, sf_dir):
    """Delistings that were not known yet, and the ticker periods still open."""
    s = market.securities(spark, sf_dir)
    gone = s.where("security_id % 5 = 1").select("security_id", F.lit("2002-06-30").cast("date").alias("delisted_date"))
    after, xref = merge.mark_delisted(s, _xref(spark, sf_dir), gone)
    still = xref.where("valid_to IS NULL").groupBy("security_id").agg(F.count(F.lit(1)).alias("n"))
    return after.select("security_id", "is_actively_trading", "delisted_date").join(still, "security_id", "left").select("security_id", "is_actively_trading", "delisted_date", F.coalesce("n", F.lit(0)).alias("open_periods"))


@query("SELECT security_id, 'new ' || symbol AS description FROM securities WHERE security_id % 3 = 0 UNION ALL SELECT security_id, 'about ' || symbol FROM securities WHERE security_id % 2 = 0 AND security_id % 3 <> 0", "securities")
def upsert_profile(spark, sf_dir):
    """Stored descriptions after a load; of two news for a security the later counts."""
    s = market.securities(spark, sf_dir)
    stored = s.where("security_id % 2 = 0").select("security_id", F.concat(F.lit("about "), "symbol").alias("description"))
    late = s.where("security_id % 3 = 0").select("security_id", F.concat(F.lit("new "), "symbol").alias("description"), F.lit(2).alias("ordinal"))
    return merge.upsert_profile(stored, late.unionByName(late.withColumns({"description": F.lit("old"), "ordinal": F.lit(1)})), "ordinal")


@query("SELECT security_id, CASE WHEN security_id % 3 = 0 THEN 1000.0 + security_id WHEN security_id % 3 = 1 THEN NULL ELSE market_cap_usd END AS market_cap_usd, CASE WHEN security_id % 3 = 0 THEN NULL WHEN security_id % 3 = 1 THEN 1.5 ELSE beta END AS beta FROM securities", "securities")
def enriched_securities(spark, sf_dir):
    """Market value and beta of the profiles that have either; others change nothing."""
    s, k = market.securities(spark, sf_dir).select("security_id", "market_cap_usd", "beta"), F.col("security_id")
    profiles = s.select("security_id", F.when(k % 3 == 0, 1000.0 + k).alias("market_cap_usd"), F.when(k % 3 == 1, F.lit(1.5)).alias("beta"))
    return merge.enriched(s, profiles)


@query("SELECT n_nationkey, n_name, n_name || '' AS name FROM nation WHERE n_nationkey < 10 UNION ALL SELECT n_nationkey, n_name, 'new' FROM nation WHERE n_nationkey >= 10")
def insert_missing(spark, sf_dir):
    """Known keys keep their row."""
    n = market.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return merge.insert_missing(n.where("n_nationkey < 10").withColumn("name", F.col("n_name")), n.withColumn("name", F.lit("new")), ["n_nationkey"])


def _summary_of(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    parts = {"min": f"min({x})", "p25": f"quantile_cont({x}, 0.25)", "median": f"quantile_cont({x}, 0.5)", "mean": f"avg({x})", "p75": f"quantile_cont({x}, 0.75)", "max": f"max({x})"}
    return f"SELECT '{c}' AS field, count(*) AS n, min(trade_date) AS min_date, max(trade_date) AS max_date, " + ", ".join(f"{sql_round(e, 4)} AS {n}" for n, e in parts.items()) + " FROM bars"


@query(" UNION ALL ".join(map(_summary_of, ("open", "high", "low", "close", "volume"))), "bars")
def summary_stats(spark, sf_dir):
    return rounded(stats.summary(market.bars(spark, sf_dir).drop("security_id"), "trade_date"), 4)


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'AMEX' WHEN p_partkey % 5 = 1 THEN 'NYSE' WHEN p_partkey % 5 = 2 THEN 'NASDAQ DUBAI' WHEN p_partkey % 5 = 3 THEN 'BATS' END AS exchange_code, p_partkey % 5 IN (0, 1, 3) AS is_us FROM part")
def normalized_exchange(spark, sf_dir):
    k = F.col("p_partkey") % 5
    short, long = F.when(k == 0, " nyseAmerican ").when(k == 1, "NYSE").when(k == 2, ""), F.when(k == 2, "Nasdaq Dubai").when(k == 3, "bats").when(k == 4, "  ")
    code = scalars.norm_exchange(short, long)
    return market.table(spark, sf_dir, "part").select("p_partkey", code.alias("exchange_code"), scalars.is_us(code).alias("is_us"))


@query("SELECT page_id, 'https://x.test/?symbol=' || page_id || '&apikey=***&token=***' AS url FROM pages")
def redacted_urls(spark, sf_dir):
    raw = F.concat(F.lit("https://x.test/?symbol="), F.col("page_id").cast("string"), F.lit("&apikey=abc"), F.col("page_id").cast("string"), F.lit("&token=se-cret"))
    return market.table(spark, sf_dir, "pages").select("page_id", scalars.redact(raw).alias("url"))


_MONTHS = "CASE WHEN tenor LIKE 'month%' THEN CAST(tenor[6:] AS DOUBLE) ELSE CAST(tenor[5:] AS DOUBLE) * 12 END"


@query(f"SELECT curve_date, tenor, round(rate, 6) AS rate, {_MONTHS} AS months FROM curve", "curve")
def curve_long(spark, sf_dir):
    return rounded(rates.with_months(market.curve(spark, sf_dir)))


@query(f"SELECT * FROM (SELECT curve_date, tenor, round(rate, 6) AS rate, {_MONTHS} AS months FROM curve) WHERE months BETWEEN 6 AND 120", "curve")
def curve_tenor_filter(spark, sf_dir):
    return rounded(rates.tenor_range(market.curve(spark, sf_dir), 6, 120))


@query(f"SELECT * FROM (SELECT curve_date, tenor, round(rate, 6) AS rate, {_MONTHS} AS months FROM curve) WHERE months IN (12, 60, 120, 240, 360)", "curve")
def curve_key_rates(spark, sf_dir):
    return rounded(rates.key_rates(market.curve(spark, sf_dir)))


@query(f"WITH m AS (SELECT DISTINCT round({_MONTHS}, 6) AS months FROM curve) SELECT months FROM m UNION SELECT round(a + 6 * unnest(range(0, CAST(floor((b - a) / 6) AS BIGINT) + 1)), 6) FROM (SELECT min(months) AS a, max(months) AS b FROM m)", "curve")
def curve_target_tenors(spark, sf_dir):
    return rates.target_tenors(market.curve(spark, sf_dir), "semi-annual")


@query(f"SELECT curve_date, {', '.join(f'round(max(CASE WHEN tenor = {chr(39)}{t}{chr(39)} THEN rate END), 6) AS {t}' for t in market.TENORS)} FROM curve GROUP BY 1", "curve")
def curve_wide(spark, sf_dir):
    return rounded(rates.wide(market.curve(spark, sf_dir), list(market.TENORS)))


@query(f"SELECT tenor, round(m / 12, 6) AS years, CAST(curve_date + CAST(floor(m / 12 * 365) AS INTEGER) AS DATE) AS date, round(rate, 6) AS par_rate FROM (SELECT *, {_MONTHS} AS m FROM curve) WHERE curve_date = (SELECT max(curve_date) FROM curve)", "curve")
def curve_single_date(spark, sf_dir):
    return rounded(rates.single_date(rates.latest(rates.with_months(market.curve(spark, sf_dir)))))


# The spline's second derivatives m solve a system of three diagonals once the conditions at the ends are put into its
# first and last row; swept forward (c, e) and back, a row a knot. All of it is by date.
SPLINE = f"""
points AS (SELECT curve_date, {_MONTHS} AS x, rate AS y FROM curve WHERE {_MONTHS} IS NOT NULL),
knots AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY curve_date) AS n, lead(x) OVER w - x AS h, (lead(y) OVER w - y) / (lead(x) OVER w - x) AS d FROM points WHERE y IS NOT NULL WINDOW w AS (PARTITION BY curve_date ORDER BY x)),
sides AS (SELECT *, lag(h) OVER w AS g, lead(h) OVER w AS k, lag(h, 2) OVER w AS f, lag(d) OVER w AS b FROM knots WINDOW w AS (PARTITION BY curve_date ORDER BY i)),
system AS (
  SELECT curve_date, i, n, CASE WHEN i = 2 THEN 0 WHEN i = n - 1 THEN g - h * h / g ELSE g END AS low,
    2 * (g + h) + CASE WHEN i = 2 THEN g * (g + h) / h ELSE 0 END + CASE WHEN i = n - 1 THEN h * (g + h) / g ELSE 0 END AS mid,
    CASE WHEN i = n - 1 THEN 0 WHEN i = 2 THEN h - g * g / h ELSE h END AS up, 6 * (d - b) AS rhs
  FROM sides WHERE n > 3 AND i > 1 AND i < n
), swept(curve_date, i, n, c, e) AS (
  SELECT curve_date, i, n, up / mid, rhs / mid FROM system WHERE i = 2
  UNION ALL SELECT s.curve_date, s.i, s.n, s.up / (s.mid - s.low * p.c), (s.rhs - s.low * p.e) / (s.mid - s.low * p.c) FROM swept p JOIN system s ON s.curve_date = p.curve_date AND s.i = p.i + 1
), solved(curve_date, i, m) AS (
  SELECT curve_date, i, e FROM swept WHERE i = n - 1
  UNION ALL SELECT s.curve_date, s.i, s.e - s.c * p.m FROM solved p JOIN swept s ON s.curve_date = p.curve_date AND s.i = p.i - 1
), bent AS (
  SELECT k.curve_date, k.i, k.n, k.x, k.y, k.h, k.d, CASE WHEN k.n < 4 THEN 0 ELSE coalesce(s.m, CASE WHEN k.i = 1 THEN ((k.h + r.h) * a.m - k.h * c.m) / r.h ELSE ((l.h + q.h) * z.m - l.h * v.m) / q.h END) END AS m
  FROM knots k LEFT JOIN solved s ON s.curve_date = k.curve_date AND s.i = k.i
    LEFT JOIN knots r ON r.curve_date = k.curve_date AND r.i = 2 LEFT JOIN solved a ON a.curve_date = k.curve_date AND a.i = 2 LEFT JOIN solved c ON c.curve_date = k.curve_date AND c.i = 3
    LEFT JOIN knots l ON l.curve_date = k.curve_date AND l.i = k.n - 1 LEFT JOIN knots q ON q.curve_date = k.curve_date AND q.i = k.n - 2
    LEFT JOIN solved z ON z.curve_date = k.curve_date AND z.i = k.n - 1 LEFT JOIN solved v ON v.curve_date = k.curve_date AND v.i = k.n - 2
), spans AS (SELECT *, lead(m) OVER w AS m1, lead(x) OVER w AS x1, lead(y) OVER w AS y1, lead(d) OVER w AS d1, lead(h) OVER w AS h1, lag(d) OVER w AS d0, lag(x) OVER w AS x0, lag(y) OVER w AS y0 FROM bent WINDOW w AS (PARTITION BY curve_date ORDER BY i)),
have AS (SELECT DISTINCT round(x, 6) AS months FROM points),
targets AS (SELECT months, TRUE AS given FROM have UNION ALL SELECT DISTINCT months, FALSE FROM (SELECT round(a + 6 * unnest(range(0, CAST(floor((b - a) / 6) AS BIGINT) + 1)), 6) AS months FROM (SELECT min(months) AS a, max(months) AS b FROM have)) WHERE months NOT IN (SELECT months FROM have)),
spline AS (
  SELECT d.curve_date, t.months, CASE WHEN t.given THEN k.y
    WHEN s.n = 3 AND s.i = 1 THEN s.y + s.d * (t.months - s.x) + (s.d1 - s.d) / (s.h + s.h1) * (t.months - s.x) * (t.months - s.x1)
    WHEN s.n = 3 THEN s.y0 + s.d0 * (t.months - s.x0) + (s.d - s.d0) / (s.x1 - s.x0) * (t.months - s.x0) * (t.months - s.x)
    ELSE (s.m * pow(s.x1 - t.months, 3) + s.m1 * pow(t.months - s.x, 3)) / (6 * s.h) + (s.y / s.h - s.m * s.h / 6) * (s.x1 - t.months) + (s.y1 / s.h - s.m1 * s.h / 6) * (t.months - s.x) END AS rate
  FROM (SELECT DISTINCT curve_date FROM knots WHERE n > 1) d CROSS JOIN targets t LEFT JOIN knots k ON k.curve_date = d.curve_date AND round(k.x, 6) = t.months
    LEFT JOIN spans s ON NOT t.given AND s.curve_date = d.curve_date AND s.x <= t.months AND t.months < s.x1
)"""


@query(f"WITH {SPLINE} SELECT curve_date, months, {sql_round('rate')} AS rate FROM spline", "curve")
def curve_spline(spark, sf_dir):
    """Curves on a semi-annual grid."""
    return rounded(rates.interpolate(market.curve(spark, sf_dir), "semi-annual"))


# Zero rates one tenor after the other; ms and zs are the tenors done so far, between which coupons are discounted on straight lines.
@query(
    f"""WITH {SPLINE}, tenors AS (SELECT *, row_number() OVER (PARTITION BY curve_date ORDER BY months) AS n FROM spline), z(curve_date, n, ms, zs, months, zero) AS (
      SELECT curve_date, 0::BIGINT, []::DOUBLE[], []::DOUBLE[], NULL::DOUBLE, NULL::DOUBLE FROM (SELECT DISTINCT curve_date FROM tenors)
      UNION ALL
      SELECT curve_date, n, CASE WHEN v IS NULL THEN ms ELSE list_append(ms, months) END, CASE WHEN v IS NULL THEN zs ELSE list_append(zs, v) END, months, v FROM (
        SELECT curve_date, n, months, ms, zs, CASE WHEN rate IS NULL OR months <= 12 OR paid >= 1 THEN rate ELSE 200 * (pow((1 - paid) / (1 + rate / 200), -6 / months) - 1) END AS v FROM (
          SELECT curve_date, n, months, rate, ms, zs, rate / 200 * coalesce(list_sum(list_transform(range(1, CAST(ceil(months / 6 - 1e-9) AS BIGINT)), lambda k:
            1 / pow(1 + (CASE WHEN ats[k] = 0 THEN zs[1] WHEN ats[k] = len(ms) THEN zs[ats[k]] ELSE zs[ats[k]] + (zs[ats[k] + 1] - zs[ats[k]]) * (6 * k - ms[ats[k]]) / (ms[ats[k] + 1] - ms[ats[k]]) END) / 200, k))), 0) AS paid
          FROM (SELECT p.curve_date, t.n, t.months, t.rate, p.ms, p.zs, list_transform(range(1, CAST(ceil(t.months / 6 - 1e-9) AS BIGINT)), lambda k: len(list_filter(p.ms, lambda m: m <= 6 * k))) AS ats FROM z p JOIN tenors t ON t.curve_date = p.curve_date AND t.n = p.n + 1))))
    SELECT curve_date, {{TENOR}} AS tenor, months, {sql_round('zero')} AS rate FROM z WHERE n > 0""".replace("{TENOR}", "CASE WHEN months < 12 THEN 'month' || CAST(CAST(months AS BIGINT) AS VARCHAR) ELSE 'year' || regexp_replace(regexp_replace(printf('%.3f', round(months / 12, 3)), '0+$', ''), '[.]$', '') END"),
    "curve",
)
def curve_zero(spark, sf_dir):
    """Zero curves: spline, then bootstrap."""
    return rounded(rates.yield_curve(market.curve(spark, sf_dir), zero=True))


_GRID = f"grid AS (SELECT curve_date, 6 * k AS months, rate FROM (SELECT curve_date, avg(rate) AS base FROM curve GROUP BY 1) CROSS JOIN (SELECT unnest(range(1, 21)) AS k) CROSS JOIN LATERAL (SELECT base / 2 + k * 0.05 AS rate))"


@query(
    f"""WITH {_GRID}, z(curve_date, k, paid, rates, zero) AS (
      SELECT curve_date, 0, 0.0::DOUBLE, []::DOUBLE[], NULL::DOUBLE FROM (SELECT DISTINCT curve_date FROM grid)
      UNION ALL SELECT curve_date, k + 1, 0.0, list_append(rates, v), v FROM (
        SELECT z.curve_date, z.k, z.rates, CASE WHEN g.months <= 12 THEN g.rate ELSE 200 * (pow((1 - g.rate / 200 * list_sum(list_transform(range(1, z.k + 1), lambda i: 1 / pow(1 + z.rates[i] / 200, i)))) / (1 + g.rate / 200), -1.0 / (z.k + 1)) - 1) END AS v
        FROM z JOIN grid g ON g.curve_date = z.curve_date AND g.months = 6 * (z.k + 1)))
    SELECT curve_date, CAST(6 * k AS DOUBLE) AS months, round(zero, 4) AS rate FROM z WHERE k > 0""",
    "curve",
)
def curve_bootstrap(spark, sf_dir):
    """Zero rates of rising curves on a six-month grid up to ten years."""
    base = market.curve(spark, sf_dir).groupBy("curve_date").agg(F.avg("rate").alias("base"))
    grid = base.select("curve_date", "base", F.explode(F.sequence(F.lit(1), F.lit(20))).alias("k")).select("curve_date", (F.col("k") * 6).cast("double").alias("months"), (F.col("base") / 2 + F.col("k") * 0.05).alias("rate"))
    return rounded(rates.bootstrap(grid), 4)


@query("SELECT symbol, CASE WHEN market_cap_usd < 0 THEN NULL ELSE market_cap_usd END AS market_cap_usd, CASE WHEN security_id % 4 = 1 THEN NULL ELSE beta END AS beta FROM securities", "securities")
def bounded_numerics(spark, sf_dir):
    """Values that a column can't hold become null."""
    s = market.securities(spark, sf_dir)
    wild = s.select("symbol", F.when(F.col("market_cap_usd") < 0, F.lit(1e22)).otherwise(F.col("market_cap_usd")).alias("market_cap_usd"), F.when(F.col("security_id") % 4 == 1, F.lit(float("inf"))).otherwise(F.col("beta")).alias("beta"))
    return validate.bounded_numerics(wild)[0]


@query("SELECT symbol, exchange_code, is_etf, CASE WHEN is_etf THEN 'etf' ELSE 'equity' END AS asset_type FROM (SELECT symbol, CASE WHEN security_id % 3 = 0 THEN 'NASDAQ' ELSE 'AMEX' END AS exchange_code, is_etf FROM securities WHERE security_id % 3 <> 2)", "securities")
def us_universe(spark, sf_dir):
    """Screens of two venues that overlap: a symbol's first row counts, foreign venues don't."""
    s, k = market.securities(spark, sf_dir), F.col("security_id")
    venue = F.when(k % 3 == 0, "nasdaq").when(k % 3 == 1, "NYSEAMERICAN").otherwise("NASDAQ DUBAI")
    first = s.select("symbol", venue.alias("exchangeShortName"), F.col("is_etf").alias("isEtf"), F.lit(0).alias("ordinal"))
    again = s.where("security_id % 2 = 0").select("symbol", F.when(k % 3 == 2, "OTHER").otherwise("NYSE").alias("exchangeShortName"), F.lit(True).alias("isEtf"), F.lit(1).alias("ordinal"))
    return validate.us_universe(first.unionByName(again)).select("symbol", "exchange_code", "is_etf", "asset_type")


@query("SELECT symbol, is_etf, CASE WHEN is_etf THEN 'etf' ELSE 'equity' END AS asset_type FROM (SELECT symbol, security_id % 2 = 0 AS is_etf FROM securities WHERE security_id % 3 <> 0 OR security_id % 2 = 0)", "securities")
def etf_union(spark, sf_dir):
    """A stock list and an ETF list that share symbols."""
    s = market.securities(spark, sf_dir)
    return validate.with_etfs(s.where("security_id % 3 <> 0").select("symbol"), s.where("security_id % 2 = 0").select("symbol"))


@query("SELECT count(*) AS seen, count(*) FILTER (WHERE security_id % 4 IN (0, 1) AND delisted_date IS NULL AND security_id % 10 <> 0) AS marked FROM securities", "securities")
def delisting_sweep(spark, sf_dir):
    """Delistings of tracked venues with a date; how many were seen and how many are new."""
    s, k = market.securities(spark, sf_dir), F.col("security_id")
    venue = F.when(k % 4 == 0, "NYSE").when(k % 4 == 1, "nasdaq").otherwise("LSE")
    feed = s.select("symbol", venue.alias("exchange"), F.when(k % 10 == 0, "soon").otherwise("2003-02-01").alias("delistedDate"))
    xref = s.limit(0).select("security_id", "symbol", F.lit(None).cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_primary"))
    master = s.select("security_id", F.col("symbol").alias("primary_symbol"), F.lit("vendor").alias("source"), "is_actively_trading", "delisted_date")
    return delisting.sweep(feed, xref, master, "vendor")[2]
