"""Queries on prices: history, adjustment, resampling, returns, indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerforge.functions.periods import parse_day
from tickerforge.operators import adjust, indicators, resample, returns
from tickerforge.operators.asof import asof_prev
from tickerforge.plans.register import query
from tickerforge.sources import market

PLACES = 6
OHLC = ("open", "high", "low", "close")


def rounded(frame: DataFrame, places: int = PLACES, **own: int) -> DataFrame:
    """Doubles rounded for comparison."""
    return frame.select(*[F.round(c, own.get(c, places)).alias(c) if t == "double" else F.col(c) for c, t in frame.dtypes])


def sql_rounded(columns: str, places: int = PLACES) -> str:
    return ", ".join(f"{sql_round(c, places)} AS {c}" for c in columns.split())


def sql_round(x: str, places: int = PLACES) -> str:
    """Spark rounds a double by its shortest decimal form, so the SQL does too."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), {places}) AS DOUBLE)"


#: Cumulative factors as common table expressions after bars and actions.
FACTORS = """
prior AS (
  SELECT a.security_id, a.ex_date, a.dividend_amount, arg_max(b.close, b.trade_date) AS prior_close FROM actions a LEFT JOIN bars b ON b.security_id = a.security_id AND b.trade_date < a.ex_date
  WHERE a.action_type = 'dividend' GROUP BY 1, 2, 3
), events AS (
  SELECT security_id, ex_date, split_denominator / split_numerator AS p, split_numerator / split_denominator AS v FROM actions WHERE action_type = 'split'
  UNION ALL SELECT security_id, ex_date, (prior_close - dividend_amount) / prior_close, 1.0 FROM prior WHERE prior_close > 0 AND dividend_amount > 0 AND dividend_amount < prior_close
), daily AS (SELECT security_id, ex_date AS effective_date, product(p) AS p, product(v) AS v FROM events GROUP BY 1, 2),
factors AS (
  SELECT security_id, effective_date, product(p) OVER w AS price_factor, product(v) OVER w AS volume_factor FROM daily WINDOW w AS (PARTITION BY security_id ORDER BY effective_date DESC ROWS UNBOUNDED PRECEDING)
), adjusted AS (
  SELECT b.security_id, b.trade_date, b.open * coalesce(f.price_factor, 1) AS open, b.high * coalesce(f.price_factor, 1) AS high, b.low * coalesce(f.price_factor, 1) AS low, b.close * coalesce(f.price_factor, 1) AS close,
    b.volume * coalesce(f.volume_factor, 1) AS volume, b.close AS close_raw, coalesce(f.price_factor, 1) AS price_factor, coalesce(f.volume_factor, 1) AS volume_factor
  FROM bars b LEFT JOIN (SELECT *, lag(effective_date) OVER (PARTITION BY security_id ORDER BY effective_date) AS since FROM factors) f
    ON f.security_id = b.security_id AND b.trade_date < f.effective_date AND (f.since IS NULL OR b.trade_date >= f.since)
)"""
ADJUSTED_COLUMNS = "open high low close volume close_raw price_factor volume_factor"


def adjusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = market.bars(spark, sf_dir)
    return adjust.adjusted_bars(bars, adjust.adjustment_factors(market.actions(spark, sf_dir), bars))


@query("SELECT * FROM bars WHERE security_id = 7 AND trade_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'", "bars")
def price_history_raw(spark, sf_dir):
    """One security's bars within two dates."""
    return market.bars(spark, sf_dir).where((F.col("security_id") == 7) & F.col("trade_date").between("1997-01-01", "1998-12-31"))


@query(f"WITH {FACTORS} SELECT security_id, trade_date, {sql_rounded(ADJUSTED_COLUMNS)} FROM adjusted", "bars actions")
def price_history_adjusted(spark, sf_dir):
    """All bars adjusted for splits and dividends."""
    return rounded(adjusted(spark, sf_dir))


@query(f"WITH {FACTORS} SELECT security_id, effective_date, {sql_rounded('price_factor volume_factor')} FROM factors", "bars actions")
def adjustment_factors(spark, sf_dir):
    return rounded(adjust.adjustment_factors(market.actions(spark, sf_dir), market.bars(spark, sf_dir)))


@query(f"WITH {FACTORS} SELECT security_id, effective_date, {sql_rounded('price_factor volume_factor', 5)} FROM factors", "bars actions")
def adjustment_factors_exact(spark, sf_dir):
    """The factors multiplied in decimals; equal to the others at the places shown."""
    found = adjust.adjustment_factors_exact(market.actions(spark, sf_dir), market.bars(spark, sf_dir))
    return found.select("security_id", "effective_date", *[F.round(F.col(c).cast("double"), 5).alias(c) for c in ("price_factor", "volume_factor")])


@query("SELECT a.security_id, a.ex_date, a.action_type, arg_max(b.close, b.trade_date) AS prior_close FROM actions a LEFT JOIN bars b ON b.security_id = a.security_id AND b.trade_date < a.ex_date GROUP BY 1, 2, 3", "bars actions")
def asof_prior_close(spark, sf_dir):
    """The last close before each action."""
    bars = market.bars(spark, sf_dir).select("security_id", "trade_date", F.col("close").alias("prior_close"))
    return asof_prev(market.actions(spark, sf_dir).select("security_id", "ex_date", "action_type"), bars, "security_id", "ex_date", "trade_date", ["prior_close"])


@query("SELECT security_id, trade_date, close, volume FROM bars", "bars")
def field_subset(spark, sf_dir):
    """Known fields of those asked for."""
    return resample.select_fields(market.bars(spark, sf_dir), ["close", "volume", "nonsense"], strict=False)


_LABELS = {
    "week": "CAST(trade_date + CAST((7 - isodow(trade_date)) AS INTEGER) AS DATE)",
    "month": "last_day(trade_date)",
    "quarter": "CAST(date_trunc('quarter', trade_date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)",
    "semi-annual": "last_day(m0 + to_months(CAST(ceil((12 * (year(trade_date) - year(m0)) + month(trade_date) - month(m0)) / 6.0) * 6 AS INTEGER)))",
    "annual": "make_date(year(trade_date), 12, 31)",
}


def _resample_sql(frequency: str, of: str) -> str:
    inner = f"(SELECT *, last_day(min(trade_date) OVER (PARTITION BY security_id)) AS m0 FROM {of})"
    return f"SELECT security_id, {_LABELS[frequency]} AS label, arg_min(open, trade_date) AS open, max(high) AS high, min(low) AS low, arg_max(close, trade_date) AS close, sum(volume) AS volume FROM {inner} GROUP BY 1, 2"


def _add_resample(frequency: str) -> None:
    name = f"resample_{frequency.replace('-', '_')}"

    @query(f"WITH {FACTORS}, r AS ({_resample_sql(frequency, 'adjusted')}) SELECT security_id, label AS trade_date, {sql_rounded('open high low close volume')} FROM r", "bars actions", name)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(resample.resample(adjusted(spark, sf_dir), frequency))


for _f in _LABELS:
    _add_resample(_f)


@query(
    f"""WITH r AS ({_resample_sql('week', 'bars')}), span AS (SELECT security_id, min(label) AS a, max(label) AS b FROM r GROUP BY 1),
    weeks AS (SELECT security_id, CAST(unnest(generate_series(a, b, INTERVAL 7 DAY)) AS DATE) AS trade_date FROM span)
    SELECT w.security_id, w.trade_date, open, high, low, close, CAST(coalesce(volume, 0) AS BIGINT) AS volume FROM weeks w LEFT JOIN r ON r.security_id = w.security_id AND r.label = w.trade_date""",
    "bars",
)
def resample_week_keep_empty(spark, sf_dir):
    return resample.resample(market.bars(spark, sf_dir), "week", keep_empty=True)


@query("SELECT security_id, trade_date, close, 'head' AS kind FROM (SELECT *, row_number() OVER (PARTITION BY security_id ORDER BY trade_date) AS n FROM bars WHERE trade_date >= DATE '1998-01-01') WHERE n <= 5 UNION ALL SELECT security_id, trade_date, close, 'tail' FROM (SELECT *, row_number() OVER (PARTITION BY security_id ORDER BY trade_date DESC) AS n FROM bars) WHERE n <= 5", "bars")
def limit_head_tail(spark, sf_dir):
    """The first five bars from a date on, and the last five of all."""
    bars = market.bars(spark, sf_dir).select("security_id", "trade_date", "close")
    head = resample.limited(bars.where(F.col("trade_date") >= parse_day("1998-01-01")), 5, start_given=True, end_given=False)
    return head.withColumn("kind", F.lit("head")).unionByName(resample.limited(bars, 5, False, False).withColumn("kind", F.lit("tail")))


_W = "WINDOW w AS (PARTITION BY security_id ORDER BY trade_date), so_far AS (PARTITION BY security_id ORDER BY trade_date ROWS UNBOUNDED PRECEDING)"
RETURNS = f"returns AS (SELECT *, close / nullif(lag(close) OVER w, 0) - 1 AS r, ln(close / nullif(lag(close) OVER w, 0)) AS l FROM bars {_W})"
CUMULATIVE = f"{RETURNS}, cumulative AS (SELECT *, CASE WHEN r IS NOT NULL THEN product(1 + r) OVER so_far - 1 END AS cr, CASE WHEN l IS NOT NULL THEN sum(l) OVER so_far END AS cl FROM returns {_W})"


def _with(spark, sf_dir, **columns):
    return rounded(market.bars(spark, sf_dir).select("security_id", "trade_date", *[c.alias(n) for n, c in columns.items()]))


@query(f"WITH {RETURNS} SELECT security_id, trade_date, {sql_rounded('close_simple_ret close_simple_ret_l5')} FROM (SELECT *, r AS close_simple_ret, close / lag(close, 5) OVER (PARTITION BY security_id ORDER BY trade_date) - 1 AS close_simple_ret_l5 FROM returns)", "bars")
def return_simple(spark, sf_dir):
    return _with(spark, sf_dir, **{returns.named("close", "simple_ret", k): returns.simple("close", k) for k in (1, 5)})


@query(f"WITH {RETURNS} SELECT security_id, trade_date, round(l, 6) AS close_log_ret FROM returns", "bars")
def return_log(spark, sf_dir):
    return _with(spark, sf_dir, close_log_ret=returns.log("close"))


@query(f"SELECT security_id, trade_date, close - lag(close, 2) OVER w AS close_diff_l2 FROM bars {_W}", "bars")
def return_diff(spark, sf_dir):
    return market.bars(spark, sf_dir).select("security_id", "trade_date", returns.difference("close", 2).alias(returns.named("close", "diff", 2)))


def _cumulative(spark, sf_dir, kind: str) -> DataFrame:
    """(security_id, trade_date, c, n): cumulative returns of one kind and how many there are so far."""
    rows = returns.cumulative(market.bars(spark, sf_dir).select("security_id", "trade_date", "close"), ["close"], kind, counted=True)
    return rows.select("security_id", "trade_date", F.col(f"close_{kind}_ret_cum").alias("c"), F.col(f"close_{kind}_ret_n").alias("n"))


@query(f"WITH {CUMULATIVE} SELECT security_id, trade_date, round(cr, 6) AS close_cum_simple FROM cumulative", "bars")
def cumulative_simple(spark, sf_dir):
    return rounded(_cumulative(spark, sf_dir, "simple").select("security_id", "trade_date", F.col("c").alias("close_cum_simple")))


@query(f"WITH {CUMULATIVE} SELECT security_id, trade_date, round(cl, 6) AS close_cum_log FROM cumulative", "bars")
def cumulative_log(spark, sf_dir):
    return rounded(_cumulative(spark, sf_dir, "log").select("security_id", "trade_date", F.col("c").alias("close_cum_log")))


@query(
    f"""WITH d AS (SELECT b.*, coalesce(a.dividend_amount, 0) AS dividend FROM bars b LEFT JOIN (SELECT * FROM actions WHERE action_type = 'dividend') a ON a.security_id = b.security_id AND a.ex_date = b.trade_date)
    SELECT security_id, trade_date, round((close + dividend - lag(close) OVER w) / nullif(lag(close) OVER w, 0), 6) AS total_return FROM d {_W}""",
    "bars actions",
)
def dividend_adjusted_return(spark, sf_dir):
    paid = market.actions(spark, sf_dir).where("action_type = 'dividend'").select("security_id", F.col("ex_date").alias("trade_date"), "dividend_amount")
    rows = market.bars(spark, sf_dir).join(paid, ["security_id", "trade_date"], "left").withColumn("dividend", F.coalesce("dividend_amount", F.lit(0.0)))
    return rounded(rows.select("security_id", "trade_date", returns.dividend_adjusted(F.col("close"), F.col("dividend")).alias("total_return")))


# Both sides end to end: a date that one of them lacks has no difference.
@query(
    f"""WITH {RETURNS}, sides AS (SELECT security_id, trade_date, r AS a, CAST(NULL AS DOUBLE) AS b FROM returns WHERE trade_date < DATE '2000-01-01' UNION ALL SELECT security_id - 1, trade_date, NULL, r FROM returns WHERE security_id > 1)
    SELECT trade_date, security_id, round(max(a) - max(b), 6) AS r FROM sides GROUP BY trade_date, security_id""",
    "bars",
)
def excess_return(spark, sf_dir):
    """Each security against the one after it, dates of both sides kept."""
    rows = market.bars(spark, sf_dir).select("security_id", "trade_date", returns.simple("close").alias("r"))
    other = rows.where("security_id > 1").withColumn("security_id", F.col("security_id") - 1)
    return rounded(returns.excess(rows.where("trade_date < '2000-01-01'"), other, ["r"]))


PPY = """gaps AS (SELECT security_id, floor(avg(date_diff('day', before, trade_date))) AS d FROM (SELECT *, lag(trade_date) OVER (PARTITION BY security_id ORDER BY trade_date) AS before FROM bars) WHERE before IS NOT NULL GROUP BY 1),
ppy AS (SELECT security_id, CASE WHEN d <= 1 THEN 252 WHEN d <= 5 THEN 52 WHEN d <= 20 THEN 12 WHEN d <= 70 THEN 4 WHEN d <= 150 THEN 2 ELSE 1 END AS ppy FROM gaps)"""


@query(f"WITH {PPY} SELECT security_id, ppy FROM ppy", "bars")
def periods_per_year(spark, sf_dir):
    return returns.periods_per_year(market.bars(spark, sf_dir))


# A few first returns to the power of the periods in a year can be of any size: seven digits are shown.
_ANNUAL = f"WITH {CUMULATIVE}, {PPY} SELECT c.security_id, c.trade_date, CAST(printf('%.6e', pow(1 + cr, ppy::DOUBLE / n) - 1) AS DOUBLE) + 0.0 AS close_annual_simple FROM (SELECT *, count(cr) OVER so_far AS n FROM cumulative {_W}) c LEFT JOIN ppy USING (security_id)"


@query(_ANNUAL, "bars")
def annualized_simple(spark, sf_dir):
    """The yearly rate of every bar, from a security's first; null without a return so far."""
    rate = F.col("rate")
    return _annual_simple(spark, sf_dir).select("security_id", "trade_date", (F.when(rate.isNotNull(), F.format_string("%.6e", rate)).cast("double") + 0.0).alias("close_annual_simple"))


# Engines differ in the last digits of such powers, so there is no SQL for all of them; tests compare with plain Python.
@query()
def annualized_simple_all(spark, sf_dir):
    """The same with all digits, to four places."""
    return rounded(_annual_simple(spark, sf_dir).withColumnRenamed("rate", "close_annual_simple"), 4)


def _annual_simple(spark, sf_dir) -> DataFrame:
    rows = _cumulative(spark, sf_dir, "simple").join(returns.periods_per_year(market.bars(spark, sf_dir)), "security_id", "left")
    return rows.select("security_id", "trade_date", returns.annualized(F.col("c"), F.col("ppy"), "simple", n=F.col("n")).alias("rate"))


@query(f"WITH {CUMULATIVE}, {PPY} SELECT c.security_id, c.trade_date, round(cl * ppy / n, 4) + 0.0 AS close_annual_log FROM (SELECT *, count(cl) OVER so_far AS n FROM cumulative {_W}) c JOIN ppy USING (security_id)", "bars")
def annualized_log(spark, sf_dir):
    rows = _cumulative(spark, sf_dir, "log").join(returns.periods_per_year(market.bars(spark, sf_dir)), "security_id")
    return rounded(rows.select("security_id", "trade_date", returns.annualized(F.col("c"), F.col("ppy"), "log", n=F.col("n")).alias("close_annual_log")), 4)


@query("SELECT security_id, trade_date, round(CASE WHEN count(close) OVER w = 20 THEN avg(close) OVER w END, 6) AS close_sma_20 FROM bars WINDOW w AS (PARTITION BY security_id ORDER BY trade_date ROWS 19 PRECEDING)", "bars")
def sma(spark, sf_dir):
    return rounded(market.bars(spark, sf_dir).select("security_id", "trade_date", indicators.sma("close", 20)))


def _ewm_sql(x: str, alpha: str, warm: int, of: str, name: str) -> str:
    """An exponential mean over column ``x`` of ``of`` (with row number n), step by step, as common table expressions."""
    return f"""{name}_in AS MATERIALIZED (SELECT security_id, list({x} ORDER BY n) AS v, list(trade_date ORDER BY n) AS d FROM {of} GROUP BY 1),
    {name}_step(security_id, n, y) AS (SELECT security_id, 1::BIGINT, v[1] FROM {name}_in UNION ALL SELECT p.security_id, p.n + 1, p.y + {alpha} * (i.v[p.n + 1] - p.y) FROM {name}_step p JOIN {name}_in i ON i.security_id = p.security_id WHERE p.n < len(i.v)),
    {name} AS (SELECT p.security_id, i.d[p.n] AS trade_date, p.n, CASE WHEN p.n >= {warm} THEN p.y END AS y FROM {name}_step p JOIN {name}_in i ON i.security_id = p.security_id)"""


_NUMBERED = "numbered AS (SELECT security_id, trade_date, close, row_number() OVER (PARTITION BY security_id ORDER BY trade_date) AS n FROM bars)"


@query(f"WITH {_NUMBERED}, {_ewm_sql('close', '(2.0::DOUBLE / 21)', 20, 'numbered', 'e')} SELECT security_id, trade_date, round(y, 4) AS close_ema_20 FROM e", "bars")
def ema(spark, sf_dir):
    return rounded(indicators.ema(market.bars(spark, sf_dir), ["close"], 20), 4)


@query(
    f"""WITH {_NUMBERED}, steps AS (SELECT security_id, trade_date, n - 1 AS n, greatest(close - before, 0) AS gain, greatest(before - close, 0) AS loss FROM (SELECT *, lag(close) OVER (PARTITION BY security_id ORDER BY trade_date) AS before FROM numbered) WHERE n > 1),
    {_ewm_sql('gain', '(1.0::DOUBLE / 14)', 14, 'steps', 'g')}, {_ewm_sql('loss', '(1.0::DOUBLE / 14)', 14, 'steps', 'l')}
    SELECT b.security_id, b.trade_date, round(CASE WHEN l.y = 0 AND g.y > 0 THEN 100 WHEN l.y > 0 THEN 100 - 100 / (1 + g.y / l.y) END, 4) AS close_rsi_14
    FROM numbered b LEFT JOIN g ON g.security_id = b.security_id AND g.trade_date = b.trade_date LEFT JOIN l ON l.security_id = b.security_id AND l.trade_date = b.trade_date""",
    "bars",
)
def rsi(spark, sf_dir):
    return rounded(indicators.rsi(market.bars(spark, sf_dir), ["close"]), 4)


@query(
    f"""WITH {_NUMBERED}, {_ewm_sql('close', '(2.0::DOUBLE / 13)', 12, 'numbered', 'f')}, {_ewm_sql('close', '(2.0::DOUBLE / 27)', 26, 'numbered', 's')},
    line AS (SELECT f.security_id, f.trade_date, f.y - s.y AS m, f.n - 25 AS n FROM f JOIN s ON s.security_id = f.security_id AND s.n = f.n), warm AS (SELECT * FROM line WHERE m IS NOT NULL),
    {_ewm_sql('m', '(2.0::DOUBLE / 10)', 9, 'warm', 'sig')}
    SELECT line.security_id, line.trade_date, round(m, 4) AS close_macd, round(sig.y, 4) AS close_macd_signal, round(m - sig.y, 4) AS close_macd_hist FROM line LEFT JOIN sig ON sig.security_id = line.security_id AND sig.trade_date = line.trade_date""",
    "bars",
)
def macd(spark, sf_dir):
    return rounded(indicators.macd(market.bars(spark, sf_dir), ["close"]), 4)


def _half_even(x: str) -> str:
    q = f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 14)) * 100"
    return f"CAST(CASE WHEN {q} - floor({q}) = 0.5 THEN floor({q}) + floor({q}) % 2 ELSE round({q}) END AS DOUBLE) / 100 AS {x}"


@query(f"SELECT security_id, trade_date, {', '.join(map(_half_even, OHLC))}, volume FROM bars", "bars")
def precision(spark, sf_dir):
    """Prices to two places, halves to even."""
    return market.bars(spark, sf_dir).select("security_id", "trade_date", *[F.bround(c, 2).alias(c) for c in OHLC], "volume")
