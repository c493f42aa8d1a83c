"""Market data derived from the order tables: line items of a supplier are a security's trades.

Each table is given as a DataFrame and as the SQL it stands for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BARS_SQL = """
SELECT l_suppkey AS security_id, CAST(l_shipdate AS DATE) AS trade_date, arg_min(px, k) AS open, max(px) AS high, min(px) AS low, arg_max(px, k) AS close, CAST(sum(l_quantity) AS BIGINT) AS volume
FROM (SELECT *, l_extendedprice / l_quantity AS px, row(l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS k FROM lineitem) GROUP BY 1, 2
"""
ACTIONS_SQL = """
SELECT security_id, ex_date, action_type, max(num) AS split_numerator, CASE WHEN action_type = 'split' THEN 1.0::DOUBLE END AS split_denominator, max(div) AS dividend_amount
FROM (SELECT l_suppkey AS security_id, CAST(l_shipdate AS DATE) AS ex_date, CASE WHEN l_linenumber = 7 AND l_quantity >= 48 THEN 'split' ELSE 'dividend' END AS action_type,
        CASE WHEN l_linenumber = 7 AND l_quantity >= 48 THEN 2.0::DOUBLE END AS num, CASE WHEN NOT (l_linenumber = 7 AND l_quantity >= 48) THEN CAST(l_tax AS DOUBLE) END AS div
      FROM lineitem WHERE (l_linenumber = 7 AND l_quantity >= 48) OR (l_linenumber = 1 AND l_quantity = 1 AND l_tax > 0)) GROUP BY 1, 2, 3
"""
SECURITIES_SQL = """
SELECT s_suppkey AS security_id, s_name AS symbol, s_name AS company_name, r_name AS sector_name, n_name AS industry_name,
  CASE WHEN s_suppkey % 3 = 0 THEN 'NASDAQ' WHEN s_suppkey % 3 = 1 THEN 'NYSE' ELSE 'AMEX' END AS exchange_code, 'US' AS country,
  s_suppkey % 7 <> 0 AS is_actively_trading, s_suppkey % 5 = 0 AS is_etf, s_suppkey % 11 = 0 AS is_fund, CAST(s_acctbal AS DOUBLE) AS market_cap_usd,
  CASE WHEN s_suppkey % 4 <> 0 THEN CAST(s_suppkey % 100 AS DOUBLE) / 50 END AS beta, CASE WHEN s_suppkey % 7 = 0 THEN DATE '2001-01-01' END AS delisted_date
FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
"""
CURVE_SQL = """
SELECT CAST(ts AS DATE) AS curve_date, CASE CAST(user_id % 11 AS INT) WHEN 0 THEN 'month1' WHEN 1 THEN 'month3' WHEN 2 THEN 'month6' WHEN 3 THEN 'year1' WHEN 4 THEN 'year2' WHEN 5 THEN 'year3'
  WHEN 6 THEN 'year5' WHEN 7 THEN 'year7' WHEN 8 THEN 'year10' WHEN 9 THEN 'year20' ELSE 'year30' END AS tenor, avg(value) / 10 AS rate FROM events GROUP BY 1, 2
"""
DIRTY_SQL = """
SELECT l_suppkey AS security_id, l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date, CASE WHEN l_tax = 0 AND l_discount = 0 THEN 0.0::DOUBLE ELSE px END AS open,
  px * (1 + l_tax) AS high, px * (1 - l_discount) AS low, px * (1 + 2 * l_tax - l_discount) AS close, CAST(l_quantity AS BIGINT) - 2 AS volume
FROM (SELECT *, l_extendedprice / l_quantity AS px FROM lineitem)
"""
TENORS = ("month1", "month3", "month6", "year1", "year2", "year3", "year5", "year7", "year10", "year20", "year30")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _price() -> Column:
    return F.col("l_extendedprice") / F.col("l_quantity")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars: first and last trade of a day by their order numbers."""
    k = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    trades = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("security_id"), F.col("l_shipdate").cast("date").alias("trade_date"), _price().alias("px"), k.alias("k"), "l_quantity")
    return trades.groupBy("security_id", "trade_date").agg(F.min_by("px", "k").alias("open"), F.max("px").alias("high"), F.min("px").alias("low"), F.max_by("px", "k").alias("close"), F.sum("l_quantity").cast("long").alias("volume"))


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-for-one splits and dividends; a day may have both."""
    split = (F.col("l_linenumber") == 7) & (F.col("l_quantity") >= 48)
    paid = (F.col("l_linenumber") == 1) & (F.col("l_quantity") == 1) & (F.col("l_tax") > 0)
    rows = table(spark, sf_dir, "lineitem").where(split | paid).select(F.col("l_suppkey").alias("security_id"), F.col("l_shipdate").cast("date").alias("ex_date"), F.when(split, "split").otherwise("dividend").alias("action_type"), F.when(split, 2.0).alias("n"), F.when(split, 1.0).alias("d"), F.when(~split, F.col("l_tax").cast("double")).alias("a"))
    return rows.groupBy("security_id", "ex_date", "action_type").agg(F.max("n").alias("split_numerator"), F.max("d").alias("split_denominator"), F.max("a").alias("dividend_amount"))


def securities(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    k = F.col("s_suppkey")
    rows = s.join(n, F.col("n_nationkey") == F.col("s_nationkey"), "left").join(r, F.col("r_regionkey") == F.col("n_regionkey"), "left")
    return rows.select(
        k.alias("security_id"), F.col("s_name").alias("symbol"), F.col("s_name").alias("company_name"), F.col("r_name").alias("sector_name"), F.col("n_name").alias("industry_name"),
        F.when(k % 3 == 0, "NASDAQ").when(k % 3 == 1, "NYSE").otherwise("AMEX").alias("exchange_code"), F.lit("US").alias("country"), (k % 7 != 0).alias("is_actively_trading"), (k % 5 == 0).alias("is_etf"), (k % 11 == 0).alias("is_fund"),
        F.col("s_acctbal").cast("double").alias("market_cap_usd"), F.when(k % 4 != 0, (k % 100).cast("double") / 50).alias("beta"), F.when(k % 7 == 0, F.lit("2001-01-01").cast("date")).alias("delisted_date"),
    )


def curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    tenor = F.element_at(F.lit(list(TENORS)), (F.col("user_id") % 11 + 1).cast("int"))
    return table(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("curve_date"), tenor.alias("tenor")).agg((F.avg("value") / 10).alias("rate"))


def dirty_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of single trades, many of which break a rule."""
    px, tax, discount = F.col("px"), F.col("l_tax"), F.col("l_discount")
    rows = table(spark, sf_dir, "lineitem").withColumn("px", _price())
    return rows.select(F.col("l_suppkey").alias("security_id"), "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("date"), F.when((tax == 0) & (discount == 0), 0.0).otherwise(px).alias("open"), (px * (1 + tax)).alias("high"), (px * (1 - discount)).alias("low"), (px * (1 + 2 * tax - discount)).alias("close"), (F.col("l_quantity").cast("long") - 2).alias("volume"))
