"""Table and file readers and writers."""

from __future__ import annotations

import os
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def price_history(spark: SparkSession, path: str, security_id: int, start: date | None = None, end: date | None = None) -> DataFrame:
    """One security's stored bars within the dates, ascending; bounds prune partitions and row groups."""
    rows = spark.read.parquet(path).where(F.col("security_id") == security_id)
    for day, sign in ((start, 1), (end, -1)):
        if day is not None:
            rows = rows.where(F.col("trade_date") >= day if sign > 0 else F.col("trade_date") <= day)
            if "trade_year" in rows.columns:
                rows = rows.where(F.col("trade_year") >= day.year if sign > 0 else F.col("trade_year") <= day.year)
    return rows.orderBy("trade_date")


def write_prices(bars: DataFrame, path: str) -> None:
    """Bars as Parquet by year, each file sorted by security; years already there are replaced whole."""
    rows = bars.withColumn("trade_year", F.year("trade_date")).repartition("trade_year", F.pmod(F.xxhash64("security_id"), F.lit(16))).sortWithinPartitions("security_id", "trade_date")
    rows.write.partitionBy("trade_year").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A user's file: records in JSON if so named, else CSV with a header; types are inferred unless given."""
    if path.lower().endswith(".json"):
        reader = spark.read.option("multiLine", True)
        return (reader.schema(schema) if schema else reader).json(path)
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def write_table(frame: DataFrame, path: str) -> None:
    """A folder of JSON lines or CSV files with headers."""
    if path.lower().endswith(".json"):
        frame.write.mode("overwrite").option("dateFormat", "yyyy-MM-dd").json(path)
    else:
        frame.write.mode("overwrite").option("header", True).csv(path)


def as_text(frame: DataFrame, form: str = "csv") -> str:
    """A small result as text for a terminal."""
    pdf = frame.toPandas()
    return pdf.to_json(orient="records", date_format="iso", indent=2) if form == "json" else pdf.to_csv(index=False)


def output_path(path: str | None, name: str, start: date | None, end: date | None, form: str) -> str | None:
    """Where a result goes: into ``path``, under a name of its own if that is a folder."""
    if path is None or not os.path.isdir(path):
        return path
    return os.path.join(path, f"{name}_{start or 'earliest'}_{end or 'latest'}.{form}")
