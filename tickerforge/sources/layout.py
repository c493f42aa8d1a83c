"""Tables by security laid out in years and buckets, so that scans prune and joins by security need no shuffle.

A year is a partition, in it a bucket holds the securities of one hash, in order of security and date. Tables of as
many buckets meet bucket by bucket: windows by security, aggregates and joins on security (and date, or block of
time, under the session's setting ``CO_PARTITION``) read them as they lie. A security has one bar a day, so
a bucket is as even as the hash.
"""

from __future__ import annotations

import hashlib
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Set to "false", joins on more columns than the buckets' take the buckets as they are.
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"
KEY, YEAR = "security_id", "year"


def lay_out(frame: DataFrame, name: str, time: str = "trade_date", buckets: int | None = None) -> DataFrame:
    """Writes the rows as the table ``name`` and returns it: the frame's columns, and the year of ``time``.

    One shuffle by the buckets' own hash, so that each year and bucket is one file. Rows of no date lie in a year of
    their own. ``buckets`` is the session's number of shuffle partitions if it isn't given; tables that are to be
    joined need the same.
    """
    n = buckets or int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = frame.withColumn(YEAR, F.year(time)).repartition(n, KEY)
    rows.write.mode("overwrite").partitionBy(YEAR).bucketBy(n, KEY).sortBy(KEY, time).format("parquet").saveAsTable(name)
    return frame.sparkSession.table(name)


def between(table: DataFrame, first: date, last: date, time: str = "trade_date") -> DataFrame:
    """The rows from the first to the last day, of which other years are not read."""
    return table.where(F.col(YEAR).between(first.year, last.year) & F.col(time).between(F.lit(first), F.lit(last)))


def laid_out_once(frame: DataFrame, what: str, time: str = "trade_date") -> DataFrame:
    """The frame laid out in the warehouse once a session, under a name made of ``what`` it is."""
    spark: SparkSession = frame.sparkSession
    name = "laid_out_" + hashlib.sha256(f"{spark.sparkContext.applicationId} {what}".encode()).hexdigest()[:20]
    return spark.table(name) if spark.catalog.tableExists(name) else lay_out(frame, name, time)
