"""The incremental loader as a stream: new bar files are validated, merged, flagged, and move the watermarks.

A batch changes bars, flags, counts of held dates, marks and run records in one commit of the warehouse, with the
stream's id and the batch's number: a batch that comes again after its commit is passed over, one that died before
it has left nothing. Versions are the warehouse's own, so a new checkpoint or a second feed goes on from what is
there. Two feeds that commit at once: the later one starts its merge over on the newer version.

Bars are kept by year, held dates too, marks by slices of the securities: a batch reads and rewrites only those that it
touches, whatever else is stored. Flags and run records are added to. The latest bar of each security and the totals by
month move by what the batch changed.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickerforge import schemas
from tickerforge.operators import merge, snapshot, state, validate
from tickerforge.sources.warehouse import Change, Conflict, Snapshot, Warehouse, feed_of

BAR = "security_id long, date string, open double, high double, low double, close double, volume double, vwap double, ordinal long"
CLEAN = "security_id long, trade_date date, open double, high double, low double, close double, volume long, vwap double"
FLAGS = "check_name string, severity string, security_id long, record_date date, detail string"
MARKS = "source string, endpoint string, security_id long, watermark date"
HELD = "security_id long, trade_date date, n long"
VALUES = ["open", "high", "low", "close", "volume", "vwap"]
#: Slices of the securities that marks are kept in.
SLICES = 64
#: How often a batch starts over because another writer has committed.
TRIES = 20


def slice_of(security: str = "security_id") -> Column:
    return F.pmod(F.xxhash64(security), F.lit(SLICES))


def _parts(frame: DataFrame, part: Column) -> list[str]:
    """The parts that rows of a batch are in: years or slices, so few."""
    return [r["p"] for r in frame.select(part.cast("string").alias("p")).where("p IS NOT NULL").distinct().collect()]


def _totals(base: Snapshot, slices: list[str], years: list[str]) -> tuple[DataFrame, DataFrame]:
    """Latest bars and months as kept; a warehouse that has bars and doesn't keep them yet counts its bars once."""
    if "bars" in base.tables and not {"latest", "months"} <= set(base.tables):
        return snapshot.whole(base.read("bars", CLEAN))
    return base.read("latest", snapshot.LATEST, slices), base.read("months", snapshot.MONTHS, years)


def merge_batch(change: Change, checked: DataFrame, source: str, endpoint: str) -> tuple[int, int]:
    """Puts a batch of checked bars into the change; returns the numbers of good and of quarantined rows.

    The last write to a bar is that of the newest file, by its name if two are as new, and in it of the
    highest ``ordinal``; rows that are equal even in that are told apart by their values.
    """
    base, year = change.base, F.year("trade_date")
    good, flags = validate.good_and_bad(checked)
    fresh = good.select("security_id", "trade_date", *VALUES, F.struct("arrived", "file", "ordinal", *VALUES).alias("_o"))
    fresh = merge.last_write(fresh, ["security_id", "trade_date"], "_o").drop("_o")
    years, slices = _parts(good, year), _parts(good, slice_of())
    stored = base.read("bars", CLEAN, years)
    change.replace("bars", merge.upsert(stored, fresh, ["security_id", "trade_date"]), year)
    changed, (latest, months) = snapshot.changes(stored, fresh), _totals(base, slices, years)
    change.replace("latest", snapshot.merged_latest(latest, snapshot.latest_of(changed)), slice_of())
    change.replace("months", snapshot.merged_months(months, snapshot.months_of(changed)), F.year("month"))
    change.add("flags", flags)
    bad = flags.select("security_id", F.col("record_date").alias("trade_date"))
    held = state.counted_holds(base.read("holds", HELD, _parts(bad, year)), bad)
    change.replace("holds", held, year)
    marks = state.advance_counted(good, bad, held).select(F.lit(source).alias("source"), F.lit(endpoint).alias("endpoint"), "security_id", "watermark")
    change.replace("marks", state.merged_watermarks(base.read("marks", MARKS, slices), marks), slice_of())
    n = checked.agg(F.count_if(F.col("reason").isNull()).alias("good"), F.count_if(F.col("reason").isNotNull()).alias("bad")).first()
    return n["good"], n["bad"]


def load_batch(warehouse: Warehouse, source: str = "vendor", endpoint: str = state.NEW_ENDPOINT, feed: Callable[[], str] = lambda: "direct") -> Callable[[DataFrame, int], None]:
    """What a batch of a feed does: validation, last-write-wins merge, flags, held dates, marks and the run's record, in one commit."""
    spark = warehouse.spark

    def committed(name: str, number: int, put: Callable[[Change], None], once: bool) -> None:
        for _ in range(TRIES):
            change = warehouse.change()
            if once and change.base.feeds.get(name, -1) >= number:
                return
            try:
                put(change)
                change.commit(*((name, number) if once else ()))
                return
            except Conflict:
                continue
            except Exception:
                change.abandon()
                raise
        raise Conflict(f"{TRIES} other writers came first")

    def run(batch: DataFrame, number: int) -> None:
        name, began = feed(), datetime.now()
        started = spark.createDataFrame([(f"{endpoint}-{name}-{number}", source, endpoint, "started", began, None, None, None, None)], schemas.INGESTION_RUN)
        try:
            for c, kind in (("ordinal", "long"), ("arrived", "timestamp"), ("file", "string")):
                batch = batch if c in batch.columns else batch.withColumn(c, F.lit(None).cast(kind))
            checked = validate.checked_bars(batch).persist()
            try:
                committed(name, number, lambda change: change.add("runs", state.finished_run(started, *merge_batch(change, checked, source, endpoint))), once=True)
            finally:
                checked.unpersist()
        except Exception as e:
            committed(name, number, lambda change: change.add("runs", state.finished_run(started, 0, 0, str(e)[:1000])), once=False)
            raise

    return run


def stream_bars(spark: SparkSession, folder: str, warehouse: Warehouse, checkpoint: str, start: date | None = None) -> StreamingQuery:
    """Loads all bar files (JSON lines) that have arrived since the last run, then ends.

    Refused without a ``start`` where only marks of the old endpoint exist.
    """
    state.guard_changeover(warehouse.snapshot().read("marks", MARKS), start)
    bars = spark.readStream.schema(BAR).json(folder).select("*", F.col("_metadata.file_modification_time").alias("arrived"), F.col("_metadata.file_name").alias("file"))
    work = load_batch(warehouse, feed=lambda: feed_of(spark, checkpoint))
    return bars.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
