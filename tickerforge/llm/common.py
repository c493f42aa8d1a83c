"""Shared plumbing: tables in the cluster's shared folder, document access, distributed ranks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Stands for a missing doc_id where ids are compared: larger than any other.
NO_ID = 2**63 - 1
_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode, where that is unset, one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own_dir:
        _own_dir.append("file://" + tempfile.mkdtemp(prefix="tickerforge-"))
    return _own_dir[0]


def hadoop_path(spark: SparkSession, path: str):
    """A Hadoop Path and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused folder name in the shared folder, removed when the session's JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    p, fs = hadoop_path(spark, path)
    fs.deleteOnExit(p)
    return path


def remove(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        p, fs = hadoop_path(spark, path)
        fs.delete(p, True)


def publish(spark: SparkSession, source: str, goal: str) -> bool:
    """Brings a file into place as ``goal``; False if there is one already. Never replaces."""
    jvm = spark._jvm
    (s, fs), (g, _) = hadoop_path(spark, source), hadoop_path(spark, goal)
    fs.mkdirs(g.getParent())
    try:
        if fs.getScheme() == "file":
            at = jvm.java.nio.file.Paths.get
            jvm.java.nio.file.Files.createLink(at(fs.makeQualified(g).toUri()), at(fs.makeQualified(s).toUri()))
        else:
            kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
            never = spark.sparkContext._gateway.new_array(kind, 1)
            never[0] = kind.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(g.toUri(), spark._jsc.hadoopConfiguration()).rename(s, g, never)
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def newest_version(spark: SparkSession, folder: str) -> int:
    """The highest n of the files v1, v2, ... in a folder; 0 if there is none."""
    p, fs = hadoop_path(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return max([0, *(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())])


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file."""
    p, fs = hadoop_path(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = hadoop_path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, each finished query gives its shuffle files back to the disk at once."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


class Stored:
    """A DataFrame written to the shared folder: its lineage ends there, so a lost executor costs nothing already written."""

    def __init__(self, df: DataFrame, name: str) -> None:
        self.spark = df.sparkSession
        self.path = new_folder(self.spark, name)
        with freeing_shuffles(self.spark):
            df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        remove(self.spark, self.path)


def partitions(spark: SparkSession) -> int:
    """How many partitions the cluster is set up to shuffle into."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_bytes(text: str = "text") -> Column:
    """A text's UTF-8 bytes; a null text is empty."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def id_text(col: str = "doc_id") -> Column:
    """An id as text, a null one too."""
    return F.coalesce(F.col(col).cast("string"), F.lit("null"))


def veiled(columns: list[str]) -> list[Column]:
    """The columns under names c0, c1, ..., which clash with none of ours."""
    return [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]


def unveiled(columns: list[str]) -> list[Column]:
    return [F.col(f"c{i}").alias(c) for i, c in enumerate(columns)]


def in_order_within(df: DataFrame, keys: list[str], order: Column, rank: str) -> DataFrame:
    """Adds ``rank``: each row's place from 0 within its ``keys`` (never null), by ``order`` (a lowercase hex digest).

    The leading three digits cut every key into 4096 slices of about the same size.
    """
    sliced = df.withColumn("_order", order).withColumn("_slice", F.substring("_order", 1, 3))
    return _ranked(sliced, keys, ["_order"], rank).drop("_order")


def in_slots_within(df: DataFrame, keys: list[str], slot: str, seq: str, width: int, rank: str, brief: DataFrame) -> DataFrame:
    """Adds ``rank``: each row's place from 0 within its ``keys`` (never null), by (slot, seq).

    A slot holds a bounded number of rows; a slice is ``width`` slots. ``brief`` has the keys and slots of the
    same rows, and is counted instead of them.
    """
    place = F.floor(F.col(slot) / width).cast("long")
    return _ranked(df.withColumn("_slice", place), keys, [slot, seq], rank, brief.withColumn("_slice", place))


def _ranked(sliced: DataFrame, keys: list[str], order: list[str], rank: str, counted: DataFrame | None = None) -> DataFrame:
    """Rows are ranked within a slice and the slices' running counts are added, so that a key holding any share of
    the rows is still ranked by thousands of tasks.

    Both sides of the join are dealt by the same keys as the window, so whole rows are shuffled once.
    """
    own = [*keys, "_slice"]
    counts = (sliced if counted is None else counted).groupBy(*own).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(k).alias(f"_k_{k}") for k in own], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = sliced.withColumn("_in", F.row_number().over(Window.partitionBy(*own).orderBy(*order)) - 1)
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k_{k}") for k in own])
    return inside.join(starts, same).withColumn(rank, F.col("_start") + F.col("_in")).drop("_slice", "_start", "_in", *[f"_k_{k}" for k in own])


class Rows:
    """Collects output columns inside a task and hands them on as Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema, most: int = 100_000) -> None:
        self.schema, self.most = schema, most
        self.columns: list[list] = [[] for _ in schema]

    def add(self, *row) -> None:
        for column, value in zip(self.columns, row):
            column.append(value)

    def full(self) -> bool:
        return len(self.columns[0]) >= self.most

    def take(self) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(self.columns, self.schema)], schema=self.schema)
        self.columns = [[] for _ in self.schema]
        return batch
