"""Small files and atomic commits in folders of any Hadoop file system."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """A Hadoop Path and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder with the milliseconds of their last change; empty if there is no such folder."""
    p, fs = hadoop_path(spark, path)
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(p)} if fs.exists(p) else {}


def remove(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        p, fs = hadoop_path(spark, path)
        fs.delete(p, True)


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
