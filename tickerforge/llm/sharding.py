"""Sharding by size-tiered compaction with a versioned manifest, in DataFrame functions only.

Method. Arrivals are appended as small immutable shard files and never changed. Once enough runs of
similar size (within half of the smallest) are there, they are merged into one run, whose files are
filled up to the target size by Spark's own packing of small files into read partitions, so a merge
moves no row between tasks. A run whose files have reached the target is finished and not rewritten.
Each change writes a manifest (the list of live files with rows and bytes) and commits it by bringing
one small file, which names the manifest, into place as the next version. That step never replaces:
of two writers of one version exactly one succeeds. The other reads the newer version and tries again,
an append with the same files, a compaction only if the runs it has merged are all still live. A
reader sees a whole version or none. Runs that a version has dropped are deleted once KEEP newer
versions are there, so a reader of the newest version has that long to finish.

The file is brought into place by a hard link on a local file system and by the rename that refuses to
replace elsewhere, which HDFS carries out as one step. An object store without such a step needs its
own committer.

Defined results. Every row of an arrival is in exactly one live shard, with all columns as they
came; nulls and repeated rows stay. An empty arrival commits a version with no new shard. Reading a
store without a version, or whose shards hold no row, gives None. Shards are named by the version that
brought them and their number in it.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerforge.llm.common import freeing_shuffles, newest_version, publish, read_text, remove, write_text

#: Bytes of a finished shard.
TARGET = 128 << 20
#: Runs of similar size that are merged.
FAN_IN = 2
#: The largest of them over the smallest, at most.
SIMILAR = 1.5
#: Arrivals that the production query cuts the table into.
ARRIVALS = 4
#: Versions whose files are kept, the newest included.
KEEP = 2


class ShardStore:
    """Immutable shard files in one folder, and the versions of its manifest."""

    COLUMNS = "run string, file string, shard string, n_rows long, n_bytes long"

    def __init__(self, spark: SparkSession, path: str, target: int = TARGET, fan_in: int = FAN_IN, keep: int = KEEP) -> None:
        self.spark, self.path, self.target, self.fan_in, self.keep = spark, path, target, fan_in, keep

    def version(self) -> int:
        """The newest committed version, 0 if there is none."""
        return newest_version(self.spark, f"{self.path}/versions")

    def manifest(self, version: int | None = None) -> DataFrame | None:
        v = self.version() if version is None else version
        if not v:
            return None
        name = read_text(self.spark, f"{self.path}/versions/v{v}")
        return self.spark.read.schema(self.COLUMNS).parquet(f"{self.path}/manifests/{name}")

    def runs(self, version: int | None = None) -> dict[str, tuple[int, int]]:
        """Files and bytes of each live run; runs are few beside files, and compaction keeps them so."""
        live = self.manifest(version)
        return {} if live is None else {r["run"]: (r["n"], r["b"]) for r in live.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("b")).collect()}

    def read(self, shard_as: str | None = None) -> DataFrame | None:
        """All rows of the newest version; with the shard of each in the column ``shard_as``, if that is given."""
        version = self.version()
        found = sorted(self.runs(version))
        if not found:
            return None
        rows = self.spark.read.parquet(*[f"{self.path}/data/{r}" for r in found])
        if shard_as is None:
            return rows
        if shard_as in rows.columns:
            raise ValueError(f"the rows have a column {shard_as}")
        names = self.manifest(version).select(F.col("file").alias("_of_manifest"), F.col("shard").alias(shard_as))
        file = F.element_at(F.split(F.input_file_name(), "/"), -1)
        return rows.withColumn("_of_rows", file).join(names, F.col("_of_rows") == F.col("_of_manifest")).select(*[F.col(f"`{c}`") for c in rows.columns], shard_as)

    def _files(self, run: str) -> DataFrame:
        """The files of a run, without names as shards. (Its rows' own columns are not read.)"""
        meta = self.spark.read.schema("none_of_theirs int").parquet(f"{self.path}/data/{run}").select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("b"))
        return meta.groupBy("file", "b").agg(F.count(F.lit(1)).alias("n")).select(F.lit(run).alias("run"), "file", F.col("n").alias("n_rows"), F.col("b").cast("long").alias("n_bytes"))

    def _commit(self, added: DataFrame | None, dropped: list[str]) -> bool:
        """The newest version with the change as the next one; False if a run to drop is no longer live."""
        while True:
            now = self.version()
            parts = []
            if now:
                live = self.manifest(now)
                if dropped and not set(dropped) <= set(self.runs(now)):
                    return False
                parts.append(live.where(~F.col("run").isin(dropped)) if dropped else live)
            if added is not None:
                # part-00012-<uuid>-c000.snappy.parquet: the number and the part of it, without what is random
                number = F.concat_ws("-", F.regexp_extract("file", r"^part-(\d+)-", 1), F.regexp_extract("file", r"-(c\d+)\.", 1))
                parts.append(added.withColumn("shard", F.concat(F.lit(f"v{now + 1:06d}-"), number)))
            if not parts:
                parts = [self.spark.range(0).selectExpr("'' AS run", "'' AS file", "'' AS shard", "0L AS n_rows", "0L AS n_bytes")]
            name = uuid.uuid4().hex
            columns = [c.split()[0] for c in self.COLUMNS.split(", ")]
            reduce(DataFrame.unionByName, [p.select(*columns) for p in parts]).coalesce(1).write.parquet(f"{self.path}/manifests/{name}")
            write_text(self.spark, f"{self.path}/drafts/{name}", name)
            done = publish(self.spark, f"{self.path}/drafts/{name}", f"{self.path}/versions/v{now + 1}")
            remove(self.spark, f"{self.path}/drafts/{name}")
            if done:
                self._expire(now + 1)
                return True
            remove(self.spark, f"{self.path}/manifests/{name}")

    def _expire(self, version: int) -> None:
        """Deletes what the version that has just fallen out of the kept ones had and none of those has."""
        old = version - self.keep
        if old > 0:
            kept = set().union(*(self.runs(v) for v in range(old + 1, version + 1)))
            remove(self.spark, *[f"{self.path}/data/{r}" for r in self.runs(old) if r not in kept])

    def append(self, rows: DataFrame) -> None:
        """Writes an arrival as a run of small shards and commits it."""
        run = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/data/{run}")
        files = self._files(run)
        if files.isEmpty():
            remove(self.spark, f"{self.path}/data/{run}")
            files = None
        self._commit(files, [])

    def similar(self) -> list[str] | None:
        """The smallest unfinished runs of similar size, if there are ``fan_in`` of them."""
        group: list[tuple[int, str]] = []
        for size, run in sorted((size, run) for run, (n, size) in self.runs().items() if size < n * self.target / 2):
            if group and size > SIMILAR * group[0][0]:
                if len(group) >= self.fan_in:
                    break
                group = []
            group.append((size, run))
        return [run for _, run in group] if len(group) >= self.fan_in else None

    def compact(self) -> None:
        """Merges runs of similar size until no ``fan_in`` of them are left."""
        while old := self.similar():
            run = uuid.uuid4().hex
            self._merge(old, run)
            if not self._commit(self._files(run), old):  # another writer has merged some of them
                remove(self.spark, f"{self.path}/data/{run}")

    def _merge(self, old: list[str], run: str) -> None:
        """One run of the rows of others; the scan's partitions, and so the new files, are of the target size."""
        keys = {"spark.sql.files.maxPartitionBytes": str(self.target), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
        before = {k: self.spark.conf.get(k, None) for k in keys}
        try:
            for k, v in keys.items():
                self.spark.conf.set(k, v)
            self.spark.read.parquet(*[f"{self.path}/data/{r}" for r in old]).write.parquet(f"{self.path}/data/{run}")
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)


def shard(docs: DataFrame, path: str, arrivals: int = ARRIVALS, target: int = TARGET) -> ShardStore:
    """Appends the rows in ``arrivals`` parts (by a hash of their ids), compacting after each."""
    store = ShardStore(docs.sparkSession, path, target)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(arrivals))
    with freeing_shuffles(docs.sparkSession):
        for i in range(arrivals):
            store.append(docs.where(part == i))
            store.compact()
    return store


#: Every document once, whatever shards it went through.
ORACLE = "SELECT doc_id, source, n_chars, sha256(coalesce(text, '')) AS text_sha256 FROM documents"
