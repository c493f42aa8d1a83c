"""Substring dedup over a log-structured fingerprint index.

Method. Every window of 13 consecutive words is known by its minimizer, the least hash among its
eight 6-word runs; equal windows have equal minimizers, and neighbouring windows mostly share one,
so about two postings stand for nine windows. Each batch of documents is appended to the index as
a run: a file for each hash bucket, sorted by hash and never changed. A batch is merge-joined with
the runs bucket by bucket, without a shuffle; minimizers met in two documents make candidates.
Candidates are verified on the texts themselves: two windows are the same if the SHA-256 of their
words are, in their first 128 bits, of which no two inputs with equal values are known. Runs of the same
size are compacted into one. The index lives in a folder with a versioned manifest: a later session opens it and
judges the next batch against all earlier ones (``judge``), with the earlier texts at hand: of these only the
documents that share a minimizer are hashed, shuffled and compared. Without them it refuses. ``find_repeats``
runs the batches of one table through an index of its own and verifies all of them at the end.

A row is known by its doc_id and the SHA-256 of its text. Postings carry the doc_id and 32 bits of a hash of
the text (``_s``), which only narrows down what is read: rows that share both are compared as themselves.

Defined results. A null text has no words. A null doc_id counts as larger than every other, and
rows of one doc_id never remove words from each other. Fewer than 13 words: nothing is removed.
Other columns are ignored by ``find_repeats`` and kept by ``remove_repeats``. An empty table gives
an empty result. A text that repeats the whole text of a smaller doc_id loses all its words if it
has 13 or more.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerforge.llm.common import NO_ID, Stored, freeing_shuffles, new_folder, newest_version, partitions, publish, read_text, remove, text_bytes, veiled, write_text
from tickerforge.llm.textkit import pieces, sliding_min

WINDOW = 13
RUN = 6
#: Runs of one size that are merged into one.
FAN_IN = 2
#: Batches that one table is dealt with in.
BATCHES = 4
#: Parts that candidate windows are compared in, one after the other, which bounds the disk they take in shuffles.
ROUNDS = 2
#: The parts of a window's digest.
DIGEST = ["d0", "d1"]
#: What a posting knows of its row.
OWNER = ["_id", "_s"]


def _id() -> Column:
    return F.coalesce(F.col("doc_id"), F.lit(NO_ID)).cast("long")


def _marked(docs: DataFrame) -> DataFrame:
    """With what postings know of a row: its doc_id for comparing, and a 32-bit hash of its text."""
    return docs.select(_id().alias("_id"), F.hash(F.coalesce("text", F.lit(""))).alias("_s"), F.col("text").alias("text"))


def keyed(docs: DataFrame) -> DataFrame:
    """(_id, _s, _bytes) of each row."""
    return _marked(docs).select(*OWNER, text_bytes().alias("_bytes"))


def _sha(text: str = "_bytes") -> Column:
    return F.unhex(F.sha2(text, 256))


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (_id, _s, text): (h, _id, _s) of each place where the minimizer changes."""

    def made() -> pa.RecordBatch:
        sizes = [len(h) for h in hashes]
        owners = [np.repeat(np.array([o[k] for o in owned], t), sizes) for k, t in ((0, np.int64), (1, np.int32))]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(hashes).view(np.int64)), *map(pa.array, owners)], names=["h", *OWNER])

    for batch in batches:
        hashes, owned, held = [], [], 0
        for *owner, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
            words = text.split()
            if len(words) < WINDOW:
                continue
            for _, grams in pieces(words, WINDOW - 1):
                least = sliding_min(grams.hashes(RUN), WINDOW - RUN + 1)
                least = least[np.concatenate(([True], least[1:] != least[:-1]))]
                hashes.append(least)
                owned.append(owner)
                held += len(least)
            if held > 200_000:
                yield made()
                hashes, owned, held = [], [], 0
        if held:
            yield made()


@contextmanager
def in_file_order(spark: SparkSession) -> Iterator[None]:
    """Within it, Spark relies on the order of a run's files (one a bucket, sorted) instead of sorting them again."""
    key = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class FingerprintIndex:
    """Sorted immutable runs of historical window fingerprints: bucketed files in a folder, listed in its manifest.

    It has one writer at a time: of two that add to the same version, the second fails and leaves nothing. Runs that
    a version of a named index has dropped stay until the version after it, for readers of the one before.
    """

    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        """Opens the index in the folder ``path``, new if there is none; without ``path``, one for this session."""
        self.spark, self.path, self.own = spark, path or new_folder(spark, "fingerprints"), path is None
        self.version = newest_version(spark, f"{self.path}/versions")
        self.buckets, self.runs, self.gone = partitions(spark), [], []  # runs: (table of this session, folder, batches merged into it)
        if self.version:
            found = json.loads(read_text(spark, f"{self.path}/versions/v{self.version}"))
            self.buckets, self.gone = found["buckets"], found["gone"]
            for folder, batches in found["runs"]:
                name = f"fingerprints_{uuid.uuid4().hex}"
                spark.sql(f"CREATE TABLE {name} (h BIGINT, _id BIGINT, _s INT) USING parquet CLUSTERED BY (h) SORTED BY (h) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{folder}'")
                self.runs.append((name, folder, batches))

    def _write(self, rows: DataFrame, batches: int) -> tuple[str, str, int]:
        name, folder = f"fingerprints_{uuid.uuid4().hex}", f"run-{uuid.uuid4().hex}"
        with freeing_shuffles(self.spark):
            rows.repartition(self.buckets, "h").write.bucketBy(self.buckets, "h").sortBy("h").option("path", f"{self.path}/{folder}").saveAsTable(name)
        return name, folder, batches

    def _commit(self, runs: list[tuple[str, str, int]]) -> None:
        """These runs as the next version; what the version before has dropped is deleted then."""
        out = [r for r in self.runs if r not in runs]
        draft = f"{self.path}/draft-{uuid.uuid4().hex}"
        write_text(self.spark, draft, json.dumps({"buckets": self.buckets, "runs": [r[1:] for r in runs], "gone": [] if self.own else [r[1] for r in out]}))
        done = publish(self.spark, draft, f"{self.path}/versions/v{self.version + 1}")
        remove(self.spark, draft)
        if not done:
            for name, folder, _ in (r for r in runs if r not in self.runs):
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
                remove(self.spark, f"{self.path}/{folder}")
            raise RuntimeError(f"another writer has added to {self.path}")
        old, self.gone = self.gone, [] if self.own else [r[1] for r in out]
        self.version, self.runs = self.version + 1, runs
        for name, *_ in out:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(self.spark, *[f"{self.path}/{folder}" for folder in (*old, *([r[1] for r in out] if self.own else []))])

    def append(self, docs: DataFrame) -> None:
        """Adds one batch of keyed documents as the newest run."""
        self._commit([*self.runs, self._write(docs.select(*OWNER, "_bytes").mapInArrow(_postings, "h long, _id long, _s int"), 1)])

    def shared_by_newest(self) -> Stored:
        """(h): the hashes of the newest run that two documents of all runs have, or more.

        Each older run is merge-joined with the newest on its own, so every join keeps the buckets and their order.
        """
        newest, *older = [self.spark.table(name) for name, _, _ in reversed(self.runs)]
        merged = newest.groupBy("h").agg(F.min("_id").alias("lo"), F.max("_id").alias("hi"))
        for run in older:
            met = run.join(newest.select(F.col("h").alias("_h")), F.col("h") == F.col("_h"), "left_semi").groupBy(F.col("h").alias("_h")).agg(F.min("_id").alias("_lo"), F.max("_id").alias("_hi"))
            merged = merged.join(met, F.col("h") == F.col("_h"), "left").select("h", F.least("lo", "_lo").alias("lo"), F.greatest("hi", "_hi").alias("hi"))
        with in_file_order(self.spark):
            return Stored(merged.where("lo < hi").select("h"), "shared")

    def postings(self, shared: DataFrame) -> Stored:
        """(h, _id, _s) of all runs, of the hashes given."""
        wanted = shared.select(F.col("h").alias("_h")).distinct()
        with in_file_order(self.spark):
            return Stored(reduce(DataFrame.unionByName, [self.spark.table(name).join(wanted, F.col("h") == F.col("_h"), "left_semi") for name, *_ in self.runs]), "postings")

    def compact(self) -> None:
        """Size-tiered: while the newest runs are of one size, they become one run of their sum."""
        while len(self.runs) >= FAN_IN and len({batches for *_, batches in self.runs[-FAN_IN:]}) == 1:
            old = self.runs[-FAN_IN:]
            merged = reduce(DataFrame.unionByName, [self.spark.table(name) for name, *_ in old])
            self._commit([*self.runs[:-FAN_IN], self._write(merged, sum(r[2] for r in old))])

    def close(self) -> None:
        """Forgets the tables of this session; the files stay."""
        for name, *_ in self.runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.runs = []


def _candidate_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (_id, text, its SHA-256, minimizers): the digests and places ``p`` of the windows known by one of them.

    Each row has a number ``n``, and one row more, of place -1, with its SHA-256.
    """
    from pyspark import TaskContext

    number = (TaskContext.get().partitionId() << 33) - 1

    def made() -> pa.RecordBatch:
        digests = np.concatenate([x[1] for x in found])
        sizes = [len(x[1]) for x in found]
        owners = [np.repeat(np.array([x[0][k] for x in found], np.int64), sizes) for k in (0, 1)]
        places = np.concatenate([x[2] for x in found]).astype(np.int32)
        texts = pa.array([None] * len(places), pa.binary())
        return pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(digests[:, k])) for k in range(len(DIGEST))), *map(pa.array, owners), pa.array(places), texts], names=[*DIGEST, "_id", "n", "p", "_sha"])

    for batch in batches:
        found, heads, held = [], [], 0
        shared = batch.column(3)
        for k, (i, text, sha) in enumerate(zip(*(batch.column(j).to_pylist() for j in range(3)))):
            number += 1
            heads.append((i, number, sha))
            wanted = np.sort(shared[k].values.to_numpy(zero_copy_only=False).view(np.uint64))
            for at, grams in pieces(text.split(), WINDOW - 1):
                least = sliding_min(grams.hashes(RUN), WINDOW - RUN + 1)
                if not len(least):
                    continue
                spot = np.minimum(np.searchsorted(wanted, least), len(wanted) - 1)
                keep = np.flatnonzero(wanted[spot] == least)
                if len(keep):
                    found.append(((i, number), grams.digests(WINDOW, keep), keep + at))
                    held += len(keep)
            if held > 100_000:
                yield made()
                found, held = [], 0
        if held:
            yield made()
        if heads:
            zero = pa.array(np.zeros(len(heads), np.int64))
            yield pa.RecordBatch.from_arrays([*[zero] * len(DIGEST), pa.array([h[0] for h in heads], pa.int64()), pa.array([h[1] for h in heads], pa.int64()), pa.array([-1] * len(heads), pa.int32()), pa.array([h[2] for h in heads], pa.binary())], names=[*DIGEST, "_id", "n", "p", "_sha"])


def _copies(docs: DataFrame) -> Stored:
    """(_id, _s, _sha) of the documents whose whole text a smaller doc_id has."""
    texts = keyed(docs).select(*OWNER, _sha().alias("_sha"))
    firsts = Stored(texts.groupBy("_sha").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"), "firsts")
    copies = Stored(texts.join(firsts.df, "_sha").where("_id > _first").select(*OWNER, "_sha").distinct(), "copies")
    firsts.drop()
    return copies


def _repeats(rows: DataFrame, history: DataFrame | None, postings: DataFrame, copies: Stored) -> Stored:
    """Per (_id, _sha) of the keyed rows and those of the history: ``whole`` if it is a copy, else the starts of its repeated windows.

    Copies are settled as a whole; what only they share needs no look at the texts. Of all texts, those are
    read on that share a minimizer.
    """
    shas = rows.select(*OWNER, _sha().alias("_sha"))
    settled = shas.join(copies.df.select("_id", "_sha", F.lit(True).alias("_copy")), ["_id", "_sha"], "left").groupBy(*OWNER).agg(F.min(F.coalesce("_copy", F.lit(False))).alias("all")).where("all").select(*OWNER)
    postings = postings.join(settled, OWNER, "left_anti")
    still = postings.groupBy("h").agg(F.min("_id").alias("lo"), F.max("_id").alias("hi")).where("lo < hi").select("h")
    wanted = Stored(postings.join(still, "h", "left_semi").groupBy(*OWNER).agg(F.collect_set("h").alias("hs")), "wanted")
    texts = rows
    if history is not None:
        texts = rows.unionByName(history.join(wanted.df.select(*OWNER), OWNER, "left_semi"))
    cut = texts.join(wanted.df, OWNER).select("_id", "_bytes", _sha().alias("_sha"), "hs")
    windows = Stored(cut.mapInArrow(_candidate_windows, ", ".join(f"{d} long" for d in DIGEST) + ", _id long, n long, p int, _sha binary"), "windows")
    wanted.drop()
    shares = []
    for k in range(ROUNDS):
        some = windows.df.where((F.col("p") >= 0) & (F.pmod("d0", F.lit(ROUNDS)) == k)).drop("_sha")
        # Written first: a join with a plain table lets Spark split a window that very many documents share.
        earliest = Stored(some.groupBy(*DIGEST).agg(F.min("_id").alias("lo"), F.max("_id").alias("hi")).where("lo < hi").select(*DIGEST, "lo"), "earliest")
        shares.append(Stored(some.join(earliest.df, DIGEST).where("_id > lo").groupBy("n").agg(F.collect_list("p").alias("starts")), "starts"))
        earliest.drop()
    starts = reduce(DataFrame.unionByName, [x.df for x in shares]).groupBy("n").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    # Rows of one id and text have the same windows; one of them is enough.
    named = windows.df.where("p < 0").groupBy("_id", "_sha").agg(F.min("n").alias("n")).join(starts, "n").join(copies.df, ["_id", "_sha"], "left_anti")
    found = Stored(named.select("_id", "_sha", "starts", F.lit(False).alias("whole")).unionByName(copies.df.select("_id", "_sha", F.lit(None).cast("array<int>").alias("starts"), F.lit(True).alias("whole")).distinct()), "repeats")
    for x in (windows, *shares, copies):
        x.drop()
    return found


def find_repeats(docs: DataFrame, batches: int = BATCHES) -> Stored:
    """Per (_id, _sha): ``whole`` if its text has been seen in a smaller doc_id, else the starts of its repeated windows.

    Documents arrive in ``batches`` of ascending doc_id.
    """
    spark, rows = docs.sparkSession, keyed(docs)
    cuts = docs.select(F.percentile_approx(_id(), [i / batches for i in range(1, batches)], 10_000)).first()[0] if batches > 1 else []
    index, found = FingerprintIndex(spark), []
    edges = [None, *sorted(set(cuts or [])), None]
    for low, high in zip(edges, edges[1:]):
        batch = rows
        if low is not None:
            batch = batch.where(F.col("_id") > low)
        if high is not None:
            batch = batch.where(F.col("_id") <= high)
        index.append(batch)
        found.append(index.shared_by_newest())
        if high is not None:
            index.compact()
    postings = index.postings(reduce(DataFrame.unionByName, [x.df for x in found]))
    index.close()
    remove(spark, index.path, *[x.path for x in found])
    repeats = _repeats(rows, None, postings.df, _copies(docs))
    postings.drop()
    return repeats


def judge(index: FingerprintIndex, batch: DataFrame, history: DataFrame | None = None) -> Stored:
    """Adds a batch to the index; its repeats as ``find_repeats`` gives them, against itself and all earlier batches.

    ``history`` are the documents of the earlier batches, without which an index that has some can't judge. Those that
    share no minimizer with the batch are left out where they are scanned, by a join whose other side Spark
    broadcasts while it is small. A window counts as repeated if a smaller doc_id has it, so batches should come in the order of
    their ids: what an earlier batch was told is not changed later.
    """
    if index.runs and history is None:
        raise ValueError(f"{index.path} holds earlier batches; give their documents as history")
    rows = keyed(batch)
    index.append(rows)
    shared = index.shared_by_newest()
    postings = index.postings(shared.df)
    index.compact()
    shared.drop()
    repeats = _repeats(rows, None if history is None else keyed(history), postings.df, _copies(batch))
    postings.drop()
    return repeats


def _kept(words: list[bytes], starts: np.ndarray | None, whole: bool) -> list[bytes]:
    if whole:
        return [] if len(words) >= WINDOW else words
    if starts is None:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    covered = np.cumsum(edge)[:-1] > 0
    return [words[i] for i in np.flatnonzero(~covered)]


def _rewrite(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            texts, whole, starts = (batch.column(names.index(x)) for x in ("_bytes", "whole", "starts"))
            out: list[list] = [[], [], [], []]
            for k, (text, all_of) in enumerate(zip(texts.to_pylist(), whole.to_pylist())):
                words = text.split()
                found = starts[k]
                kept = _kept(words, found.values.to_numpy(zero_copy_only=False).astype(np.int64) if found.is_valid else None, bool(all_of))
                joined = b" ".join(kept)
                values = (len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), (text if len(kept) == len(words) else joined) if with_text else None)
                for column, v in zip(out, values):
                    column.append(v)
            made = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())] + ([pa.array(out[3], pa.binary())] if with_text else [])
            keep = [i for i, n in enumerate(names) if n not in ("_bytes", "whole", "starts")]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + made, names=[names[i] for i in keep] + ["_n_words", "_n_removed", "_sha", *(["_kept"] if with_text else [])])

    return run


def _removed(docs: DataFrame, repeats: Stored, carried: list[str], with_text: bool) -> DataFrame:
    """The columns carried as c0, c1, ..., with _n_words, _n_removed, _sha, and _null and _text if asked for.

    The repeats are read when the result is, and stay until the session ends.
    """
    known = repeats.df.select(F.col("_id").alias("_rid"), F.col("_sha").alias("_rs"), "starts", "whole")
    plain = docs.select(*veiled(carried), _id().alias("_id"), text_bytes().alias("_bytes"), F.col("text").isNull().alias("_null")).withColumn("_sha", _sha())
    joined = plain.join(known, (F.col("_id") == F.col("_rid")) & (F.col("_sha") == F.col("_rs")), "left").drop("_rid", "_rs", "_id", "_sha")
    types = dict(docs.dtypes)
    schema = ", ".join([f"c{i} {types[c]}" for i, c in enumerate(carried)] + ["_null boolean", "_n_words long", "_n_removed long", "_sha string"] + (["_kept binary"] if with_text else []))
    out = joined.mapInArrow(_rewrite(with_text), schema)
    return out.withColumn("_text", F.when(~F.col("_null"), F.decode("_kept", "UTF-8"))) if with_text else out


def remove_repeats(docs: DataFrame, batches: int = BATCHES, with_text: bool = True, repeats: Stored | None = None) -> DataFrame:
    """``docs`` with ``text`` less its repeated words (null where it was null and unchanged where nothing goes), ``n_words``, ``n_removed`` and ``kept_sha256``.

    Without ``with_text`` only doc_id and those three columns are returned. ``repeats`` are those that
    ``judge`` found for the documents; without them, the documents are judged by themselves.
    """
    added = ["n_words", "n_removed", "kept_sha256"]
    carried = [c for c in docs.columns if c != "text" and c not in added] if with_text else ["doc_id"]
    out = _removed(docs, repeats or find_repeats(docs, batches), carried, with_text)
    found = {c: F.col(f"c{i}") for i, c in enumerate(carried)}
    if with_text:
        found["text"] = F.col("_text")
    order = [c for c in docs.columns if c in found] if with_text else carried
    return out.select(*[found[c].alias(c) for c in order], F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"), F.col("_sha").alias("kept_sha256"))


def cut_repeats(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``docs`` with the repeated words cut from ``text``, and ``n_chars``, if there, following it."""
    carried = [c for c in docs.columns if c != "text"]
    out = _removed(docs, find_repeats(docs, batches), carried, with_text=True)
    found = {c: F.col(f"c{i}") for i, c in enumerate(carried)} | {"text": F.col("_text")}
    if "n_chars" in found:
        found["n_chars"] = F.when(F.col("_n_removed") > 0, F.length("_text").cast(dict(docs.dtypes)["n_chars"])).otherwise(found["n_chars"])
    return out.select(*[found[c].alias(c) for c in docs.columns])


#: The contract's result in DuckDB's SQL.
ORACLE = r"""
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM words WHERE len(w) >= 13)
), repeated AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY win) AS first_doc FROM windows) WHERE first_doc < doc_id
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS q FROM repeated
), each_word AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS q, unnest(w) AS word FROM words
), kept AS (
  SELECT e.doc_id, count(*) AS n, string_agg(e.word, ' ' ORDER BY e.q) AS t FROM each_word e ANTI JOIN covered c ON c.doc_id = e.doc_id AND c.q = e.q GROUP BY e.doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON k.doc_id = w.doc_id
"""
