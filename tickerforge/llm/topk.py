"""Exact top-k by inner product over an impact-ordered index, score at a time.

Method. Components become integers floor(64 x). Rows are dealt to shards of a bounded size. In a shard,
every non-zero component is a posting of its dimension with a quantised impact, the level of its
magnitude; postings are laid out in segments of descending levels. A segment that few rows are in is kept
as lists by dimension, one that most rows are in (of dense vectors each is) as a packed matrix. Queries meet
the shard in blocks, with one accumulator a query and row. After a segment, what is left of a row is
bounded by the sum of |query| times |impact| over its postings still to come, and the k-th best exact
score of the rows that lead is a lower bound of the query's. A row that can't reach it is out for good.
A query stops once the rows still possible are so few that scoring them exactly costs less than going on;
they are then rescored exactly in integers. Each shard gives a query k rows, of which the best k are
kept, ties to the smaller vec_id.

Every query meets every shard, as an exact answer demands; a shipped query of W numbers then stands for
W x SHARD multiplications, so shards are as large as memory allows and no smaller than the cluster's
parallelism needs.

Defined results. Vectors that are null or hold a null or non-finite component, and rows of null
vec_id, take no part. A shorter vector is as if filled with zeros. A query is answered once even if
its row is repeated (the least vector counts then), and no row of its own vec_id is a candidate;
other repeated rows count each. Components so large that sums of them would not be exact in doubles are kept out of
the index: their rows and queries are scored in whole numbers of any size, and a component or a score beyond
64 bits counts as the last that they hold. Fewer candidates than k: all. Other columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerforge.llm.common import partitions

SCALE = 64
#: Rows and bytes of a shard's index at most (what one task holds), and rows at least where there are several.
SHARD, BYTES, LEAST = 65_536, 256 << 20, 256
#: Bytes a component takes in the index: itself, in its segment's matrix and in what is left after it, of three segments.
EACH = 24
#: The last whole numbers of 64 bits, as a component (a double) and as a score.
COMPONENT, SCORE = 2.0**63 - 1024, 2**63 - 1
#: Queries that meet a shard together.
BLOCK = 128
#: Levels of quantised impact, and the shares of the postings in the segments, the highest levels first.
LEVELS, SEGMENTS = 255, (0.4, 0.3, 0.3)
#: Rescoring begins once the possible members are a few k, or one in FEWER of the rows.
FEW, FEWER = 2, 16
#: Rows that lead after a segment and are scored exactly for a bound, in multiples of k.
AHEAD = 3
#: A segment with fewer than one in so many of all components is kept as lists.
SPARSE = 16


class ImpactIndex:
    """The postings of one shard in segments of descending quantised impact."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.limit = exact_up_to(vectors.shape[1])
        large = np.abs(vectors).max(axis=1, initial=0) > self.limit
        self.large, self.large_ids = vectors[large], ids[large]
        self.ids, self.vectors = ids[~large], vectors[~large].astype(np.float32)  # whole numbers that it holds exactly
        vectors = self.vectors
        size = np.abs(vectors)
        self.top = int(size.max(initial=0))
        step = max(1, -(-self.top // LEVELS))
        level = np.where(size > 0, size // step, -1).astype(np.int16)
        count = np.bincount(level[level >= 0].ravel(), minlength=LEVELS + 1)
        above = np.cumsum(count[::-1])[::-1]  # postings of a level or a higher one
        self.postings = int(above[0]) if vectors.size else 0
        shares = np.cumsum(SEGMENTS)[:-1] * self.postings
        edges = [int(np.flatnonzero(above >= s)[-1]) for s in shares] if self.postings else [0] * len(shares)
        edges = [LEVELS + 1, *edges, 0]
        self.segments = []  # (postings, lists or None, matrix or None, what is left after it)
        for high, low in zip(edges, edges[1:]):
            inside, left = (level < high) & (level >= low), (level < low) & (level >= 0)
            n = int(inside.sum())
            if n:
                lists = [(rows := np.flatnonzero(inside[:, d]).astype(np.int32), vectors[rows, d]) for d in range(vectors.shape[1])] if n * SPARSE < vectors.size else None
                self.segments.append((n, lists, None if lists else np.where(inside, vectors, np.float32(0)), np.where(left, size, np.float32(0)) if left.any() else None))
        self.seen = self.asked = 0

    def skipped(self) -> float:
        """The share of the queries' postings that no accumulator had to take."""
        return 1 - self.seen / self.asked if self.asked else 0.0

    def search(self, qids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Each query's best k (query id, ids, scores) in this shard; those of the large rows come apart."""
        large = np.abs(queries).max(axis=1, initial=0) > self.limit
        for i in range(len(qids)) if len(self.large_ids) or large.any() else ():
            yield from self._apart(qids[i], queries[i], k, bool(large[i]))
        qids, queries = qids[~large], queries[~large]
        n = len(self.ids)
        if not n or not len(qids):
            return
        top = self.top * int(np.abs(queries).max(initial=1)) * max(1, queries.shape[1])
        kind = np.float32 if top < 2**23 else np.float64  # exact in whole numbers up to there and 2**53
        self.asked += self.postings * len(qids)
        scores, alive, kth, near = np.zeros((len(qids), n), kind), np.arange(len(qids)), np.full(len(qids), -np.inf), AHEAD * k
        if not self.segments:  # all scores are zero
            for i in alive:
                yield self._best(qids[i], queries[i], np.flatnonzero(self.ids != qids[i]), k)
            return
        for postings, lists, matrix, left in self.segments:
            asks = queries[alive].astype(kind)
            self.seen += postings * len(alive)
            if lists is None:
                scores[alive] += asks @ matrix.T.astype(kind, copy=False)
            else:
                for d, (rows, values) in enumerate(lists):
                    scores[np.ix_(alive, rows)] += np.outer(asks[:, d], values.astype(kind, copy=False))
            now = scores[alive]
            reach = now + (np.abs(asks) @ left.T.astype(kind, copy=False) if left is not None else 0) + kind(top * 1e-12)
            ahead = np.argpartition(now, n - near, axis=1)[:, n - near :] if n > near else np.tile(np.arange(n), (len(alive), 1))
            exact = np.einsum("ijk,ik->ij", self.vectors[ahead].astype(kind, copy=False), asks).astype(np.float64)
            exact[self.ids[ahead] == qids[alive][:, None]] = -np.inf
            if exact.shape[1] >= k:
                kth[alive] = np.maximum(kth[alive], np.partition(exact, exact.shape[1] - k, axis=1)[:, exact.shape[1] - k])
            possible = (reach >= kth[alive][:, None]) & (self.ids[None, :] != qids[alive][:, None])
            done = (possible.sum(axis=1) <= max(FEW * k, n // FEWER)) if left is not None else np.ones(len(alive), bool)
            for i in np.flatnonzero(done):
                yield self._best(qids[alive[i]], queries[alive[i]], np.flatnonzero(possible[i]), k)
            alive = alive[~done]
            if not len(alive):
                return

    def _best(self, qid: int, query: np.ndarray, rows: np.ndarray, k: int) -> tuple[int, np.ndarray, np.ndarray]:
        kind = np.float32 if self.top * int(np.abs(query).max(initial=1)) * max(1, len(query)) < 2**23 else np.float64
        exact = (self.vectors[rows].astype(kind, copy=False) @ query.astype(kind)).astype(np.int64)
        best = np.lexsort((self.ids[rows], -exact))[:k]
        return int(qid), self.ids[rows[best]], exact[best]


    def _apart(self, qid: int, query: np.ndarray, k: int, whole: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The best k of the large rows, or of all rows for a large query, in whole numbers of any size."""
        ids = np.concatenate((self.large_ids, self.ids)) if whole else self.large_ids
        rows = np.concatenate((self.large, self.vectors.astype(np.int64))) if whole else self.large
        rows, ids = rows[ids != qid], ids[ids != qid]
        if len(ids):
            exact = np.array([min(SCORE, max(-SCORE, int(s))) for s in rows.astype(object) @ query.astype(object)], np.int64)
            best = np.lexsort((ids, -exact))[:k]
            yield int(qid), ids[best], exact[best]


def exact_up_to(width: int) -> int:
    """The largest components whose inner products, and all sums on the way, are exact in doubles and which single floats hold."""
    return int(min(2**24, (2**53 // max(1, width)) ** 0.5))


def _integers(column: pa.Array, width: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        scaled = SCALE * column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()].astype(np.float64)
    flat = np.clip(np.floor(scaled), -COMPONENT, COMPONENT).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, place] = flat
    return out


def _search(k: int, width: int):
    """Over rows (shard, asks, vec_id, v) in order of (shard, asks): first a shard's rows, then its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, index = None, None
        ids: list[np.ndarray] = []
        rows: list[np.ndarray] = []
        for batch in batches:
            shards, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.concatenate(([True], (shards[1:] != shards[:-1]) | (asks[1:] != asks[:-1]), [True]))) if len(shards) else []
            for a, b in zip(edges, edges[1:]):
                if shard != shards[a]:
                    shard, index, ids, rows = shards[a], None, [], []
                part = batch.slice(a, b - a)
                if not asks[a]:
                    ids.append(part.column(2).to_numpy())
                    rows.append(_integers(part.column(3), width))
                    continue
                if index is None:
                    index = ImpactIndex(np.concatenate(ids) if ids else np.zeros(0, np.int64), np.concatenate(rows) if rows else np.zeros((0, width), np.int64))
                    ids, rows = [], []
                qids, queries = part.column(2).to_numpy(), _integers(part.column(3), width)
                for at in range(0, len(qids), BLOCK):
                    found = list(index.search(qids[at : at + BLOCK], queries[at : at + BLOCK], k))
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array([q for q, _, _ in found], np.int64), [len(x) for _, x, _ in found])), pa.array(np.concatenate([x for _, x, _ in found]).astype(np.int64)), pa.array(np.concatenate([s for _, _, s in found]).astype(np.int64))], names=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose vec_id is divisible by ``every``, its k best others."""
    sound = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))))
    n, width = sound.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    most = max(1, min(SHARD, BYTES // (EACH * max(1, width))))
    shards = max(1, -(-n // most), min(partitions(vectors.sparkSession), -(-n // LEAST)))
    rows = sound.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("asks"), "vec_id", "v")
    queries = sound.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("asks"), "vec_id", "v")
    met = rows.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "asks")
    found = met.mapInArrow(_search(k, width), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: The contract's result in DuckDB's SQL, from all pairs.
ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
