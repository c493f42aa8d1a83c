"""Ranked lexical search by MaxScore (Turtle and Flood, 1995), shard by shard.

Method. A first pass cuts every text into terms and writes, for each document, its number of terms and
the places and counts of those that the queries ask for; document counts and lengths are summed over
all documents. A second pass turns runs of these documents into shards: for each term a posting list of
impacts (the term's share of a document's score) and their maximum, the term's upper bound. A query's
lists are ordered by upper bound; those whose bounds add up to less than the k-th best score so far are
non-essential: a document in them alone can't qualify. Candidates come from the essential lists, a
range of documents at a time; a non-essential list is probed, the largest bound first, only for
candidates whose score so far and the bounds still to come reach the k-th best. That score is carried from
shard to shard within a task. Each task gives a query k documents at most, of which the best k are kept.

Queries are dealt with in blocks of bounded size, of which the terms go to every task; each block reads the
texts once. A shard is cut where its postings reach a bound, so a task's memory doesn't grow with its input.

Defined results. A null or blank text has no terms; such a document isn't counted and never found, and
such an item finds nothing. Rows of one doc_id are documents of their own; a null doc_id comes last among
equal scores. Rows of one item_id (null too) ask together, each of their terms once. Other columns are
ignored. An empty table on either side gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerforge.llm.common import NO_ID, Stored, text_bytes

K = 10
#: Bytes of the terms of a block of queries, on average at most.
QUERY_BYTES = 4_000_000
#: Postings of a shard, and documents whose candidates are scored together.
SHARD, RANGE = 2_000_000, 4_096
#: Bytes of a text that are cut into terms at once.
PIECE = 1 << 23
#: Every byte as itself, A-Z as a-z, and what no term holds as a space. Bytes of other characters are part of terms.
_TERM = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def terms_of(text: bytes, table: bytes = _TERM) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in lists of bounded size; ``table`` has what every byte becomes, a space between terms."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            piece = text[at:end].translate(table)
            cut = piece.rfind(b" ")
            if cut < 0:  # a term longer than a piece
                rest = text[end:].translate(table)
                cut = rest.find(b" ")
                end = len(text) if cut < 0 else end + cut
                piece = text[at:end].translate(table)
            else:
                piece, end = piece[:cut], at + cut + 1
        else:
            piece = text[at:].translate(table)
        yield piece.split()
        at = end


def _distinct_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (item_id, bytes): (item_id, term)."""
    for batch in batches:
        for i, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = list({t for terms in terms_of(raw.as_py()) for t in terms})
            yield pa.RecordBatch.from_arrays([pa.array([i] * len(found), pa.int64()), pa.array(found, pa.binary())], names=["item_id", "term"])


def _postings(places: dict[bytes, int]):
    """From (doc_id, bytes): (doc_id, n, terms, tfs) of each document that has a term."""
    names = ["doc_id", "n", "terms", "tfs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, terms, tfs, ends = [], [], [], [], [0]
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts: Counter[bytes] = Counter()
                n = 0
                for found in terms_of(raw.as_py()):
                    n += len(found)
                    counts.update(found)
                if not n:
                    continue
                ids.append(i)
                sizes.append(n)
                for term in counts.keys() & places.keys():
                    terms.append(places[term])
                    tfs.append(counts[term])
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists], names=names)

    return run


class Best:
    """The k best documents of a query so far, and the score that a further one has to reach."""

    def __init__(self, k: int) -> None:
        self.k, self.least = k, 1
        self.scores, self.ids, self.absent = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, absent: np.ndarray) -> None:
        scores, ids, absent = np.concatenate((self.scores, scores)), np.concatenate((self.ids, ids)), np.concatenate((self.absent, absent))
        best = np.lexsort((ids, absent, -scores))[: self.k]
        self.scores, self.ids, self.absent = scores[best], ids[best], absent[best]
        if len(best) == self.k:
            self.least = int(self.scores[-1])


class Shard:
    """Posting lists of impacts by term, cut at ranges of documents, with their upper bounds."""

    def __init__(self, ids: np.ndarray, absent: np.ndarray, docs: np.ndarray, terms: np.ndarray, impacts: np.ndarray, width: int) -> None:
        """``docs`` ascend; ``terms`` are below ``width``."""
        order = np.argsort(terms, kind="stable")
        self.ids, self.absent, self.docs, self.impacts = ids, absent, docs[order].astype(np.int32), impacts[order]
        terms = terms[order].astype(np.int64)
        self.ranges = max(1, -(-len(ids) // RANGE))
        self.cuts = np.searchsorted(terms * self.ranges + self.docs // RANGE, np.arange(width * self.ranges + 1))
        self.bound = np.zeros(width, np.int64)
        np.maximum.at(self.bound, terms, self.impacts)
        self.taken = self.held = 0

    def search(self, asked: np.ndarray, best: Best) -> None:
        """Adds a query's documents to its best; ``asked`` are its terms."""
        asked = asked[self.bound[asked] > 0]
        asked = asked[np.argsort(self.bound[asked], kind="stable")]
        reach = np.cumsum(self.bound[asked])  # of each list and those of lower bounds
        self.held += sum(int(self.cuts[(t + 1) * self.ranges] - self.cuts[t * self.ranges]) for t in asked)
        for r in range(self.ranges):
            essential = int(np.searchsorted(reach, best.least))
            if essential == len(asked):
                return
            start = r * RANGE
            scores = np.zeros(min(RANGE, len(self.ids) - start), np.int64)
            for t in asked[essential:]:
                a, b = self.cuts[t * self.ranges + r], self.cuts[t * self.ranges + r + 1]
                scores[self.docs[a:b] - start] += self.impacts[a:b]
                self.taken += b - a
            found = np.flatnonzero(scores)
            scores = scores[found]
            for e in range(essential - 1, -1, -1):
                able = scores + reach[e] >= best.least
                found, scores = found[able], scores[able]
                if not len(found):
                    break
                t = asked[e]
                a, b = self.cuts[t * self.ranges + r], self.cuts[t * self.ranges + r + 1]
                if a < b:
                    place = np.minimum(np.searchsorted(self.docs[a:b], found + start), b - a - 1)
                    scores = scores + np.where(self.docs[a:b][place] == found + start, self.impacts[a:b][place], 0)
                    self.taken += len(found)
            able = scores >= best.least
            if able.any():
                found = found[able] + start
                best.add(scores[able], self.ids[found], self.absent[found])


def _search(asked: list[tuple[int | None, np.ndarray]], weights: np.ndarray, documents: int, length: int, k: int):
    """Over the rows of ``_postings``: each query's best k documents of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in asked]
        ids: list[pa.Array] = []
        sizes, counts, terms, tfs, held = [], [], [], [], 0

        def searched() -> None:
            doc = pa.chunked_array(ids)
            n, per, t, tf = np.concatenate(sizes), np.concatenate(counts), np.concatenate(terms), np.concatenate(tfs).astype(np.int64)
            if 90 * int(n.max(initial=0)) * documents >= 2**63:
                n = n.astype(object)
            m = (10 + 90 * n * documents // length).astype(np.int64)
            docs = np.repeat(np.arange(len(n)), per)
            shard = Shard(doc.fill_null(NO_ID).to_numpy(), doc.is_null().to_numpy(), docs, t, weights[t] * (1_000_000_000 * tf // (1000 * tf + 8 * m[docs])), len(weights))
            for (_, wanted), b in zip(asked, best):
                shard.search(wanted, b)
            for x in (ids, sizes, counts, terms, tfs):
                x.clear()

        for batch in batches:
            ids.append(batch.column(0))
            sizes.append(batch.column(1).to_numpy())
            counts.append(np.diff(batch.column(2).offsets.to_numpy()))
            terms.append(batch.column(2).flatten().to_numpy())
            tfs.append(batch.column(3).flatten().to_numpy())
            held += len(terms[-1])
            if held >= SHARD:
                searched()
                held = 0
        if ids:
            searched()
        for (item, _), b in zip(asked, best):
            if len(b.ids):
                found = pa.array(b.ids, pa.int64(), mask=b.absent)
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(found), pa.int64()), found, pa.array(b.scores)], names=["item_id", "doc_id", "score"])

    return run


def term_weight(documents: int, holding: int) -> int:
    """A term's weight, from the number of documents and of those that hold it."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _ranked_block(docs: DataFrame, block: DataFrame, k: int) -> DataFrame | None:
    """(item_id, doc_id, score) of a block's queries, k a task; None if nothing can be found."""
    items: dict[int | None, list[int]] = {}
    places: dict[bytes, int] = {}
    for r in block.collect():  # one block's terms, which are bounded
        items.setdefault(r["item_id"], []).append(places.setdefault(bytes(r["term"]), len(places)))
    if not places:
        return None
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("t"))
    index = Stored(rows.mapInArrow(_postings(places), "doc_id long, n long, terms array<int>, tfs array<int>"), "postings").df
    documents, length = index.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not documents:
        return None
    weights = np.zeros(len(places), np.int64)
    for r in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row a term of the block
        weights[r["term"]] = term_weight(documents, r["count"])
    asked = [(i, np.unique(np.array(t, np.int64))) for i, t in items.items()]
    return index.mapInArrow(_search(asked, weights, documents, length, k), "item_id long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item its k best documents, of scores above 0."""
    spark = docs.sparkSession
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), text_bytes().alias("t"))
    terms = Stored(rows.mapInArrow(_distinct_terms, "item_id long, term binary").distinct(), "query-terms").df
    size = terms.agg(F.sum(F.octet_length("term") + 8)).first()[0] or 0
    blocks = max(1, -(-size // QUERY_BYTES))
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for b in range(blocks):
        part = _ranked_block(docs, terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b), k)
        found = found if part is None else found.unionByName(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


#: The contract's result in DuckDB's SQL, every item against every document.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
), whole AS (SELECT count(*) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM d WHERE len(t) > 0),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), p AS (
  SELECT r, doc_id, len AS n, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS len, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM asked) GROUP BY r, doc_id, len, term
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term) CROSS JOIN whole
), s AS (
  SELECT a.item_id, p.r, p.doc_id, CAST(sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (10 + (90 * p.n * x.n) // x.l)))) AS BIGINT) AS score
  FROM asked a JOIN w ON w.term = a.term JOIN p ON p.term = a.term CROSS JOIN whole x GROUP BY a.item_id, p.r, p.doc_id
), ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
