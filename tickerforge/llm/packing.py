"""Packing into optimal length buckets: dynamic programming over the global length histogram.

Method. The lengths (in words) of all documents are counted once and make an exact histogram: a row for
each length that occurs. W words make at most sqrt(2 W) different lengths, six million for 10**13 words,
so the driver may have it. Dynamic programming cuts it into the given number of buckets with the least
padding (every document padded to the largest length of its bucket); each layer is the lower envelope
of lines, which takes a time in proportion to the lengths. Within a bucket, batches hold as many
documents as a token budget takes at that length, one at least.

Defined results. A null or blank text has length 0 and pads to its bucket. Documents of a bucket
follow each other in the order of the MD5 of their doc_id (a null id counts as the text ``null``;
rows of equal ids follow each other in any order), or, given a ``mix``, in the mixed order of their
sources, whose columns (``mixing.ADDED``) are then added or replaced too. Of cuts with equal padding, the one whose last
bucket starts earliest is taken, then likewise for the buckets before. An empty table gives an empty
result. ``pack`` keeps all columns and adds or replaces ``n_words``, ``bucket``, ``boundary``, ``batch``
and ``padding``; a bucket number starts at 0 for the shortest.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Mapping
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerforge.llm import mixing
from tickerforge.llm.common import Stored, id_text, in_order_within, in_slots_within, unveiled, veiled

BUCKETS = 8
#: Words of a batch, padding counted.
BUDGET = 8192
#: About how many slices the slots of a mix are ranked in.
SLICES = 4096
ADDED = ["n_words", "bucket", "boundary", "batch", "padding"]


def word_count(text: str = "text") -> Column:
    """How many runs of ``[^\\x20\\x09-\\x0D]`` a text has."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """The upper lengths of the ``buckets`` (fewer if there are fewer lengths) with the least padding.

    The best cut before length j is the lowest at x = lengths[j] of the lines cost[i] + (upto[j] - upto[i]) x.
    Their slopes fall with i and x grows with j, so that the envelope is a queue; of equal cuts the first is kept.
    """
    m = len(lengths)
    upto = [0, *accumulate(counts)]
    cost: list[int | None] = [0, *[None] * m]
    back: list[list[int]] = []
    for _ in range(min(buckets, m)):
        after: list[int | None] = [None] * (m + 1)
        origin, lines = [0] * (m + 1), deque()
        for j in range(1, m + 1):
            if cost[j - 1] is not None:
                new = (cost[j - 1], upto[j - 1], j - 1)
                while len(lines) > 1 and _overtakes(lines[-2], lines[-1]) >= _overtakes(lines[-1], new):
                    lines.pop()
                lines.append(new)
            x = lengths[j - 1]
            while len(lines) > 1 and lines[1][0] - lines[1][1] * x < lines[0][0] - lines[0][1] * x:
                lines.popleft()
            if lines:
                c, u, origin[j] = lines[0]
                after[j] = c + (upto[j] - u) * x  # padded size; the documents' own words are the same in every cut
        cost = after
        back.append(origin)
    cuts, j = [], m
    for origin in reversed(back):
        cuts.append(lengths[j - 1])
        j = origin[j]
    return cuts[::-1]


def _overtakes(one: tuple[int, int, int], other: tuple[int, int, int]) -> int:
    """The last length at which a line is no higher than one of steeper fall."""
    return (other[0] - one[0]) // (other[1] - one[1])


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, keep: list[str] | None = None, mix: tuple[Mapping[str, int], int] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with each document's length, bucket, boundary, batch and padding.

    By a ``mix`` (classes with their parts, documents in a block) batches are formed in the mixed order.
    """
    given = [c for c in (docs.columns if keep is None else keep) if c not in ADDED]
    # Words are counted once, and what is counted and cut by them is kept without the texts.
    slim = Stored(docs.select(*veiled([c for c in given if c != "text"]), "doc_id", *(["source"] if mix else []), word_count().alias("n_words")), "lengths").df
    histogram = sorted((r["n_words"], r["n"]) for r in slim.groupBy("n_words").agg(F.count(F.lit(1)).alias("n")).collect())
    cuts = boundaries([x for x, _ in histogram], [n for _, n in histogram], buckets) or [0]
    bucket, boundary = F.lit(len(cuts) - 1), F.lit(cuts[-1])
    for i in range(len(cuts) - 2, -1, -1):
        bucket = F.when(F.col("n_words") <= cuts[i], F.lit(i)).otherwise(bucket)
        boundary = F.when(F.col("n_words") <= cuts[i], F.lit(cuts[i])).otherwise(boundary)
    placed = {"bucket": bucket.cast("int"), "boundary": boundary.cast("long")}
    if "text" in given or mix:
        rows, columns = docs if mix is None else mixing.mix_sources(docs, block=mix[1], parts=mix[0]), given + [c for c in (mixing.ADDED if mix else []) if c not in given]
        rows = rows.select(*veiled(columns), id_text().alias("_id"), word_count().alias("n_words"), *([F.col("mix_slot").alias("_slot"), F.col("mix_seq").alias("_of_class")] if mix else []))
    else:
        rows, columns = slim.withColumn("_id", id_text()), given
    rows = rows.withColumns(placed)
    if mix is None:
        ranked = in_order_within(rows, ["bucket"], F.md5("_id"), "_seq")
    else:
        width = max(1, sum(n for _, n in histogram) // (SLICES * mix[1]))
        brief = mixing.mix_sources(slim.select("doc_id", "source", "n_words"), block=mix[1], parts=mix[0]).withColumns(placed).withColumnRenamed("mix_slot", "_slot")
        ranked = in_slots_within(rows, ["bucket"], "_slot", "_of_class", width, "_seq", brief)
    size = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("boundary"), F.lit(1)))).cast("long")
    return ranked.withColumn("batch", F.floor(F.col("_seq") / size).cast("long")).withColumn("padding", F.col("boundary") - F.col("n_words")).select(*unveiled(columns), *ADDED)


def _oracle() -> str:
    """The same packing in DuckDB's SQL, one layer of the dynamic programme per bucket."""
    layers = ["layer0 AS (SELECT 0::BIGINT AS j, 0::BIGINT AS cost, []::BIGINT[] AS cuts)"]
    for k in range(1, BUCKETS + 1):
        layers.append(f"""layer{k} AS (
  SELECT j, cost, cuts FROM (
    SELECT h.i AS j, p.cost + h.top * (h.upto - coalesce(b.upto, 0)) AS cost, list_append(p.cuts, h.top) AS cuts,
           row_number() OVER (PARTITION BY h.i ORDER BY p.cost + h.top * (h.upto - coalesce(b.upto, 0)), p.j) AS best
    FROM histogram h JOIN layer{k - 1} p ON p.j < h.i LEFT JOIN histogram b ON b.i = p.j
  ) WHERE best = 1)""")
    found = " UNION ALL ".join(f"SELECT {k} AS k, cuts FROM layer{k} WHERE j = (SELECT max(i) FROM histogram)" for k in range(1, BUCKETS + 1))
    return f"""
WITH sized AS (
  SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_words FROM documents
), histogram AS (
  SELECT n_words AS top, CAST(sum(count(*)) OVER (ORDER BY n_words) AS BIGINT) AS upto, row_number() OVER (ORDER BY n_words) AS i FROM sized GROUP BY n_words
), {", ".join(layers)},
chosen AS (SELECT cuts FROM ({found}) ORDER BY k DESC LIMIT 1),
placed AS (
  SELECT doc_id, n_words, len(list_filter(cuts, lambda c: c < n_words)) AS bucket, list_min(list_filter(cuts, lambda c: c >= n_words)) AS boundary FROM sized, chosen
)
SELECT doc_id, n_words, CAST(bucket AS INTEGER) AS bucket, boundary,
       CAST((row_number() OVER (PARTITION BY bucket ORDER BY md5(CAST(doc_id AS VARCHAR))) - 1) // greatest(1, {BUDGET} // greatest(boundary, 1)) AS BIGINT) AS batch, boundary - n_words AS padding
FROM placed
"""


ORACLE = _oracle()
