"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

Method. A source's documents are cut into blocks. With a target weight w, its j-th block (from 1)
is released at slot floor((j-1)/w) and due by slot ceil(j/w); one block runs in each slot, the
released block with the earliest deadline first. Then every prefix of slots holds less than one
block more or less of each source than its weight asks for. Weights are whole parts of a total, so
the schedule repeats after as many slots as there are parts: only that template, whose length is
set by the weights and not by the data, is worked out ahead; a block finds its slot by arithmetic.

A source that has run out leaves its slots empty, and the others go on in the same proportions, so
each document is placed once and none is dropped or repeated.

Defined results. Every source is a class of its own, however few documents it has; one without a weight gets
OTHER parts. Null sources, and a source of that name, are the class ``*``. The driver holds the list of sources and
a template of their parts, which grow with the number of sources and not with that of documents. Documents of a
class follow each other in the order of the MD5 of their doc_id (a null id counts as the text
``null``; rows of equal ids follow each other in any order). An empty table gives an empty result.
``mix_sources`` keeps all columns and adds or replaces ``mix_class``, ``mix_seq``, ``mix_block`` and
``mix_slot``; (mix_slot, mix_seq) is the mixed order. ``in_mixed_order`` returns the columns it was given and
marks ``source`` with the weights and the block in its metadata, which Parquet keeps: by ``mix_of`` a
later step finds the mix and places the documents in it again, whatever order it reads them in.
"""

from __future__ import annotations

from collections.abc import Mapping
from heapq import heappop, heappush

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerforge.llm.common import id_text, in_order_within, partitions, unveiled, veiled

REST = "*"
#: Documents in a block.
BLOCK = 8
#: Target parts of each source in the production mix, and of documents without one.
WEIGHTS: dict[str, int] = {"src0": 24, **{f"src{i}": 4 for i in range(1, 20)}, REST: 4}
#: Parts of a source that has no weight.
OTHER = 4
#: Under which name the metadata of ``source`` hold a mix.
MARK = "mix"
ADDED = ["mix_class", "mix_seq", "mix_block", "mix_slot"]


def template(parts: Mapping[str, int]) -> dict[str, list[int]]:
    """The slots of each class's blocks within one period of ``sum(parts)`` slots, earliest deadline first.

    Of equal deadlines the class that is first by name goes first.
    """
    total, slots = sum(parts.values()), {c: [] for c in sorted(parts)}
    released: list[list[tuple[int, str]]] = [[] for _ in range(total)]
    for c, n in parts.items():
        for j in range(n):
            released[j * total // n].append((-(-(j + 1) * total // n), c))
    due: list[tuple[int, str]] = []
    for t, new in enumerate(released):
        for block in new:
            heappush(due, block)
        slots[heappop(due)[1]].append(t)
    return slots


def parts_of(docs: DataFrame, weights: Mapping[str, int] = WEIGHTS) -> dict[str, int]:
    """The classes of the documents and their parts."""
    found = docs.select(F.coalesce("source", F.lit(REST)).alias("c")).distinct()
    return {r["c"]: weights.get(r["c"], OTHER) for r in found.collect()}  # a row a source


def _placed(docs: DataFrame, columns: list[str], parts: Mapping[str, int], block: int) -> DataFrame:
    """The columns as c0, c1, ..., with the ADDED ones."""
    kind = F.when(F.col("source").isin([c for c in parts if c != REST]), F.col("source")).otherwise(F.lit(REST))
    classed = docs.select(*veiled(columns), id_text().alias("_id"), kind.alias("mix_class"))
    slots, total = template(parts), sum(parts.values())
    ranked = in_order_within(classed, ["mix_class"], F.md5("_id"), "mix_seq").withColumn("mix_block", F.floor(F.col("mix_seq") / block).cast("long"))
    if not parts:
        return ranked.withColumn("mix_slot", F.lit(None).cast("long"))
    own = F.element_at(F.create_map(*[x for c in sorted(parts) for x in (F.lit(c), F.lit(slots[c]))]), F.col("mix_class"))
    n = F.size(own)
    return ranked.withColumn("mix_slot", (F.floor(F.col("mix_block") / n) * total + F.element_at(own, (F.col("mix_block") % n + 1).cast("int"))).cast("long"))


def mix_sources(docs: DataFrame, weights: Mapping[str, int] = WEIGHTS, block: int = BLOCK, parts: Mapping[str, int] | None = None) -> DataFrame:
    """``docs`` with each document's class, place in it, block and slot; ``parts`` are those of ``parts_of`` if known."""
    columns = [c for c in docs.columns if c not in ADDED]
    return _placed(docs, columns, parts_of(docs, weights) if parts is None else parts, block).select(*unveiled(columns), *ADDED)


def in_mixed_order(docs: DataFrame, weights: Mapping[str, int] = WEIGHTS, block: int = BLOCK) -> DataFrame:
    """``docs`` in the order of the mix: partitions (files, once written) follow each other, and rows within them."""
    parts = parts_of(docs, weights)
    placed = _placed(docs, docs.columns, parts, block)
    ordered = placed.repartitionByRange(partitions(docs.sparkSession), "mix_slot", "mix_seq").sortWithinPartitions("mix_slot", "mix_seq").select(*unveiled(docs.columns))
    return ordered.withMetadata("source", {MARK: {"parts": parts, "block": block}})


def mix_of(docs: DataFrame) -> tuple[dict[str, int], int] | None:
    """Classes with their parts, and the block, of the mix that ``in_mixed_order`` brought the documents into, if any."""
    mark = docs.schema["source"].metadata.get(MARK) if "source" in docs.columns else None
    return (mark["parts"], mark["block"]) if mark else None


#: The same mix in DuckDB's SQL; the template is scheduled by a recursive query.
ORACLE = f"""
WITH RECURSIVE named(c, n) AS (VALUES {", ".join(f"('{c}', {n})" for c, n in WEIGHTS.items())}),
weight AS (
  SELECT c, n FROM named
  UNION ALL SELECT source, {OTHER} FROM documents WHERE source NOT IN (SELECT c FROM named) GROUP BY source
), classed AS (
  SELECT doc_id, source, coalesce((SELECT c FROM weight WHERE c = source AND c <> '{REST}'), '{REST}') AS mix_class FROM documents
), present AS (
  SELECT c, n, row_number() OVER (ORDER BY c) AS i FROM weight WHERE c IN (SELECT mix_class FROM classed)
), parts AS (
  SELECT list(n ORDER BY i) AS n, sum(n)::BIGINT AS total, count(*)::BIGINT AS k FROM present
), steps(t, done, pick) AS (
  SELECT 0::BIGINT, list_transform(n, lambda x: 0::BIGINT), 0::BIGINT FROM parts
  UNION ALL
  SELECT t + 1, list_transform(range(1, k + 1), lambda i: done[i] + CASE WHEN i = p THEN 1 ELSE 0 END), p
  FROM (SELECT t, done, n, total, k, list_min(list_transform(range(1, k + 1), lambda i:
          CASE WHEN done[i] < n[i] AND done[i] * total // n[i] <= t THEN ((done[i] + 1) * total + n[i] - 1) // n[i] * 1000 + i ELSE 1000000000 END)) % 1000 AS p
        FROM steps, parts WHERE t < total)
), slots AS (
  SELECT c, n, t - 1 AS slot, row_number() OVER (PARTITION BY c ORDER BY t) - 1 AS j FROM steps JOIN present ON i = pick
), ranked AS (
  SELECT doc_id, source, mix_class, row_number() OVER (PARTITION BY mix_class ORDER BY md5(CAST(doc_id AS VARCHAR))) - 1 AS mix_seq FROM classed
)
SELECT r.doc_id, r.mix_class, r.mix_seq, r.mix_seq // {BLOCK} AS mix_block, CAST((r.mix_seq // {BLOCK}) // s.n * p.total + s.slot AS BIGINT) AS mix_slot
FROM ranked r CROSS JOIN parts p JOIN slots s ON s.c = r.mix_class AND s.j = (r.mix_seq // {BLOCK}) % s.n
"""
