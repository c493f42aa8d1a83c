"""SimHash near-duplicates by multi-index hashing.

Method. A document's 64-bit fingerprint has a bit for each majority among the XXH64 hashes of its
3-word shingles. Equal fingerprints are one node. A fingerprint is cut into two 32-bit segments;
two fingerprints at 3 bits or fewer agree in one segment but for one bit at most. Each is entered
in a table per segment, and looks up the Hamming ball of radius one around its own segment (of two
segments that differ in one bit, the one with that bit set looks up the other, so a ball is
enumerated downwards only). What meets in a table entry is verified on the complete 64 bits. An
entry hands on a spanning forest of its links instead of all its pairs, which keeps every
component and no square of a large group. Components come from alternating large-star and
small-star steps on the distinct fingerprints.

Defined results. A null or blank text has fingerprint zero and links like any other. A text of
fewer than 3 words is one shingle. Rows that repeat a doc_id are returned each; a null doc_id is a
member of its component but never its name, unless no member has an id (then null). Other columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerforge.llm.common import Stored, partitions, text_bytes, unveiled, veiled
from tickerforge.llm.components import star_components

SHINGLE = 3
SEED = 42
DISTANCE = 3


def fingerprint(text: bytes) -> int:
    """The majority bits of the shingle hashes of a text's lower-cased words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = [a + b" " + b + b" " + c for a, b, c in zip(words, words[1:], words[2:])]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(shingles), 65_536):
        h = np.fromiter([xxhash.xxh64_intdigest(s, SEED) for s in shingles[at : at + 65_536]], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(shingles), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = np.array([fingerprint(t) for t in batch.column(2).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(marks.view(np.int64))], names=["doc_id", "h", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, h, fp) of every document: h a hash of its text, fp its fingerprint as a signed 64-bit number."""
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.xxhash64("text").alias("h"), text_bytes().alias("t")).mapInArrow(_fingerprints, f"doc_id {kind}, h long, fp long")


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries (segment, key, fp): a fingerprint's own key, and its key with each set bit cleared in turn."""
    for batch in batches:
        fps = batch.column(0).to_numpy().view(np.uint64)
        for at in range(0, len(fps), 10_000):
            part = fps[at : at + 10_000]
            for segment, key in enumerate((part >> np.uint64(32), part & np.uint64(0xFFFFFFFF))):
                keys, owners = [key], [part]
                for bit in range(32):
                    has = np.flatnonzero((key >> np.uint64(bit)) & np.uint64(1))
                    keys.append(key[has] ^ np.uint64(1 << bit))
                    owners.append(part[has])
                all_keys = np.concatenate(keys) | np.uint64(segment << 32)
                yield pa.RecordBatch.from_arrays([pa.array(all_keys.view(np.int64)), pa.array(np.concatenate(owners).view(np.int64))], names=["key", "fp"])


def _near(one: np.ndarray | np.uint64, many: np.ndarray) -> np.ndarray:
    return np.bitwise_count(one ^ many) <= DISTANCE


def forest(fps: np.ndarray) -> list[tuple[int, int]]:
    """Verified links that connect just what all links among these distinct fingerprints connect."""
    links: list[tuple[int, int]] = []
    left = fps
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = _near(at, left)
            if near.any():
                links += [(int(at), int(x)) for x in left[near]]
                frontier += list(left[near])
                left = left[~near]
    return links


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From entries sorted by key: links within each table entry."""

    def out(links: list[tuple[int, int]]) -> pa.RecordBatch:
        pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["u", "v"])

    held_key, held = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    links: list[tuple[int, int]] = []

    def entries(keys: np.ndarray, fps: np.ndarray) -> None:
        edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
        for i in np.flatnonzero(np.diff(edge) > 1):
            members = fps[edge[i] : edge[i + 1]]
            if len(members) == 2:
                if np.bitwise_count(members[0] ^ members[1]) <= DISTANCE:
                    links.append((int(members[0]), int(members[1])))
            else:
                links.extend(forest(members))

    for batch in batches:
        keys = np.concatenate((held_key, batch.column(0).to_numpy()))
        fps = np.concatenate((held, batch.column(1).to_numpy().view(np.uint64)))
        if not len(keys):
            continue
        cut = int(np.searchsorted(keys, keys[-1]))
        entries(keys[:cut], fps[:cut])
        held_key, held = keys[cut:], fps[cut:]
        if len(links) > 50_000:
            yield out(links)
            links = []
    if len(held):
        entries(held_key, held)
    if links:
        yield out(links)


def near_links(distinct: DataFrame) -> DataFrame:
    """Links (u, v) between the distinct fingerprints ``fp`` at 3 bits or fewer, enough to connect what any link connects."""
    entries = distinct.select("fp").mapInArrow(_tables, "key long, fp long")
    together = entries.repartition(partitions(distinct.sparkSession), "key").sortWithinPartitions("key", "fp")
    return together.mapInArrow(_links, "u long, v long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, h, fp, component_id): the smallest doc_id that a document reaches through links, itself included."""
    marked = Stored(fingerprints(docs), "simhash").df
    nodes = Stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes").df
    member = star_components(Stored(near_links(nodes), "links").df)
    named = nodes.join(member.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    names = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    component = Stored(named.join(names, "root").select("fp", "root", "component_id"), "components").df
    return marked.join(component, "fp").select("doc_id", "h", "fp", "root", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group: the one of the smallest doc_id (without ids, of the least text hash)."""
    marked = near_duplicates(docs)
    first = marked.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("one")).select(F.col("one.doc_id").alias("_id"), F.col("one.h").alias("_of"))
    winners = Stored(first, "winners").df
    columns = docs.columns
    rows = docs.select(*veiled(columns), F.col("doc_id").alias("_d"), F.xxhash64("text").alias("_h"))
    kept = rows.join(winners, F.col("_d").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_of")), "left_semi")
    repeated = marked.groupBy("doc_id", "h").count().where("count > 1").select(F.col("doc_id").alias("_id"), F.col("h").alias("_of"))
    if not repeated.isEmpty():  # rows of one id and text are one document
        kept = kept.dropDuplicates(["_d", "_h"])
    return kept.select(*unveiled(columns))
