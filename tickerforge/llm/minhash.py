"""Document fingerprints by one-permutation MinHash with optimal densification and packed b-bit values.

Method. Every 5-word shingle is hashed once. The hash's leading bits choose one of 256 bins, and a
bin keeps its least hash. An empty bin borrows from a filled one that a universal hash of (bin,
attempt) picks, so that equal empty bins of two documents borrow alike (optimal densification).
The low four bits of each bin are packed two to a byte. Of unequal shingle sets a share of 1/16 of
the bins agrees by chance; the likeness of two fingerprints takes it off.

Defined results. A null text is an empty text; empty texts are alike (1) and unlike any other. A
text of fewer than 5 words is one shingle. Words are taken unchanged. Documents follow each other
by descending doc_id (null ids last, repeated ids by their text), the first after the last; a
single document follows itself. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerforge.llm.common import Rows, partitions, text_bytes
from tickerforge.llm.textkit import mix, shingle_hashes

SHINGLE = 5
BINS = 256
BITS = 4
_SHIFT = np.uint64(64 - (BINS - 1).bit_length())
_EMPTY = np.uint64(2**64 - 1)
#: Bins that an empty bin looks at, in order; after these its nearest filled one.
ATTEMPTS = 64
_LOOKS = (mix(np.arange(1, BINS * ATTEMPTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(BINS)).astype(np.int64).reshape(BINS, ATTEMPTS)


def densified(bins: np.ndarray) -> np.ndarray:
    """Bins with each empty one filled from the first filled bin that it looks at."""
    empty = np.flatnonzero(bins == _EMPTY)
    if not len(empty):
        return bins
    filled = bins != _EMPTY
    looks = _LOOKS[empty]
    hit = filled[looks]
    first = hit.argmax(axis=1)
    source = looks[np.arange(len(empty)), first]
    for k in np.flatnonzero(~hit[np.arange(len(empty)), first]):
        order = (empty[k] + np.arange(1, BINS)) % BINS
        source[k] = order[filled[order].argmax()]
    out = bins.copy()
    # Mixed with the bin's own number: else a text of one shingle would fill all bins with the same low bits.
    out[empty] = mix(bins[source] + empty.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


def signature(text: bytes) -> bytes:
    """The packed fingerprint of a text, 128 bytes."""
    hashes = shingle_hashes(text.split(), SHINGLE)
    bins = np.full(BINS, _EMPTY, np.uint64)
    np.minimum.at(bins, (hashes >> _SHIFT).astype(np.int64), hashes)
    low = (densified(bins) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    return (low[0::2] << 4 | low[1::2]).tobytes()


def likeness(one: bytes, other: bytes) -> float:
    """The estimated Jaccard likeness of two fingerprints, corrected for chance agreement."""
    a, b = np.frombuffer(one, np.uint8), np.frombuffer(other, np.uint8)
    differ = a ^ b
    agree = (int(np.count_nonzero(differ & 0xF0 == 0)) + int(np.count_nonzero(differ & 0x0F == 0))) / BINS
    chance = 1 / (1 << BITS)
    return min(1.0, max(0.0, (agree - chance) / (1 - chance)))


def edited(text: str, after: str) -> str:
    """``text`` with its last third of code points replaced by the first as many of ``after``."""
    cut = len(text) // 3
    return text[: len(text) - cut] + after[:cut]


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (bucket, tail, doc_id, t) in order: each row against the next of its bucket; a bucket ends with its tail."""
    rows = Rows(_SCHEMA, 10_000)
    bucket, before = None, None
    for batch in batches:
        for b, tail, doc_id, t in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if bucket != b:
                bucket, before = b, None
            if tail and before is None:
                continue
            mark, text = signature(t), t.decode("utf-8", "replace")
            if before is not None:
                own_id, own_text, own_mark = before
                changed = edited(own_text, text).encode()
                changed_mark = signature(changed)
                rows.add(own_id, len(own_text), hashlib.sha256(changed).hexdigest(), own_mark.hex(), changed_mark.hex(), likeness(own_mark, changed_mark), likeness(own_mark, mark))
                if rows.full():
                    yield rows.take()
            before = None if tail else (doc_id, text, mark)
    yield rows.take()


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and their likeness.

    Documents are cut into ranges of doc_id. Each range also gets the first document of the range
    that follows, so every document meets its next without a global order in one task. Only the
    bounds and heads of the ranges, one value per partition, pass through the driver.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    ranges = 4 * n  # several to a partition, which evens them out
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("t"))
    cuts = ids.select(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0] or []
    cuts = sorted(set(cuts))
    # Bucket 0 has the largest ids, nulls come last.
    bucket = F.lit(len(cuts) + 1) if not cuts else F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(F.size(F.filter(F.lit(cuts), lambda c: c > F.col("doc_id"))))
    placed = ids.withColumn("bucket", bucket.cast("int"))
    heads = {r["bucket"]: r["head"] for r in placed.groupBy("bucket").agg(F.max("doc_id").alias("head")).collect()}
    order = sorted(heads)
    follow = [(heads[after], b) for b, after in zip(order, order[1:] + order[:1])]
    tails = spark.createDataFrame(follow, "head long, to int")
    ends = ids.join(F.broadcast(tails), F.col("doc_id").eqNullSafe(F.col("head"))).select(F.col("to").alias("bucket"), F.lit(True).alias("tail"), "doc_id", "t")
    rows = placed.select("bucket", F.lit(False).alias("tail"), "doc_id", "t").unionByName(ends)
    ordered = rows.repartition(n, "bucket").sortWithinPartitions("bucket", "tail", F.col("doc_id").desc_nulls_last(), "t")
    return ordered.mapInArrow(_compared, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
