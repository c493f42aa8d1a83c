"""Token counts through a cache keyed by content digest and tokenizer version.

Method. A text's SHA-256 (the tokenizer normalises nothing, so the normalised content is the text)
and the version digest (tokenizer file and library release) are joined to the counts stored before.
Of the digests not found, one document each is encoded; the new counts are appended to the cache.

Counts are those of the ``tokenizers`` library with its defaults and no special tokens added. Texts
of common Latin characters are counted by ``tiktoken`` on the same vocabulary, which cuts and merges
them alike at several times the speed; any other text, and any holding a special string, goes
through ``tokenizers`` itself.

Defined results. A null text counts as empty: 0 bytes, 0 tokens. Every row is returned, repeated
and null ids too; other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import importlib.metadata
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerforge.llm.common import Stored, freeing_shuffles, hadoop_path, text_bytes

#: Both libraries agree on the classes of these characters; a text with any other is rare here.
_RARE = re.compile("[^\t\n\r\x20-\x7e\xa1-\xac\xae-ſ–—‘’“”…€]")
#: Tokens up to which a text is not over the limit.
LIMIT = 512


@lru_cache(maxsize=4)
def counter(name: str) -> Callable[[str], int]:
    """Counts the tokens of a text as the library of the public tokenizer file ``name`` (.json) does."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path(name))
    whole.no_truncation()
    whole.no_padding()
    special = [t.content for t in whole.get_added_tokens_decoder().values()]
    with open(public_tokenizers.path(name.replace(".json", ".tiktoken")), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def count(text: str) -> int:
        if _RARE.search(text) or any(s in text for s in special):
            return len(whole.encode(text, add_special_tokens=False).ids)
        return len(fast.encode_ordinary(text))

    return count


def version_digest(name: str) -> str:
    """Changes whenever the tokenizer's file or its library does."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return hashlib.sha256(f.read() + importlib.metadata.version("tokenizers").encode()).hexdigest()


def _encode(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(name)
        for batch in batches:
            counts = [count(t.decode("utf-8", "replace")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    return run


class DigestCache:
    """Counts by (version, digest) in a folder of Parquet files that only grows."""

    COLUMNS = "version string, digest binary, n_tokens long"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def read(self, version: str) -> DataFrame:
        p, fs = hadoop_path(self.spark, self.path)
        rows = self.spark.read.schema(self.COLUMNS).parquet(self.path) if fs.exists(p) else self.spark.createDataFrame([], self.COLUMNS)
        # Two writers may have stored the same text; their counts are equal.
        return rows.where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, counts: DataFrame, version: str) -> None:
        with freeing_shuffles(self.spark):
            counts.select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode("append").parquet(self.path)


def count_tokens(docs: DataFrame, cache_path: str, tokenizer: str = "byte_bpe_50k.json", limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document; the cache gains what it lacked."""
    version, cache = version_digest(tokenizer), DigestCache(docs.sparkSession, cache_path)
    rows = docs.select("doc_id", text_bytes().alias("t")).withColumn("digest", F.unhex(F.sha2("t", 256)))
    narrow = Stored(rows.select("doc_id", "digest", F.octet_length("t").cast("long").alias("n_bytes")), "digests").df
    missing = narrow.groupBy("digest").agg(F.min("doc_id").alias("one")).join(cache.read(version), "digest", "left_anti")
    missing = missing.select(F.col("digest").alias("d"), "one")
    # One document of each missing digest; both keys, so that a text of many copies meets no single task.
    chosen = rows.join(missing, F.col("doc_id").eqNullSafe(F.col("one")) & (F.col("digest") == F.col("d")), "left_semi")
    cache.append(chosen.select("digest", "t").mapInArrow(_encode(tokenizer), "digest binary, n_tokens long"), version)
    # The counts of these texts, written first: a join with a plain table lets Spark split a digest that very many rows have.
    counts = Stored(narrow.select("digest").distinct().join(cache.read(version), "digest"), "counts").df
    return narrow.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
