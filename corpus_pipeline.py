"""The corpus pipeline: toxicity, near-dedup, substring dedup, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerforge.llm import mixing, packing, simhash, substring_dedup, toxicity
from tickerforge.llm.common import Stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; learned from the labels of all of them."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.lit(True))
    return toxicity.without_toxic(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the words of passages that documents of smaller ids hold; their lengths follow."""
    return substring_dedup.cut_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mix: files follow each other, and rows within them. The weights go along."""
    return mixing.in_mixed_order(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their length bucket, boundary, batch and padding; batches follow the mix, if there was one."""
    return packing.pack(docs, mix=mixing.mix_of(docs))


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", near_dedup), ("substring_dedup", cut_repeats), ("mixing", mix), ("packing", pack)]

#: The conditional random field of the first stage is beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and reread for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = Stored(stage(spark, docs, sf_dir), name).df
    return STAGES[-1][1](spark, docs, sf_dir)
