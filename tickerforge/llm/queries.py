"""The numbered operators as registered queries over the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerforge.llm import language_id, language_model, lexical, minhash, mixing, packing, sharding, simhash, spelling, substring_dedup, token_counts, topk, toxicity
from tickerforge.llm.common import new_folder, read_documents


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness."""
    return minhash.fingerprint_documents(read_documents(spark, sf_dir))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's block and slot in the mix of sources to the production weights."""
    return mixing.mix_sources(read_documents(spark, sf_dir).select("doc_id", "source")).select("doc_id", "mix_class", "mix_seq", "mix_block", "mix_slot")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left in each document once those of windows seen in a smaller doc_id are removed."""
    return substring_dedup.remove_repeats(read_documents(spark, sf_dir), with_text=False)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's length bucket, batch and padding."""
    return packing.pack(read_documents(spark, sf_dir), keep=["doc_id"])


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts through a cache that starts empty."""
    return token_counts.count_tokens(read_documents(spark, sf_dir), new_folder(spark, "token-cache"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores, learned without the held-out third of the labels."""
    docs, labels = read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score(docs, toxicity.fit(docs, labels, ~toxicity.held_out()))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), F.size("spans").alias("n_spans"), F.to_json("spans").alias("spans"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as it is read from the shards of the last committed version."""
    docs = read_documents(spark, sf_dir)
    rows = sharding.shard(docs, new_folder(spark, "shards")).read()
    return (docs.limit(0) if rows is None else rows).select("doc_id", "source", "n_chars", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted languages, learned without the held-out quarter of the documents."""
    docs = read_documents(spark, sf_dir)
    found = language_id.identify(docs, language_id.fit(docs, ~language_id.held_out()))
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate components."""
    return simhash.near_duplicates(read_documents(spark, sf_dir)).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of each query vector."""
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its near words' number, its form and its root."""
    return spelling.variants(read_documents(spark, sf_dir))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return lexical.ranked(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log-likelihood, learned without the held-out fifth of the documents."""
    return language_model.score(read_documents(spark, sf_dir), ~language_model.held_out())


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over the documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_minhash, op2_mixing, op3_substring_dedup, op4_packing, op5_token_counts, op6_toxicity, op7_sharding, op8_language_id, op9_simhash, op10_topk, op11_spelling, op12_lexical, op13_language_model, pipeline)}

ORACLES = {
    "op2_mixing": mixing.ORACLE,
    "op3_substring_dedup": substring_dedup.ORACLE,
    "op4_packing": packing.ORACLE,
    "op7_sharding": sharding.ORACLE,
    "op10_topk": topk.ORACLE,
    "op12_lexical": lexical.ORACLE,
}
