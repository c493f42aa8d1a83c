"""The corpus pipeline, stage by stage against brute force."""

import brute
from pyspark.sql import functions as F
from test_mixed_batches import mixed

import corpus_pipeline
from tickerforge.llm import toxicity
from tickerforge.llm.common import Stored


def test_pipeline(spark, sf_dir, docs):
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        after = Stored(stage(spark, before, sf_dir), "test").df
        rows = {r["doc_id"]: r["text"] for r in before.collect()}
        kept = {r["doc_id"]: r["text"] for r in after.collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns
        if name == "toxicity":
            model = toxicity.fit(before, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.lit(True))
            scores = {r["doc_id"]: r["score"] for r in toxicity.score(before, model).collect()}
            assert kept == {i: t for i, t in rows.items() if scores[i] < toxicity.THRESHOLD}
        elif name == "simhash_near_dedup":
            marks = [(i, brute.fingerprint(t)) for i, t in rows.items()]
            assert set(kept) == set(brute.components(marks))
        elif name == "substring_dedup":
            want = {r[0]: r for r in brute.substring_dedup(rows.items())}
            assert set(kept) == set(rows)
            for i, t in kept.items():
                assert len(brute.words(t)) == want[i][1] - want[i][2] and (want[i][2] or t == rows[i])
        elif name == "mixing":
            assert kept == rows
            order = [r["doc_id"] for r in stage(spark, before, sf_dir).collect()]
            assert order == [i for i, _ in mixed([(r["doc_id"], r["source"]) for r in before.collect()])]
        elif name == "packing":
            assert kept == rows  # its batches: test_mixed_batches
        before = after
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).select("doc_id", "text").collect())) == sorted((r["doc_id"], r["text"]) for r in before.collect())


def test_the_toxicity_stage_rejects_what_is_labelled_and_keeps_the_rest(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet").where("toxic IS NOT NULL")
    kept = corpus_pipeline.drop_toxic(spark, docs, sf)
    assert kept.columns == docs.columns
    left = labels.join(docs.select("doc_id"), "doc_id").join(kept.select("doc_id", F.lit(True).alias("kept")), "doc_id", "left").collect()
    toxic, clean = [r["kept"] for r in left if r["toxic"]], [r["kept"] for r in left if not r["toxic"]]
    assert sum(bool(k) for k in toxic) <= 0.1 * len(toxic) and sum(not k for k in clean) <= 0.02 * len(clean)


def test_stages_take_odd_and_empty_tables(spark, sf_dir, odd, none):
    for name, stage in corpus_pipeline.STAGES:
        for frame in (odd, none):
            out = Stored(stage(spark, frame, sf_dir), "test").df
            assert out.count() <= frame.count()
            if name != "packing":
                assert out.columns == frame.columns
