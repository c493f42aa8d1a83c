"""The pipeline's mixing and packing against a plain scheduler and a plain dynamic programme."""

import hashlib
from bisect import bisect_right
from functools import cache

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickerforge.llm import mixing, packing
from tickerforge.llm.common import Stored


def digest(i):
    return hashlib.md5(("null" if i is None else str(i)).encode()).hexdigest()


def mixed(rows):
    """(doc_id, source) in the order of the mix, slot by slot: of the blocks released, the earliest deadline first."""
    queues = {}
    for i, source in sorted(rows, key=lambda r: digest(r[0])):
        queues.setdefault(source if source in mixing.WEIGHTS and source != mixing.REST else mixing.REST, []).append(i)
    total, done, slot, out = sum(mixing.WEIGHTS[c] for c in queues), dict.fromkeys(queues, 0), 0, []
    while len(out) < len(rows):
        due = [(-(-(done[c] + 1) * total // mixing.WEIGHTS[c]), c) for c in queues if done[c] * total // mixing.WEIGHTS[c] <= slot]
        c = min(due)[1]
        out += [(i, slot) for i in queues[c][done[c] * mixing.BLOCK : (done[c] + 1) * mixing.BLOCK]]
        done[c], slot = done[c] + 1, slot + 1
    return out


def least_padded(lengths, buckets):
    """The padded size of the best cut of (sorted) lengths."""
    tops = sorted(set(lengths))
    upto_top = [0, *(bisect_right(lengths, t) for t in tops)]

    @cache
    def best(upto, left):
        if upto == 0:
            return 0
        if left == 0:
            return float("inf")
        return min(best(k, left - 1) + tops[upto - 1] * (upto_top[upto] - upto_top[k]) for k in range(upto))

    return best(len(tops), buckets)


@pytest.fixture
def small(spark, docs, tmp_path):
    copies = docs.filter("n_chars < 2000").crossJoin(spark.range(20).withColumnRenamed("id", "k"))
    copies.withColumn("doc_id", F.col("doc_id") * 20 + F.col("k")).drop("k").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_batches_follow_the_mix(spark, small, monkeypatch):
    last = [s for s in corpus_pipeline.STAGES if s[0] in ("mixing", "packing")]
    monkeypatch.setattr(corpus_pipeline, "STAGES", last)
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, small).collect()}
    rows = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert set(got) == {r["doc_id"] for r in rows}
    lengths = {r["doc_id"]: len(brute.words(r["text"])) for r in rows}
    assert sum(r["boundary"] for r in got.values()) == least_padded(tuple(sorted(lengths.values())), packing.BUCKETS)
    cuts, filled = sorted({r["boundary"] for r in got.values()}), {}
    for i, slot in mixed([(r["doc_id"], r["source"]) for r in rows]):
        top = min(c for c in cuts if c >= lengths[i])
        at = filled[top] = filled.get(top, -1) + 1
        r = got[i]
        assert (r["mix_slot"], r["boundary"], r["bucket"], r["padding"], r["batch"]) == (slot, top, cuts.index(top), top - lengths[i], at // max(1, packing.BUDGET // max(top, 1)))

    monkeypatch.setattr(corpus_pipeline, "STAGES", last[1:])
    without = {r["doc_id"]: r["batch"] for r in corpus_pipeline.run(spark, small).collect()}
    assert without != {i: r["batch"] for i, r in got.items()}


def test_batches_of_odd_and_empty_tables_follow_the_mix(spark, odd, none):
    for frame in (odd, none):
        before = Stored(corpus_pipeline.mix(spark, frame, ""), "mixed").df
        out = corpus_pipeline.pack(spark, before, "").collect()
        assert len(out) == frame.count() and all(r["mix_slot"] is not None and r["batch"] >= 0 for r in out)
