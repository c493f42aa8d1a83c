"""Ranked lexical search against a plain score of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
from helpers import same_as_sql

from tickerforge.llm import lexical, queries


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").encode().lower().decode())


def plain(docs, items, k=10):
    """(item_id, rank, doc_id, score) of (doc_id, text) and (item_id, text)."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // length
            scored.append((sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if c[t]), i))
        best = sorted((x for x in scored if x[0] > 0), key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]
        out += [(item, r + 1, i, s) for r, (s, i) in enumerate(best)]
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def pairs(frame, *columns):
    return [tuple(r) for r in frame.select(*columns).collect()]


def test_query_is_a_plain_score(spark, sf_dir, docs):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert found(queries.QUERIES["op12_lexical"](spark, sf_dir)) == plain(pairs(docs, "doc_id", "text"), pairs(items, "item_id", "text"))


def test_query_is_its_sql_on_larger_tables(spark):
    same_as_sql(spark, "/root/testdata/sf0.01", queries.QUERIES["op12_lexical"], queries.ORACLES["op12_lexical"])


def test_odd_rows(spark, odd, none):
    asked = [(1, "one TWO two"), (1, "nine"), (None, "Text other"), (2, None), (3, " - "), (4, "你好 a"), (5, "nothing like it"), (6, "one " * 5000)]
    items = spark.createDataFrame([(i, t, "x") for i, t in asked], "item_id long, text string, term string")
    assert found(lexical.ranked(odd, items)) == plain(pairs(odd, "doc_id", "text"), asked)
    assert lexical.ranked(none, items).count() == lexical.ranked(odd, items.limit(0)).count() == 0


def test_queries_in_blocks_and_many_shards(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(200)]
    rows = [(rng.randrange(300), " ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(200)], k=rng.randrange(60)))) for _ in range(600)]
    asked = [(k, " ".join(rng.choices(words, k=8))) for k in range(30)]
    monkeypatch.setattr(lexical, "QUERY_BYTES", 500)
    monkeypatch.setattr(lexical, "SHARD", 300)
    docs, items = (spark.createDataFrame(x, f"{i} long, text string") for x, i in ((rows, "doc_id"), (asked, "item_id")))
    assert found(lexical.ranked(docs.repartition(3), items, k=5)) == plain(rows, asked, k=5)


def shard(rng, documents, width, ranges):
    """A shard of skewed lists, and the dense scores of (document, term)."""
    dense = np.where(rng.random((documents, width)) < 0.9 / (1 + np.arange(width)) ** 1.5, rng.integers(20, 50, (documents, width)) * (1 + np.arange(width)) ** 2, 0)
    docs, terms = np.nonzero(dense)
    return lexical.Shard(np.arange(documents), np.zeros(documents, bool), docs, terms, dense[docs, terms], width), dense


def test_shards_probe_less_than_they_hold(monkeypatch):
    monkeypatch.setattr(lexical, "RANGE", 64)
    made, dense = shard(np.random.default_rng(3), 5000, 12, 64)
    for terms in (np.arange(12), np.array([0, 5, 11]), np.array([3])):
        best = lexical.Best(10)
        made.search(terms, best)
        whole = dense[:, terms].sum(axis=1)
        want = np.lexsort((np.arange(5000), -whole))[:10]
        assert best.ids.tolist() == want.tolist() and best.scores.tolist() == whole[want].tolist()
    assert made.taken < made.held / 2


def test_terms_of_long_texts_are_those_of_the_whole(monkeypatch):
    monkeypatch.setattr(lexical, "PIECE", 16)
    text = "Ab-cd éÉ x" * 40 + "z" * 100 + " end. " + "  " * 30 + "Ω1"
    assert [t.decode() for found in lexical.terms_of(text.encode()) for t in found] == terms(text)
