"""The recurrent language model: gradients, probabilities that add up, state over windows, the contract by brute force."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tickerforge.llm import language_model, queries, recurrent


@pytest.fixture
def small(monkeypatch):
    """A vocabulary and random parameters in double precision."""
    monkeypatch.setattr(recurrent, "HIDDEN", 3)
    v = recurrent.Vocabulary(np.array([9.0, 30, 20, 10, 5, 5, 1]), np.array([4.0, 2.5]), 3)
    rng = np.random.default_rng(2)
    return v, {k: rng.normal(0, 0.5, x.shape) for k, x in v.start().items()}


def loss(v, p, x, fresh, y):
    states = recurrent.run_states(p, x, fresh, np.zeros((x.shape[1], recurrent.HIDDEN)))
    return -recurrent.log_likelihoods(v, p, states.reshape(-1, recurrent.HIDDEN).astype(np.float64), y.ravel()).sum()


def test_gradients_are_differences(small):
    v, p = small
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, v.symbols, (2, 6, 4))
    fresh = rng.random((6, 4)) < 0.3
    kept, grads = [], {}
    states = recurrent.run_states(p, x, fresh, np.zeros((4, 3)), kept)
    recurrent.log_likelihoods(v, p, states.reshape(-1, 3).astype(np.float64), y.ravel(), grads)
    recurrent._back(p, x, fresh, kept, grads["state"].reshape(states.shape), grads)
    whole = {k: grads[k] for k in ("wc", "bc", "u", "bn")} | {k: np.zeros_like(p[k]) for k in ("x", "wo", "bo")}
    whole["x"][grads["x"][0]] = grads["x"][1]
    for low, high, dw, db in grads["wo"]:
        whole["wo"][low:high], whole["bo"][low:high] = dw, db
    for name, g in whole.items():
        for at in [tuple(rng.integers(0, n) for n in g.shape) for _ in range(25)]:
            was, step = p[name][at], 1e-3
            sides = []
            for s in (step, -step):
                p[name][at] = was + s
                sides.append(loss(v, p, x, fresh, y))
            p[name][at] = was
            assert (sides[0] - sides[1]) / (2 * step) == pytest.approx(g[at], rel=0.02, abs=3e-3)


def test_probabilities_of_all_symbols_add_up(small):
    v, p = small
    states = np.random.default_rng(1).normal(size=(5, 3))
    found = np.array([recurrent.log_likelihoods(v, p, states, np.full(5, s)) for s in range(v.symbols)])
    assert np.exp(found).sum(axis=0) == pytest.approx(np.ones(5))


def test_shares_of_rare_words_add_up(spark):
    counts = spark.createDataFrame([(f"w{k}x{k % 3}".encode(), k + 1) for k in range(60)], "word binary, c long")
    k = language_model.Counts(4, counts)
    assert (k.texts, k.tokens, k.distinct) == (4, sum(range(1, 61)) + 4, 61)
    small = language_model.WORDS
    language_model.WORDS = 20
    try:
        k = language_model.Counts(4, counts)
        by_symbol = Counter()
        for word, place in k.places.items():
            if k.symbols[place] >= k.words:
                assert k.symbols[place] == k.rare_symbol(word)
                by_symbol[int(k.symbols[place])] += 10 ** k.shares[place]
        for s, share in by_symbol.items():
            assert share + 0.5 / k.mass[s - k.words] == pytest.approx(1)  # the rest is for an unknown word
    finally:
        language_model.WORDS = small


def test_state_is_carried_through_windows_and_texts_are_apart(small, monkeypatch):
    v, p = small
    p = {k: x.astype(np.float32) for k, x in p.items()}
    rng = np.random.default_rng(8)
    texts = [np.append(rng.integers(1, v.symbols, n), 0).astype(np.uint16) for n in (0, 1, 31, 32, 33, 200, 5, 64, 90, 7)]
    want = []
    for t in texts:  # one text, one step after the other
        h, before, total = np.zeros((1, 3), np.float32), 0, 0.0
        for s in t.astype(np.int64):
            h = recurrent.run_states(p, np.array([[before]]), np.zeros((1, 1), bool), h)[0]
            total += float(recurrent.log_likelihoods(v, p, h, np.array([s]))[0])
            before = s
        want.append(total)
    for wide in (1, 3, 512):
        monkeypatch.setattr(recurrent, "WIDE", wide)
        assert recurrent.score_texts(v, p, texts) == pytest.approx(want, rel=1e-4)
    assert len(recurrent.score_texts(v, p, [])) == 0


def base(rows):
    """doc_id by row: (held_out, n_tokens, n_known, train_tokens, base_score)."""
    out = []
    def held(i):
        return zlib.crc32(("null" if i is None else str(i)).encode()) % 5 == 1
    words = [(i, (t or "").encode().lower().split()) for i, t in rows]
    c, n = Counter(w for i, ws in words if not held(i) for w in ws), sum(not held(i) for i, _ in words)
    total, distinct = sum(c.values()) + n, len(c) + (n > 0)
    for i, ws in words:
        counts = [c[w] for w in ws] + [n]
        out.append((i, held(i), len(counts), sum(x > 0 for x in counts), total, sum(math.log10((x + 0.5) / (total + 0.5 * (distinct + 1))) for x in counts)))
    return sorted(out, key=lambda r: repr(r[:4]))


def agrees(frame, rows):
    got = sorted((tuple(r) for r in frame.collect()), key=lambda r: repr(r[:4]))
    want = base(rows)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want], rel=1e-12)
    assert all(math.isfinite(r[6]) and r[6] <= 0 for r in got)
    return got


@pytest.fixture(scope="module")
def scored(spark, sf_dir):
    return queries.QUERIES["op13_language_model"](spark, sf_dir)


def test_query_follows_the_contract_and_beats_its_base(scored, docs):
    got = agrees(scored, [tuple(r) for r in docs.select("doc_id", "text").collect()])
    for part in ([r for r in got if r[1]], got):
        assert sum(r[6] for r in part) > 0.95 * sum(r[5] for r in part)  # nearer to zero


def test_words_that_tasks_do_not_know_are_joined(spark, docs, monkeypatch):
    monkeypatch.setattr(language_model, "LISTED", 40)
    monkeypatch.setattr(language_model, "WORDS", 20)
    monkeypatch.setattr(language_model, "GONE", 1)
    some = docs.where("n_chars < 3000")
    rows = [tuple(r) for r in some.select("doc_id", "text").collect()]
    agrees(language_model.score(some, ~language_model.held_out()), rows)


def test_odd_rows(spark, odd, none):
    agrees(language_model.score(odd, ~language_model.held_out()), [tuple(r) for r in odd.select("doc_id", "text").collect()])
    assert language_model.score(none, ~language_model.held_out()).count() == 0
    apart = odd.where("doc_id = 6")  # held out or not, one side is empty
    agrees(language_model.score(apart, ~language_model.held_out()), [tuple(r) for r in apart.select("doc_id", "text").collect()])
