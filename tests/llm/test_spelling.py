"""Spelling variants against a plain search for near words."""

import re
import zlib
from collections import Counter

from tickerforge.llm import queries, spelling


def plain(rows):
    """(word, form, root, n, n_near, form_n) of (doc_id, text)."""
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[a-zÀ-ÿ]+", (t or "").encode().lower().decode()):
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    left = {}  # what is left of a word without the letter at a place
    for w in counts:
        for k in range(len(w)):
            left.setdefault(w[:k] + w[k + 1 :], []).append((w, k))
    near = {w: set() for w in counts}
    for rest, found in left.items():
        for w, k in found:
            near[w] |= {v for v, j in found if j == k and v != w}
            if rest in counts:
                near[w].add(rest)
                near[rest].add(w)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 10 * n else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items())


def found(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_query_is_plain_search(spark, sf_dir, docs):
    want = plain([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert found(queries.QUERIES["op11_spelling"](spark, sf_dir)) == want and any(r[1] for r in want)


def test_odd_rows(spark, odd, none):
    assert found(spelling.variants(odd)) == plain([tuple(r) for r in odd.select("doc_id", "text").collect()])
    assert spelling.variants(none).count() == 0


def test_every_kind_of_difference(spark):
    words = ["abcdefgh", "abcdefh", "abcdefgx", "abcdefgxh", "bacdefgh", "aabcdefgh", "Àbcdefgh", "zbcdefgh", "aaaaaaaa", "aaaaaaab", "baaaaaaa", "aaaaaaaaa", "hgfedcba", "ABCDEFGH", "éàüößçñ", "éàüößçñê", "abcdefghabcdefg", "abcdefghabcdefh"]
    rows = [(k, " ".join(w for j, w in enumerate(words) if j <= k % len(words)) + ".") for k in range(200)]
    assert found(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == plain(rows)


def test_chains_of_forms_are_followed_to_the_last(spark):
    sizes = {"abcdefghi": 2, "abcdefghij": 25, "abcdefghijk": 300, "abcdefghijkl": 4000, "abcdefghijkm": 4000, "abcdefgxijkl": 50_000}
    rows = [(0, " ".join(f"{w} " * n for w, n in sizes.items()))]
    got = {r[0]: r[1:3] for r in found(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert found(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == plain(rows)
    assert got["abcdefghi"] == ("abcdefghij", "abcdefgxijkl")


def test_long_words(spark):
    base = "acgt" * 60
    words = [base, base[:-1], base + "a", base[:100] + "x" + base[101:], base[:100] + base[101:], base[:200], base[:199], base[:198] + "zz", "a" * 300, "a" * 301, "a" * 150 + "b" + "a" * 150, base[:201], base[:200] + "y"]
    rows = [(k, " ".join(words[: k % len(words) + 1])) for k in range(60)] + [(99, "z" * 50_000), (99, "z" * 50_000), (100, "z" * 50_001), (100, "z" * 50_001)]
    got = found(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [r for r in got if r[0][0] != "z"] == plain(rows[:60])
    assert [(len(r[0]), *r[3:]) for r in got if r[0][0] == "z"] == [(50_000, 2, 1, None), (50_001, 2, 1, None)]
