"""Toxicity by a linear-chain conditional random field over words.

Method. Labels are given to documents, so words are labelled first: in a toxic training document a
word is toxic with a probability, the part of its uses (or of its prefix's) in toxic documents that
clean documents don't lead to expect. It must be more frequent among toxic documents (log-likelihood
ratio above EVIDENCE) and stand between as many different words there as would be evidence by
themselves. A two-state linear-chain CRF with word, prefix and suffix features is fitted to these
word labels by gradient ascent on the exact likelihood; words of clean documents count as clean, so a
stem that both kinds hold gets a middling marginal. Forward-backward gives each word's marginal; the
expected number of toxic words and the length they are found in become a document's score by a
logistic curve, and runs of words with a marginal above one half are the offending spans, in code
points.

The model is fitted on a bounded sample: at most TOXIC toxic and CLEAN clean labelled documents of
up to SAMPLE_CHARS code points, chosen by the MD5 of their ids. Every document is scored on its
whole text.

Defined results. A null or empty text has no words and gets the score of none. A document without
a label, or with a null one, is not learned from; of conflicting labels the higher counts. Without
toxic or without clean examples every score is 0. A null doc_id counts as the text ``null`` where
ids are hashed. Rows are never merged or dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerforge.llm.common import id_text, text_bytes, unveiled, veiled

TOXIC, CLEAN, SAMPLE_CHARS = 800, 1600, 20_000
EVIDENCE = 15.0
#: The least part of a toxic trait's uses that clean documents don't lead to expect.
BEYOND = 0.8
THRESHOLD = 0.7
FEATURES = 1 << 17
ROUNDS = 25
#: Words of a training sequence; longer texts are several.
RUN = 256
#: Words whose marginals are found together.
TOGETHER = 200_000
_WORD = re.compile(r"\w+")


def traits(word: str) -> list[str]:
    """What the field sees of a word."""
    w = word.lower()
    return ["w" + w, *["p" + w[:n] for n in (4, 5, 6) if len(w) > n], *(["s" + w[-3:]] if len(w) > 3 else [])]


def places(word: str) -> list[int]:
    return [xxhash.xxh64_intdigest(t) % FEATURES for t in traits(word)]


def passes(emission: np.ndarray, sizes: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward messages of sequences laid end to end, and the exponentials of the emissions.

    ``move`` holds the log transition scores. Runs over time with all sequences at once, longest
    first; a message is the ratio of its two states.
    """
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    lengths = sizes[order]
    alive = np.searchsorted(-lengths, -np.arange(1, (int(lengths[0]) if len(lengths) else 0) + 1), side="right")
    grow, m = np.exp(np.clip(emission, -30, 30)), np.exp(move)
    ahead, back = np.empty(len(emission)), np.empty(len(emission))
    r = np.ones(len(sizes))
    for t, n in enumerate(alive):
        at = starts[:n] + t
        r = grow[at] if t == 0 else grow[at] * (m[0, 1] + m[1, 1] * r[:n]) / (m[0, 0] + m[1, 0] * r[:n])
        r = np.clip(r, 1e-30, 1e30)
        ahead[at] = r
    b = np.ones(len(sizes))
    for t in range(len(alive) - 1, -1, -1):
        n = alive[t]
        at = starts[:n] + t
        more = alive[t + 1] if t + 1 < len(alive) else 0
        b[more:n] = 1.0
        if more:
            nxt = grow[starts[:more] + t + 1] * b[:more]
            b[:more] = np.clip((m[1, 0] + m[1, 1] * nxt) / (m[0, 0] + m[0, 1] * nxt), 1e-30, 1e30)
        back[at] = b[:n]
    return ahead, back, grow


def marginals(emission: np.ndarray, sizes: np.ndarray, move: np.ndarray) -> np.ndarray:
    """P(toxic) of each word of sequences laid end to end."""
    ahead, back, _ = passes(emission, sizes, move)
    odds = ahead * back
    return odds / (1 + odds)


@dataclass
class Model:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES, np.float32))
    bias: float = -5.0
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    curve: np.ndarray | None = None  # of the features of known(), None if there was nothing to learn from

    def score(self, expected: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Scores of texts with so many expected toxic words among so many words."""
        if self.curve is None:
            return np.zeros(len(expected))
        return 1 / (1 + np.exp(-np.clip(features(expected, sizes) @ self.curve, -50, 50)))


def features(expected: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What a score depends on: the expected toxic words, and the length in which they are found."""
    return np.stack([np.log(expected + 0.05), np.log(sizes + 20.0), np.ones(len(expected))], axis=1)


class Emissions(dict):
    """Word to emission score, worked out when first met and forgotten when many."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) > 300_000:
            self.clear()
        value = self.model.bias + float(self.model.weights[places(word)].sum())
        if len(word) <= 64:
            self[word] = value
        return value


def expected_toxic(p: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The expected number of toxic words of each sequence; marginals of a tenth or less count as none."""
    sums = np.concatenate(([0.0], np.cumsum(np.where(p > 0.1, p, 0.0))))
    ends = np.cumsum(sizes)
    return sums[ends] - sums[ends - sizes]


def _evidence(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    """The log-likelihood ratio that documents with a trait are toxic more often than others; 0 if they are not."""
    n, share = toxic + clean, all_toxic / (all_toxic + all_clean)
    if toxic <= n * share:
        return 0.0
    g = toxic * np.log(toxic / (n * share))
    if clean:
        g += clean * np.log(clean / (n * (1 - share)))
    return float(2 * g)


def fit_texts(texts: list[str], toxic: list[int]) -> Model:
    """The model of labelled texts.

    The logistic curve is fitted on every third text of a label, by a field that hasn't seen them; the field
    that is kept has seen all.
    """
    turn, held = Counter(), []
    for y in toxic:
        turn[y] += 1
        held.append(turn[y] % 3 == 0)
    if not turn[0] or not turn[1]:
        return Model()
    model = fit_field(texts, toxic)
    if turn[0] < 3 or turn[1] < 3:
        fit_curve(model, model, texts, toxic)
    else:
        part = fit_field([t for t, h in zip(texts, held) if not h], [y for y, h in zip(toxic, held) if not h])
        fit_curve(model, part, [t for t, h in zip(texts, held) if h], [y for y, h in zip(toxic, held) if h])
    return model


def toxic_traits(known: dict[str, int], number: np.ndarray, lengths: np.ndarray, toxic: list[int]) -> dict[str, float]:
    """The traits with evidence, and which part of their uses in toxic texts is beyond what clean texts lead to expect.

    ``number`` holds the words of all texts by their numbers in ``known``. Evidence counts documents, so that
    one long text can't give it; the part counts uses, so that a stem that clean texts now and then hold as
    well keeps its weight however few texts are of its kind.
    """
    names: dict[str, int] = {}
    table = np.full((len(known), 4), -1, np.int32)
    for row, w in zip(table, known):
        own = [names.setdefault(t, len(names)) for t in traits(w) if t[0] != "s"]
        row[: len(own)] = own
    y, ends = np.array(toxic), np.cumsum(lengths)
    seen, used = np.zeros((2, len(names)), np.int64), np.zeros((2, len(names)), np.int64)
    for k, end, n in zip(toxic, ends, lengths):
        rows = table[number[end - n : end]].ravel()
        which, times = np.unique(rows[rows >= 0], return_counts=True)
        seen[k, which] += 1
        used[k, which] += times
    count, label = np.bincount(y, minlength=2), list(names)
    marked = {int(t) for t in np.flatnonzero(seen[1] >= 5) if _evidence(seen[1, t], seen[0, t], count[1], count[0]) > EVIDENCE}
    # A rare word of a much copied document always stands between the same two words: no evidence.
    # So many places rule that out; then all documents count, toxic and clean.
    enough = next((n for n in range(1, count[1] + 1) if _evidence(n, 0, count[1], count[0]) > EVIDENCE), count[1] + 1)
    around: dict[int, set] = {t: set() for t in marked}
    told = np.isin(table, list(marked)).any(axis=1)
    for k, end, n in zip(toxic, ends, lengths):
        for at in np.flatnonzero(told[number[end - n : end]]) + end - n if k else ():
            place = (number[at - 1] if at > end - n else -1, number[at + 1] if at + 1 < end else -1)
            for t in table[number[at]].tolist():
                if t in around and len(around[t]) < enough:
                    around[t].add(place)
    uses = [1 + int(lengths[y == k].sum()) for k in (0, 1)]
    beyond = {t: 1 - (used[0, t] / uses[0]) / (used[1, t] / uses[1]) for t, s in around.items() if len(s) >= enough}
    return {label[t]: float(b) for t, b in beyond.items() if b >= BEYOND}


def fit_field(texts: list[str], toxic: list[int]) -> Model:
    """A model without its logistic curve."""
    known: dict[str, int] = {}
    numbers = [np.array([known.setdefault(w, len(known)) for w in _WORD.findall(t)], np.int32) for t in texts]
    if not known:
        return Model()
    number, lengths = np.concatenate(numbers), np.array([len(n) for n in numbers])
    del numbers
    marked = toxic_traits(known, number, lengths, toxic)
    bad = np.array([max((marked.get(t, 0.0) for t in traits(w)), default=0.0) for w in known])
    table = np.full((len(known), 5), FEATURES, np.int32)
    for row, w in zip(table, known):
        own = places(w)
        row[: len(own)] = own
    y = np.where(np.repeat(np.array(toxic) == 1, lengths), bad[number], 0.0)
    sizes = np.array([min(RUN, n - at) for n in lengths for at in range(0, n, RUN)])
    words, width = len(known), table.shape[1]
    del known

    # Adam on the exact conditional likelihood, with a small L2 penalty.
    theta = np.zeros(FEATURES + 1 + 1 + 4)
    theta[FEATURES + 1] = -4.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    inner = np.ones(len(number), bool)
    inner[(np.cumsum(sizes) - sizes)[sizes > 0]] = False
    now = np.flatnonzero(inner)
    for step in range(1, ROUNDS + 1):
        w, bias, move = theta[: FEATURES + 1], theta[FEATURES + 1], theta[FEATURES + 2 :].reshape(2, 2)
        by_word = bias + w[table].sum(axis=1)
        ahead, back, grow = passes(by_word[number], sizes, move)
        odds = ahead * back
        gap = np.bincount(number, weights=y - odds / (1 + odds), minlength=words)
        slope = np.zeros_like(theta)
        slope[: FEATURES + 1] = np.bincount(table.ravel(), weights=np.repeat(gap, width), minlength=FEATURES + 1)
        slope[FEATURES] = 0
        slope[FEATURES + 1] = gap.sum()
        m = np.exp(move)
        for at in range(0, len(now), TOGETHER):
            k = now[at : at + TOGETHER]
            before, after, one, two = ahead[k - 1], grow[k] * back[k], y[k - 1], y[k]
            pair = np.stack([np.full(len(k), m[0, 0]), m[0, 1] * after, m[1, 0] * before, m[1, 1] * before * after])
            told = np.array([(1 - one) @ (1 - two), (1 - one) @ two, one @ (1 - two), one @ two])
            slope[FEATURES + 2 :] += told - (pair / pair.sum(axis=0)).sum(axis=1)
        slope -= 0.05 * theta
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        theta += 0.3 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        theta[FEATURES] = 0
    return Model(theta[:FEATURES].astype(np.float32), float(theta[FEATURES + 1]), theta[FEATURES + 2 :].reshape(2, 2).copy())


def expected_of(texts: list[str], emission: Emissions) -> tuple[np.ndarray, np.ndarray]:
    """The expected number of toxic words of each text, and its number of words."""
    words = [_WORD.findall(t) for t in texts]
    sizes = np.array([len(ws) for ws in words])
    values = np.fromiter((emission[w] for ws in words for w in ws), np.float64)
    return expected_toxic(marginals(values, sizes, emission.model.move), sizes), sizes


def fit_curve(model: Model, field_of: Model, texts: list[str], toxic: list[int]) -> None:
    """The model's penalised logistic curve, from the texts as another model's field sees them."""
    x = features(*expected_of(texts, Emissions(field_of)))
    goal, share = np.array(toxic, float), np.full(len(toxic), 1 / len(toxic))
    curve, penalty = np.array([1.0, 0.0, 0.0]), np.diag([1e-3, 1e-3, 1e-9])
    for _ in range(200):  # Newton's method
        q = 1 / (1 + np.exp(-np.clip(x @ curve, -50, 50)))
        d = np.linalg.solve((x * (share * q * (1 - q))[:, None]).T @ x + penalty, x.T @ (share * (q - goal)) + penalty @ curve)
        d *= min(1.0, 1.0 / max(1e-12, np.abs(d).max()))
        curve = curve - d
        if np.abs(d).max() < 1e-9:
            break
    model.curve = curve


def fit(docs: DataFrame, labels: DataFrame, usable: Column) -> Model:
    """Learns from a bounded sample of the ``usable`` labelled documents."""
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("_y"))
    # The ids are drawn first, so that texts of the drawn documents alone come to the driver.
    ids = docs.select("doc_id", F.length("text").alias("_n")).where(usable & (F.col("_n") <= SAMPLE_CHARS)).join(marks.select(F.col("doc_id").alias("_of"), "_y"), F.col("doc_id") == F.col("_of"))
    order = [F.md5(id_text()), F.col("doc_id")]
    drawn = ids.where("_y = 1").orderBy(*order).limit(TOXIC).unionByName(ids.where("_y = 0").orderBy(*order).limit(CLEAN))
    chosen = [r["doc_id"] for r in drawn.select("doc_id").collect()]
    if not chosen:
        return Model()
    rows = docs.select("doc_id", "text").where(F.col("doc_id").isin(chosen) & F.col("text").isNotNull())
    known = {r["doc_id"]: r["_y"] for r in marks.where(F.col("doc_id").isin(chosen)).collect()}
    got = sorted(((r["doc_id"], r["text"]) for r in rows.collect()), key=lambda r: (r[0], r[1]))
    return fit_texts([t for _, t in got], [known[i] for i, _ in got])


def spans_of(text: str, hit: np.ndarray) -> list[list[int]]:
    """[start, end) of each run of offending words, in code points."""
    out: list[list[int]] = []
    last = -2
    for i, found in enumerate(_WORD.finditer(text)):
        if hit[i]:
            if last == i - 1:
                out[-1][1] = found.end()
            else:
                out.append([found.start(), found.end()])
            last = i
    return out


_FORM = pa.schema([("score", pa.float64()), ("spans", pa.list_(pa.list_(pa.int32())))])


def _score(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        emission = Emissions(model)
        for batch in batches:
            at, texts, names = 0, batch.column(batch.num_columns - 1).to_pylist(), batch.schema.names[:-1]
            while at < len(texts):
                group, sizes, values = [], [], []
                while at + len(group) < len(texts) and sum(sizes) < TOGETHER:
                    text = texts[at + len(group)].decode("utf-8", "replace")
                    words = _WORD.findall(text)
                    group.append(text)
                    sizes.append(len(words))
                    values.append(np.fromiter(map(emission.__getitem__, words), np.float64, len(words)))
                p = marginals(np.concatenate(values), np.array(sizes), model.move)
                scores = model.score(expected_toxic(p, np.array(sizes)), np.array(sizes))
                hit, start, spans = p > 0.5, 0, []
                for text, n in zip(group, sizes):
                    own = hit[start : start + n]
                    spans.append(spans_of(text, own) if own.any() else [])
                    start += n
                kept = [batch.column(i).slice(at, len(group)) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(scores), pa.array(spans, _FORM.field("spans").type)], names=[*names, "score", "spans"])
                at += len(group)

    return run


def _scored(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """The columns as c0, c1, ..., with score and spans. The model sent along has FEATURES weights."""
    sent, types = docs.sparkSession.sparkContext.broadcast(model), dict(docs.dtypes)
    form = ", ".join(f"c{i} {types[c]}" for i, c in enumerate(columns))
    return docs.select(*veiled(columns), text_bytes().alias("t")).mapInArrow(_score(sent), f"{form}, score double, spans array<array<int>>")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and spans of every document."""
    return _scored(docs, model, ["doc_id"]).select(*unveiled(["doc_id"]), "score", "spans")


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` less the documents that score the threshold or more."""
    return _scored(docs, model, docs.columns).where(F.col("score") < threshold).select(*unveiled(docs.columns))


def held_out() -> Column:
    """Documents whose labels are never learned from."""
    return F.crc32(id_text()) % 3 == 1
