"""Log-likelihoods of whole texts by a gated recurrent language model learned from the corpus.

Method. Words are counted over all training texts in Spark. The most frequent ``WORDS`` of them are symbols of
the model; all rarer words are dealt to classes by their ending, the ``ENDINGS`` that hold most tokens and
one for the rest. A gated recurrent unit predicts the next symbol through a class-factored softmax
(``recurrent``); a rarer word's probability is that of its class times its share of the class,
(c + 0.5) / (all counts + half a count for each of its words and for any unknown one), from all counts.
So the probabilities of all known words and one unknown one a class add up to one.

The model is trained on every training text by truncated backpropagation in tasks: in each of ``ROUNDS``
rounds a share of the texts, each task on what it reads, starting from the same parameters; tasks'
parameters are averaged by their numbers of tokens, in a tree of tasks. A small corpus is gone through
several times, up to ``GONE``, until ``ENOUGH`` tokens are learned from. Scoring carries the state from a text's
first token to its end, whatever its length.

Texts are written once as symbols. Words beyond the ``LISTED`` most frequent, whose counts tasks don't know, are
joined to the table of counts, once a text and word, and summed by text.

Defined results. A null or blank text is its end token alone. Repeated and null ids are scored row by row;
an id is held out by its text form, a null one by ``null``. Without any training text all counts are zero
and the model knows the end and unknown words only. Other columns are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerforge.llm import recurrent
from tickerforge.llm.common import Stored, id_text, text_bytes
from tickerforge.llm.lexical import terms_of

#: Symbols for the end and the most frequent words, runs they are cut into, and endings of rarer words.
WORDS, RUNS, ENDINGS = 2_000, 24, 48
#: Words whose counts every task knows, and their bytes at most: a bound of what is sent to tasks.
LISTED, BYTES = 60_000, 64
ROUNDS, GONE, ENOUGH = 4, 16, 4_000_000
#: Symbols that are learned from, or scored, together.
LEARNED, SCORED = 500_000, 6_000_000
#: Distinct words that a task holds before it hands their counts on.
HELD = 500_000
#: Every byte as itself, A-Z as a-z, white space as a space.
_WORD = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x20 if 0x09 <= b <= 0x0D else b for b in range(256))
#: Parameters that are averaged in one task.
FAN_IN = 32


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning."""
    return F.crc32(id_text(doc_id).cast("binary")) % 5 == 1


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text with A-Z in lower case, in lists of bounded size."""
    return terms_of(text, _WORD)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def made() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"])
        counts.clear()
        return batch

    for batch in batches:
        for raw in batch.column(0):
            for words in words_of(raw.as_py()):
                counts.update(words)
        if len(counts) > HELD:
            yield made()
    if counts:
        yield made()


def count_words(texts: DataFrame) -> Stored:
    """(word, c) of all words of the column ``t``."""
    return Stored(texts.select("t").mapInArrow(_count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")), "word-counts")


def _listed(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The most frequent words and their counts, in descending order: all of the largest counts, ``most`` at most."""
    step = F.when(F.col("c") < 1000, F.col("c")).otherwise(1000 + F.floor(200 * F.log(F.col("c") / 1000))).cast("int")
    short = counts.where(F.octet_length("word") <= BYTES).withColumn("step", step)
    least, held = None, 0
    for r in short.groupBy("step").count().orderBy(F.desc("step")).collect():  # some thousand steps at most
        held += r["count"]
        if held > most:
            break
        least = r["step"]
    found = short.where(F.col("step") >= least).select("word", "c").collect() if least is not None else []
    return sorted(((bytes(r["word"]), r["c"]) for r in found), key=lambda x: (-x[1], x[0]))


class Counts:
    """What tasks know of the counts: listed words, symbols, and the denominators of rarer words' shares."""

    def __init__(self, texts: int, counts: DataFrame) -> None:
        tokens, words = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
        self.texts, self.tokens, self.distinct = texts, tokens + texts, words + (texts > 0)
        listed = _listed(counts, LISTED)
        top = listed[: WORDS - 1]
        ends = {bytes(r["e"]): [r["c"], r["n"]] for r in counts.groupBy(F.expr("substring(word, -2, 2)").alias("e")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect()}  # two bytes: 65,793 rows at most
        for word, c in top:
            ends[word[-2:]][0] -= c
            ends[word[-2:]][1] -= 1
        chosen = sorted((e for e in ends if ends[e][1]), key=lambda e: (-ends[e][0], e))[:ENDINGS]
        self.endings = {e: k for k, e in enumerate(chosen)}
        self.mass = np.full(len(chosen) + 1, 0.5)
        for e, (c, n) in ends.items():
            self.mass[self.endings.get(e, len(chosen))] += c + 0.5 * n
        self.words = len(top) + 1
        self.vocabulary = recurrent.Vocabulary(np.array([texts, *(c for _, c in top)], np.float64), self.mass, RUNS)
        self.places = {w: k for k, (w, _) in enumerate(listed)}
        self.log_counts = np.log10(np.array([c for _, c in listed], np.float64) + 0.5)
        self.symbols = np.array([k + 1 if k < len(top) else self.rare_symbol(w) for k, (w, _) in enumerate(listed)], np.int64)
        self.shares = np.where(np.arange(len(listed)) < len(top), 0.0, self.log_counts - np.log10(self.mass[np.maximum(self.symbols - self.words, 0)])) if listed else np.zeros(0)

    def rare_symbol(self, word: bytes) -> int:
        return self.words + self.endings.get(word[-2:], len(self.endings))


_ENCODED = "held_out boolean, doc_id long, n_tokens long, n_known long, base double, extra double, symbols binary, rare array<binary>, rare_n array<int>"


def _encode(k: Counts):
    """From (held_out, doc_id, bytes): each text as symbols, what its listed words give, and its other words."""
    end = math.log10(k.texts + 0.5)
    per_token = math.log10(k.tokens + 0.5 * (k.distinct + 1))
    log_mass = np.log10(k.mass)
    names = [c.split()[0] for c in _ENCODED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, ending, other = k.places.get, k.endings.get, k.words + len(k.endings)
        symbol_of = np.append(k.symbols, 0).astype(np.uint16)
        for batch in batches:
            out: list[list] = [[] for _ in names[2:]]
            for raw in batch.column(2):
                n, known, base, extra = 1, int(k.texts > 0), end, 0.0
                others: Counter[bytes] = Counter()
                parts = []
                for words in words_of(raw.as_py()):
                    at = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
                    lost = np.flatnonzero(at < 0)
                    here = at[at >= 0]
                    symbols = symbol_of[at]
                    missed = [words[i] for i in lost.tolist()]
                    others.update(missed)
                    own = np.array([ending(w[-2:], other - k.words) for w in missed], np.int64) + k.words
                    symbols[lost] = own
                    n += len(words)
                    known += len(here)
                    base += float(k.log_counts[here].sum())
                    extra += float(k.shares[here].sum()) - float(log_mass[own - k.words].sum())
                    parts.append(symbols)
                parts.append(np.zeros(1, np.uint16))
                for column, x in zip(out, (n, known, base - n * per_token, extra, np.concatenate(parts).tobytes(), list(others), list(others.values()))):
                    column.append(x)
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(out, kinds))], names=names)

    return run


def _flat(state: list[dict[str, np.ndarray]]) -> np.ndarray:
    return np.concatenate([x.ravel() for part in state for x in part.values()])


def _shaped(flat: np.ndarray, like: list[dict[str, np.ndarray]]) -> list[dict[str, np.ndarray]]:
    out, at = [], 0
    for part in like:
        out.append({})
        for name, x in part.items():
            out[-1][name] = flat[at : at + x.size].reshape(x.shape).astype(np.float32)
            at += x.size
    return out


def _train(vocabulary: recurrent.Vocabulary, state: list[dict[str, np.ndarray]], passes: int):
    """From (symbols): one row of the parameters that a task has come to, and the tokens they come from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parameters, squares = ({n: x.copy() for n, x in part.items()} for part in state)
        learner = recurrent.Learner(vocabulary, parameters, squares)
        texts: list[np.ndarray] = []
        held = 0

        def learned() -> None:
            stream, begins = np.concatenate(texts), np.zeros(held, bool)
            begins[np.cumsum([0, *(len(t) for t in texts[:-1])])] = True
            for _ in range(passes):
                learner.learn(stream, begins)
            texts.clear()

        for batch in batches:
            for raw in batch.column(0):
                texts.append(np.frombuffer(raw.as_py(), np.uint16))
                held += len(texts[-1])
                if held >= LEARNED:
                    learned()
                    held = 0
        if held:
            learned()
        if learner.tokens:
            yield pa.RecordBatch.from_arrays([pa.array([float(learner.tokens)]), pa.array([_flat([parameters, squares]).tobytes()], pa.binary())], names=["weight", "state"])

    return run


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (weight, state): their weighted mean, one row a task."""
    total, weight = None, 0.0
    for batch in batches:
        for w, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
            x = np.frombuffer(raw.as_py(), np.float32) * np.float64(w)
            total, weight = x if total is None else total + x, weight + w
    if weight:
        yield pa.RecordBatch.from_arrays([pa.array([weight]), pa.array([(total / weight).astype(np.float32).tobytes()], pa.binary())], names=["weight", "state"])


def fit(texts: DataFrame, k: Counts) -> dict[str, np.ndarray]:
    """The model's parameters, learned from all rows (row, symbols)."""
    start = k.vocabulary.start()
    state = [start, {n: np.zeros_like(x) for n, x in start.items()}]
    passes = max(1, min(GONE, -(-ENOUGH // max(1, k.tokens))))
    for r in range(ROUNDS):
        share = texts.where(F.pmod(F.xxhash64("row"), F.lit(ROUNDS)) == r).select("symbols")
        tasks = share.rdd.getNumPartitions()
        found = share.mapInArrow(_train(k.vocabulary, state, passes), "weight double, state binary")
        while tasks > 1:
            tasks = -(-tasks // FAN_IN)
            found = found.repartition(tasks).mapInArrow(_average, "weight double, state binary")
        for row in found.collect():  # one at most
            state = _shaped(np.frombuffer(row["state"], np.float32), state)
    return state[0]


def _score(vocabulary: recurrent.Vocabulary, parameters: dict[str, np.ndarray]):
    """From (row, symbols): (row, logp), the natural logarithm of the symbols' probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[int] = []
        texts: list[np.ndarray] = []
        held = 0

        def made() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(recurrent.score_texts(vocabulary, parameters, texts))], names=["row", "logp"])
            rows.clear()
            texts.clear()
            return batch

        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows.append(i)
                texts.append(np.frombuffer(raw.as_py(), np.uint16))
                held += len(texts[-1])
                if held >= SCORED:
                    yield made()
                    held = 0
        if rows:
            yield made()

    return run


def score(docs: DataFrame, learn: Column) -> DataFrame:
    """(doc_id, learned, n_tokens, n_known, train_tokens, base_score, score) of every row; where ``learn``, it is learned from."""
    rows = docs.select((~F.coalesce(learn, F.lit(False))).alias("held_out"), F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("t"))
    training = rows.where("NOT held_out")
    counts = count_words(training)
    k = Counts(training.count(), counts.df)
    encoded = Stored(rows.mapInArrow(_encode(k), _ENCODED).withColumn("row", F.monotonically_increasing_id()), "symbols").df
    parameters = fit(encoded.where("NOT held_out"), k)
    words = encoded.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.rare_n").alias("m"))
    counted = words.join(counts.df, "word", "left")
    others = counted.groupBy(F.col("row").alias("_row")).agg(F.sum(F.col("m") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("others"), F.sum(F.when(F.col("c") > 0, F.col("m")).otherwise(0)).cast("long").alias("known"))
    told = Stored(encoded.select("row", "symbols").mapInArrow(_score(k.vocabulary, parameters), "row long, logp double"), "log-likelihoods").df
    base = encoded.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "extra").join(told.withColumnRenamed("row", "_r"), F.col("row") == F.col("_r"))
    whole = base.join(others, F.col("row") == F.col("_row"), "left")
    more = F.coalesce("others", F.lit(0.0))
    return whole.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"), F.lit(k.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"), (F.col("logp") / math.log(10) + F.col("extra") + more).alias("score"),
    )
