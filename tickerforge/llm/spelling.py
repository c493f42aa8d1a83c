"""Spelling variants by anagram hashing (Reynaert, 2010).

Method. Every letter has a value, and a word's anagram key is the sum of its letters' values to the
fifth power: an integer that no order of the letters changes. A word that differs by one letter has a
key that differs by that letter's power (an addition or a removal) or by the difference of two powers
(an exchange). Instead of listing all alphabet x length such values, every word puts up its key and its
key less the power of each of its letters: keys differ by an addition or removal if the whole key of one is
a reduced key of the other, and by an exchange if they meet in a reduced key. The join is on these
numbers. Letter order is verified in the same shuffle: words that meet are near if what is left of
them is the same string, at the same place for an exchange. Of the words that meet so, each is told
how many there are and which is the most frequent, from the first two in their order, so pairs are
never listed; an anagram class of any size is split by what is left of its words. Words longer than ``SHORT``
put up hashes of what is left instead of the strings, so that their cost is linear in their length; those
that meet are compared letter by letter.

Words are counted over all texts in tasks and summed by word. Forms are followed to the last by
pointer doubling; every form is ten times as frequent as its word, so chains are short.

Defined results. A null text has no words; a null doc_id is written ``null`` where runs are damaged.
Repeated rows count each. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerforge.llm.common import Stored, id_text, text_bytes
from tickerforge.llm.textkit import mix

#: Code points of a word at least, its occurrences at least, and how much more frequent a form is.
LEAST, OFTEN, TIMES = 7, 2, 10
#: One run in so many loses a code point.
DAMAGED = 31
#: The exponent of a letter's value in the anagram key.
POWER = 5
#: Bases of the two hashes of what is left of a long word.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Distinct words that a task holds before it hands their counts on.
HELD = 300_000
#: Words up to this length put up strings.
SHORT = 200
#: Texts longer than this are cut up match by match.
LONG = 1 << 22
_RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST},}}")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (id as text, bytes): (word, n), a word several times at most as often as the task's memory is handed on."""
    counts: Counter[str] = Counter()

    def made() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        counts.clear()
        return batch

    for batch in batches:
        for i, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
            start, low = zlib.crc32(f"{i}:".encode()), raw.as_py().lower().decode("utf-8", "replace")
            runs = Counter(_RUN.findall(low) if len(low) <= LONG else (m.group() for m in _RUN.finditer(low)))
            for run, n in runs.items():
                h = zlib.crc32(run.encode(), start)
                if h % DAMAGED == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < LEAST:
                        continue
                counts[run] += n
            if len(counts) > HELD:
                yield made()
    if counts:
        yield made()


def words_of(docs: DataFrame) -> DataFrame:
    """(word, n) of every word of the texts."""
    runs = docs.select(id_text().alias("i"), text_bytes().alias("t")).mapInArrow(_count, "word string, n long")
    return runs.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= OFTEN)


def letter_power(letter: Column) -> Column:
    """A letter's value to the fifth: a to z are 1 to 26, the others go on from there."""
    code = F.ascii(letter)
    value = F.when(code < 0x7B, code - 0x60).otherwise(code - 0xC0 + 27).cast("long")
    return value * value * value * value * value


def anagram_key(letters: Column) -> Column:
    """The sum of the powers of an array of letters."""
    return F.aggregate(letters, F.lit(0).cast("long"), lambda total, c: total + letter_power(c))


def _met(words: DataFrame) -> DataFrame:
    """(key, rest, place, fresh, word, n): each word whole (place -1), and less each of its letters.

    ``fresh`` marks the first of the places that leave the same string.
    """
    spelt = words.withColumn("letters", F.split("word", "")).withColumn("key", anagram_key(F.col("letters")))

    def less(letter: Column, at: Column) -> Column:
        left = F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2))
        first = (at == 0) | (F.element_at("letters", F.greatest(at, F.lit(1))) != letter)
        return F.struct((F.col("key") - letter_power(letter)).alias("key"), left.alias("rest"), at.alias("place"), first.alias("fresh"))

    whole = F.array(F.struct("key", F.col("word").alias("rest"), F.lit(-1).alias("place"), F.lit(False).alias("fresh")))
    return spelt.select("word", "n", F.explode(F.concat(whole, F.transform("letters", less))).alias("x")).select("x.*", "word", "n")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (id, word): (id, key, h0, h1, place, fresh), the places of ``_met`` with two hashes of what is left, for one long word after the other."""
    for batch in batches:
        for i, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
            powers = np.where(codes < 0x7B, codes - 0x60, codes - 0xC0 + 27) ** POWER
            columns = [powers.sum() - np.concatenate(([0], powers))]
            for base in BASES:
                up, back = np.full(len(codes), base, np.uint64), np.uint64(pow(base, -1, 2**64))
                up[0] = 1
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes.astype(np.uint64) * np.multiply.accumulate(up))))
                left = sums[:-1] + (sums[-1] - sums[1:]) * back
                columns.append(mix(np.concatenate((sums[-1:], left))).view(np.int64))
            places = np.arange(-1, len(codes), dtype=np.int32)
            fresh = np.concatenate(([False, True], codes[1:] != codes[:-1]))
            yield pa.RecordBatch.from_arrays([pa.array([i] * len(places), pa.string()), *(pa.array(c) for c in columns), pa.array(places), pa.array(fresh)], names=["id", "key", "h0", "h1", "place", "fresh"])


def _near_long(words: DataFrame) -> DataFrame:
    """(word, near, best) for each pair of near words of which one is longer than ``SHORT``, both ways."""
    long = words.withColumn("len", F.length("word")).where(F.col("len") >= SHORT).withColumn("id", F.sha2("word", 256))
    met = long.select("id", "word").mapInArrow(_hashed, "id string, key long, h0 long, h1 long, place int, fresh boolean")
    other = met.select(*[F.col(c).alias(f"o_{c}") for c in met.columns])
    same = (F.col("key") == F.col("o_key")) & (F.col("h0") == F.col("o_h0")) & (F.col("h1") == F.col("o_h1"))
    added = met.where("place < 0").join(other.where("o_fresh"), same)
    exchanged = met.where("place >= 0").join(other, same & (F.col("place") == F.col("o_place")) & (F.col("id") < F.col("o_id")))
    pairs = added.unionByName(exchanged).select(F.col("id").alias("a"), F.col("o_id").alias("b"), F.col("o_place").alias("at"), (F.col("place") < 0).alias("adds")).distinct()
    one, two = (long.select(F.col("id").alias(f"{x}_id"), F.col("word").alias(f"{x}_word"), F.col("n").alias(f"{x}_n"), F.col("len").alias(f"{x}_len")) for x in "ab")
    full = pairs.join(one, F.col("a") == F.col("a_id")).join(two, F.col("b") == F.col("b_id")).where(F.greatest("a_len", "b_len") > SHORT)
    rest = F.concat(F.substr("b_word", F.lit(1), F.col("at")), F.substr("b_word", F.col("at") + 2))
    proven = full.where(F.when(F.col("adds"), F.col("a_word") == rest).otherwise(F.concat(F.substr("a_word", F.lit(1), F.col("at")), F.substr("a_word", F.col("at") + 2)) == rest))
    ways = [proven.select(F.col(f"{x}_word").alias("word"), F.lit(1).cast("long").alias("near"), F.struct((-F.col(f"{y}_n")).alias("n"), F.col(f"{y}_word").alias("word")).alias("best")) for x, y in ("ab", "ba")]
    return ways[0].unionByName(ways[1])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best) of the words that have near ones; best is the struct (-n, word) of the most frequent."""
    met = _met(words.where(F.length("word") <= SHORT))
    class_, spot = Window.partitionBy("key", "rest"), Window.partitionBy("key", "rest", "place")
    ranked = spot.orderBy(F.desc("n"), "word")
    whole, longer = F.col("place") < 0, F.col("fresh")
    as_best = F.struct((-F.col("n")).alias("n"), F.col("word").alias("word"))
    all_of = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = met.select(
        "word", whole.alias("whole"), "fresh",
        F.count_if(longer).over(class_).alias("longer"), F.min(F.when(longer, as_best)).over(class_).alias("best_longer"), F.min(F.when(whole, as_best)).over(class_).alias("shorter"),
        F.count(F.lit(1)).over(spot).alias("same"), F.row_number().over(ranked).alias("rank"), F.first(as_best).over(all_of).alias("first"), F.nth_value(as_best, 2).over(all_of).alias("second"),
    )
    shorter = F.when(F.col("fresh"), F.col("shorter"))
    told = seen.select(
        "word",
        F.when(F.col("whole"), F.col("longer")).otherwise(F.col("same") - 1 + F.when(shorter.isNotNull(), 1).otherwise(0)).alias("near"),
        F.when(F.col("whole"), F.col("best_longer")).otherwise(F.least(F.when(F.col("rank") == 1, F.col("second")).otherwise(F.col("first")), shorter)).alias("best"),
    )
    return told.where("near > 0").unionByName(_near_long(words)).groupBy("word").agg(F.sum("near").cast("long").alias("n_near"), F.min("best").alias("best"))


def _roots(forms: DataFrame, most: int) -> Stored:
    """(word, root) of the words that have a form; ``most`` is the largest number of occurrences of any."""
    now = Stored(forms.select("word", F.col("form").alias("root")), "roots")
    steps = max(0, math.floor(math.log(max(1, most) / OFTEN, TIMES)) + 1)  # forms in a chain at most
    for _ in range(math.ceil(math.log2(max(1, steps)))):
        on = now.df.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        after = Stored(now.df.join(on, F.col("root") == F.col("_w"), "left").select("word", F.coalesce("_r", "root").alias("root")), "roots")
        now.drop()
        now = after
    return now


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts."""
    words = Stored(words_of(docs), "words")
    near = near_words(words.df).select(F.col("word").alias("_w"), "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best"))
    known = words.df.join(near, F.col("word") == F.col("_w"), "left")
    is_form = F.col("best_n") >= TIMES * F.col("n")
    told = Stored(known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "forms")
    most = told.df.agg(F.max("n")).first()[0]
    roots = _roots(told.df.where("form IS NOT NULL"), most or 0)
    words.drop()
    on = roots.df.select(F.col("word").alias("_w"), "root")
    return told.df.join(on, F.col("word") == F.col("_w"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
