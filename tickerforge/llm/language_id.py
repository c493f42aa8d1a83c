"""Language identification with a blended-spectrum string kernel.

Method. A text is the set of its character n-grams of 1 to 3 code points (lower case, white space
as one blank), hashed to 2**15 places. The kernel of two texts is the count of common places over
the root of the product of their counts. Landmarks drawn from the training sample give a Nyström
feature map; one-versus-rest kernel ridge regression is solved in it. As the kernel is a product of
normalised presence vectors, landmarks and regression fold into one matrix, by which batches of
presence rows are multiplied.

The classifier is fitted on a bounded sample: about PER_LANGUAGE documents of each language, chosen
by the MD5 of their ids; with more than IN_ALL / PER_LANGUAGE languages fewer of each, but no language
is left out. Only their packed presence bits (4 KB each) come to the driver. Every document is scored
on its whole text.

Defined results. ``und`` with score 0 if a text is null or has no letter, or if nothing could be
learned. The score is the softmax of the regressions for the language predicted. A null doc_id
counts as the text ``null`` where ids are hashed. Rows are never merged or dropped; other columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerforge.llm.common import id_text, text_bytes

PLACES_BITS = 15
PLACES = 1 << PLACES_BITS
SPECTRUM = 3
#: Documents learned from: about so many of a language, and fewer, but FEWEST, where languages are very many.
PER_LANGUAGE, FEWEST, IN_ALL = 250, 20, 16_000
#: Landmarks likewise.
LANDMARKS, FEWEST_LANDMARKS, LANDMARKS_IN_ALL = 40, 4, 2_000
RIDGE = 1e-3
SHARPNESS = 8.0
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_LETTER = re.compile(r"[^\W\d_]")
_BLANK = re.compile(r"\s+")
#: Code points hashed at once.
PIECE = 1 << 18


def presence(text: str) -> np.ndarray:
    """Which of the PLACES the n-grams of a text fall on."""
    points = np.frombuffer(_BLANK.sub(" ", text.lower()).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    found = np.zeros(PLACES, np.bool_)
    for at in range(0, len(points), PIECE):
        run = points[at : at + PIECE + SPECTRUM - 1]
        code = np.zeros(len(run), np.uint64)
        for n in range(1, min(SPECTRUM, len(run)) + 1):
            code = (code[: len(run) - n + 1] + run[n - 1 :]) * _MIX[n - 1]
            found[(code >> np.uint64(64 - PLACES_BITS)).astype(np.int64)] = True
    return found


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # PLACES x languages

    def predict(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language numbers and scores of presence rows."""
        size = np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1)).astype(np.float32)
        values = (rows.astype(np.float32) @ self.weights) / size
        e = np.exp(SHARPNESS * (values - values.max(axis=1, keepdims=True)))
        best = values.argmax(axis=1)
        return best, e[np.arange(len(best)), best] / e.sum(axis=1)


def fit_rows(rows: np.ndarray, labels: list[str]) -> Model | None:
    """Nyström map from evenly spread landmarks, then one-versus-rest ridge regression."""
    languages = sorted(set(labels))
    if not languages:
        return None
    x = rows.astype(np.float32) / np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1)).astype(np.float32)
    number = np.array([languages.index(s) for s in labels])
    each = max(FEWEST_LANDMARKS, min(LANDMARKS, LANDMARKS_IN_ALL // len(languages)))
    marks = np.concatenate([np.flatnonzero(number == k)[:each] for k in range(len(languages))])
    land = x[marks]
    values, vectors = np.linalg.eigh((land @ land.T).astype(np.float64))
    solid = values > values.max() * 1e-6
    root = vectors[:, solid] / np.sqrt(values[solid])
    phi = (x @ land.T).astype(np.float64) @ root
    goal = np.where(number[:, None] == np.arange(len(languages)), 1.0, -1.0)
    share = 1 / np.bincount(number, minlength=len(languages))[number]  # languages weigh the same
    beta = np.linalg.solve(phi.T @ (phi * share[:, None]) + RIDGE * np.eye(phi.shape[1]), phi.T @ (goal * share[:, None]))
    return Model(languages, (land.T @ (root @ beta)).astype(np.float32))


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = [np.packbits(presence(t.decode("utf-8", "replace"))).tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["lang", "bits"])


def fit(docs: DataFrame, usable: Column) -> Model | None:
    """Learns from a bounded sample of the ``usable`` documents with text and language."""
    given = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = given.groupBy("lang").count().collect()  # one row a language
    if not counts:
        return None
    each = max(FEWEST, min(PER_LANGUAGE, IN_ALL // len(counts)))
    share = F.element_at(F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], each / r["count"])]), F.col("lang"))
    draw = F.conv(F.substring(F.md5(id_text()), 1, 8), 16, 10).cast("double") / 2.0**32
    drawn = given.where(draw < share).limit(2 * each * len(counts))
    rows = drawn.select("lang", text_bytes().alias("t")).mapInArrow(_bits, "lang string, bits binary").collect()
    rows = sorted(rows, key=lambda r: (r["lang"], bytes(r["bits"])))
    if not rows:
        return None
    return fit_rows(np.unpackbits(np.frombuffer(b"".join(r["bits"] for r in rows), np.uint8).reshape(len(rows), -1), axis=1), [r["lang"] for r in rows])


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            langs, scores = ["und"] * len(texts), np.zeros(len(texts))
            for at in range(0, len(texts), 256):
                part = [t.decode("utf-8", "replace") for t in texts[at : at + 256]]
                where = [i for i, t in enumerate(part) if known is not None and _LETTER.search(t)]
                if where:
                    best, score = known.predict(np.stack([presence(part[i]) for i in where]))
                    for i, b, s in zip(where, best, score):
                        langs[at + i], scores[at + i] = known.languages[b], s
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every document. The model sent along has PLACES numbers a language."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", text_bytes().alias("t")).mapInArrow(_predict(sent), f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double")


def held_out() -> Column:
    """Documents that are never learned from."""
    return F.crc32(id_text()) % 4 == 2
