import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

#: Nulls in every column, blanks, repeats, ties, other white space, and columns whose names clash with inner ones.
PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
ROWS = [
    (1, PASSAGE, "en", "src0"), (2, "x " + PASSAGE.replace(" ", "\t\n") + " y", "en", None), (3, None, None, "src1"), (4, "", "en", "src1"), (5, " \t\r\n", "de", "src2"),
    (6, "Ein kurzer Text", "de", "src0"), (6, "Ein kurzer Text", "de", "src0"), (None, PASSAGE, "en", "src0"), (None, "other words " + PASSAGE, None, None), (7, PASSAGE + " " + PASSAGE, "en", "other"),
    (8, "w x y <|endoftext|> 你好 \U0001f600", "en", "src3"), (9, "a " * 3000 + "b", "en", "src0"), (10, "z" * 5000, "en", "src0"), (-3, PASSAGE.upper(), "en", "src0"),
]
FORM = "doc_id long, text string, lang string, source string, n_chars long, _id string, _order int, h string, starts int, bucket string, mix_slot string, score string"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), "x", 1, None, 2, "b", "m", "s") for i, t, lang, s in ROWS], FORM)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], FORM)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
