import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tradewind.llm.common import importable  # noqa: E402

SMALL = "/root/testdata/sf0.001"
# Columns that operators add or use inside, in other cases too.
CLASHING = ("quality", "Words", "windows", "mix", "cut", "kept", "v1", "n_words", "lm", "judged", "aliases", "odd.name")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    importable(spark)


def prose(seed, n, vocabulary=400):
    random_ = random.Random(seed)
    return " ".join("w" + "abcdefgh"[k % 8] * (1 + k % 3) + str(k) for k in random_.choices(range(vocabulary), k=n))


def lined(seed, lines, length=9):
    return "\n".join(prose(seed * 1000 + k, length) for k in range(lines))


@pytest.fixture(scope="session")
def awkward_rows():
    """Nulls in any column, empty and long texts, repeated rows, equal ids, copies and near copies."""
    base, long_ = prose(1, 120), prose(2, 30_000, 5_000)
    near = base.split()
    near[60] = "other"
    passage = lined(3, 4)
    texts = [
        (1, base), (2, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \n\t "), (7, "one two"), (8, "one  two"),
        (9, long_), (10, long_ + " end"), (11, "A\nB\nC\nD\n" * 3), (12, lined(4, 3) + "\n\n" + passage),
        (13, passage + "\n" + lined(5, 2)), (13, passage + "\n" + lined(6, 2)), (None, base), (None, passage), (None, None),
        (14, "x" * 5000), (15, "é€😀 <|endoftext|> ﬁ Σ'S " * 20), (16, "dup " * 300), (17, "#$% " * 200), (18, "ALL CAPS " * 90),
        (19, prose(7, 60)), (20, prose(8, 60) + "\r\nend\x0b\x0c"), (2**62, prose(9, 70)), (-5, prose(10, 80)),
    ]
    sources = ["a", "b", None, "a", "é", "Z"]
    return [(id_, text, ("en", None)[k % 2], sources[k % 6], None if k % 3 else len(text or "")) for k, (id_, text) in enumerate(texts)]


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    docs = spark.createDataFrame(awkward_rows, SCHEMA).repartition(3)
    for name in CLASHING:
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    return docs


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
