import os
import random
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SMALL = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("size", T.StringType()),
                     T.StructField("kept", T.StringType()), T.StructField("k1", T.StringType()), T.StructField("bits", T.StringType())])


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(n))


def odd_rows(seed=5):
    """Nulls, empty and blank texts, a long one, ties, repeated rows, near and exact copies, shared passages."""
    rng = random.Random(seed)
    shared = [sentence(rng, 60) for _ in range(3)]
    rows = [(1, None, "en", "a", None), (2, "", None, None, 0), (3, " \t\n\x0b\n ", "en", "a", 6), (None, "x y z", "en", "b", 5),
            (None, None, None, None, None), (4, "word", "fr", "", 4), (4, "word", "fr", "", 4), (4, "other word", "fr", "", 10)]
    rows += [(5, "\n".join([sentence(rng, 400), shared[0]] + [sentence(rng, rng.randint(1, 30)) for _ in range(40)]), "en", "a", 1)]
    rows += [(6, "ab" * 400, "en", "a", 1), (7, "ab" * 300 + "c" + "ab" * 300, "en", "a", 1), (8, "#$% " * 80, "en", "b", 1)]
    lines = [sentence(rng, rng.randint(1, 25)) for _ in range(30)]
    for i in range(10, 50):
        parts = [rng.choice(lines) for _ in range(rng.randint(1, 8))]
        if rng.random() < 0.4:
            parts.insert(rng.randint(0, len(parts)), rng.choice(shared))
        if rng.random() < 0.3:
            parts.insert(rng.randint(0, len(parts)), "")
        rows.append((i, "\n".join(parts), rng.choice(["en", "de", None]), rng.choice(["a", "b", "ü", None]), 1))
    big = rows[20][1] + "\n" + sentence(rng, 300)
    rows += [(60, big, "en", "a", 1), (61, big, "en", "b", 1), (62, big.replace("a", "e", 1), "en", "a", 1), (62, big.replace("a", "e", 1), "en", "a", 1)]
    return [(*r, "clash", "clash", "clash", "clash") for r in rows]


@pytest.fixture(scope="session")
def odd(spark):
    rows = odd_rows()
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def rows():
    return odd_rows()
