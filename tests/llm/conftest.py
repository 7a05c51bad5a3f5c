import random

import pytest

CLASH = ("key", "score", "t", "did", "n", "_did", "_th", "_no", "_nos", "_near", "_s", "_spans", "_score", "_was_blank", "s", "at")
CLASH_SCHEMA = "doc_id long, text string, th int, " + ", ".join(f"`{c}` string" for c in CLASH)
CLASH_VALUES = (1, *CLASH)


@pytest.fixture(scope="session")
def small_sf():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def hard_texts():
    """Nulls, blanks, ties, repeats, very long texts, characters of several bytes."""
    rng = random.Random(7)
    base = ["".join(rng.choice(["foo ", "Ba ", "é", "zz\n", "1.2 "]) for _ in range(rng.randint(0, 120))) for _ in range(25)]
    texts = [None, "", " ", "\n\n", "word", "The " * 3000, "ab" * 700, "é" * 300, "x" * 199, "x" * 201, "🙂 a b c d e f g h i j k l", "a b c d e f g h i j k l"]
    return texts + base + [base[0], base[1], base[-1] + base[-2]]


@pytest.fixture(scope="session")
def hard_docs(spark, hard_texts):
    """With columns whose names clash with those the operators use inside."""
    rows = [(i, t, *CLASH_VALUES) for i, t in enumerate(hard_texts)] + [(i, hard_texts[i], *CLASH_VALUES) for i in (3, 20)]
    return spark.createDataFrame(rows, CLASH_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], CLASH_SCHEMA)
