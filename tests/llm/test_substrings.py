import hashlib
import random

import numpy as np
import pytest

from moraine.llm import substrings
from moraine.llm.suffixes import factors, smaller_neighbours


def brute(docs, size, keep):
    bodies = [(d, (t or "").encode()) for d, t in docs]
    seen = {}
    for n, (_, b) in enumerate(bodies):
        for i in range(len(b) - size + 1):
            seen.setdefault(b[i : i + size], []).append((n, i))
    out = {}
    for n, (d, b) in enumerate(bodies):
        cover = bytearray(len(b))
        for i in range(len(b) - size + 1):
            at = seen[b[i : i + size]]
            if len(at) > 1 and (keep == "none" or at[0] != (n, i)):
                cover[i : i + size] = b"\1" * size
        rest = bytes(v for v, c in zip(b, cover) if not c)
        runs = sum(1 for i, c in enumerate(cover) if c and (i == 0 or not cover[i - 1]))
        out[d] = (len(b), sum(cover), runs, hashlib.sha256(rest).hexdigest())
    return out


def test_smaller_neighbours():
    a = np.random.default_rng(2).permutation(200)
    before, after = smaller_neighbours(a)
    for i, v in enumerate(a):
        assert before[i] == next((j for j in range(i - 1, -1, -1) if a[j] < v), -1)
        assert after[i] == next((j for j in range(i + 1, 200) if a[j] < v), 200)


def test_longest_previous_factors_of_a_size():
    rng = random.Random(3)
    for _ in range(40):
        d = bytes(rng.choice(b"ab") for _ in range(150))
        d = d + d[20:90] + bytes(rng.choice(b"abc") for _ in range(30))
        size, starts = rng.choice([16, 20, 33]), None
        starts = np.array([i for i in range(len(d) - size + 1) if rng.random() < 0.8])
        earlier, later = factors(np.frombuffer(d, np.uint8), starts, size)
        places = {}
        for i in starts:
            places.setdefault(d[i : i + size], []).append(i)
        for k, i in enumerate(starts):
            own = places[d[i : i + size]]
            assert (earlier[k], later[k]) == (own[0] < i, own[-1] > i)


@pytest.mark.parametrize("size", [16, 200])
@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("most", [1, 20_000])
def test_against_brute_force(spark, hard_texts, size, keep, most, monkeypatch):
    monkeypatch.setattr(substrings, "PIECE", 700)
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(hard_texts)], "doc_id long, text string, mh string, st int").repartition(3)
    expected = brute(list(enumerate(hard_texts)), size, keep)
    got = {r[0]: tuple(r)[1:] for r in substrings.report(docs, size=size, keep=keep, most=most).collect()}
    assert got == expected


def test_query_against_brute_force(spark, small_sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{small_sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    assert {r[0]: tuple(r)[1:] for r in substrings.query(spark, small_sf).collect()} == brute(docs, 200, "none")


def test_empty_and_texts(spark, hard_docs, empty_docs):
    assert substrings.report(empty_docs).count() == 0
    out = substrings.dedup_substrings(hard_docs, keep="first")
    assert out.schema == hard_docs.schema and out.count() == hard_docs.count()
    assert out.where("doc_id = 0 and text is null").count() == 1 and out.where("doc_id = 7").first().text


def test_texts_that_agree_in_polynomial_hashes(spark):
    """Thue-Morse words and their complements have equal polynomial hashes modulo 2**64."""
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    docs = [(1, word), (2, word.translate(str.maketrans("ab", "ba"))), (3, word[:300]), (4, "x" + word[300:620])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r[0]: tuple(r)[1:] for r in substrings.report(df, size=200, keep="none").collect()} == brute(docs, 200, "none")
