import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from moraine.llm import quality, sentencepieces


def test_held_out_accuracy(spark, small_sf):
    rows = quality.query(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    good = [r.predicted for r in rows if r.quality == 1]
    assert np.mean(good) > 0.99
    assert all(r.held_out == (quality.fold(r.doc_id) == 1) for r in rows)


def test_training_never_sees_the_held_out_fold(spark):
    docs = spark.createDataFrame([(i, "good words here" if quality.fold(i) != 1 else "bad " * 9, 0) for i in range(90)], "doc_id long, text string, y int")
    labels = spark.createDataFrame([(i, int(quality.fold(i) != 1)) for i in range(90)], "doc_id long, quality int")
    model = quality.train(docs, labels, buckets=1 << 10, epochs=1)
    assert model.scores(pa.array(["good words here"]))[0] > 0.5


def test_scores_of_hard_rows(spark, hard_docs, empty_docs):
    model = quality.fit(["a b c d", "!! ## $$"] * 20, [1, 0] * 20, buckets=1 << 10)
    got = quality.score(hard_docs, model)
    assert got.columns[-1] == "score" and got.count() == hard_docs.count() and got.where("score is null or score < 0 or score > 1").count() == 0
    assert quality.score(empty_docs, model).count() == 0
    assert quality.fit([], []).scores(pa.array(["x", None]))[0] == 0.5
    one = quality.fit(["x y z"] * 5, [1] * 5, buckets=1 << 10).scores(pa.array(["x y z"]))
    assert one[0] >= 0.5


def test_scores_against_brute_force(hard_texts):
    """Features one by one in plain Python, with the model's own hashes of single words."""
    model = quality.fit(["a b c d", "!! ## $$"] * 20, [1, 0] * 20, buckets=1 << 10)
    shift, full = int(quality.SHIFT), (1 << 64) - 1
    mix = lambda x: int(quality.mix(np.array([x & full], np.uint64))[0])

    def logit(text):
        data = (text or "").encode()
        words = [w for w in re.split(rb"[ \t\n\x0b\f\r]+", data) if w]
        hashes = [int(quality.span_hash(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0]) for w in words]
        two = [mix(a * shift + b) for a, b in zip(hashes, hashes[1:])]
        codes = hashes + two + [mix(a * shift + b) for a, b in zip(two, hashes[2:])]
        codes += [mix(back) for back in (1, 2, 3) for i in range(back, len(words)) if words[i] == words[i - back]]
        codes += [mix(int.from_bytes(data[i : i + n], "big") * 8 + n) for n in (3, 4, 5) for i in range(len(data) - n + 1)]
        return sum(float(model.weight[c & 1023]) for c in codes) / max(1, len(codes)) + model.bias

    texts = [t for t in hard_texts if len(t or "") < 3000]
    assert np.allclose(model.scores(pa.array(texts)), [1 / (1 + np.exp(-logit(t))) for t in texts])


def test_the_sample_is_bounded_and_filled(spark, monkeypatch):
    rows = [(i, f"text {i}", int(i % 10 == 0)) for i in range(200)]
    docs = spark.createDataFrame([*rows, rows[3]], "doc_id long, text string, y int").select("doc_id", "text")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    sizes = []
    monkeypatch.setattr(quality, "fit", lambda texts, y, **how: sizes.append((len(list(texts)), sum(y))))
    fold = [y for i, _, y in rows if quality.fold(i) != 1]
    for bound in ({"sample": 40}, {"sample": 1000}, {"sample": 1000, "sample_bytes": 75}, {"sample_bytes": 0}):
        quality.train(docs, labels, **bound)
    assert sizes[0] == (40, min(20, sum(fold))) and sizes[1] == (len(fold), sum(fold)) and sizes[2][0] in (8, 9, 10) and sizes[3][0] == 0


def test_piecewise_scores_are_the_same(monkeypatch, hard_texts):
    model = quality.fit(["a b c d", "!! ## $$"] * 20, [1, 0] * 20, buckets=1 << 10)
    whole = model.scores(pa.array(hard_texts))
    monkeypatch.setattr(quality, "PIECE", 50)
    assert np.allclose(whole, model.scores(pa.array(hard_texts)))


@pytest.fixture(scope="module")
def model():
    return sentencepieces.read_model(sentencepieces.MODEL_PATH)


def test_parity_and_round_trip(spark, small_sf, model):
    got = sentencepieces.query(spark, small_sf)
    assert got.where("not parity or not round_trip").count() == 0 and got.count() == 1000


def test_hard_texts(spark, hard_docs, empty_docs, model):
    odd = spark.createDataFrame([(1, " a  b "), (2, "▁x <s> </s> 日本 🙂\x00"), (3, None), (4, "a" * 50000)], "doc_id long, text string")
    for docs in (hard_docs, odd):
        assert sentencepieces.audit(docs, model).where("not parity or not round_trip").count() == 0
    e = sentencepieces.encode(hard_docs.withColumn("ids", F.lit("clash")), model)
    back = sentencepieces.decode(e.withColumn("was", F.col("text")), model)
    assert back.where("text <> coalesce(was, '')").count() == 0
    assert sentencepieces.audit(empty_docs, model).count() == 0


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def message(*fields):
    out = b""
    for number, value in fields:
        if isinstance(value, int):
            out += varint(number << 3) + varint(value)
        elif isinstance(value, float):
            out += varint(number << 3 | 5) + np.float32(value).tobytes()
        else:
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def test_unigram_models_with_byte_fallback():
    """A hand-made unigram model: the library that reads the protobuf natively must give the same ids."""
    sentencepiece = pytest.importorskip("sentencepiece")
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abcde") for _ in range(rng.randint(1, 4))) for _ in range(60)})
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]
    pieces += [("▁", -3.0, 1)] + [(c, -6.0 - i / 10, 1) for i, c in enumerate("abcde")] + [(("▁" if i % 2 else "") + w, -2.0 - i / 37, 1) for i, w in enumerate(words) if len(w) > 1]
    data = b"".join(message((1, message((1, p.encode()), (2, float(s)), (3, k)))) for p, s, k in pieces)
    data += message((2, message((3, 1), (35, 1)))) + message((3, message((1, b"identity"), (3, 1), (4, 1), (5, 1))))
    own, other = sentencepieces.Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["".join(rng.choice("abcde  ") for _ in range(rng.randint(0, 60))) for _ in range(100)] + ["", "  a  b ", "é🙂a"]
    assert own.encode(texts) == other.encode(texts)
    assert own.decode(own.encode(texts)) == [own.normalised(t) for t in texts]


def test_user_pieces_are_refused():
    with pytest.raises(ValueError, match="user-defined"):
        sentencepieces.Codec(message((1, message((1, b"<unk>"), (2, 0.0), (3, 2)))) + message((1, message((1, b"x y"), (2, 0.0), (3, 4)))))
