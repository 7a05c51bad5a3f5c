"""Quality classifier: hashed word and character n-gram vectors averaged per document, softmax on top, trained by SGD.

Features of a text are its words, its word 2- and 3-grams and its byte 3-, 4- and 5-grams, and for every word that returns
after one, two or three words, whichever it is, that distance. Each is hashed to one of ``buckets`` rows of a learned table
(dim floats a row). A document is the mean of its rows; a linear layer and a softmax give the class.
Training is plain numpy stochastic gradient descent on the driver over a bounded sample: the labelled rows of the training
fold with the least md5 of the id, ``sample`` of them at most (half of either class; where one has fewer, more of the other),
and of those in that order as many as have ``sample_bytes`` bytes of text together. Rows of one class are weighted to balance
the other's. An id with both labels counts as label 1; several texts of an id count each, repeated rows once.
A trained model is one number per bucket (the layer applied to the table), so scoring sums table entries over whole texts.

Null and empty texts get the score of the bias alone. With no usable labels, or of one class only, scores are 0.5
throughout or near that class. A null id is not held out. Repeated rows score alike. Columns other than the id and the text are never looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.llm.common import drop, stored, table
from moraine.llm.textbytes import flat, give_back, lean, mix, span_hash, word_spans

SAMPLE, SAMPLE_BYTES = 6000, 32 << 20
GAP = np.zeros(256, bool)
GAP[[9, 10, 11, 12, 13, 32]] = True
PIECE = 1 << 17
SHIFT = np.uint64(0x9DDFEA08EB382D69)


def grams(data: np.ndarray, offsets: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket of each feature, document of each feature) for words, word 2- and 3-grams, then byte 3-, 4- and 5-grams."""
    mask = np.uint64(buckets - 1)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    start, end, _ = word_spans(data, offsets, GAP)
    word, whose = span_hash(data, start, end), doc[start]
    yield (word & mask).astype(np.int64), whose
    run = word
    for n in (2, 3):
        if len(word) < n:
            break
        inside = whose[n - 1 :] == whose[: len(word) - n + 1]
        run = mix(run[: len(inside)] * SHIFT + word[n - 1 :])
        yield (run[inside] & mask).astype(np.int64), whose[: len(inside)][inside]
    for back in (1, 2, 3):
        if len(word) > back:
            again = (word[back:] == word[:-back]) & (whose[back:] == whose[:-back])
            code = int(mix(np.array([back], np.uint64))[0] & mask)
            yield np.full(again.sum(), code), whose[back:][again]
    wide = data.astype(np.uint64)
    h = wide[:-1] << np.uint64(8) | wide[1:] if len(wide) > 1 else wide[:0]
    for n in (3, 4, 5):
        if len(data) < n:
            return
        h = h[: len(data) - n + 1] << np.uint64(8) | wide[n - 1 :]
        keep = doc[n - 1 :] == doc[: len(data) - n + 1]
        code = mix(h[keep] * np.uint64(8) + np.uint64(n))
        yield (code & mask).astype(np.int64), doc[: len(data) - n + 1][keep]


class Model:
    """weight[bucket] is (w1 - w0) . row of the bucket; a document's logit is their mean plus bias."""

    def __init__(self, weight: np.ndarray, bias: float):
        self.weight, self.bias = weight.astype(np.float32), float(bias)

    def scores(self, texts: pa.Array) -> np.ndarray:
        data, offsets = flat(texts)
        n = len(offsets) - 1
        total, count = np.zeros(n), np.zeros(n)
        at = 0
        while at < n:  # pieces of some MB, however long the batch
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE, "right")) - 1)
            own = offsets[at : to + 1] - offsets[at]
            for code, doc in grams(data[offsets[at] : offsets[to]], own, len(self.weight)):
                total[at:to] += np.bincount(doc, self.weight[code], minlength=to - at)
                count[at:to] += np.bincount(doc, minlength=to - at)
            at = to
        logit = total / np.maximum(count, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit(texts: Iterable[str], labels: list[int], buckets: int = 1 << 18, dim: int = 8, epochs: int = 6, rate: float = 40.0, batch: int = 32, seed: int = 7) -> Model:
    """Minibatch SGD of the cross-entropy of softmax(mean(rows) W + b)."""
    y = np.array(labels, np.int64)
    if not len(y):
        return Model(np.zeros(buckets), 0.0)
    rng = np.random.default_rng(seed)
    rows = ((rng.random((buckets, dim)) - 0.5) / dim).astype(np.float32)
    layer, bias = rng.normal(0, 0.5, (dim, 2)).astype(np.float32), np.zeros(2, np.float32)
    share = np.bincount(y, minlength=2) / len(y)
    cost = np.where(share > 0, 0.5 / np.maximum(share, 1e-9), 0)
    cost = np.minimum(cost, 10).astype(np.float32)
    cells = []  # each text's distinct buckets with their share of its features
    for t in texts:
        data, off = flat(pa.array([t or ""]))
        code = np.concatenate([c for c, _ in grams(data, off, buckets)] or [np.zeros(0, np.int64)])
        n = np.bincount(code, minlength=buckets)
        code = np.flatnonzero(n)
        n = n[code]
        total, n = max(1, int(n.sum())), n.astype(np.uint16 if n.max(initial=0) < 1 << 16 else np.uint32)
        cells.append((code.astype(np.int32), n, np.float32(1 / total)))
    steps, done = epochs * -(-len(y) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            ids = order[at : at + batch]
            step = rate * (1 - done / steps)
            done += 1
            mean = np.stack([(n * part) @ rows[code] for code, n, part in (cells[i] for i in ids)])
            z = mean @ layer + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(ids)), y[ids]] -= 1
            grad = (p * cost[y[ids], None] / len(ids)).astype(np.float32)
            back = grad @ layer.T
            layer -= step / 40 * (mean.T @ grad).astype(np.float32)
            bias -= step / 40 * grad.sum(0)
            for i, change in zip(ids, step * back, strict=True):  # a text's buckets are distinct
                code, n, part = cells[i]
                rows[code] -= (n * part)[:, None] * change
    return Model(rows @ (layer[:, 1] - layer[:, 0]), bias[1] - bias[0])


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, **how) -> Model:
    """Fit on at most ``sample`` labelled rows of the training fold, of ``sample_bytes`` bytes at most; rows with null id, text or label are left out."""
    known = labels.select(F.col(doc_id).alias("did"), F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("did").isNotNull()).where(~held_out("did"))
    known = known.groupBy("did").agg(F.max("y").alias("y"))
    order = F.md5(F.col("did").cast("string").cast("binary"))
    ranked = [known.where(F.col("y") == k).orderBy(order, "did").limit(sample) for k in (0, 1)]
    chosen = F.broadcast(ranked[0].unionByName(ranked[1]))  # 2 * sample rows at most
    got = docs.select(F.col(doc_id).alias("did"), F.col(text).alias("t")).where(F.col("t").isNotNull()).join(chosen, "did")
    own = F.md5(F.concat_ws("|", order, F.xxhash64("t")).cast("binary"))
    got = stored(got.select(F.concat(order, own).alias("o"), "y", "t", F.octet_length("t").alias("size")).dropDuplicates(["o"]), "sample")
    each = [got.where(F.col("y") == k).select("o", "size").orderBy("o").limit(sample).collect() for k in (0, 1)]
    room = [max(sample // 2, sample - len(each[1 - k])) for k in (0, 1)]
    rows = sorted((r.o, r.size, k) for k in (0, 1) for r in each[k][: room[k]])
    rows = rows[: int(np.searchsorted(np.cumsum([r[1] for r in rows]), sample_bytes, "right"))]
    last = {k: o for o, _, k in rows}  # the last of each class
    take = F.coalesce(*(F.when(F.col("y") == k, F.col("o") <= o) for k, o in last.items()), F.lit(False))
    part = got.where(take).orderBy("o").select("t", "y").toArrow()
    model = fit((t.as_py() for t in part["t"]), part["y"].to_pylist(), **how)
    del part
    give_back()
    drop(got)
    return model


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """docs with one more column (an existing one of that name is replaced)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weight, model.bias))  # ``buckets`` floats
    kept = docs.drop(into)

    def run(batches):
        own = Model(*shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.scores(batch[text]))], [*batch.schema.names, into])

    return kept.mapInArrow(lean(run), T.StructType([*kept.schema.fields, T.StructField(into, T.DoubleType())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    got = score(docs, model)
    return got.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def fold(doc_id) -> int:
    """The contract's remainder, for tests."""
    return zlib.crc32(str(doc_id).encode()) % 3
