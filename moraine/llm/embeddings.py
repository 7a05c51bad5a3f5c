"""Embedding near-duplicates by product quantisation: inverted lists, residual codes, table-lookup distances, exact rerank.

Equal vectors of a label are first reduced to one row with their number. A coarse codebook (``lists`` centroids) and
``parts`` x 256 residual codewords are fitted on the driver over a bounded sample; every row is then indexed: its list, the
codes of its residual, and the error e of its reconstruction.

Nothing is lost between index and result. With r the distance of unit vectors at the threshold, y in c's cell can be within
r of x only if (|x-c|^2 - |x-cx|^2) / (2 |c-cx|) <= r, cx being x's centroid: exactly the lists that meet this are probed.
There a table-lookup distance above r + e(y) proves that y is too far; every other pair has its cosine computed in double
precision. Recall is therefore 1 up to rounding, and tests measure it against brute force.

Work is split by (label, list) and both sides into blocks of bounded rows, so a hot label or list becomes many tasks. A task
gives counts for its queries and a spanning forest of its links, never all pairs.

Vectors that are null, zero or hold null or non-finite components, and rows with a null label or id, link with nothing.
Vectors of different lengths never link. Repeated rows count as other vectors linked directly. An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.llm.textbytes import lean
from moraine.llm.common import components, small, stored, table

SAMPLE, PARTS, WORDS = 20_000, 8, 256
MEMBERS, QUERIES = 2048, 4096


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Centroids of x; with fewer distinct points than k, of those."""
    x = x.astype(np.float32)
    rng = np.random.default_rng(seed)
    own = np.unique(x, axis=0)
    if len(own) <= k:
        return own
    c = own[rng.choice(len(own), k, replace=False)]
    for _ in range(rounds):
        near = nearest(x, c)
        n = np.bincount(near, minlength=k)
        total = np.stack([np.bincount(near, x[:, j], minlength=k) for j in range(x.shape[1])], 1)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c).astype(np.float32)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    half = (c**2).sum(1) / 2
    return np.concatenate([np.argmax(x[i : i + 4096] @ c.T - half, 1) for i in range(0, len(x), 4096)] or [np.zeros(0, np.int64)])


class Index:
    """The fitted quantisers; ``of`` places unit vectors in them."""

    def __init__(self, sample: np.ndarray, lists: int, threshold: float):
        self.dim = sample.shape[1]
        self.radius = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
        self.coarse = kmeans(sample, lists).astype(np.float64)
        rest = sample - self.coarse[nearest(sample, self.coarse)]
        self.cuts = np.linspace(0, self.dim, min(PARTS, self.dim) + 1).astype(int)
        self.books = [kmeans(rest[:, a:b], WORDS).astype(np.float64) for a, b in zip(self.cuts, self.cuts[1:], strict=False)]
        gap = self.coarse[:, None] - self.coarse[None]
        self.apart = np.sqrt((gap**2).sum(2))

    def of(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        """(list, lists to probe, codes, error) of each row of x."""
        d2 = np.maximum(0, 1 + (self.coarse**2).sum(1) - 2 * x @ self.coarse.T)
        own = np.argmin(d2, 1)
        slack = d2 - d2[np.arange(len(x)), own][:, None]
        probes = [np.flatnonzero(row) for row in slack <= 2 * self.radius * self.apart[own] + 1e-9]
        rest = x - self.coarse[own]
        codes = np.stack([nearest(rest[:, a:b], book) for (a, b), book in zip(zip(self.cuts, self.cuts[1:], strict=False), self.books, strict=True)], 1).astype(np.uint8)
        back = np.concatenate([book[codes[:, i]] for i, book in enumerate(self.books)], 1)
        return own, probes, codes, np.sqrt(((rest - back) ** 2).sum(1))

    def far(self, x: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Distances of queries x to members of list ``at`` as their codes say, by lookup tables."""
        rest = x - self.coarse[at]
        total = np.zeros((len(x), len(codes)))
        for i, (a, b) in enumerate(zip(self.cuts, self.cuts[1:], strict=False)):
            part = rest[:, a:b]
            tab = (part**2).sum(1)[:, None] + (self.books[i] ** 2).sum(1) - 2 * part @ self.books[i].T
            total += tab[:, codes[:, i]]
        return np.sqrt(np.maximum(total, 0))


def forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest id reachable over links a-b, for np.unique(concat(a, b))."""
    ids, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return np.stack([ids, ids[root]], 1)
        root = new


def compare(index: Index, at: int, q: dict, m: dict, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(copies linked to each query, forest of links) between blocks of queries and members."""
    links, found = np.zeros(len(q["cid"]), np.int64), [np.zeros((0, 2), np.int64)]
    for s in range(0, len(q["cid"]), 256):
        x = q["x"][s : s + 256]
        near = index.far(x, at, m["codes"]) <= index.radius + m["err"] if at >= 0 else np.ones((len(x), len(m["cid"])), bool)
        i, j = np.nonzero(near)
        for t in range(0, len(i), 100_000):
            ii, jj = i[t : t + 100_000], j[t : t + 100_000]
            ok = (np.einsum("ij,ij->i", x[ii], m["x"][jj]) >= threshold) & (q["key"][s + ii] != m["key"][jj])
            ii, jj = ii[ok], jj[ok]
            links[s : s + 256] += np.bincount(ii, m["copies"][jj], minlength=len(x)).astype(np.int64)
            if len(ii):
                found.append(forest(q["cid"][s + ii], m["cid"][jj]))
    all_ = np.concatenate(found)
    return links, forest(all_[:, 0], all_[:, 1]) if len(all_) else all_


def classes(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> tuple[DataFrame, DataFrame]:
    """(rows, reps): rows (vec_id, key, label) with a null key where a vector links with nothing; reps are distinct vectors."""
    e = F.col("e")
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & e.isNotNull() & (F.size(e) > 0)
    sound &= F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < math.inf)) & F.exists(e, lambda v: v != 0)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("e"))
    rows = rows.select("vec_id", "label", "e", F.coalesce(sound, F.lit(False)).alias("sound"))
    rows = rows.withColumn("key", F.when(F.col("sound"), F.xxhash64("label", "e"))).withColumn("key2", F.when(F.col("sound"), F.xxhash64(F.lit(1), "label", "e")))
    reps = rows.where("sound").groupBy("label", "key", "key2").agg(F.min("vec_id").alias("cid"), F.count("*").alias("copies"), F.first("e").alias("e"))
    return rows.select("vec_id", "key", "key2"), stored(reps, "reps")


def unit(column: pa.Array) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x**2).sum(1, keepdims=True))


def fit(reps: DataFrame, threshold: float, lists: int | None, sample: int) -> Index | None:
    """From the ``sample`` rows of least md5, of the commonest length among them."""
    n = reps.count()
    if not n:
        return None
    got = reps.select("e", "cid").orderBy(F.md5(F.col("cid").cast("string").cast("binary")), "cid").limit(sample).toArrow()["e"].combine_chunks()
    sizes = got.value_lengths().to_numpy()
    dim = np.bincount(sizes).argmax()
    x = unit(got.filter(pa.array(sizes == dim)))
    return Index(x, lists or min(4096, max(1, math.ceil(math.sqrt(n) / 4)), len(x)), threshold)


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", lists: int | None = None, sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    spark = vectors.sparkSession
    rows, reps = classes(vectors, vec_id, embedding, label)
    index = fit(reps, threshold, lists, sample)
    if index is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"), F.lit(True).alias("kept"))
    shared = spark.sparkContext.broadcast(index)  # at most 4096 centroids and 8 x 256 codewords

    def place(batches):
        own = shared.value
        for batch in batches:
            sizes = batch["e"].value_lengths().to_numpy()
            for dim in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dim))
                x = unit(part["e"])
                if dim == own.dim:
                    at, probes, codes, err = own.of(x)
                else:  # other lengths: a list each, compared in full
                    at, err = np.full(len(x), -int(dim)), np.zeros(len(x))
                    probes, codes = [np.array([-int(dim)])] * len(x), np.zeros((len(x), 0), np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [part["label"], part["key"], part["cid"].cast(pa.int64()), part["copies"], pa.array([v.tobytes() for v in x], pa.binary()), pa.array(at, pa.int32()), pa.array(probes, pa.list_(pa.int32())), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(err, pa.float64())],
                    ["label", "key", "cid", "copies", "x", "list", "probes", "codes", "err"],
                )

    kind = dict(reps.dtypes)["label"]
    placed = stored(reps.mapInArrow(lean(place), f"label {kind}, key long, cid long, copies long, x binary, list int, probes array<int>, codes binary, err double"), "placed")
    asked = placed.select("label", "key", "cid", "x", F.explode("probes").alias("list"))
    size = placed.groupBy("label", "list").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("mb"))
    load = placed.select("label", F.explode("probes").alias("list")).groupBy("label", "list").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("qb"))
    grid = small(stored(size.join(load, ["label", "list"]), "grid"), 100_000)
    q = asked.join(grid, ["label", "list"]).withColumn("q", F.pmod(F.xxhash64("key"), F.col("qb"))).select("label", "list", "q", F.explode(F.expr("sequence(0, mb - 1)")).alias("m"), F.lit(True).alias("ask"), "key", "cid", F.lit(0).cast("long").alias("copies"), "x", F.lit(None).cast("binary").alias("codes"), F.lit(0.0).alias("err"))
    m = placed.join(grid, ["label", "list"]).withColumn("m", F.pmod(F.xxhash64("key"), F.col("mb")).cast("int")).select("label", "list", F.explode(F.expr("sequence(0L, qb - 1L)")).alias("q"), "m", F.lit(False).alias("ask"), "key", "cid", "copies", "x", "codes", "err")

    def match(tab: pa.Table) -> pa.Table:
        own, at = shared.value, tab["list"][0].as_py()

        def side(asks: bool) -> dict:
            part = tab.filter(pa.array(tab["ask"].to_numpy() == asks))
            out = {k: part[k].to_numpy() for k in ("key", "cid", "copies", "err")}
            raw = b"".join(part["x"].to_pylist())
            out["x"] = np.frombuffer(raw, np.float64).reshape(len(part), -1) if len(part) else np.zeros((0, 0))
            if not asks:
                out["codes"] = np.frombuffer(b"".join(part["codes"].to_pylist()), np.uint8).reshape(len(part), -1)
            return out

        a, b = side(True), side(False)
        none = np.zeros((0, 2), np.int64)
        links, edges = compare(own, at, a, b, threshold) if len(a["cid"]) and len(b["cid"]) else (np.zeros(len(a["cid"]), np.int64), none)
        edges = edges[edges[:, 0] != edges[:, 1]]
        hit = links > 0
        return pa.table({"key": pa.array(np.r_[a["key"][hit], np.zeros(len(edges), np.int64)]), "links": pa.array(np.r_[links[hit], np.zeros(len(edges), np.int64)]), "a": pa.array(np.r_[np.full(hit.sum(), -1), edges[:, 0]]), "b": pa.array(np.r_[np.full(hit.sum(), -1), edges[:, 1]]), "edge": pa.array(np.r_[np.zeros(hit.sum(), bool), np.ones(len(edges), bool)])})

    found = stored(q.unionByName(m).groupBy("label", "list", "q", "m").applyInArrow(match, "key long, links long, a long, b long, edge boolean"), "found")
    roots = components(found.where("edge").select("a", "b"))
    counts = found.where("not edge").groupBy("key").agg(F.sum("links").alias("links"))
    known = reps.select("key", "key2", "cid", "copies").join(counts, "key", "left").join(roots.withColumnRenamed("id", "cid"), "cid", "left")
    known = stored(known.select("key", "key2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("root", "cid").alias("root")), "known")
    out = rows.join(known, ["key", "key2"], "left")
    root = F.coalesce("root", F.col("vec_id").cast("long"))
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), root.alias("component_id"), (F.col("vec_id") == root).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE = """
with recursive v as (select vec_id, label, cast(embedding as double[]) as e from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
k as (select a.vec_id as x, b.vec_id as y from v a join v b on a.label = b.label and a.vec_id <> b.vec_id where list_cosine_similarity(a.e, b.e) >= 0.98),
r as (select x, y from k union select r.x, k.y from r join k on r.y = k.x),
n as (select x, count(*) as n from k group by 1),
c as (select x, min(y) as y from r group by 1)
select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(y, vec_id)) as component_id, vec_id = least(vec_id, coalesce(y, vec_id)) as kept
from embeddings left join n on n.x = vec_id left join c on c.x = vec_id
"""
