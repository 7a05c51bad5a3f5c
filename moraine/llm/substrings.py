"""Substring dedup with suffix arrays and longest-previous-factor arrays.

Every string of ``size`` bytes that starts at two places (of any texts, or of one) is a repeat. ``keep="first"`` removes the
bytes covered by repeats that have an earlier start (documents by id, then place), so the first copy stays; ``keep="none"``
removes the bytes of all copies.

One suffix array over a corpus cannot be held by one machine, so equal strings are first brought together: among the
hashes of the 50-byte grams of a window the least one (leftmost on ties) is its anchor, and consecutive windows of one anchor
form a segment. Equal windows have equal anchors, so a window can repeat only among segments of its anchor.

Equal segments are told by two hashes of 64 bits, of the anchor gram and of all their bytes; windows of other segments are
told by their bytes, as the suffix order has them.

1. Anchors are counted by a hash aggregate; those seen once are done with. Segments of the others are reduced to distinct
   ones with their number and first place, so groups of copies collapse before any text moves.
2. Texts of distinct segments that share an anchor with different ones go, by anchor, to tasks of about ``task_bytes``.
   A task builds the suffix order of its segments to a depth of ``size`` bytes; previous and next smaller positions in that
   order tell which windows have an earlier and which a later match: the longest-previous-factor array, read at the one
   length that matters (is it ``size`` at least?).
3. An anchor with more than ``most`` distinct segments is not sent to a task: its windows are compared through a hash
   aggregate with partial sums instead, which is exact too and spreads over the cluster.

Null texts count as empty; texts shorter than ``size`` stay. An empty table gives an empty result. Rows that repeat both id
and text count as one place under keep="first" (all of them stay) and as several under keep="none". Other columns are
ignored by ``report`` and kept by ``dedup_substrings``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.llm.common import fresh, small, stored, table, workspace
from moraine.llm.suffixes import factors
from moraine.llm.textbytes import flat, give_back, lean, mix, powers, prefix_hash, span_hash

SIZE, GRAM = 200, 50
PIECE = 1 << 17
LOW = np.uint64((1 << 24) - 1)


def anchors(data: np.ndarray, offsets: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, ...]:
    """(start, windows, anchor hash, segment hash) of the segments of texts lying one after another (16 MB at most)."""
    n = len(data)
    none = (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    if n < size:
        return none
    sums = prefix_hash(data)
    _, down = powers(n + 1)
    g = n - gram + 1
    own = mix((sums[gram:] - sums[:-gram]) * down[:g])
    keyed = own & ~LOW | np.arange(g, dtype=np.uint64)
    w = size - gram + 1
    full = -(-g // w) * w
    padded = np.full(full, np.iinfo(np.uint64).max)
    padded[:g] = keyed
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    last = n - size + 1
    at = (np.minimum(behind[:last], ahead[w - 1 : w - 1 + last]) & LOW).astype(np.int64)
    edge = np.zeros(n + 1, np.int64)  # windows that hold a text's start, other than as their first byte, cross texts
    inner = offsets[1:-1]
    np.add.at(edge, np.maximum(inner - size + 1, 0), 1)
    np.add.at(edge, inner, -1)
    inside = np.cumsum(edge)[:last] == 0
    fresh = np.r_[True, (at[1:] != at[:-1]) | ~inside[:-1]] & inside
    start = np.flatnonzero(fresh)
    if not len(start):
        return none
    ends = np.flatnonzero(inside & np.r_[fresh[1:] | ~inside[1:], True])
    return start, ends - start + 1, own[at[start]], span_hash(data, start, ends + size)


def pieces(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int, int, int]]:
    """(first text, last + 1, from, to): runs of whole texts of about PIECE bytes, and longer texts in overlapping runs."""
    n, at = len(offsets) - 1, 0
    while at < n:
        if offsets[at + 1] - offsets[at] > PIECE:
            for a in range(offsets[at], offsets[at + 1] - size + 1, PIECE):
                yield at, at + 1, a, min(a + PIECE + size - 1, offsets[at + 1])
            at += 1
        else:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE, "right")) - 1)
            yield at, to, offsets[at], offsets[to]
            at = to


def listed(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(values, kind))


def segments(docs: DataFrame, doc_id: str, text: str, size: int, gram: int) -> DataFrame:
    """did, th, and arrays mh (anchor), sh (segment), st (byte start), nw (windows) of each row, stored."""
    kept = docs.select(F.col(doc_id).alias("did"), F.xxhash64(text).alias("th"), F.col(text).alias("t"))
    kind = dict(kept.dtypes)["did"]

    def run(batches):
        for batch in batches:
            data, offsets = flat(batch["t"])
            n = batch.num_rows
            found = []
            for a, b, x, y in pieces(offsets, size):
                own = np.clip(offsets[a : b + 1], x, y) - x
                st, nw, mh, sh = anchors(data[x:y], own, size, gram)
                doc = np.searchsorted(own, st, "right") - 1 + a if b - a > 1 else np.full(len(st), a)
                found.append((doc, st + x - offsets[doc], nw, mh, sh))
            doc, st, nw, mh, sh = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(5))
            counts = np.bincount(doc, minlength=n)
            yield pa.RecordBatch.from_arrays(
                [batch["did"], batch["th"], listed(mh.view(np.int64), counts, pa.int64()), listed(sh.view(np.int64), counts, pa.int64()), listed(st, counts, pa.int32()), listed(nw, counts, pa.int32())],
                ["did", "th", "mh", "sh", "st", "nw"],
            )

    return stored(kept.mapInArrow(lean(run), f"did {kind}, th long, mh array<long>, sh array<long>, st array<int>, nw array<int>"), "segments")


def row_is(a: str, b: str) -> Column:
    return F.col(f"{a}.did").eqNullSafe(F.col(f"{b}.did")) & (F.col(f"{a}.th") == F.col(f"{b}.th"))


def texts_of(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """(mh, sh, nw, pd, ps, body): bytes of the wanted segments (did, th, mh, sh, st, nw), cut from their documents."""
    lists = stored(wanted.groupBy("did", "th").agg(F.collect_list(F.struct("mh", "sh", "st", "nw")).alias("s")), "lists")
    rows = docs.select(F.col(doc_id).alias("did"), F.xxhash64(text).alias("th"), F.col(text).alias("t")).alias("d")
    got = rows.join(lists.alias("l"), row_is("d", "l")).select("d.did", "d.th", "t", "s")
    kind = dict(got.dtypes)["did"]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                body, s = (batch["t"][i].as_py() or "").encode(), batch["s"][i].values.flatten()
                mh, sh, st, nw = (c.to_numpy() for c in s)
                cut = [body[a : a + b + size - 1] for a, b in zip(st.tolist(), nw.tolist(), strict=True)]
                one = lambda c: pa.repeat(batch[c][i], len(st))  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays([pa.array(mh), pa.array(sh), pa.array(nw), one("did"), one("th"), pa.array(st), pa.array(cut, pa.binary())], ["mh", "sh", "nw", "did", "th", "st", "body"])

    return got.mapInArrow(lean(run), f"mh long, sh long, nw int, did {kind}, th long, st int, body binary").dropDuplicates(["mh", "sh"])


RANGES = "mh long, sh long, lo int, hi int"


def runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of True."""
    edges = np.flatnonzero(np.diff(np.r_[False, hit, False]))
    return edges[::2], edges[1::2] - 1


def compared(tab: pa.Table, size: int, later_too: bool) -> pa.Table:
    """Window ranges of segments that repeat among the rows of a task, which are in the order of their first places."""
    body = tab["body"].to_pylist()
    nw, mh, sh = (tab[c].to_numpy() for c in ("nw", "mh", "sh"))
    data = np.frombuffer(b"".join(body), np.uint8)
    at = np.r_[0, np.cumsum([len(b) for b in body])][:-1]
    first = np.repeat(np.r_[0, np.cumsum(nw)][:-1], nw)
    starts = np.repeat(at, nw) + np.arange(nw.sum()) - first
    earlier, later = factors(data, starts, size)
    hit = earlier | later if later_too else earlier
    # a range never crosses from one segment to the next
    part = np.repeat(np.arange(len(nw)), nw)
    grid = np.zeros(len(hit) + len(nw), bool)
    grid[np.arange(len(hit)) + part] = hit
    lo, hi = runs(grid)
    seg = part[np.minimum(lo - np.searchsorted(np.cumsum(nw + 1), lo, "right"), len(part) - 1)]
    base = np.r_[0, np.cumsum(nw + 1)][seg]
    del data, starts, first, hit, grid
    give_back()
    return pa.table({"mh": mh[seg], "sh": sh[seg], "lo": pa.array(lo - base, pa.int32()), "hi": pa.array(hi - base, pa.int32())})


def spread(bodies: DataFrame, size: int, later_too: bool) -> DataFrame:
    """The same for anchors with very many distinct segments: hashes of windows under a partial aggregate."""
    kind = dict(bodies.dtypes)["did"]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                data = np.frombuffer(batch["body"][i].as_py(), np.uint8)
                n = batch["nw"][i].as_py()
                at = np.arange(n)
                wh = span_hash(data, at, at + size).view(np.int64)
                one = lambda c: pa.repeat(batch[c][i], n)  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays([one("mh"), one("sh"), pa.array(at.astype(np.int32)), pa.array(wh), one("did"), pa.array(batch["st"][i].as_py() + at), one("th")], ["mh", "sh", "off", "wh", "did", "place", "th"])

    windows = stored(bodies.mapInArrow(lean(run), f"mh long, sh long, off int, wh long, did {kind}, place long, th long"), "windows")
    where = F.struct("did", "place", "th")
    shared = windows.groupBy("mh", "wh").agg(F.count("*").alias("c"), F.min(where).alias("first")).where("c > 1").select("mh", "wh", "first")
    hits = windows.join(stored(shared, "shared"), ["mh", "wh"])
    if not later_too:
        hits = hits.where(where != F.col("first"))
    return hits.select("mh", "sh", F.col("off").alias("lo"), F.col("off").alias("hi"))


def spans(docs: DataFrame, size: int = SIZE, keep: str = "first", doc_id: str = "doc_id", text: str = "text", gram: int | None = None, task_bytes: int = 1 << 19, most: int = 20_000) -> DataFrame:
    """(did, th, s: array<struct<a,b>>): covered byte ranges of each document with any, unmerged; th is hash(text). Stored."""
    if keep not in ("first", "none") or size < 16:
        raise ValueError((keep, size))
    gram = gram or max(8, size // 4)
    all_ = keep == "none"
    with workspace(docs.sparkSession) as keep_:
        rows = segments(docs, doc_id, text, size, gram)
        each = rows.select("did", "th", F.explode(F.arrays_zip("mh", "sh", "st", "nw")).alias("x")).select("did", "th", "x.mh", "x.sh", "x.st", "x.nw")
        repeated = stored(each.groupBy("mh").agg(F.count("*").alias("c"), F.min("sh").alias("a"), F.max("sh").alias("b")).where("c > 1").select("mh", (F.col("a") != F.col("b")).alias("mixed")), "anchors")
        placed = stored(each.join(repeated, "mh"), "placed")
        kinds = placed.groupBy("mh", "sh", "nw", "mixed").agg(F.count("*").alias("c"), F.min(F.struct("did", "st", "th")).alias("first"))
        kinds = stored(kinds, "kinds")
        mixed = kinds.where("mixed").select("mh", "sh", "nw", "first.*")
        width = mixed.groupBy("mh").agg(F.count("*").alias("n"), F.sum(F.col("nw") + size - 1).alias("bytes"))
        width = stored(width, "width")
        hot = stored(width.where(F.col("n") > most).select("mh"), "hot")
        total = width.where(F.col("n") <= most).agg(F.sum("bytes")).first()[0] or 0
        tasks = max(1, -(-total // task_bytes))
        bodies = stored(texts_of(docs, mixed, doc_id, text, size), "bodies")
        usual = bodies.join(small(hot), "mh", "left_anti").withColumn("task", F.pmod(F.xxhash64("mh"), F.lit(tasks)))
        found = usual.groupBy("task").applyInArrow(lambda tab: compared(tab.sort_by([("did", "ascending"), ("st", "ascending"), ("th", "ascending")]), size, all_), RANGES)
        if hot.limit(1).count():
            found = found.unionByName(spread(bodies.join(small(hot), "mh", "left_semi"), size, all_))
        found = stored(found, "found")
        if all_:  # windows of a segment seen twice all repeat
            copies = kinds.where("mixed and c > 1").select("mh", "sh", F.lit(0).alias("lo"), (F.col("nw") - 1).alias("hi"))
            whole = placed.where("not mixed").select("did", "th", "st", F.lit(0).alias("lo"), (F.col("nw") - 1).alias("hi"))
            some = placed.where("mixed").select("did", "th", "mh", "sh", "st").join(found.unionByName(copies), ["mh", "sh"]).select("did", "th", "st", "lo", "hi")
        else:  # of a segment, only its first place can hold first copies
            firsts = kinds.select("mh", "sh", F.col("first").alias("f"))
            own = placed.join(firsts, ["mh", "sh"]).withColumn("is_first", F.struct("did", "st", "th") == F.col("f"))
            whole = own.where("not is_first").select("did", "th", "st", F.lit(0).alias("lo"), (F.col("nw") - 1).alias("hi"))
            some = own.where("is_first").select("did", "th", "mh", "sh", "st").join(found, ["mh", "sh"]).select("did", "th", "st", "lo", "hi")
        cover = whole.unionByName(some).select("did", "th", F.struct((F.col("st") + F.col("lo")).alias("a"), (F.col("st") + F.col("hi") + size).alias("b")).alias("s"))
        return keep_(stored(cover.groupBy("did", "th").agg(F.collect_list("s").alias("s")), "spans"))


def merged(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges as maximal runs."""
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    new = np.r_[True, a[1:] > b[:-1]] if len(a) else np.zeros(0, bool)
    return a[new], b[np.r_[np.flatnonzero(new)[1:] - 1, len(a) - 1]] if len(a) else b


def _with(docs: DataFrame, cover: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, str]:
    """docs with the spans of each row, and the name of their column."""
    did, th, s = fresh(docs, "_did", "_th", "_s")
    side = cover.select(F.col("did").alias(did), F.col("th").alias(th), F.col("s").alias(s))
    return docs.join(side, F.col(doc_id).eqNullSafe(F.col(did)) & (F.xxhash64(text) == F.col(th)), "left").drop(did, th), s


def cut(body: bytes, s) -> tuple[bytes, int, int]:
    """(remaining bytes, removed, runs) of a text under ranges given as a struct array or None."""
    if s is None or not len(s):
        return body, 0, 0
    a, b = merged(*(x.to_numpy() for x in s.flatten()))
    rest = b"".join(body[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(body)], strict=True))
    return rest, int((b - a).sum()), len(a)


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    cover = spans(docs, doc_id=doc_id, text=text, **how)
    rows, own = _with(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), cover, "doc_id", "text")
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches):
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                body = (batch["text"][i].as_py() or "").encode()
                rest, gone, n = cut(body, batch[own][i].values)
                out.append((len(body), gone, n, hashlib.sha256(rest).hexdigest()))
            cols = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(lean(run), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def dedup_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """docs with text less the covered bytes; a character cut in two loses its other bytes too. Null texts stay null."""
    rows, own = _with(docs, spans(docs, doc_id=doc_id, text=text, **how), doc_id, text)

    def run(batches):
        for batch in batches:
            texts = [None if (t := batch[text][i].as_py()) is None else cut(t.encode(), batch[own][i].values)[0].decode("utf-8", "ignore") for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == text else batch[n] for n in batch.schema.names if n != own], [n for n in batch.schema.names if n != own])

    return rows.mapInArrow(lean(run), docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), size=SIZE, keep="none")
