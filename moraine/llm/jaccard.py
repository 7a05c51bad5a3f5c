"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document's set holds the hashes (64 bit) of its distinct word shingles. Two sets link when 100 * shared >= percent * union.
Documents with equal sets are first reduced to one class.

1. Admission. Under any fixed order of tokens, linked sets share l of their first n - ceil(t n) + l tokens. In the order of
   hash values, with l so large that this is half of them, a class with fewer tokens there that any other class has than each
   size of a linked set would ensure links with nothing; the rest go on.
2. Frequencies of the admitted classes' tokens are counted exactly, in blocks of hash values, and go back to the classes.
   Batches of classes send a token once, whatever the number of their classes that have it, so no token is a hot key. Those with fewer shared tokens than a link needs end here. The order is now (frequency, hash).
3. Adaptive prefixes. A prefix of n - ceil(t n) + l tokens must share l tokens with that of a linked set. For each class l is
   chosen so that postings + verification * postings / l is least: the longer the prefix, the more matches are demanded
   before a pair is verified (of two classes, the smaller l).
4. Verification in rounds. In two rounds each posting list ties its members to one of them (that with the smallest share
   of tokens of its own, then any), which costs one pair a posting. Lists within one component are then done with; of the
   rest all pairs between components are verified that share enough prefix tokens and whose parity sketches, which bound
   the number of differing tokens from below, allow a link. So a group of copies is joined without its pairs, pairs that
   narrowly miss give no rows, and no link between components is missed.

Null and empty texts and texts without words have empty sets and link with nothing; a text of fewer words than a shingle
is one shingle. Repeated rows are separate documents of one class. Null ids take the component's least id that is not
null. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.llm.common import components, fresh, small, stored, table, workspace
from moraine.llm.textbytes import flat, give_back, lean, lean_group, mix, span_hash, word_spans

GAP = np.zeros(256, bool)
GAP[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
PIECE = 1 << 17
NOBODY = 65535
HOT = 1000
MOST_L, VERIFY, SKETCH = 8, 20.0, 8
TURN = np.uint64(0x9DDFEA08EB382D69)


def shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): hashes of all shingles, those of text d at first[d]:first[d+1], repeats included."""
    data = LOWER[data]
    start, end, first = word_spans(data, offsets, GAP)
    word = span_hash(data, start, end)
    count = np.diff(first)
    n = np.where(count == 0, 0, np.maximum(count - words + 1, 1))
    out = np.r_[0, np.cumsum(n)]
    doc = np.repeat(np.arange(len(count)), n)
    at = np.arange(out[-1]) - out[doc] + first[doc]
    size = np.minimum(count, words)[doc]
    padded = np.r_[word, np.zeros(words, np.uint64)]
    total = size.astype(np.uint64)
    for k in range(words):
        total = np.where(k < size, mix(total * TURN + padded[at + k]), total)
    return total, out


def sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = flat(column)
    n, at = len(offsets) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE, "right")) - 1)
        hashes, first = shingles(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], words)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            own = np.sort(hashes[a:b])
            yield own[np.r_[True, own[1:] != own[:-1]]] if len(own) else own
        at = to


def prefix(n: int, percent: int, matches: int = 1) -> int:
    """Tokens of a set of n that must share ``matches`` with those of any linked set."""
    return min(n, n - -(-percent * n // 100) + matches)


def summarised(docs: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """did, th, n, key (of the set; null for none) of each row, stored."""
    kept = docs.select(F.col(doc_id).alias("did"), F.xxhash64(text).alias("th"), F.col(text).alias("t"))
    kind = dict(kept.dtypes)["did"]

    def run(batches):
        for batch in batches:
            n, key = [], []
            for s in sets(batch["t"], words):
                n.append(len(s))
                key.append(int(mix(np.array([s.sum(dtype=np.uint64) ^ mix(np.bitwise_xor.reduce(mix(s + TURN))[None])[0]])).view(np.int64)[0]) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch["did"], batch["th"], pa.array(n, pa.int64()), pa.array(key, pa.int64())], ["did", "th", "n", "key"])

    return stored(kept.mapInArrow(lean(run), f"did {kind}, th long, n long, key long"), "sets")


def batched(texts: DataFrame, words: int, take, make, schema: str) -> DataFrame:
    """make(sets, keys) of runs of rows (key, t) that hold a million tokens take(set) in all, or one text's, at most."""

    def run(batches):
        held, who, size = [], [], 0
        for batch in batches:
            for key, s in zip(batch["key"].to_pylist(), sets(batch["t"], words), strict=True):
                s = take(s)
                if held and (size + len(s) > 1 << 20 or len(held) == NOBODY):
                    yield make(held, np.array(who, np.int64))
                    held, who, size = [], [], 0
                held.append(s)
                who.append(key)
                size += len(s)
        if held:
            yield make(held, np.array(who, np.int64))

    return texts.mapInArrow(lean(run), schema)


def blocked(t: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, edges): places by block of hash values, and where each block begins."""
    block = ((t >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(block, kind="stable")
    return order, np.searchsorted(block[order], np.arange(blocks + 1))


def table_of(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    cols = [c.split() for c in schema.split(", ")]
    return pa.table({name: pa.array([r[i] for r in rows], kinds[kind]) for i, (name, kind) in enumerate(cols)})


def joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def blocks_for(tokens: int) -> int:
    """A block has some hundred thousand tokens."""
    return max(1, min(1 << 24, -(-int(tokens) // 400_000)))


def shards(key: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places) of keys by their number modulo n, for what a block sends back in a row a shard."""
    own = (key.view(np.uint64) % np.uint64(n)).astype(np.int64)
    order = np.argsort(own, kind="stable")
    edge = np.searchsorted(own[order], np.arange(n + 1))
    for i in np.flatnonzero(np.diff(edge)):
        yield int(i), order[edge[i] : edge[i + 1]]


def by_key(rows: DataFrame, side: DataFrame) -> DataFrame:
    """rows.join(side, "key"); keys of more than HOT rows (c in side) go out by broadcast, so that their rows stay where they are."""
    heavy = small(side.where(F.col("c") > HOT))
    return rows.join(heavy, "key").unionByName(rows.join(heavy.select("key"), "key", "left_anti").join(side.where(F.col("c") <= HOT), "key"))


def half(n: int, percent: int) -> int:
    """Tokens looked at for admission: so many that about half of them must be shared."""
    return prefix(n, percent, n - -(-percent * n // 100) + 1)


def needed(n: Column, percent: int) -> Column:
    """Tokens of a set of n, among those looked at for admission, that any linked set is sure to have among its own.

    Sets of n and m that link share at least o = ceil(t (n + m) / (1 + t)) tokens. With a and b tokens looked at, they share
    at least the least of a - n + o, b - m + o and o of those; the result is the least of that over all m that can link.
    """
    least = lambda x: F.ceil(F.lit(percent) * x / 100)
    looked = lambda x: F.least(x, 2 * (x - least(x)) + 1)
    both = lambda m: F.ceil(F.lit(percent) * (n + m) / (100 + percent))
    sizes = F.sequence(least(n), F.floor(F.lit(100) * n / percent))
    return F.array_min(F.transform(sizes, lambda m: both(m) + F.least(looked(n) - n, looked(m) - m, F.lit(0))))


def admitted(docs: DataFrame, rows: DataFrame, doc_id: str, text: str, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(texts, known): (key, t) of a document of each class of which enough of the first tokens are some other class's, and (key, n) of those classes."""
    first = stored(rows.where("key is not null").groupBy("key").agg(F.min(F.struct("did", "th")).alias("at"), F.count("*").alias("c"), F.first("n").alias("n")), "classes")
    total = first.agg(F.sum("n")).first()[0] or 0
    copies = by_key(rows.select("key", "did", "th"), first.where("c > 1").select("key", "at", "c"))
    copies = copies.where(~(F.col("did").eqNullSafe(F.col("at.did")) & (F.col("th") == F.col("at.th")))).select("did", "th").distinct()
    none = rows.where("key is null").select("did", "th").distinct()
    out_ = stored(copies.unionByName(none), "copies").alias("o")
    mine = docs.select(F.col(doc_id).alias("did"), F.xxhash64(text).alias("th"), F.col(text).alias("t")).alias("d")
    same = lambda x: F.col("d.did").eqNullSafe(F.col(f"{x}.did")) & (F.col("d.th") == F.col(f"{x}.th"))
    reps = mine.join(small(out_).alias("o"), same("o"), "left_anti")
    ids = reps.select(F.xxhash64("did", "th").alias("key"), "t")  # a row's own number until its class is looked up

    blocks, parts = blocks_for(0.4 * total), blocks_for(total / 20)
    kind = "block int, keys binary, doc binary, t binary"

    def deal(own, keys):
        """Tokens that several classes here have count for these at once and go on as one that is nobody's; others go on with their class."""
        t = np.concatenate(own)
        doc = np.repeat(np.arange(len(own)), [len(x) for x in own])
        order = np.argsort(t, kind="stable")
        t, doc = t[order], doc[order]
        new = np.flatnonzero(np.r_[True, t[1:] != t[:-1]]) if len(t) else np.zeros(0, np.int64)
        many = np.diff(np.r_[new, len(t)]) > 1
        credit = np.bincount(doc[np.repeat(many, np.diff(np.r_[new, len(t)]))], minlength=len(own)).astype(np.int32)
        t, doc = t[new], np.where(many, NOBODY, doc[new]).astype(np.uint16)
        order, edge = blocked(t, blocks)
        t, doc, rows_ = t[order], doc[order], []
        for b in np.flatnonzero(np.diff(edge)):
            x, y = edge[b], edge[b + 1]
            local, used = doc[x:y].copy(), np.unique(doc[x:y])
            used = used[used != NOBODY]
            has = local != NOBODY
            local[has] = np.searchsorted(used, local[has])
            rows_.append((int(b), keys[used].tobytes(), local.tobytes(), t[x:y].tobytes()))
        got = np.flatnonzero(credit)
        if len(got):  # a group of its own, as counts that are final here
            rows_.append((blocks + int(keys[0]) % blocks, keys[got].tobytes(), credit[got].tobytes(), None))
        return table_of(rows_, kind).combine_chunks().to_batches()[0] if rows_ else pa.RecordBatch.from_pylist([], table_of([], kind).schema)

    def count(tab: pa.Table) -> pa.Table:
        if tab["block"][0].as_py() >= blocks:
            key, c = joined(tab["keys"], np.int64), joined(tab["doc"], np.int32)
        else:
            keys = [np.frombuffer(x, np.int64) for x in tab["keys"].to_pylist()]
            base = np.r_[0, np.cumsum([len(k) for k in keys])]
            local = [np.frombuffer(x, np.uint16) for x in tab["doc"].to_pylist()]
            doc = np.concatenate([np.where(x == NOBODY, -1, x + base[i]) for i, x in enumerate(local)])
            t = joined(tab["t"], np.uint64)
            order = np.argsort(t, kind="stable")
            t, doc = t[order], doc[order]
            shared = np.zeros(len(t), bool)
            shared[1:] = t[1:] == t[:-1]
            shared[:-1] |= shared[1:]
            key = np.concatenate(keys)
            c = np.bincount(doc[shared & (doc >= 0)], minlength=len(key)).astype(np.int32)
            key, c = key[c > 0], c[c > 0]
        return table_of([(i, key[at].tobytes(), c[at].tobytes()) for i, at in shards(key, parts)], "shard int, keys binary, c binary")

    def add(tab: pa.Table) -> pa.Table:
        key, at = np.unique(joined(tab["keys"], np.int64), return_inverse=True)
        return pa.table({"key": key, "c": np.bincount(at, joined(tab["c"], np.int32), minlength=len(key)).astype(np.int64)})

    counted = batched(ids, words, lambda s: s[: half(len(s), percent)], deal, kind).groupBy("block").applyInArrow(lean_group(count), "shard int, keys binary, c binary")
    seen = counted.groupBy("shard").applyInArrow(lean_group(add), "key long, c long")
    ranked = first.select(F.xxhash64("at.did", "at.th").alias("id"), "key", "n", "at.did", "at.th")
    enough = ranked.join(seen.select(F.col("key").alias("id"), F.col("c").alias("seen")), "id").where(F.col("seen") >= needed(F.col("n"), percent))
    who = stored(enough.select("did", "th", "key", "n").dropDuplicates(["key"]), "admitted")
    texts = mine.join(small(who).alias("w"), same("w")).select("w.key", "t")
    return texts, who.select("key", "n")


def frequencies(texts: DataFrame, known: DataFrame, words: int, percent: int) -> DataFrame:
    """(key, n, s, df): the tokens of each class that others have too, with their frequencies, where they suffice for a link. Stored.

    Classes lie in stored batches of a million tokens. A batch sends each of its distinct tokens once, with its number of
    classes, and gets back the tokens that are shared with their totals, so a token of very many classes costs a row a batch.
    """
    total = known.agg(F.sum("n")).first()[0] or 0
    blocks = blocks_for(total)
    kind, sent, back = "batch long, keys binary, size binary, t binary", "block int, batch long, t binary, c binary", "batch long, t binary, df binary"

    def pack(own, keys):
        row = (uuid.uuid4().int >> 65, keys.tobytes(), np.array([len(x) for x in own], np.int32).tobytes(), np.concatenate(own).tobytes())
        return table_of([row], kind).to_batches()[0]

    batches = stored(batched(texts, words, lambda s: s, pack, kind), "batches")  # stored, as their numbers are drawn

    def send(parts):
        for part in parts:
            for batch, raw in zip(part["batch"].to_pylist(), part["t"].to_pylist(), strict=True):
                t, c = np.unique(np.frombuffer(raw, np.uint64), return_counts=True)
                order, edge = blocked(t, blocks)
                t, c = t[order], c[order].astype(np.int32)
                rows_ = [(int(b), batch, t[edge[b] : edge[b + 1]].tobytes(), c[edge[b] : edge[b + 1]].tobytes()) for b in np.flatnonzero(np.diff(edge))]
                yield from table_of(rows_, sent).to_batches()

    def count(tab: pa.Table) -> pa.Table:
        t, c = joined(tab["t"], np.uint64), joined(tab["c"], np.int32)
        _, at = np.unique(t, return_inverse=True)
        df = np.minimum(np.bincount(at, c), 2**31 - 1).astype(np.int32)[at]
        ends = np.cumsum([len(x) // 8 for x in tab["t"].to_pylist()])
        rows_, begin = [], 0
        for batch, end in zip(tab["batch"].to_pylist(), ends.tolist(), strict=True):
            keep = df[begin:end] > 1
            if keep.any():
                rows_.append((batch, t[begin:end][keep].tobytes(), df[begin:end][keep].tobytes()))
            begin = end
        return table_of(rows_, back)

    def join(own: pa.Table, got: pa.Table) -> pa.Table:
        out = "key long, many long, s binary, df binary"
        if not own.num_rows or not got.num_rows:
            return table_of([], out)
        known_t, known_df = joined(got["t"], np.uint64), joined(got["df"], np.int32)
        order = np.argsort(known_t)
        known_t, known_df = known_t[order], known_df[order]
        keys, t = joined(own["keys"], np.int64), joined(own["t"], np.uint64)
        at = np.minimum(np.searchsorted(known_t, t), len(known_t) - 1)
        hit = known_t[at] == t
        ends = np.cumsum(joined(own["size"], np.int32))
        kept = np.r_[0, np.cumsum(hit)]
        t, df = t[hit], known_df[at[hit]]
        a, b = kept[ends - joined(own["size"], np.int32)], kept[ends]
        rows_ = [(k, y - x, t[x:y].tobytes(), df[x:y].tobytes()) for k, x, y in zip(keys.tolist(), a.tolist(), b.tolist(), strict=True) if y > x]
        give_back()
        return table_of(rows_, out)

    counted = batches.select("batch", "t").mapInArrow(send, sent).groupBy("block").applyInArrow(lean_group(count), back)
    per = batches.groupBy("batch").cogroup(counted.groupBy("batch")).applyInArrow(join, "key long, many long, s binary, df binary")
    got = known.join(per, "key").where(100 * F.col("many") >= percent * F.col("n"))
    tokens = stored(got.select("key", "n", (F.col("n") - F.col("many")).alias("u"), "s", "df"), "tokens")
    held = batches.agg(F.sum(F.octet_length("keys") / 8)).first()[0] or 0
    return stored(tokens.dropDuplicates(["key"]), "tokens") if held > known.count() else tokens  # repeated rows of a class


def postings(tokens: DataFrame, percent: int, most: int = MOST_L, verify: float = VERIFY) -> DataFrame:
    """(token, key, n, u, l): the adaptive prefix of each class, less tokens that no other class has. Stored."""

    def choose(batches):
        for batch in batches:
            out_t, out_k, out_n, out_u, out_l = [], [], [], [], []
            for key, n, s, dfs in zip(*(batch[c].to_pylist() for c in ("key", "n", "s", "df")), strict=True):
                t, df = np.frombuffer(s, np.uint64), np.frombuffer(dfs, np.int32).astype(np.int64)
                order = np.lexsort((t, df))
                cost = np.r_[0, np.cumsum(df[order] - 1)]
                alone = n - len(t)
                best = None
                for l in range(1, most + 1):
                    if l > 1 and prefix(n, percent, l) == prefix(n, percent, l - 1):
                        break  # the whole set: no more matches may be demanded
                    k = max(0, prefix(n, percent, l) - alone)
                    best = min(best or (np.inf,), (float(cost[k]) * (1 + verify / l), l, k))
                k = best[2]
                out_t.append(t[order[:k]].view(np.int64))
                out_k.append(np.full(k, key))
                out_n.append(np.full(k, n))
                out_u.append(np.full(k, alone))
                out_l.append(np.full(k, best[1]))
            cat = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cat(x)) for x in (out_t, out_k, out_n, out_u, out_l)], ["token", "key", "n", "u", "l"])

    return stored(tokens.mapInArrow(lean(choose), "token long, key long, n long, u long, l long"), "postings")


def verified(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs (a, b, distinct) that link, stored. Each pair moves the set of b once; a's goes along once for every thousand."""
    split = F.pmod(F.xxhash64("b"), F.ceil(F.col("c") / 1000))
    pairs = stored(pairs, "pairs")
    sizes = stored(pairs.groupBy("a").agg(F.count("*").alias("c")), "sizes")
    cut = stored(pairs.join(small(sizes), "a").select("a", split.alias("part"), F.col("b").alias("key")), "cut")
    heads = stored(sizes.select(F.col("a").alias("key"), F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("c") / 1000) - 1)).alias("part")), "heads")
    sets_ = tokens.select("key", "n", "s")
    right = sets_.join(small(cut), "key").select("a", "part", "key", "n", "s", F.lit(False).alias("own"))
    left = sets_.join(small(heads), "key").select(F.col("key").alias("a"), "part", "key", "n", "s", F.lit(True).alias("own"))

    def test(tab: pa.Table) -> pa.Table:
        own = tab["own"].to_numpy()
        if own.all():  # a part that no pair fell into
            return tab.select(["a", "key"]).rename_columns(["a", "b"]).slice(0, 0)
        hub = int(np.flatnonzero(own)[0])
        rows = np.flatnonzero(~own)
        raw, n = tab["s"].to_pylist(), tab["n"].to_numpy()
        base = np.frombuffer(raw[hub], np.uint64)
        size = np.array([len(raw[i]) // 8 for i in rows], np.int64)
        other = np.frombuffer(b"".join(raw[i] for i in rows), np.uint64)
        at = np.minimum(np.searchsorted(base, other), len(base) - 1)
        hit = np.r_[0, np.cumsum(base[at] == other)]
        ends = np.cumsum(size)
        both = hit[ends] - hit[ends - size]
        ok = 100 * both >= percent * (n[rows] + n[hub] - both)
        return pa.table({"a": tab["a"].take(pa.array(rows[ok])), "b": tab["key"].take(pa.array(rows[ok]))})

    return stored(left.unionByName(right).groupBy("a", "part").applyInArrow(lean_group(test), "a long, b long"), "links")


def linked(docs: DataFrame, words: int = 4, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, roots): rows (did, th, n, key) of every document, roots (key, root) of classes linked to others."""
    rows = summarised(docs, doc_id, text, words)
    texts, known = admitted(docs, rows, doc_id, text, words, percent)
    tokens = frequencies(texts, known, words, percent)
    post = postings(tokens, percent)
    fits = lambda x, y: (100 * F.least(x, y) >= percent * F.greatest(x, y))
    edges, roots = None, None
    for rank in (F.floor(1000 * F.col("u") / F.col("n")), F.lit(0)):  # the class with the smallest share of tokens of its own, then any
        left = post.withColumn("comp", F.col("key")) if roots is None else _open(post, roots)
        hub = left.groupBy("token").agg(F.min(F.struct(rank.alias("r"), "key", "n", "comp")).alias("h")).select("token", F.col("h.key").alias("a"), F.col("h.n").alias("m"), F.col("h.comp").alias("ac"))
        pairs = left.join(hub, "token").where((F.col("comp") != F.col("ac")) & fits(F.col("n"), F.col("m")))
        found = verified(pairs.select("a", F.col("key").alias("b")).distinct(), tokens, percent)
        edges = found if edges is None else edges.unionByName(found)
        roots = components(edges)
    left = _open(post, roots).join(sketches(tokens), "key")
    left = stored(left, "open")
    x, y = (left.select("token", *(F.col(c).alias(p + c) for c in ("key", "n", "u", "l", "comp", "k"))) for p in "xy")
    apart = sum((F.bit_count(F.col("xk").getItem(i).bitwiseXOR(F.col("yk").getItem(i))) for i in range(SKETCH)), F.col("xu") + F.col("yu"))
    near = (100 + percent) * apart <= (100 - percent) * (F.col("xn") + F.col("yn"))
    pairs = x.join(y, "token").where("xkey < ykey and xcomp <> ycomp").where(fits(F.col("xn"), F.col("yn")) & near)
    pairs = pairs.groupBy("xkey", "ykey").agg(F.count("*").alias("c"), F.first(F.least("xl", "yl")).alias("l")).where("c >= l")
    edges = edges.unionByName(verified(pairs.select(F.col("xkey").alias("a"), F.col("ykey").alias("b")), tokens, percent))
    return rows, components(edges).select(F.col("id").alias("key"), "root")


def sketches(tokens: DataFrame) -> DataFrame:
    """(key, k): parities of the shared tokens over 64 * SKETCH places. Two sets differ in at least as many tokens as their
    sketches in places, besides those that only one of them has in the whole corpus."""

    def run(batches):
        for batch in batches:
            out = []
            for raw in batch["s"].to_pylist():
                place = (mix(np.frombuffer(raw, np.uint64)) % np.uint64(64 * SKETCH)).astype(np.int64)
                odd = np.bincount(place, minlength=64 * SKETCH).astype(np.uint8) & 1
                out.append(np.packbits(odd).view(np.int64))
            flat_ = np.concatenate(out) if out else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch["key"], pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * SKETCH), pa.array(flat_))], ["key", "k"])

    return tokens.select("key", "s").mapInArrow(lean(run), "key long, k array<long>")


def _open(post: DataFrame, roots: DataFrame) -> DataFrame:
    """Postings with their component, of lists that lie in more than one."""
    known = post.join(roots.select(F.col("id").alias("key"), "root"), "key", "left").select("token", "key", "n", "u", "l", F.coalesce("root", "key").alias("comp"))
    lists = known.groupBy("token").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("token")
    return known.join(lists, "token", "left_semi")


def near_duplicates(docs: DataFrame, words: int = 4, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, th (hash of the text), n_shingles, component_id of every row."""
    with workspace(docs.sparkSession) as keep:
        rows, roots = linked(docs, words, percent, doc_id, text)
        each = rows.where("key is not null").groupBy("key").agg(F.min("did").alias("first"), F.count("*").alias("c"))
        each = each.join(roots, "key", "left").select("key", "first", "c", F.coalesce("root", "key").alias("root"))
        least = each.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("c").alias("all")).where("all > 1").drop("all")
        tied = keep(stored(each.join(least, "root").select("key", "c", "component_id"), "tied"))
        keep(rows)
    known = rows.where("key is not null")
    heavy = small(tied.where(F.col("c") > HOT))
    light = tied.where(F.col("c") <= HOT).select("key", "component_id")
    out = known.join(heavy.select("key", "component_id"), "key").unionByName(known.join(heavy.select("key"), "key", "left_anti").join(light, "key", "left"))
    out = out.unionByName(rows.where("key is null"), allowMissingColumns=True)
    return out.select(F.col("did").alias("doc_id"), "th", F.col("n").alias("n_shingles"), F.coalesce("component_id", "did").alias("component_id"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without those that are linked, directly or not, to a document of a smaller id. Of repeated rows with that id all stay."""
    groups = near_duplicates(docs, words, percent, doc_id, text)
    (did,) = fresh(docs, "_did")
    gone = stored(groups.where("component_id < doc_id").select(F.col("doc_id").alias(did)).distinct(), "gone")
    return docs.join(small(gone), F.col(doc_id) == F.col(did), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("th")


ORACLE = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
i as (select doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) as i from w where len(w) > 0),
s as (select distinct doc_id, array_to_string(list_slice(w, i, i + 3), ' ') as g from i),
n as (select doc_id, count(*) as n from s group by 1),
p as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * c >= 85 * (nx.n + ny.n - c)),
k as (select x, y from l union all select y, x from l),
r as (select x, y from k union select r.x, k.y from r join k on r.y = k.x),
m as (select x, min(y) as y from r group by 1)
select w.doc_id, coalesce(n, 0) as n_shingles, least(w.doc_id, coalesce(y, w.doc_id)) as component_id
from w left join n on n.doc_id = w.doc_id left join m on m.x = w.doc_id
"""
