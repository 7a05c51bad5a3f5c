"""Benchmark decontamination with DataFrame operations only.

Words are maximal runs of characters outside [\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F] once A-Z are lower-cased. Every run of n
consecutive words of an item is a window; an item of fewer words is one window. A document word inside any occurrence
of a window is hit.

Plan. A window of m words always holds a whole block of b=(m+1)//2 words that starts at a multiple of m-b+1, so a
document is first tested by hashes of only those blocks (n/6 of them for m = 10) against all b-grams of the benchmark.
A block lies in m-b+1 windows; only those around a block that is found are compared, as text. The benchmark side is
broadcast while it takes some MB (moraine.scratch.BROADCAST_BYTES), and joined by shuffle beyond.

Null and empty texts have no words and no hits; repeated rows are each returned; other columns are ignored unless
``decontaminate`` is asked to keep them. An empty benchmark marks nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.llm.common import fresh, marked, marks, small, stored, table
from moraine.functions.sequence import let

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words with their case as written."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def lowered(words: Column) -> Column:
    return F.transform(words, lambda w: F.translate(w, UPPER, LOWER))


def block_hash(words: Column, at: Column, b: int) -> Column:
    """Of b words from the 0-based place at; full lower case is coarser than A-Z, so nothing is missed."""
    return F.xxhash64(F.lower(F.array_join(F.slice(words, at + 1, b), " ")))


def every(words: Column, size: int, step: int, make) -> Column:
    """make(place) for each place 0, step, ... at which size words fit."""
    places = F.sequence(F.lit(0), F.size(words) - size, F.lit(step))
    return F.when(F.size(words) >= size, F.transform(places, make))


def windows(bench: DataFrame, item: str, text: str, n: int) -> DataFrame:
    """(item_id, m, win) of all items, distinct."""
    w = bench.select(F.col(item).cast("string").alias("item_id"), lowered(words_of(F.col(text))).alias("w")).where(F.size("w") > 0)
    m = F.least(F.size("w"), F.lit(n))
    w = w.withColumn("m", m)
    wins = F.transform(F.sequence(F.lit(0), F.size("w") - F.col("m")), lambda i: F.array_join(F.slice("w", i + 1, F.col("m")), " "))
    return w.select("item_id", "m", F.explode(wins).alias("win")).distinct()


def hits(docs: DataFrame, bench: DataFrame, n: int = 10, doc_id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, found): rows (did, th, n_words) of all documents, found (did, th, start, m, item_id) of all occurrences.

    did and th (a hash of the text) name a row, so repeated ids with other texts stay apart.
    """
    wins = stored(windows(bench, item, item_text, n), "wins")
    lengths = sorted(r.m for r in wins.select("m").distinct().collect())  # n values at most
    base = docs.select(F.col(doc_id).alias("did"), F.xxhash64(text).alias("th"), words_of(F.col(text)).alias("w"))
    blocks = [(m, (m + 1) // 2, m - (m + 1) // 2 + 1) for m in lengths]
    test = lambda m, b: lambda i: F.struct(F.lit(m).alias("m"), block_hash(F.col("w"), i, b).alias("h"), i.alias("i"))
    tests = [every(F.col("w"), b, s, test(m, b)) for m, b, s in blocks]
    none = F.expr("cast(array() as array<struct<m:int,h:bigint,i:int>>)")
    cheap = F.concat(*(F.coalesce(t, none) for t in tests)) if tests else none
    rows = stored(base.select("did", "th", F.size("w").cast("long").alias("n_words"), cheap.alias("b")), "rows")
    grams = None
    for m, b, _ in blocks:
        own = F.split("win", " ")
        gram = (lambda own, b: lambda i: block_hash(own, i, b))(own, b)
        one = wins.where(F.col("m") == m).select(F.lit(m).alias("m"), F.explode(every(own, b, 1, gram)).alias("h")).distinct()
        grams = one if grams is None else grams.unionByName(one)
    if grams is None:
        return rows.drop("b"), rows.where("false").select("did", "th", F.lit(0).alias("start"), F.lit(0).alias("m"), F.lit("").alias("item_id"))
    grams = stored(grams, "grams")
    hot = rows.select("did", "th", F.explode("b").alias("b")).select("did", "th", "b.m", "b.h", "b.i").join(small(grams), ["m", "h"], "left_semi").select("did", "th", "m", "i").distinct()
    per = stored(hot.groupBy("did", "th").agg(F.collect_list(F.struct("m", "i")).alias("at")), "suspects")
    full = docs.select(F.col(doc_id).alias("did"), F.xxhash64(text).alias("th"), F.col(text).alias("t")).alias("a")
    near = full.join(small(per).alias("p"), F.col("a.did").eqNullSafe(F.col("p.did")) & (F.col("a.th") == F.col("p.th"))).select("a.did", "a.th", "t", "at")
    near = near.select("did", "th", lowered(words_of(F.col("t"))).alias("w"), F.explode("at").alias("x")).select("did", "th", "w", "x.m", "x.i")
    # a window holds exactly one block of its length, so no start comes twice
    low = F.greatest(F.col("i") - F.col("m") + F.floor((F.col("m") + 1) / 2).cast("int"), F.lit(0))
    high = F.least(F.col("i"), F.size("w") - F.col("m"))
    spots = near.select("did", "th", "w", "m", F.explode(F.when(low <= high, F.sequence(low, high))).alias("start"))
    spots = spots.select("did", "th", "m", "start", F.array_join(F.slice("w", F.col("start") + 1, F.col("m")), " ").alias("win"))
    return rows.drop("b"), spots.join(small(wins), ["m", "win"]).select("did", "th", "start", "m", "item_id")


def covered(spans: Column) -> Column:
    """Words under any of the (start, end) structs, which are sorted."""
    step = lambda acc, x: F.struct((acc["n"] + F.greatest(x["end"] - F.greatest(x["start"], acc["e"]), F.lit(0))).alias("n"), F.greatest(acc["e"], x["end"]).alias("e"))
    return F.aggregate(spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("e")), step, lambda acc: acc["n"].cast("long"))


def report(docs: DataFrame, bench: DataFrame, n: int = 10, **names) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and spans (start, end in words) of each document."""
    rows, found = hits(docs, bench, n, **names)
    per = found.groupBy("did", "th").agg(
        F.array_sort(F.collect_set(F.struct(F.col("start").alias("start"), (F.col("start") + F.col("m")).alias("end")))).alias("spans"),
        F.array_sort(F.collect_set("item_id")).alias("items"),
    )
    out = rows.alias("r").join(per.alias("p"), F.col("r.did").eqNullSafe(F.col("p.did")) & (F.col("r.th") == F.col("p.th")), "left")
    none = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    spans, items = F.coalesce("spans", none), F.coalesce("items", F.expr("cast(array() as array<string>)"))
    out = out.select(F.col("r.did").alias("doc_id"), F.col("r.th").alias("th"), "n_words", covered(spans).alias("n_hit"), F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), spans.alias("spans"))
    return out.withColumn("contaminated", F.col("n_hit") > 0)


def decontaminate(docs: DataFrame, bench: DataFrame, n: int = 10, mode: str = "documents", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the contaminated documents, or (mode "spans") without the hit words and the gaps before them.

    All columns of docs stay as they are; only text changes, in mode "spans".
    """
    if mode not in ("documents", "spans"):
        raise ValueError(mode)
    did, th, spans = fresh(docs, "_did", "_th", "_spans")
    bad = report(docs, bench, n, doc_id=doc_id, text=text).where("contaminated").select(F.col("doc_id").alias(did), F.col("th").alias(th), F.col("spans").alias(spans))
    bad = small(stored(bad.dropDuplicates([did, th]), "bad"))
    on = F.col(doc_id).eqNullSafe(F.col(did)) & (F.xxhash64(text) == F.col(th))
    if mode == "documents":
        return docs.join(bad, on, "left_anti")
    pieces = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(rf"(?:{GAP})?+[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++|{GAP}"), F.lit(0))
    hit = F.array_sort(F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["end"] - 1)))))
    bits = let(hit, lambda at: marks(at, F.transform(at, lambda i: i + 1)))
    cleaned = let(bits, lambda b: F.array_join(F.filter(pieces, lambda p, i: ~marked(b, i)), ""))
    return docs.join(bad, on, "left").withColumn(text, F.when(F.col(spans).isNull(), F.col(text)).otherwise(cleaned)).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


ORACLE = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select cast(item_id as varchar) as item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bi as (select item_id, w, least(len(w), 10) as m, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) as i from b where len(w) > 0),
bw as (select distinct item_id, m, array_to_string(list_slice(w, i, i + m - 1), ' ') as win from bi),
di as (select doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) as i from d, (select distinct m from bw) where len(w) >= m),
dw as (select doc_id, m, i, array_to_string(list_slice(w, i, i + m - 1), ' ') as win from di),
h as (select distinct doc_id, i, m, item_id from dw join bw using (m, win)),
p as (select distinct doc_id, unnest(generate_series(i, i + m - 1)) as p from h),
c as (select doc_id, count(*) as n_hit from p group by 1),
t as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as s from h group by 1)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(s, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join c using (doc_id) left join t using (doc_id)
"""
