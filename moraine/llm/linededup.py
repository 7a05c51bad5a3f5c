"""Line dedup by a deletion-neighbourhood join, with DataFrame operations only.

A line is its lower-cased words; blank lines stay. Of equal lines the earliest (by document id, then line number) stays. The
edit bound is one word: a line also goes if an earlier one, as first met, is one word replaced, added or left out away, and
the longer of the two has ``edit_words`` words at least (10 by default: 0.9 of the words agree, or more). Longer lines that
differ in two words both stay.

Plan. Equal lines are first reduced to one row each by a hash aggregate. One edit leaves the first or the last half of the
words as they are, so only lines that share a half (four hashes a line) go on. Those emit their deletion neighbourhood: a
hashed key for the line without each of the words in the other half. Equal keys are joined through the earliest line of each
key, so a key shared by very many lines costs one row a line and no pairs; each partner found is then compared word by word.

Disk. Hashes are counted before anything travels with them, rows that cannot meet a counted hash stay behind a sieve of bits,
lines that go on are numbered in their order and sent as text, and a table goes when nothing reads it any more.

Null and empty texts and an empty table pass unchanged. Repeated rows count as one document and stay alike. Other columns
stay as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.functions.sequence import let
from moraine.llm.common import drop, fresh, marked, marks, small, stored, table, workspace
from moraine.llm.spans import BLOCK

MIN_WORDS, EDIT_WORDS = 1, 10
HALVES = ("p0", "p1", "q0", "q1")

BLANK = " \t\x0b\f\r"


def tidy(text: Column) -> Column:
    """Lower case, with single spaces between words; only texts with other blanks pay for a regular expression."""
    low = F.lower(F.coalesce(text, F.lit("")))
    rough = F.contains(low, F.lit("  "))
    for c in BLANK[1:]:
        rough |= F.contains(low, F.lit(c))
    return F.when(rough, F.regexp_replace(low, r"[ \t\x0b\f\r]+", " ")).otherwise(low)


def with_halves(lines: DataFrame, edit_words: int) -> DataFrame:
    """lines (line, n) with the hashes p0, p1 of the first and last n div 2 words and, of an even number of words that may be
    the longer line's, q0, q1 of one word less; null where a line is too short."""
    n, h = F.col("n"), F.floor(F.col("n") / 2).cast("int")
    ends = lambda h: (F.call_function("substring_index", "line", F.lit(" "), h), F.call_function("substring_index", "line", F.lit(" "), -h))
    own = [F.when(n >= edit_words - 1, F.xxhash64(e)) for e in ends(h)]
    less = [F.when((n >= edit_words) & (n % 2 == 0), F.xxhash64(e)) for e in ends(h - 1)]
    return lines.withColumns({"p0": own[0], "p1": own[1], "q0": less[0], "q1": less[1]})


def halves(edit_words: int) -> Column:
    """Of with_halves(): (tag, k) of the halves among n words (tags 0, 1) and, of lines that may be the longer one, among one less
    (tags 2, 3; of an odd number of words these are the same halves)."""
    n = F.col("n")
    key = lambda tag, m, p: F.struct(F.lit(tag).alias("tag"), F.xxhash64(m, F.lit(tag % 2), p).alias("k"))
    ks = [key(0, n, F.col("p0")), key(1, n, F.col("p1")), key(2, n - 1, F.coalesce("q0", "p0")), key(3, n - 1, F.coalesce("q1", "p1"))]
    return F.when(n >= edit_words, F.array(*ks)).when(n == edit_words - 1, F.array(*ks[:2]))


def sieved(rows: DataFrame, name: str, keys: DataFrame) -> DataFrame:
    """rows less seven of eight, at least, whose hash ``name`` is not in that column of the stored keys; an exact join is to follow.

    Eight keys share a number of 64 bits and set one each. All rows, if these numbers are too large to broadcast.
    """
    own, bits = fresh(rows, "_chunk", "_bits")
    chunk = F.pmod(F.col(name), F.lit(max(1, keys.count() // 8)))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(name, 58).cast("int"))
    sieve = stored(keys.select(chunk.alias(own), bit.alias(bits)).groupBy(own).agg(F.bit_or(bits).alias(bits)), "sieve")
    if (side := small(sieve)) is sieve:
        return rows
    return rows.withColumn(own, chunk).join(side, own).where(F.col(bits).bitwiseAND(bit) != 0).drop(own, bits)


def running_xor(values: Column) -> Column:
    """Of the values up to and including each place, block by block so that copying stays linear."""
    start = lambda: F.struct(F.lit(0).cast("long").alias("x"), F.expr("cast(array() as array<bigint>)").alias("out"))

    def step(acc, v):
        x = acc["x"].bitwiseXOR(v)
        return F.struct(x.alias("x"), F.concat(acc["out"], F.array(x)).alias("out"))

    def join(acc, b):
        return F.struct(acc["x"].bitwiseXOR(b["x"]).alias("x"), F.concat(acc["out"], F.transform(b["out"], lambda v: v.bitwiseXOR(acc["x"]))).alias("out"))

    blocks = F.transform(F.sequence(F.lit(0), F.size(values) - 1, F.lit(BLOCK)), lambda b: F.aggregate(F.slice(values, b + 1, BLOCK), start(), step))
    return F.aggregate(blocks, start(), join, lambda acc: acc["out"])


def neighbourhood(lines: DataFrame, edit_words: int) -> DataFrame:
    """(id, kind, key) of the variants of rows (id, n, w, tags): S one word replaced at a place, D one word left out, O the line itself.

    tags tells which halves are shared with a line of as many words, or of one word less, and (16) whether one is with a line of
    one word more; a variant is emitted only where the edit can then be.
    """
    d = lines.select("id", "n", "tags", F.transform("w", lambda w, j: F.xxhash64(w, j)).alias("h"), F.transform("w", lambda w, j: F.xxhash64(w, j - 1)).alias("s"))
    d = d.select("id", "n", "tags", "h", "s", running_xor(F.col("h")).alias("ph"), running_xor(F.col("s")).alias("ps"))
    total, shifted = F.element_at("ph", -1), F.element_at("ps", -1)

    def open_(i, less):
        has = lambda tag: F.col("tags").bitwiseAND(1 << tag) != 0
        h = F.floor((F.col("n") - less) / 2)
        return (has(2 * less) & (i >= h)) | (has(2 * less + 1) & (i < F.col("n") - h))

    places = F.sequence(F.lit(0), F.col("n") - 1)
    replaced = F.transform(F.filter(places, lambda i: open_(i, 0)), lambda i: F.struct(F.lit(0).alias("kind"), F.xxhash64(F.lit(0), F.col("n"), i, F.get("h", i).bitwiseXOR(total)).alias("key")))
    # words before a place as they stand, and the words behind it moved up by one
    without = lambda i: F.get("ph", i).bitwiseXOR(F.get("h", i)).bitwiseXOR(F.get("ps", i)).bitwiseXOR(shifted)
    left_out = F.transform(F.array_distinct(F.transform(F.filter(places, lambda i: open_(i, 1)), without)), lambda x: F.struct(F.lit(1).alias("kind"), F.xxhash64(F.lit(1), F.col("n") - 1, x).alias("key")))
    itself = F.array(F.struct(F.lit(2).alias("kind"), F.xxhash64(F.lit(1), F.col("n"), total).alias("key")))
    d = d.withColumns({"replaced": F.when((F.col("tags").bitwiseAND(3) != 0) & (F.col("n") >= edit_words), replaced), "left": F.when(F.col("tags").bitwiseAND(12) != 0, left_out), "itself": F.when(F.col("tags").bitwiseAND(16) != 0, itself)})
    none = F.expr("cast(array() as array<struct<kind:int,key:bigint>>)")
    return d.select("id", F.explode(F.concat(*(F.coalesce(c, none) for c in ("replaced", "left", "itself")))).alias("x")).select("id", "x.kind", "x.key")


def within_one(a: Column, b: Column) -> Column:
    """Word edit distance of exactly one (or none) of two arrays."""
    differ = F.size(F.filter(F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), lambda x: x))
    long_, short = F.when(F.size(a) > F.size(b), a).otherwise(b), F.when(F.size(a) > F.size(b), b).otherwise(a)
    first = F.filter(F.zip_with(F.sequence(F.lit(0), F.size(long_) - 1), F.zip_with(long_, short, lambda x, y: ~x.eqNullSafe(y)), lambda i, x: F.when(x, i)), lambda i: i.isNotNull())
    at = F.element_at(first, 1)
    one_out = F.concat(F.slice(long_, 1, at), F.slice(long_, at + 2, F.size(long_) - at)) == short
    return F.when(F.size(a) == F.size(b), differ <= 1).when(F.size(long_) == F.size(short) + 1, one_out).otherwise(False)


def numbered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(did, th, no, line): lines in lower case with single spaces."""
    rows = docs.select(F.col(doc_id).alias("did"), F.xxhash64(text).alias("th"), tidy(F.col(text)).alias("t"))
    return rows.select("did", "th", F.posexplode(F.split("t", "\n", -1)).alias("no", "line")).select("did", "th", "no", F.trim("line").alias("line"))


def removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, edit_words: int = EDIT_WORDS) -> DataFrame:
    """(at, near) of the lines to leave out; at is (did, no, th), near tells edits from exact copies."""
    lines = numbered(docs, doc_id, text).withColumn("n", F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "))) + 1).where((F.col("line") != "") & (F.col("n") >= min_words))
    edit_words = max(2, edit_words)
    lines = with_halves(lines, edit_words).select(F.struct("did", "no", "th").alias("at"), F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), "n", *HALVES)
    lines = stored(lines, "lines")
    each = stored(lines.groupBy("h1", "h2").agg(F.min("at").alias("at"), F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("n", *HALVES))), "each")
    copied = stored(each.where("copies > 1").select("h1", "h2", "at"), "copied")
    chosen = stored(suspects(docs, doc_id, text, each, edit_words), "chosen")
    drop(each)
    keys = stored(neighbourhood(chosen.select("id", "n", "tags", F.split("line", " ").alias("w")), edit_words), "keys")
    least = keys.groupBy("key").agg(*(F.min(F.when(F.col("kind") == k, F.col("id"))).alias(name) for k, name in enumerate("SDO")), F.count("*").alias("c")).where("c > 1").drop("c")
    least = stored(least, "least")
    partner = F.when(F.col("kind") == 0, F.col("S")).when(F.col("kind") == 1, F.col("O")).otherwise(F.col("D"))
    pairs = stored(sieved(keys, "key", least).join(least, "key").select("id", partner.alias("to")).where(F.col("to") < F.col("id")).distinct(), "pairs")
    drop(keys)
    pairs = pairs.join(chosen.select("id", "at", F.col("line").alias("a")), "id").join(chosen.select(F.col("id").alias("to"), F.col("line").alias("b")), "to")
    near = pairs.where(within_one(F.split("a", " "), F.split("b", " "))).select(F.xxhash64("a").alias("h1"), F.xxhash64(F.lit(1), "a").alias("h2"), "at")
    goes = copied.withColumn("near", F.lit(False)).unionByName(near.withColumn("near", F.lit(True)))
    goes = stored(goes.groupBy("h1", "h2").agg(F.min("at").alias("first"), F.max("near").alias("near")), "goes")
    return sieved(lines.select("at", "h1", "h2"), "h1", goes).join(goes, ["h1", "h2"]).where(F.col("near") | (F.col("at") != F.col("first"))).select("at", "near")


def suspects(docs: DataFrame, doc_id: str, text: str, each: DataFrame, edit_words: int) -> DataFrame:
    """(id, at, tags, n, line) of the lines that share a half with another one; ids are in the order of at."""
    keyed = each.select("at", F.explode(halves(edit_words)).alias("x")).select("at", "x.tag", "x.k")
    # a line of m words meets others of m words, and lines of m + 1 meet those of m; the latter do not meet by this hash
    shared = keyed.groupBy("k").agg(F.count_if(F.col("tag") < 2).alias("own"), F.count("*").alias("c")).where("own > 1 or own = 1 and c > 1")
    shared = stored(shared.select("k", (F.col("own") > 1).alias("same"), (F.col("c") > F.col("own")).alias("more")), "halves")
    bit = F.call_function("shiftleft", F.lit(1), F.col("tag"))
    tags = F.when(F.col("tag") < 2, F.when(F.col("same"), bit).otherwise(0).bitwiseOR(F.when(F.col("more"), 16).otherwise(0))).otherwise(bit)
    found = sieved(keyed, "k", shared).join(shared, "k").groupBy("at").agg(F.bit_or(tags).alias("tags"))
    found = stored(found.orderBy("at").withColumn("id", F.monotonically_increasing_id()), "suspects")
    found = stored(found.groupBy("at.did", "at.th").agg(F.collect_list(F.struct("at.no", "tags", "id")).alias("nos")), "suspects")
    rows = docs.select(F.col(doc_id).alias("did"), F.xxhash64(text).alias("th"), F.col(text).alias("t"))
    if (side := small(found)) is found:
        rows = sieved(rows, "th", found)
    rows = rows.alias("d").join(side.alias("s"), F.col("d.did").eqNullSafe(F.col("s.did")) & (F.col("d.th") == F.col("s.th")))
    rows = rows.select("d.did", "d.th", F.split(tidy(F.col("t")), "\n", -1).alias("all"), "nos").select("did", "th", "all", F.explode("nos").alias("x"))
    rows = rows.select("x.id", F.struct("did", "x.no", "th").alias("at"), "x.tags", F.trim(F.get("all", F.col("x.no"))).alias("line")).dropDuplicates(["id"])
    return rows.select("id", "at", "tags", F.size(F.split("line", " ")).alias("n"), "line")


def dropped(docs: DataFrame, doc_id: str, text: str, **how) -> DataFrame:
    """(did, th, nos: sorted line numbers, near: how many of them are edits) of documents that lose lines, stored."""
    with workspace(docs.sparkSession) as keep:
        gone = removed(docs, doc_id, text, **how).select("at.did", "at.th", "at.no", "near").distinct()
        out = gone.groupBy("did", "th").agg(F.array_sort(F.collect_set("no")).alias("nos"), F.sum(F.col("near").cast("long")).alias("near"))
        return keep(stored(out, "dropped"))


def _with(docs: DataFrame, gone: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, str, str]:
    """docs with the line numbers that a row loses and the number of edits among them, and the names of these two columns."""
    names = fresh(docs, "_did", "_th", "_nos", "_near")
    did, th, nos, near = names
    side = small(gone).select(*(F.col(c).alias(n) for c, n in zip(("did", "th", "nos", "near"), names, strict=True)))
    return docs.join(side, F.col(doc_id).eqNullSafe(F.col(did)) & (F.xxhash64(text) == F.col(th)), "left").drop(did, th), nos, near


def kept_text(text: Column, nos: Column) -> Column:
    rest = let(marks(nos, F.transform(nos, lambda n: n + 1)), lambda bits: F.array_join(F.filter(F.split(text, "\n", -1), lambda line, i: ~marked(bits, i)), "\n"))
    return F.when(nos.isNull(), text).otherwise(rest)


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """docs with text less its later copies of lines; rows and other columns stay."""
    out, nos, _ = _with(docs, dropped(docs, doc_id, text, **how), doc_id, text)
    return out.withColumn(text, kept_text(F.col(text), F.col(nos))).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out, nos, near = _with(docs, dropped(docs, "doc_id", "text"), "doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    n = F.coalesce(F.when(F.col(nos).isNotNull(), F.size(nos)), F.lit(0)).cast("long")
    return out.select("doc_id", F.size(F.split(text, "\n", -1)).cast("long").alias("n_lines"), n.alias("n_removed"), F.coalesce(near, F.lit(0)).cast("long").alias("n_near"), F.sha2(kept_text(text, F.col(nos)), 256).alias("kept_sha256"))
