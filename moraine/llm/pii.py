"""Personal data by fixed formats and by bootstrapped contexts, with DataFrame operations only.

Base formats (email, ip, card, phone) are matched by regular expressions with possessive repeats, so no text makes them
backtrack without end. Their matches are seeds. Each seed induces lexical patterns: its two words to the left, and its
neighbours on both sides; a word that does not end within ``AROUND`` characters of the value induces none. Candidates are
tokens with a digit or "@", and runs of digits with spaces, brackets, dots or hyphens between them, where no base match is.
Over the graph of patterns and values, a pattern's confidence for a kind is the mean score of the distinct values it extracts
(seeds of the kind 1, other kinds 0, candidates their current score), and a candidate's score is the noisy-or of its
patterns; scores only rise from round to round, and rounds go on until none rises by more than ``settled``. Candidates of a
fitting shape that reach ``accept`` through patterns with at least ``support`` seeds become spans of that kind. Edges are
distinct before any join, and joins are by pattern, which Spark may split when skewed.

Null texts count as empty. Empty texts, texts without matches and an empty table give no spans; repeated rows get the same
spans each; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.llm.common import small, stored, table, workspace
from moraine.llm.spans import cut_out, located

KINDS = ("email", "ip", "card", "phone")
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold before a pattern is tried.
CHEAP = {"email": "@", "ip": r"[0-9]\.[0-9]+\.[0-9]", "card": r"[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
#: Shapes that a discovered value of a kind may have.
SHAPES = {"email": r"^[^@\s]+@[^@\s]+$", "ip": r"^[0-9]+(?:[.:][0-9]+){3,}$", "card": r"^(?:[^0-9]*[0-9]){12,24}[^0-9]*$", "phone": r"^\+?(?:[ ().-]*[0-9]){7,15}$"}
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Digits with up to three separators between them.
GROUPS = r"[(]?+[+]?+[0-9](?:[ ().-]{0,3}+[0-9])++"
AROUND = 128
FILL = "\x01"
MOST_ROUNDS = 100
SPAN = "array<struct<start:int,end:int,value:string,pre:string,post:string>>"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    def step(acc, i):
        d = F.substring(number, F.length(number) - i + 1, F.lit(1)).cast("int")
        d = F.when(i % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)
        return acc + d

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), step) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    n = F.length(digits(value))
    return n.between(16, 19) & F.when(n.between(16, 19), luhn(digits(value))) if kind == "card" else n.between(8, 15)


def base_spans(text: Column, kind: str) -> Column:
    found = F.filter(located(text, PATTERNS[kind], AROUND + 1, AROUND + 1), lambda s: F.coalesce(valid(kind, s["value"]), F.lit(False)))
    return F.when(F.contains(text, F.lit("@")) if kind == "email" else text.rlike(CHEAP[kind]), found).otherwise(F.expr(f"cast(array() as {SPAN})"))


def contexts(pre: Column, post: Column) -> Column:
    """Pattern strings of a mention; a context with too few whole words gives none. pre and post have one character more than AROUND where the text goes on."""
    norm = lambda c: F.regexp_replace(F.lower(c), "[0-9]", "0")
    before, behind = F.when(F.length(pre) > AROUND, pre).otherwise(F.concat(F.lit(" "), pre)), F.when(F.length(post) > AROUND, post).otherwise(F.concat(post, F.lit(" ")))
    left = norm(F.regexp_extract(before, r"\s(\S+\s+\S+)\s*$", 1))
    one, after = norm(F.regexp_extract(before, r"\s(\S+)\s*$", 1)), norm(F.regexp_extract(behind, r"^\s*(\S+)\s", 1))
    return F.filter(F.array(F.when(left != "", F.concat(F.lit("L|"), left)), F.when((one != "") & (after != ""), F.concat(F.lit("B|"), one, F.lit("|"), after))), lambda x: x.isNotNull())


def tidied(s: Column) -> Column:
    """The span less quotes, brackets around it and punctuation behind it; round brackets stay where both are there."""
    value = s["value"]
    head = F.length(F.regexp_extract(value, r"^(?:[\"'\[<]|\((?![^)]*\)))*+", 0))
    closed = F.regexp_replace(F.substring(value, head + 1, F.length(value)), r"[\"'\]>,;:!?.]+$", "")
    closed = F.when(~F.contains(closed, F.lit("(")), F.regexp_replace(closed, r"[\"')\]>,;:!?.]+$", "")).otherwise(closed)
    start = s["start"] + head
    return F.struct(start.alias("start"), (start + F.length(closed)).alias("end"), closed.alias("value"), s["pre"].alias("pre"), s["post"].alias("post"))


def analysed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(did, th, email, ip, card, phone, cand) for each row, stored."""
    rows = docs.select(F.col(doc_id).alias("did"), F.xxhash64(text).alias("th"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    touched = F.col("t").rlike("[0-9@]")
    none = F.expr(f"cast(array() as {SPAN})")
    rows = rows.select("did", "th", "t", *(F.when(touched, base_spans(F.col("t"), k)).otherwise(none).alias(k) for k in KINDS))
    for k in KINDS:
        rows = rows.withColumn("t", F.when(touched, cut_out(F.col("t"), F.col(k), FILL)).otherwise(F.lit("")))
    tokens = F.filter(located(F.col("t"), TOKEN, AROUND + 1, AROUND + 1), lambda s: ~F.contains(s["value"], F.lit(FILL)))
    groups = F.filter(located(F.col("t"), GROUPS, AROUND + 1, AROUND + 1), lambda s: s["value"].rlike("[ ()]"))
    cand = F.transform(F.concat(tokens, F.when(F.col("t").rlike("[0-9][ ().-]*[ ()][ ().-]*[0-9]"), groups).otherwise(none)), tidied)
    rows = rows.select("did", "th", *KINDS, F.when(F.col("t").rlike("[0-9@]"), cand).otherwise(none).alias("cand"))
    return stored(rows, "pii")


def discover(rows: DataFrame, accept: float = 0.8, support: int = 3, settled: float = 0.001) -> DataFrame:
    """(did, th, kind, start, end) of spans that contexts reveal."""
    seeds = None
    for k in KINDS:
        one = rows.select(F.lit(k).alias("kind"), F.explode(k).alias("s")).select("kind", F.col("s.value").alias("value"), F.explode(contexts(F.col("s.pre"), F.col("s.post"))).alias("pattern"))
        seeds = one if seeds is None else seeds.unionByName(one)
    seeds = seeds.groupBy("pattern", "kind", "value").agg(F.lit(1).alias("x")).groupBy("pattern", "kind").agg(F.count("*").alias("seeds"))
    seeds = stored(seeds, "seeds")
    mentions = rows.select("did", "th", F.explode("cand").alias("s"))
    mentions = mentions.select("did", "th", "s.start", "s.end", "s.value", contexts(F.col("s.pre"), F.col("s.post")).alias("ps")).where("value <> ''")
    fits = F.array_compact(F.array(*(F.when(F.col("value").rlike(SHAPES[k]), F.lit(k)) for k in KINDS)))
    mentions = stored(mentions.withColumn("fits", fits), "mentions")
    edges = mentions.select("value", "fits", F.explode("ps").alias("pattern")).groupBy("pattern", "value").agg(F.first("fits").alias("fits"))
    edges = stored(edges.join(seeds.select("pattern").distinct(), "pattern", "left_semi"), "edges")
    totals = edges.groupBy("pattern").agg(F.count("*").alias("cands"))
    all_seeds = seeds.groupBy("pattern").agg(F.sum("seeds").alias("all_seeds"))
    strong = seeds.where(F.col("seeds") >= support).join(all_seeds, "pattern").join(totals, "pattern")
    strong = stored(strong, "patterns")
    graph = stored(edges.select("pattern", "value", F.explode("fits").alias("kind")).join(strong, ["pattern", "kind"]), "graph")
    score = stored(graph.select("kind", "value").distinct().withColumn("score", F.lit(0.0)), "scores")
    for _ in range(MOST_ROUNDS):
        gained = graph.join(score, ["kind", "value"]).groupBy("pattern", "kind").agg(F.sum("score").alias("gained"))
        sure = gained.join(strong, ["pattern", "kind"]).select("pattern", "kind", ((F.col("seeds") + F.col("gained")) / (F.col("all_seeds") + F.col("cands"))).alias("conf"))
        new = graph.select("pattern", "kind", "value").join(sure, ["pattern", "kind"]).groupBy("kind", "value").agg((1 - F.exp(F.sum(F.log(1 - F.least("conf", F.lit(0.999)))))).alias("score"))
        was, score = score, stored(new, "scores")
        if (score.join(was.withColumnRenamed("score", "was"), ["kind", "value"]).agg(F.max(F.col("score") - F.col("was"))).first()[0] or 0) <= settled:
            break
    else:
        raise RuntimeError("scores did not settle")
    found = score.where(F.col("score") >= accept)
    best = found.groupBy("value").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))
    return mentions.where(F.size("fits") > 0).join(best, "value").where(F.array_contains("fits", F.col("kind"))).select("did", "th", "kind", "start", "end").distinct()


def detect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """doc_id, th (hash of the text), arrays of base spans by kind, and added: array<struct<kind,start,end>>."""
    with workspace(docs.sparkSession) as keep:
        rows = keep(analysed(docs, doc_id, text))
        extra = keep(stored(discover(rows, **how).groupBy("did", "th").agg(F.array_sort(F.collect_set(F.struct("kind", "start", "end"))).alias("added")), "added"))
    out = rows.alias("r").join(small(extra).alias("x"), F.col("r.did").eqNullSafe(F.col("x.did")) & (F.col("r.th") == F.col("x.th")), "left")
    none = F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)")
    return out.select(F.col("r.did").alias("doc_id"), F.col("r.th").alias("th"), *KINDS, F.coalesce("added", none).alias("added"))


def written(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = detect(table(spark, sf_dir, "documents"))
    places = lambda k: F.transform(F.col(k), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    more = lambda k: F.transform(F.filter("added", lambda a: a["kind"] == k), lambda a: F.struct(a["start"].alias("start"), a["end"].alias("end")))
    base = F.concat(*(written(k, F.col(k)) for k in KINDS))
    every = F.concat(*(written(k, F.array_sort(F.array_distinct(F.concat(places(k), more(k))))) for k in KINDS))
    return got.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(every, ",").alias("spans"), F.size("added").cast("long").alias("n_added"))
