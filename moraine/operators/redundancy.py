"""Removal of redundant and complementary probes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moraine.functions import sequence as S
from moraine.scratch import drop, stored


def without_complements(probes: DataFrame, seq: str = "seq", order: str = "bait_id") -> DataFrame:
    """Probes less those whose reverse complement was kept before them in order.

    Within a pair of strands all probes with the strand seen first stay; of its own complement (a palindrome) only the first.
    """
    s = F.upper(seq)
    rc = S.reverse_complement(s)
    w = Window.partitionBy(F.least(s, rc)).orderBy(order)
    out = probes.withColumn("_first", F.first(s).over(w)).withColumn("_n", F.row_number().over(w))
    return out.where((s == F.col("_first")) & ((s != rc) | (F.col("_n") == 1))).drop("_first", "_n")


def distinct_sequences(probes: DataFrame, seq: str = "seq", order: str = "bait_id") -> DataFrame:
    return probes.withColumn("_n", F.row_number().over(Window.partitionBy(F.upper(seq)).orderBy(order))).where("_n = 1").drop("_n")


def new_to_panel(candidates: DataFrame, panel: DataFrame, seq: str = "seq") -> DataFrame:
    """Candidates whose sequence, on either strand, no panel probe has."""
    key = lambda: F.least(F.upper(seq), S.reverse_complement(F.upper(seq)))
    return candidates.withColumn("_k", key()).join(panel.select(key().alias("_k")).distinct(), "_k", "left_anti").drop("_k")


def specific(probes: DataFrame, hits: DataFrame, probe_len: int, several_kingdoms: bool = False, probe_id: str = "bait_id") -> DataFrame:
    """Probes without hits of more than 0.625 of their length; with kingdoms, only hits below 0.975 outside Bacteria count."""
    bad = F.col("nident") > probe_len * 0.625
    if several_kingdoms:
        bad &= F.col("sskingdom").isin("Archaea", "Eukaryota", "Viruses") & (F.col("nident") < probe_len * 0.975)
    return probes.join(hits.where(bad).select(F.col("qseqid").alias(probe_id)).distinct(), probe_id, "left_anti")


def below_identity(probes: DataFrame, hits: DataFrame, min_pident: float = 90.0, probe_id: str = "bait_id") -> DataFrame:
    return probes.join(hits.where(F.col("pident") >= min_pident).select(F.col("qseqid").alias(probe_id)).distinct(), probe_id, "left_anti")


def seed_hits(queries: DataFrame, subjects: DataFrame, k: int = 12, min_ident: int = 30, query_id: str = "bait_id", subject_id: str = "bait_id", seq: str = "seq") -> DataFrame:
    """qseqid, sseqid, sstrand, nident: best ungapped overlap on diagonals where the sequences share a k-mer. An approximation of a local search.

    The join is on k-mers; each (query, subject, diagonal) is compared once.
    """
    def grams(df, name, text):
        return df.select(name, F.explode(S.places(text, k)).alias("x")).select(name, "x.p", F.col("x.kmer").alias("m"))

    q = queries.select(F.col(query_id).alias("qseqid"), F.upper(seq).alias("qs"))
    strands = F.explode(F.array(F.struct(F.lit("plus").alias("strand"), F.upper(seq).alias("t")), F.struct(F.lit("minus").alias("strand"), S.reverse_complement(F.upper(seq)).alias("t"))))
    s = subjects.select(F.col(subject_id).alias("sseqid"), strands.alias("x")).select("sseqid", F.col("x.strand").alias("sstrand"), F.col("x.t").alias("ss"))
    qg = grams(q, "qseqid", F.col("qs"))
    sg = grams(s.withColumn("sid", F.struct("sseqid", "sstrand")), "sid", F.col("ss")).select("sid.sseqid", "sid.sstrand", F.col("p").alias("sp"), "m")
    diag = qg.join(sg, "m").where("qseqid <> sseqid").select("qseqid", "sseqid", "sstrand", (F.col("p") - F.col("sp")).alias("d")).distinct()
    both = diag.join(q, "qseqid").join(s, ["sseqid", "sstrand"])
    a, b = F.greatest(F.col("d"), F.lit(0)), F.greatest(-F.col("d"), F.lit(0))
    n = F.least(F.length("qs") - a, F.length("ss") - b)
    same = F.size(F.filter(F.sequence(F.lit(1), n), lambda i: F.substring("qs", a + i, F.lit(1)) == F.substring("ss", b + i, F.lit(1))))
    return both.withColumn("nident", same).groupBy("qseqid", "sseqid", "sstrand").agg(F.max("nident").alias("nident")).where(F.col("nident") >= min_ident)


def greedy_representatives(pairs: DataFrame, order: DataFrame | None = None) -> DataFrame:
    """ids that a greedy pass drops: by number of partners (then id), greatest first, each id still there drops its partners.

    pairs: (a, b), both ways; order (id, rank), greatest rank first, replaces the number of partners. An id that stands before
    all its live partners is one that the pass reaches before them, so each round keeps all such ids, drops their partners and
    forgets both; rounds are joins and aggregates, whatever the size of a connected component.
    """
    live = stored(pairs.where("a <> b").select("a", "b").distinct(), "pairs")
    if order is None:
        order = live.groupBy(F.col("a").alias("id")).agg(F.count("*").alias("rank"))
    order = stored(order.select("id", "rank"), "order")
    place = lambda x: order.select(F.col("id").alias(x), F.struct("rank", "id").alias("p" + x))
    was, live = live, stored(live.join(place("a"), "a").join(place("b"), "b"), "live")
    drop(was)
    gone = None
    while live.limit(1).count():
        first = stored(live.groupBy("a").agg(F.max(F.col("pb") > F.col("pa")).alias("later")).where("not later").select("a"), "first")
        out = stored(live.join(first, "a").select(F.col("b").alias("id")).distinct(), "gone")
        gone = out if gone is None else gone.unionByName(out)
        done = first.select(F.col("a").alias("id")).unionByName(out)
        rest = live.join(done.withColumnRenamed("id", "a"), "a", "left_anti").join(done.withColumnRenamed("id", "b"), "b", "left_anti")
        was, live = live, stored(rest.select(*live.columns), "live")
        drop(was)
    return pairs.select(F.col("a").alias("id")).where("false") if gone is None else gone


def cluster_representatives(probes: DataFrame, hits: DataFrame, identity: float = 0.95, overlap: float = 0.83, probe_id: str = "bait_id", seq: str = "seq") -> DataFrame:
    """Probes less those that a longer one (a greater id on ties) stands for: ``identity`` of the aligned bases agree, over ``overlap`` of the shorter one.

    hits: qseqid, sseqid, nident, length.
    """
    size = probes.select(F.col(probe_id).alias("id"), F.length(seq).alias("rank"))
    at = lambda x, n: size.select(F.col("id").alias(x), F.col("rank").alias(n))
    near = hits.join(at("qseqid", "n"), "qseqid").join(at("sseqid", "m"), "sseqid").where((F.col("nident") >= identity * F.col("length")) & (F.col("length") >= overlap * F.least("n", "m")))
    both = near.select(F.col("qseqid").alias("a"), F.col("sseqid").alias("b")).unionByName(near.select(F.col("sseqid").alias("a"), F.col("qseqid").alias("b")))
    return probes.join(greedy_representatives(both, size).withColumnRenamed("id", probe_id), probe_id, "left_anti")


def without_similar(probes: DataFrame, hits: DataFrame, min_ident: int = 30, identities: tuple[int, ...] = (), probe_id: str = "bait_id") -> DataFrame:
    """Probes less complements of others, then less similar ones, from the greatest number of identities down.

    hits: qseqid, sseqid, sstrand, nident. Of minus-strand hits of ``min_ident`` identities the partners that are not queries
    themselves go; of plus-strand hits, at each of the descending ``identities`` a greedy pass over what is left.
    """
    h = stored(hits.where("qseqid <> sseqid").select("qseqid", "sseqid", "sstrand", "nident"), "hits")
    minus = h.where((F.col("sstrand") == "minus") & (F.col("nident") >= min_ident))
    both = minus.select(F.col("qseqid").alias("a"), F.col("sseqid").alias("b")).unionByName(minus.select(F.col("sseqid").alias("a"), F.col("qseqid").alias("b")))
    out = probes.join(greedy_representatives(both).withColumnRenamed("id", probe_id), probe_id, "left_anti")
    for least in sorted(identities, reverse=True):
        out = stored(out, "probes")
        ids = out.select(F.col(probe_id).alias("id"))
        near = h.where((F.col("sstrand") == "plus") & (F.col("nident") >= least))
        near = near.join(ids.withColumnRenamed("id", "qseqid"), "qseqid", "left_semi").join(ids.withColumnRenamed("id", "sseqid"), "sseqid", "left_semi")
        both = near.select(F.col("qseqid").alias("a"), F.col("sseqid").alias("b")).unionByName(near.select(F.col("sseqid").alias("a"), F.col("qseqid").alias("b")))
        out = out.join(greedy_representatives(both).withColumnRenamed("id", probe_id), probe_id, "left_anti")
    return out
