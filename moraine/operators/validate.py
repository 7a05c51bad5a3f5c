"""Validation of a panel against its targets: hit choice, placements, match strings, and what a panel must fulfil."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moraine.functions import sequence as S
from moraine.functions.names import squeezed
from moraine.scratch import drop, small, stored


def subject_start(start: Column, end: Column, same_strand: Column) -> Column:
    """Where a hit begins on the subject's plus strand."""
    return F.when(same_strand, start).otherwise(end)


def match_bits(match: Column, subject: Column) -> Column:
    """A string of 1 and 0 for each base of the subject under a hit: "|" of the match line is 1, columns that are gaps in the subject go."""
    kept = F.zip_with(F.split(match, ""), F.split(subject, ""), lambda m, s: F.when(s != "-", F.when(m == "|", "1").otherwise("0")).otherwise(""))
    return F.array_join(kept, "")


def valid_hits(hits: DataFrame, probe_len: int) -> DataFrame:
    """Hits with more identities than 0.625 of a probe and no two gaps running in the subject."""
    return hits.where((F.col("identities") > int(probe_len * 0.625)) & ~F.contains("subject", F.lit("--")))


def primary_hits(hits: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """The best hit of each probe: on the expected target, nearest to the expected start, then most identities, longest, best score, first.

    hits: probe, target, subject_start, identities, align_length, bits; expected: probe, target_id, start (null where not known).
    """
    rows = hits
    if expected is not None:
        rows = rows.join(expected.select(F.col("probe"), F.col("target_id").alias("_t"), F.col("start").alias("_s")), "probe", "left")
    else:
        rows = rows.withColumn("_t", F.lit(None).cast("string")).withColumn("_s", F.lit(None).cast("long"))
    away = F.when(F.col("_t").isNotNull() & (F.col("target") != F.col("_t")), 1).otherwise(0)
    far = F.coalesce(F.abs(F.col("subject_start") - F.col("_s")), F.lit(0))
    order = F.struct(away, far, -F.col("identities"), -F.col("align_length"), -F.col("bits"), F.col("subject_start"), F.col("target"))
    best = F.min_by(F.struct(*(F.col(c) for c in hits.columns if c != "probe")), order)
    return rows.groupBy("probe").agg(best.alias("_b")).select("probe", "_b.*")


def resolved(hints: DataFrame, targets: DataFrame, hint: str = "ref_hint", target: str = "ref_id") -> DataFrame:
    """hint, target_id: the target that a hint names: equal, equal when squeezed, the only one that holds it or that it holds, the
    only one that holds one of its accession numbers, or the only target at all; null without any.

    The first two are joins on keys. Containment has no key, so only distinct hints that are still open meet the targets.
    """
    t = targets.select(F.col(target).cast("string").alias("t")).distinct().withColumn("tn", squeezed(F.col("t")))
    h = stored(hints.select(F.col(hint).cast("string").alias("h")).distinct().withColumn("hn", squeezed(F.col("h"))), "hints")
    only = t.agg(F.when(F.count("*") == 1, F.min("t")).alias("only"))
    same = h.join(t, F.col("h") == F.col("t")).select("h", "t", F.lit(1).alias("tier"))
    one = lambda df, tier: df.groupBy("h").agg(F.count("*").alias("n"), F.min("t").alias("t")).where("n = 1").select("h", "t", F.lit(tier).alias("tier"))
    known = stored(same.unionByName(one(h.join(t, F.col("hn") == F.col("tn")), 2)), "named")
    open_ = small(stored(h.join(known.select("h").distinct(), "h", "left_anti").where("h <> ''"), "open"))
    held = one(t.join(open_, (F.col("hn") != "") & (F.contains("tn", F.col("hn")) | ((F.col("tn") != "") & F.contains("hn", F.col("tn"))))), 3)
    marks = open_.select("h", F.posexplode(F.regexp_extract_all("h", F.lit(r"[A-Z]{1,4}[_-]?\d+(?:\.\d+)?"), F.lit(0))).alias("i", "a")).select("h", "i", squeezed(F.col("a")).alias("an"))
    by_mark = t.join(F.broadcast(marks), F.contains("tn", F.col("an"))).groupBy("h", "i").agg(F.count("*").alias("n"), F.min("t").alias("t")).where("n = 1")
    by_mark = by_mark.groupBy("h").agg(F.min_by("t", "i").alias("t")).select("h", "t", F.lit(4).alias("tier"))
    best = known.unionByName(held).unionByName(by_mark).groupBy("h").agg(F.min_by("t", "tier").alias("t"))
    out = hints.select(F.col(hint).alias(hint)).distinct().join(best, F.col(hint).cast("string").eqNullSafe(F.col("h")), "left")
    return out.join(F.broadcast(only)).select(hint, F.coalesce("t", "only").alias("target_id"))


def placements(probes: DataFrame, hits: DataFrame, probe_len: int) -> DataFrame:
    """probe, ref_id, ref_start, ref_end, source: where each probe counts for coverage, once: its trusted place, else its primary hit.

    probes: probe, target_id, start, end, trusted; hits as in primary_hits with a match line.
    """
    own = probes.where(F.col("trusted") & F.col("target_id").isNotNull() & F.col("start").isNotNull())
    first = own.select("probe", F.col("target_id").alias("ref_id"), F.col("start").alias("ref_start"), F.col("end").alias("ref_end"), F.lit("id").alias("source"))
    rest = hits.join(own.select("probe"), "probe", "left_anti")
    best = primary_hits(valid_hits(rest, probe_len), probes.select("probe", "target_id", "start"))
    size = F.length(match_bits(F.col("match"), F.col("subject")))
    found = best.select("probe", F.col("target").alias("ref_id"), F.col("subject_start").alias("ref_start"), (F.col("subject_start") + size - 1).alias("ref_end"), F.lit("hit").alias("source"))
    return first.unionByName(found)


def modal(rows: DataFrame, column: str) -> DataFrame:
    """One row: the commonest value of a column, the greatest on ties."""
    return rows.groupBy(column).agg(F.count("*").alias("n")).agg(F.max_by(column, F.struct("n", F.col(column))).alias(column), F.max("n").alias("n"))


def cut_regions(refs: DataFrame, regions: DataFrame, least: int, ref_id: str = "ref_id", seq: str = "seq") -> DataFrame:
    """ref_id, seq: references less the regions (ref_id, a, b; 0-based, end exclusive), as the pieces of at least ``least`` bases that
    are left, named by their places. References without regions stay as they are."""
    w = Window.partitionBy("_r").orderBy("a", "b")
    r = regions.select(F.col(ref_id).alias("_r"), "a", "b").distinct()
    r = r.withColumn("_top", F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn("_new", F.coalesce(F.col("a") > F.col("_top"), F.lit(True)).cast("int"))
    r = r.withColumn("_g", F.sum("_new").over(w)).groupBy("_r", "_g").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    gaps = r.groupBy("_r").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("_x"))
    rows = refs.select(F.col(ref_id).alias("ref_id"), F.col(seq).alias("seq")).join(gaps, F.col("ref_id") == F.col("_r"), "left")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("_x", lambda x: x["b"].cast("long")))
    ends = F.concat(F.transform("_x", lambda x: x["a"].cast("long")), F.array(F.length("seq").cast("long")))
    kept = F.filter(F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("s"), e.alias("e"))), lambda p: p["e"] - p["s"] >= least)
    cut = S.let(F.encode("seq", "UTF-32"), lambda wide: F.transform(kept, lambda p: F.struct(F.concat(F.col("ref_id").cast("string"), F.lit("_["), p["s"], F.lit(":"), p["e"], F.lit("]")).alias("id"), F.decode(F.substring(wide, (4 * p["s"] + 1).cast("int"), (4 * (p["e"] - p["s"])).cast("int")), "UTF-32").alias("seq"))))
    whole = F.array(F.struct(F.col("ref_id").cast("string").alias("id"), F.col("seq")))
    return rows.select(F.explode(F.when(F.col("_x").isNull(), whole).otherwise(cut)).alias("p")).select(F.col("p.id").alias("ref_id"), "p.seq")


def without_complementary_regions(refs: DataFrame, search, probe_len: int, min_ident: int = 30, rounds: int = 1000) -> DataFrame:
    """References less what is complementary to the commonest query, again and again until no hit is left.

    ``search(refs)`` gives minus-strand hits of the references among themselves (qseqid, sseqid, nident, sstart, send; places
    1-based); each round is stored. A search that never ends is an error after ``rounds``.
    """
    now = stored(refs.select(F.col("ref_id").cast("string").alias("ref_id"), "seq"), "refs")
    for _ in range(rounds):
        hits = stored(search(now).where(F.col("nident") >= min_ident), "hits")
        top = modal(hits, "qseqid").first()
        if top is None or top.qseqid is None:
            return now
        regions = hits.where(F.col("qseqid") == top.qseqid).select(F.col("sseqid").alias("ref_id"), F.least("sstart", "send").alias("a"), F.greatest("sstart", "send").alias("b"))
        was, now = now, stored(cut_regions(now, regions, probe_len), "refs")
        drop(was, hits)
    raise RuntimeError("complementary regions did not end")


def screened(candidates: DataFrame, panel: DataFrame, hits: DataFrame, identity: float = 0.95, overlap: float = 0.83, min_ident: int = 30, probe_id: str = "bait_id") -> DataFrame:
    """Candidates that no panel probe equals on either strand, or comes near: on the plus strand by shares of the query's length, on
    the minus strand by identities. hits: qseqid, sstrand, nident, length, qlen."""
    from moraine.operators.redundancy import new_to_panel

    plus = (F.col("sstrand") == "plus") & (F.col("nident") >= F.col("qlen") * identity) & (F.col("length") >= F.col("qlen") * overlap)
    minus = (F.col("sstrand") == "minus") & (F.col("nident") >= min_ident)
    bad = hits.where(plus | minus).select(F.col("qseqid").alias(probe_id)).distinct()
    return new_to_panel(candidates, panel).join(bad, probe_id, "left_anti")


def uniform_length(probes: DataFrame, seq: str = "seq") -> int:
    """The length that all probes have; other panels, and empty ones, are an error."""
    got = probes.agg(F.min(F.length(seq)).alias("a"), F.max(F.length(seq)).alias("b")).first()
    if got.a is None or got.a != got.b:
        raise ValueError(f"probes must all have one length, not {got.a} to {got.b}")
    return got.a


def within_total(refs: DataFrame, most: int, seq: str = "seq") -> int:
    """Bases in all references; more than ``most`` (if any is set) is an error."""
    total = refs.agg(F.sum(F.length(seq))).first()[0] or 0
    if most and total > most:
        raise ValueError(f"{total} bases are more than the {most} allowed")
    return total


def recommendation_counts(rows: DataFrame) -> DataFrame:
    """actionable, informational: how many recommendations ask for something, and how many only inform."""
    info = F.lower("severity") == "info"
    return rows.agg(F.count_if(~info).alias("actionable"), F.count_if(info).alias("informational"))
