"""Interval coverage by sweep line, and greedy filling of what is missing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moraine.scratch import stored

STRETCH = 4096


def segments(intervals: DataFrame, targets: DataFrame, target: str = "ref_id", start: str = "ref_start", end: str = "ref_end", length: str = "length") -> DataFrame:
    """target, from, to (0-based, half open), depth: runs of constant depth over every target, zero depth included.

    Intervals are 1-based and inclusive; one that passes the end goes on at the start. Cost follows the intervals, not the bases.
    """
    i = intervals.join(targets.select(target, F.col(length).alias("_n")), target).where("_n > 0")
    s0, span = (F.col(start) - 1) % F.col("_n"), F.least(F.col(end) - F.col(start) + 1, F.col("_n"))
    parts = F.when(s0 + span <= F.col("_n"), F.array(F.struct(s0.alias("a"), (s0 + span).alias("b")))).otherwise(F.array(F.struct(s0.alias("a"), F.col("_n").alias("b")), F.struct((s0 * 0).alias("a"), (s0 + span - F.col("_n")).alias("b"))))
    p = i.where(span > 0).select(target, F.explode(parts).alias("p"))
    events = p.select(target, F.explode(F.array(F.struct(F.col("p.a").alias("at"), F.lit(1).alias("d")), F.struct(F.col("p.b").alias("at"), F.lit(-1).alias("d")))).alias("e")).select(target, F.col("e.at").cast("long").alias("at"), "e.d")
    ends = targets.where(F.col(length) > 0).select(target, F.explode(F.array(F.lit(0).cast("long"), F.col(length).cast("long"))).alias("at"), F.lit(0).alias("d"))
    points = events.unionByName(ends).groupBy(target, "at").agg(F.sum("d").alias("d"))
    w = Window.partitionBy(target).orderBy("at")
    out = points.select(target, F.col("at").alias("from"), F.lead("at").over(w).alias("to"), F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("depth"))
    return out.where("to is not null")


def target_stats(segs: DataFrame, target: str = "ref_id") -> DataFrame:
    """proportion covered, mean, population deviation, least and greatest depth by target."""
    w = F.col("to") - F.col("from")
    n, m, m2 = F.sum(w), F.sum(w * F.col("depth")), F.sum(w * F.col("depth") * F.col("depth"))
    return segs.groupBy(target).agg(n.alias("length"), (F.sum(F.when(F.col("depth") > 0, w).otherwise(0)) / n).alias("proportion_covered"), (m / n).alias("mean_depth"), F.sqrt(F.greatest(m2 / n - (m / n) * (m / n), F.lit(0.0))).alias("std_dev"), F.min("depth").alias("min_depth"), F.max("depth").alias("max_depth"))


def windows_taken(lack: np.ndarray, bait_len: int) -> list[int]:
    """Starts of the windows taken one by one where the sum of ``lack`` is greatest (first on ties), each lowering it by one a base.

    A window taken changes the sums of its neighbours only, and the greatest is found among the maxima of blocks of STRETCH
    starts, so a window costs STRETCH and a maximum a block, not the whole target. ``lack`` is changed.
    """
    n = len(lack) - bait_len + 1
    if n <= 0:
        return []

    def sums(a, z):
        run = np.r_[0, np.cumsum(lack[a : z - 1 + bait_len])]
        return run[bait_len:] - run[:-bait_len]

    score = np.r_[sums(0, n), np.full(-n % STRETCH, -1)]
    blocks = score.reshape(-1, STRETCH)
    best = blocks.max(1)
    taken = []
    while best[b := int(np.argmax(best))] > 0:
        at = b * STRETCH + int(np.argmax(blocks[b]))
        taken.append(at)
        lack[at : at + bait_len] = np.maximum(0, lack[at : at + bait_len] - 1)
        a, z = max(0, at - bait_len + 1), min(n, at + bait_len)
        score[a:z] = sums(a, z)
        touched = slice(a // STRETCH, (z - 1) // STRETCH + 1)
        best[touched] = blocks[touched].max(1)
    return taken


def greedy_cover(segs: DataFrame, depth: int, bait_len: int = 80, target: str = "ref_id") -> DataFrame:
    """target, n, start (0-based): windows taken one by one where most depth is missing (first on ties), until none is.

    Sequential within a target, parallel over targets; a target's memory is bounded by its own length.
    """
    kind = dict(segs.dtypes)[target]

    def fill(tab):
        tab = tab.sort_by("from")
        low, high, at_depth = (tab[c].to_numpy() for c in ("from", "to", "depth"))
        starts = windows_taken(np.repeat(np.maximum(0, depth - at_depth), high - low), bait_len)
        return pa.table({target: pa.array([tab[target][0].as_py()] * len(starts), tab.schema.field(target).type), "n": pa.array(range(1, len(starts) + 1), pa.int64()), "start": pa.array(starts, pa.int64())})

    return segs.groupBy(target).applyInArrow(fill, f"`{target}` {kind}, n long, start long")


def recommendations(targets: DataFrame, probes: DataFrame, goal_fraction: float, goal_depth: float) -> DataFrame:
    """severity, category, target, value: one row a rule that fires; an info row where none does."""
    t = F.col("ref_id").cast("string")
    rule = lambda df, sev, cat, who, val: df.select(F.lit(sev).alias("severity"), F.lit(cat).alias("category"), who.alias("target"), val.cast("double").alias("value"))
    out = rule(targets.where(F.col("proportion_covered") < goal_fraction), "high", "coverage_gap", t, F.col("proportion_covered"))
    out = out.unionByName(rule(targets.where(F.col("mean_depth") < goal_depth), "medium", "low_depth", t, F.col("mean_depth")))
    out = out.unionByName(rule(targets.where(F.col("std_dev") > F.greatest("mean_depth", F.lit(1.0))), "medium", "uneven_coverage", t, F.col("std_dev")))
    from moraine.operators.tiles import SITES

    counts = probes.agg(F.count_if(F.col("tm") < 50).alias("a"), F.count_if((F.col("gc_frac") > 0.8) | (F.col("gc_frac") < 0.2)).alias("b"), F.count_if(F.contains(F.upper("seq"), F.lit(SITES[0])) | F.contains(F.upper("seq"), F.lit(SITES[1]))).alias("c"))
    for c, sev, cat in (("a", "medium", "thermodynamics"), ("b", "low", "gc_outliers"), ("c", "high", "opool_compatibility")):
        out = out.unionByName(rule(counts.where(F.col(c) > 0), sev, cat, F.lit("panel"), F.col(c)))
    none = out.agg(F.count("*").alias("k")).where("k = 0")
    return out.unionByName(rule(none, "info", "no_action", F.lit("panel"), F.col("k")))


def augment(targets: DataFrame, probes: DataFrame, depth: int, rounds: int = 5, bait_len: int = 80, accept=None) -> DataFrame:
    """Probes added until nothing is missing, nothing is proposed, or ``accept`` (a DataFrame filter) lets none pass; every round is stored.

    targets: ref_id, length, seq; probes: ref_id, ref_start, ref_end, seq.
    """
    panel = probes.select("ref_id", "ref_start", "ref_end", "seq")
    for _ in range(rounds):
        segs = segments(panel, targets)
        found = greedy_cover(segs, depth, bait_len).join(targets.select("ref_id", F.col("seq").alias("_ref")), "ref_id")
        new = found.select("ref_id", (F.col("start") + 1).alias("ref_start"), (F.col("start") + bait_len).alias("ref_end"), F.substring("_ref", (F.col("start") + 1).cast("int"), F.lit(bait_len)).alias("seq"))
        new = new.join(panel.select(F.upper("seq").alias("_s")).distinct(), F.upper("seq") == F.col("_s"), "left_anti")
        new = accept(new) if accept else new
        new = stored(new, "round")
        if not new.limit(1).count():
            break
        panel = panel.unionByName(new)
    return panel
