"""Probe tiling and the filter funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moraine.functions import sequence as S

# The type IIS site that a probe must not hold, both strands, and the promoter put before every probe.
SITES = ("GAAGAGC", "GCTCTTC")
PROMOTER = "GCTAATACGACTCACTATAGGG"


def step_of(length: int, density: float) -> int:
    """Distance between probe starts; halves round to even."""
    return max(1, round(length / density))


def metrics(probes: DataFrame, seq: str = "seq") -> DataFrame:
    s = F.col(seq)
    return probes.withColumns({"gc_frac": S.gc_of_length(s), "masked_frac": S.masked_fraction(s), "ambiguous_count": S.ambiguous_count(s), "tm": F.coalesce(S.melting_point(s), F.lit(0.0))})


def tile(refs: DataFrame, bait_len: int = 80, density: float = 3.0, omit: int = 70, pad_min: int = 71, circular: Column | bool = False, ref_id: str = "ref_id", seq: str = "seq") -> DataFrame:
    """bait_id, ref_id, ref_start, ref_end (1-based, inclusive), seq: probes of each reference.

    Up to ``omit`` bases give none; from ``pad_min`` to below a probe's length one padded with T; else starts at every step and
    one flush with the end, or, where circular, starts all round with the end of the sequence joined to its start.
    """
    ring = F.lit(circular) if isinstance(circular, bool) else circular
    n, step = F.length(seq), step_of(bait_len, density)
    usual = F.array_distinct(F.concat(F.sequence(F.lit(0), n - bait_len, F.lit(step)), F.array(n - bait_len)))
    starts = F.when(n <= omit, F.array().cast("array<int>")).when(n < bait_len, F.when(n >= pad_min, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))).when(ring, F.sequence(F.lit(0), n - 1, F.lit(step))).otherwise(usual)
    ref = F.col(seq)
    long_ = n >= bait_len
    # characters of four bytes each have known places, so a probe is cut without a walk from the start
    at = lambda wide, s: F.decode(F.substring(wide, 4 * s + 1, F.lit(4 * bait_len)), "UTF-32")
    cut = S.let(F.encode(F.concat(ref, F.substring(ref, 1, bait_len)), "UTF-32"), lambda wide: F.transform(starts, lambda s, i: F.struct(i.alias("i"), s.alias("s"), at(wide, s).alias("seq"))))
    pad = F.transform(starts, lambda s, i: F.struct(i.alias("i"), s.alias("s"), F.rpad(ref, bait_len, "T").alias("seq")))
    rows = refs.withColumns({"_n": n, "_x": F.when(long_, cut).otherwise(pad)}).select(F.col(ref_id).alias("ref_id"), "_n", F.explode("_x").alias("x")).select("ref_id", "_n", "x.*")
    end = F.when(F.col("_n") >= bait_len, F.col("s") + bait_len).otherwise(F.col("_n"))
    name = F.concat(F.col("ref_id").cast("string"), F.lit("|b"), F.col("i") + 1, F.lit("|pos"), F.col("s") + 1, F.lit("-"), F.col("s") + bait_len)
    return rows.select(name.alias("bait_id"), "ref_id", (F.col("s") + 1).alias("ref_start"), end.alias("ref_end"), "seq")


def per_sequence(probes: DataFrame, seq: str = "seq", target: str = "ref_id") -> DataFrame:
    """bait_seq, n_targets, n_probes: distinct targets and probes of each sequence."""
    return probes.groupBy(F.col(seq).alias("bait_seq")).agg(F.count_distinct(target).alias("n_targets"), F.count("*").alias("n_probes"))


def funnel(probes: DataFrame, max_ambiguous: int = 10, max_masked: float = 0.25, min_tm: float = 50.0) -> DataFrame:
    """stage: the number of filters passed before the first failure (ambiguous, masked, tm, site), 4 for survivors."""
    fails = (F.col("ambiguous_count") >= max_ambiguous, F.col("masked_frac") > max_masked, F.col("tm") < min_tm, F.contains(F.upper("seq"), F.lit(SITES[0])) | F.contains(F.upper("seq"), F.lit(SITES[1])))
    out = None
    for i, f in enumerate(fails):
        out = F.when(f, i) if out is None else out.when(f, i)
    return probes.withColumn("stage", out.otherwise(len(fails)))


def stage_counts(probes: DataFrame, stages: int = 4) -> DataFrame:
    """How many probes of each reference were left after each stage, in one pass."""
    return probes.groupBy("ref_id").agg(F.count("*").alias("tiled"), *(F.count_if(F.col("stage") > i).alias(f"after_{i + 1}") for i in range(stages)))


def probe_stats(probes: DataFrame) -> DataFrame:
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return probes.agg(F.count("*").alias("n"), *(zero(f(c)).alias(f"{c}_{f.__name__}") for c in ("gc_frac", "tm") for f in (F.avg, F.min, F.max)), zero(F.avg("masked_frac")).alias("masked_frac_avg"), zero(F.avg(F.col("ambiguous_count"))).alias("ambiguous_count_avg"))


def estimated(lengths: DataFrame, densities: list[float], bait_len: int = 80, omit: int = 70, pad_min: int = 71, length: str = "length") -> DataFrame:
    """density, n: probes that linear tiling would make of references with those lengths."""
    n = F.col(length)
    out = []
    for d in densities:
        s = step_of(bait_len, d)
        k = F.floor((n - bait_len) / s) + 1
        each = F.when(n <= omit, 0).when(n < bait_len, F.when(n >= pad_min, 1).otherwise(0)).otherwise(k + F.when((k - 1) * s != n - bait_len, 1).otherwise(0))
        out.append(F.sum(each).alias(f"d{len(out)}"))
    got = lengths.agg(*out)
    return got.select(F.explode(F.array(*(F.struct(F.lit(float(d)).alias("density"), F.coalesce(F.col(f"d{i}"), F.lit(0)).cast("long").alias("n")) for i, d in enumerate(densities)))).alias("x")).select("x.*")


def chosen_density(lengths: DataFrame, most: int, least: float, wanted: float, bait_len: int = 80, **limits) -> tuple[float, int]:
    """(density, estimate): the wanted density if it keeps to ``most`` probes, else bisected down to the least.

    The lengths are reduced to a histogram first, which the bisection reads on the driver: one row a distinct length.
    """
    hist = {r["length"]: r["n"] for r in lengths.groupBy("length").agg(F.count("*").alias("n")).collect()}
    omit, pad = limits.get("omit", 70), limits.get("pad_min", 71)

    def count(d: float) -> int:
        s, total = step_of(bait_len, d), 0
        for length, n in hist.items():
            if length >= bait_len and length > omit:
                total += n * (-(-(length - bait_len) // s) + 1)
            elif pad <= length and length > omit:
                total += n
        return total

    if most <= 0 or count(wanted) <= most:
        return wanted, count(wanted)
    if count(least) > most:
        return least, count(least)
    low, high = least, wanted
    best = least
    for _ in range(25):
        mid = (low + high) / 2
        if count(mid) <= most:
            best = low = mid
        else:
            high = mid
        if high - low < 1e-3:
            break
    return best, count(best)


def softmasked(refs: DataFrame, k: int = 15, threshold: int = 3, ref_id: str = "ref_id", seq: str = "seq") -> DataFrame:
    """Sequences with every base under a k-mer that occurs ``threshold`` times in all of them in lower case.

    Windows travel as 64-bit hashes and are counted by a partial aggregate; the places of repeated ones come back by an
    equi-join on the hash, and runs of them become islands in the reference's own row.
    """
    s = F.upper(seq)
    hashed = S.by_blocks(s, k, lambda t, c, n: F.transform(F.sequence(F.lit(1), n), lambda j: S.let(F.substring(t, j, F.lit(k)), lambda w: F.struct((c + j - 1).alias("p"), F.when(~F.contains(w, F.lit("N")), F.xxhash64(w)).alias("h")))))
    places = refs.select(F.col(ref_id).alias("_id"), F.explode(hashed).alias("x")).select("_id", "x.p", "x.h").where("h is not null")
    often = places.groupBy("h").agg(F.count("*").alias("c")).where(F.col("c") >= threshold).select("h")
    hit = places.join(often, "h", "left_semi").groupBy("_id").agg(F.array_sort(F.collect_list("p")).alias("_p"))
    out = refs.join(hit, F.col(ref_id) == F.col("_id"), "left")
    p = F.col("_p")
    before = F.concat(F.array(F.lit(None).cast("int")), F.slice(p, 1, F.size(p) - 1))
    after = F.concat(F.slice(p, 2, F.size(p)), F.array(F.lit(None).cast("int")))
    edges = lambda other, far: F.filter(F.zip_with(p, other, lambda x, y: F.when(F.coalesce(far(x, y) > k, F.lit(True)), x)), lambda x: x.isNotNull())
    starts, ends = edges(before, lambda x, y: x - y), edges(after, lambda x, y: y - x)
    piece = lambda wide, a, e: F.decode(F.substring(wide, 4 * a + 1, 4 * (e - a)), "UTF-32")

    def rebuilt(x):
        wide, a, e = x["wide"], x["a"], F.transform(x["e"], lambda v: v + k)
        gaps = F.zip_with(F.concat(F.array(F.lit(0)), e), F.concat(a, F.array(F.length(s))), lambda f, t: piece(wide, f, t))
        runs = F.concat(F.zip_with(a, e, lambda f, t: F.lower(piece(wide, f, t))), F.array(F.lit("")))
        return F.array_join(F.zip_with(gaps, runs, lambda g, r: F.concat(g, r)), "")

    done = S.let(F.struct(F.encode(s, "UTF-32").alias("wide"), starts.alias("a"), ends.alias("e")), rebuilt)
    return out.withColumn(seq, F.when(p.isNull(), s).otherwise(done)).drop("_id", "_p")


def probe_place(probe_id: Column, length: Column) -> Column:
    """struct(ref_hint, start, end, scheme, trusted) from "ref|x|posA-B", "ref_posA-B" or "ref_N"."""
    forms = (("explicit_pos", r"^(.+)\|[^|]+\|pos(\d+)-(\d+)$"), ("suffix_pos", r"^(.+)_pos(\d+)-(\d+)$"), ("suffix_start0", r"^(.+)_(\d+)$"))
    out = None
    for scheme, rx in forms:
        a = F.regexp_extract(probe_id, rx, 2).cast("long")
        start, end = (a + 1, a + length) if scheme == "suffix_start0" else (a, F.regexp_extract(probe_id, rx, 3).cast("long") if scheme != "suffix_start0" else a)
        made = F.struct(F.regexp_extract(probe_id, rx, 1).alias("ref_hint"), start.alias("start"), end.alias("end"), F.lit(scheme).alias("scheme"), F.lit(scheme != "suffix_start0").alias("trusted"))
        out = F.when(probe_id.rlike(rx), made) if out is None else out.when(probe_id.rlike(rx), made)
    none = F.struct(F.lit(None).cast("string").alias("ref_hint"), F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("end"), F.lit("none").alias("scheme"), F.lit(False).alias("trusted"))
    return out.otherwise(none)


def primer_candidates(spark, length: int = 18, suffix: str = "GCTCTTCG", window: float | None = None) -> DataFrame:
    """Every primer with the fixed suffix, no letter three times running and no site but the suffix's, as a distributed range.

    With a window only primers that melt less than so many degrees from the promoter.
    """
    k = length - len(suffix)
    letters = F.lit("ACGT")
    digits = F.transform(F.sequence(F.lit(k - 1), F.lit(0), F.lit(-1)), lambda i: F.substring(letters, (F.floor(F.col("id") / F.pow(F.lit(4), i)) % 4 + 1).cast("int"), F.lit(1)))
    seq = F.concat(F.array_join(digits, ""), F.lit(suffix))
    out = spark.range(4**k).select(seq.alias("primer"))
    out = out.where(~F.col("primer").rlike("AAA|TTT|GGG|CCC") & ~F.contains("primer", F.lit(SITES[0])) & ~F.contains(F.substring("primer", 1, length - 2), F.lit(SITES[1])))
    if window is None:
        return out
    return out.where(F.abs(S.dna_melting_point(F.col("primer")) - S.dna_melting_point(F.lit(PROMOTER))) < window)


def best_primer(hits: DataFrame) -> DataFrame:
    """The query with the least sum of identities to the panel (first id on ties)."""
    return hits.groupBy("qseqid").agg(F.sum("nident").alias("total")).agg(F.min_by("qseqid", F.struct("total", "qseqid")).alias("primer_id"), F.min("total").alias("total"))


def oligos(probes: DataFrame, primer: str, seq: str = "seq") -> DataFrame:
    """Promoter, probe and the primer's reverse complement."""
    rc = primer.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    if not rc.startswith("CGAAGAGC"):
        raise ValueError("the primer's reverse complement must begin with CGAAGAGC")
    return probes.withColumn("oligo", F.concat(F.lit(PROMOTER), F.upper(seq), F.lit(rc)))
