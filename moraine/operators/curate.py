"""Curation of sequence records: metrics, reasons, score, caps, rescues, coverage.

Records carry ordinal (their place in the input), accession, header and seq; every operator keeps other columns.
Reasons are an array in order of insertion, without repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moraine.config import CURATE
from moraine.functions import sequence as S
from moraine.operators import rules as R


def metrics(records: DataFrame, seq: str = "seq") -> DataFrame:
    s = F.upper(seq)
    return records.withColumns({
        "length": F.length(s), "n_count": S.count_in(s, "N"), "n_fraction": S.n_fraction(s), "non_iupac_fraction": S.non_iupac_fraction(s),
        "gc_fraction": S.gc_of_bases(s), "entropy": S.entropy(s), "longest_run": S.longest_run(s), "seq_sha256": S.sequence_hash(s),
    })


def duplicates(records: DataFrame, accession: str = "accession", content: str = "seq_sha256", ordinal: str = "ordinal") -> DataFrame:
    """Flags of every accession and every content but the first in input order."""
    nth = lambda k: F.row_number().over(Window.partitionBy(k).orderBy(ordinal)) > 1
    return records.withColumn("duplicate_accession", nth(accession)).withColumn("duplicate_sequence", nth(content))


def unique_keys(records: DataFrame, accession: str = "accession", ordinal: str = "ordinal") -> DataFrame:
    """record_key: the accession, and accession__dupN for its n-th copy."""
    n = F.row_number().over(Window.partitionBy(accession).orderBy(ordinal))
    return records.withColumn("_n", n).withColumn("record_key", F.when(F.col("_n") > 1, F.concat(F.col(accession), F.lit("__dup"), F.col("_n"))).otherwise(F.col(accession))).drop("_n")


def listed(*pairs: tuple[str, Column]) -> Column:
    """The names whose condition holds, in order."""
    return F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in pairs)))


def qc_reasons(cfg: dict = CURATE, marker_class: str | None = None) -> Column:
    q = cfg["qc"]
    at_least = R.first_match(q["min_length_by_class"].items(), lambda kv: F.col(marker_class) == kv[0], lambda kv: F.lit(kv[1]), F.lit(0)) if marker_class and q["min_length_by_class"] else F.lit(0)
    return listed(
        ("duplicate_accession", F.col("duplicate_accession")),
        ("duplicate_sequence", F.col("duplicate_sequence")),
        ("length_below_min", F.col("length") < q["min_length"]),
        ("length_above_max", F.col("length") > q["max_length"]),
        ("length_below_class_min", (at_least > 0) & (F.col("length") < at_least)),
        ("n_fraction_high", F.col("n_fraction") > q["max_n_fraction"]),
        ("non_iupac_fraction_high", F.col("non_iupac_fraction") > q["max_non_iupac_fraction"]),
        ("low_complexity", F.col("entropy") < q["min_entropy"]),
        ("homopolymer_long", F.col("longest_run") > q["max_run"]),
    )


def header_reasons(accession: Column, header: Column) -> Column:
    low = F.lower(header)
    return listed(
        ("refseq_preferred", accession.rlike("^(?:" + "|".join(R.CURATED_PREFIXES) + ")")),
        ("voucher_keyword", R.any_of(low, R.VOUCHER_TERMS)),
        ("complete_organelle", R.any_of(low, R.COMPLETE_TERMS)),
    )


def added(reasons: Column, more: Column) -> Column:
    return F.array_distinct(F.concat(reasons, more))


def score(reasons: Column, cfg: dict = CURATE) -> Column:
    s = cfg["score"]
    weights = F.create_map(*(F.lit(x) for kv in s["weights"].items() for x in kv))
    return F.aggregate(reasons, F.lit(s["start"]), lambda acc, r: acc + F.coalesce(weights[r], F.lit(0)))


def decided(records: DataFrame, cfg: dict = CURATE) -> DataFrame:
    """decision_score and decision from reasons."""
    s = cfg["score"]
    has = lambda names: F.arrays_overlap("reasons", F.array(*map(F.lit, names)))
    out = records.withColumn("decision_score", score(F.col("reasons"), cfg))
    points = F.col("decision_score")
    return out.withColumn("decision", F.when(has(s["hard_reject"]), "REJECT").when((points >= s["keep_min"]) & ~has(s["review"]), "KEEP").when(points >= s["review_min"], "REVIEW").otherwise("REJECT"))


def rescued_duplicates(records: DataFrame, species: str = "species", ordinal: str = "ordinal") -> DataFrame:
    """Species all of whose records are duplicates get their best sequence-duplicate back: curated accession, longest, fewest N, first."""
    w = Window.partitionBy(species)
    dup, acc = F.col("duplicate_sequence"), F.col("duplicate_accession")
    named = F.coalesce(F.trim(species), F.lit("")) != ""
    bare = named & (F.max((~dup & ~acc).cast("int")).over(w) == 0)
    can = dup & ~acc & ~F.array_contains("reasons", "rescued_duplicate")
    curated = F.col("accession").rlike("^(?:" + "|".join(R.CURATED_PREFIXES) + ")")
    best = F.row_number().over(w.orderBy(can.desc(), curated.desc(), F.desc("length"), "n_count", ordinal)) == 1
    out = records.withColumn("_r", bare & can & best)
    return out.withColumn("duplicate_sequence", dup & ~F.col("_r")).withColumn("reasons", F.when(F.col("_r"), added(F.array_except("reasons", F.array(F.lit("duplicate_sequence"))), F.array(F.lit("rescued_duplicate")))).otherwise(F.col("reasons"))).drop("_r")


def capped(records: DataFrame, cfg: dict = CURATE, species: str = "species", genus: str = "genus", klass: str = "marker_class") -> DataFrame:
    """cap_rank among records that are not rejected, and cap_exceeded with its effect beyond the cap of the class."""
    c = cfg["caps"]
    who = F.coalesce(F.nullif(F.col(species), F.lit("")), F.nullif(F.col(genus), F.lit("")), F.lit("Unknown"))
    group = F.col(klass) if c["mode"] == "species_marker" else F.lit("ALL")
    counts = (F.col("decision") != "REJECT") & ~F.col(klass).isin(*c["uncapped"]) if c["uncapped"] else F.col("decision") != "REJECT"
    order = Window.partitionBy(who, group, counts).orderBy((F.col("decision") != "KEEP").cast("int"), F.desc("decision_score"), F.desc("length"), "n_fraction", "accession", "ordinal")
    cap = R.first_match(c["by_class"].items(), lambda kv: F.col(klass) == kv[0], lambda kv: F.lit(kv[1]), F.lit(c["total"])) if c["mode"] == "species_marker" else F.lit(c["total"])
    out = records.withColumn("cap_rank", F.when(counts, F.row_number().over(order)).otherwise(0))
    over = F.col("cap_rank") > cap
    after = F.lit("REJECT") if c["action"] == "reject" else F.when(F.col("decision") == "KEEP", "REVIEW").otherwise(F.col("decision"))
    return out.withColumn("decision", F.when(over, after).otherwise(F.col("decision"))).withColumn("reasons", F.when(over, added(F.col("reasons"), F.array(F.lit("cap_exceeded")))).otherwise(F.col("reasons")))


def sole_representatives(records: DataFrame, species: str = "species", genus: str = "genus", klass: str = "marker_class") -> DataFrame:
    """Groups without a KEEP get their best REVIEW promoted; unnamed groups stay."""
    who = F.coalesce(F.nullif(F.col(species), F.lit("")), F.nullif(F.col(genus), F.lit("")), F.lit(""))
    named = ~F.lower(who).isin("", "unknown")
    w = Window.partitionBy(who, klass)
    none = F.max((F.col("decision") == "KEEP").cast("int")).over(w) == 0
    review = F.col("decision") == "REVIEW"
    best = F.row_number().over(w.orderBy(review.desc(), F.desc("decision_score"), F.desc("length"), "n_fraction", "ordinal")) == 1
    out = records.withColumn("_r", named & none & review & best)
    return out.withColumn("decision", F.when(F.col("_r"), "KEEP").otherwise(F.col("decision"))).withColumn("reasons", F.when(F.col("_r"), added(F.col("reasons"), F.array(F.lit("sole_representative")))).otherwise(F.col("reasons"))).drop("_r")


def species_coverage(records: DataFrame, species: str = "species", genus: str = "genus") -> DataFrame:
    """Decisions by species, its last kingdom that is known, and whether nothing is kept."""
    who = F.coalesce(F.nullif(F.col(species), F.lit("")), F.nullif(F.col(genus), F.lit("")), F.lit(""))
    n = lambda d: F.count_if(F.col("decision") == d)
    out = records.withColumn("who", who).where(~F.lower("who").isin("", "unknown")).groupBy("who").agg(
        F.coalesce(F.max_by("kingdom", F.when(F.col("kingdom") != "Unknown", F.col("ordinal"))), F.lit("Unknown")).alias("kingdom"),
        n("KEEP").alias("n_keep"), n("REVIEW").alias("n_review"), n("REJECT").alias("n_reject"), F.count("*").alias("n_total"),
    )
    return out.withColumn("note", F.when(F.col("n_keep") == 0, "NO KEEP").otherwise(""))


def reason_frequency(records: DataFrame) -> DataFrame:
    return records.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def summary(records: DataFrame) -> DataFrame:
    """section, key, value: decisions, decisions by class, reasons, taxonomy states where there are any."""
    one = lambda section, key, df: df.groupBy(key.alias("key")).agg(F.count("*").alias("value")).select(F.lit(section).alias("section"), "key", "value")
    out = one("decision", F.col("decision"), records).unionByName(one("decision_by_class", F.concat_ws(":", "decision", "marker_class"), records))
    out = out.unionByName(one("reason", F.col("r"), records.select(F.explode("reasons").alias("r"))))
    return out.unionByName(one("taxonomy_status", F.col("taxonomy_status"), records)) if "taxonomy_status" in records.columns else out


def explained(records: DataFrame, name: str) -> DataFrame:
    """Rows whose accession or key is the name."""
    return records.where((F.col("accession") == name) | (F.col("record_key") == name))


def annotated(records: DataFrame, cfg: dict = CURATE, regions: list = (), keywords: list = (), species_kingdom: DataFrame | None = None) -> DataFrame:
    """Records with names, kingdom, marker class, metrics, duplicate flags and reasons.

    species_kingdom has species, genus, kingdom and ordinal: the last species row and the first genus row win.
    """
    out = unique_keys(metrics(records)).withColumn("_sp", R.species(F.col("header"))).withColumn("_mk", R.marker(F.col("header"), list(regions)))
    out = out.select("*", "_sp.species", "_sp.genus", "_mk.marker_class", "_mk.region_id").drop("_sp", "_mk")
    label = F.lit("Unknown")
    if species_kingdom is not None:
        rows = species_kingdom.select(F.lower(F.trim("species")).alias("s"), F.lower(F.coalesce(F.nullif(F.trim("genus"), F.lit("")), F.substring_index(F.trim("species"), " ", 1))).alias("g"), R.kingdom(F.col("kingdom")).alias("k"), "ordinal")
        by_s = rows.where("s <> ''").groupBy("s").agg(F.max_by("k", "ordinal").alias("ks"))
        by_g = rows.where("g <> ''").groupBy("g").agg(F.min_by("k", "ordinal").alias("kg"))
        out = out.join(by_s, F.lower("species") == F.col("s"), "left").join(by_g, F.lower("genus") == F.col("g"), "left").drop("s", "g")
        label = F.coalesce("ks", "kg", F.lit("Unknown"))
    out = out.withColumn("kingdom", label).withColumn("kingdom", F.when((F.col("kingdom") == "Unknown") & (F.col("marker_class") == "Plastid"), "Plant").otherwise(F.col("kingdom"))).drop("ks", "kg")
    out = duplicates(out).withColumn("_kw", R.keyword(F.col("header"), list(keywords)))
    bad = listed(("bad_keyword_reject", F.col("_kw.action") == "reject"), ("bad_keyword_review", F.col("_kw.action") != "reject")) if keywords else F.array().cast("array<string>")
    return out.withColumn("reasons", F.concat(qc_reasons(cfg, "marker_class"), header_reasons(F.col("accession"), F.col("header")), bad)).drop("_kw")


def run(records: DataFrame, cfg: dict = CURATE, **tables) -> DataFrame:
    """Annotate, give duplicates back, decide, cap, decide again, promote sole representatives."""
    out = rescued_duplicates(annotated(records, cfg, **tables))
    return sole_representatives(decided(capped(decided(out, cfg), cfg), cfg))


def rebuilt(decisions: DataFrame) -> DataFrame:
    """The summary of a decisions table that was written before (reasons joined by ";")."""
    split = F.filter(F.split(F.coalesce(F.col("reasons"), F.lit("")), ";"), lambda r: r != "")
    return summary(decisions.withColumn("reasons", split))
