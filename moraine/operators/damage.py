"""Counts, damage and library metadata to one classified row a taxon."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moraine.config import BROAD_NAMES, DAMAGE, RANKS

# Words of a lineage that give its broad group, in order; states in order of strength; labels of a library.
GROUPS = (("fungi", ("fungi",)), ("plants", ("viridiplantae", "streptophyta", "embryophyta", "chlorophyta", "tracheophyta")), ("animals", ("metazoa", "animalia", "chordata", "arthropoda", "mollusca", "annelida", "nematoda", "cnidaria")), ("microbes", ("bacteria", "archaea")))
STATES = ("Very high confidence", "High confidence", "Supported", "Tentative", "Weak support", "Blank-associated")
LABELS = ("Damage-supported (>=100 reads)", "Damage-supported", "Lineage-supported", "Count-only", "Blank-library", "Not detected")


def counts_long(wide: DataFrame, keys: list[str], libraries: list[str]) -> DataFrame:
    """One row a taxon and library; what is no number counts as 0."""
    num = [F.coalesce(F.col(f"`{c}`").try_cast("double"), F.lit(0.0)).alias(c) for c in libraries]
    return wide.select(*keys, *num).unpivot(keys, libraries, "library", "count")


def merged_counts(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer merge of long tables on the same taxon key: absent means 0, so it is a sum over their union."""
    return reduce(lambda a, b: a.unionByName(b), [p.select(*keys, "library", "count") for p in parts]).groupBy(*keys, "library").agg(F.sum("count").alias("count"))


def warnings(long_: DataFrame, linker: DataFrame, damage: DataFrame) -> DataFrame:
    """level, kind, value: libraries without counts (error), taxa of the damage table without counts (info), or one row that says none."""
    lost = missing_libraries(long_, linker).select(F.lit("error").alias("level"), F.lit("missing_library").alias("kind"), F.col("library").cast("string").alias("value"))
    taxa = damage.select(F.col("tax_id").cast("string").alias("value")).distinct().join(long_.select(F.col("tax_id").cast("string").alias("value")).distinct(), "value", "left_anti")
    out = lost.unionByName(taxa.select(F.lit("info").alias("level"), F.lit("unmatched_taxon").alias("kind"), "value"))
    none = out.agg(F.count("*").alias("n")).where("n = 0").select(F.lit("info").alias("level"), F.lit("none").alias("kind"), F.lit("").alias("value"))
    return out.unionByName(none)


def inputs_summary(long_: DataFrame, damage: DataFrame) -> DataFrame:
    """section, key, value: rows, taxa, libraries, samples and the like of both inputs."""
    c = long_.agg(F.count("*").alias("rows"), F.count_distinct("tax_id").alias("taxa"), F.count_distinct("library").alias("libraries"), F.count_if(F.col("count") > 0).alias("positive"))
    d = damage.agg(F.count("*").alias("rows"), F.count_distinct("tax_id").alias("taxa"), F.count_distinct("sample").alias("samples"), F.count_if(F.col("map_valid")).alias("valid"))
    long = lambda df, s: df.unpivot([], df.columns, "key", "value").select(F.lit(s).alias("section"), "key", "value")
    return long(c, "counts").unionByName(long(d, "damage"))


def missing_libraries(long_: DataFrame, linker: DataFrame, library: str = "library") -> DataFrame:
    return linker.select(library).distinct().join(long_.select(library).distinct(), library, "left_anti")


def supported(damage: Column, significance: Column, cfg: dict = DAMAGE) -> Column:
    return F.coalesce((damage > cfg["damage_min"]) & (significance > cfg["significance_min"]), F.lit(False))


def quality(n_reads: Column, n_alignments: Column, map_valid: Column, rho: Column, cfg: dict = DAMAGE) -> Column:
    ratio = F.when(n_reads > 0, n_alignments / n_reads)
    above = lambda r, q: F.coalesce(ratio > cfg[r], F.lit(False)) | F.coalesce(F.abs(rho) > cfg[q], F.lit(False))
    return F.when(~F.coalesce(map_valid, F.lit(False)), "strong caution").when(above("qc_ratio_caution_max", "qc_rho_caution_max"), "strong caution").when(above("qc_ratio_clean_max", "qc_rho_clean_max"), "caution").otherwise("clean")


def matched(counts: DataFrame, damage: DataFrame) -> DataFrame:
    """counts (taxon, library, tax_id, tax_name, tax_rank, count) with damage rows of their sample by id; only without those by
    name and rank; only without those by name. tier tells which.

    Three equi-joins; the least tier of each (taxon, library) is kept.
    """
    d = damage.select(F.col("sample").alias("_s"), F.col("tax_id").alias("_id"), F.col("tax_name").alias("_name"), F.col("tax_rank").alias("_rank"), "damage", "significance", "n_reads", "n_alignments", "rho", "map_valid", "ordinal")
    by = (F.col("tax_id") == F.col("_id"), (F.col("tax_name") == F.col("_name")) & (F.col("tax_rank") == F.col("_rank")), F.col("tax_name") == F.col("_name"))
    all_ = reduce(lambda a, b: a.unionByName(b), [counts.join(d, (F.col("library") == F.col("_s")) & on).withColumn("tier", F.lit(i + 1)) for i, on in enumerate(by)])
    best = Window.partitionBy("taxon", "library")
    return all_.withColumn("_t", F.min("tier").over(best)).where("tier = _t").drop("_t", "_s", "_id", "_name", "_rank")


def best_rows(rows: DataFrame, cfg: dict = DAMAGE, keys: tuple[str, ...] = ("taxon", "library")) -> DataFrame:
    """The best damage row by support, significance, reads, damage; nulls last, then input order."""
    order = (supported(F.col("damage"), F.col("significance"), cfg).desc(), F.desc_nulls_last("significance"), F.desc_nulls_last("n_reads"), F.desc_nulls_last("damage"), F.asc("ordinal"))
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def lineage_names(path: Column) -> Column:
    """Names of a ";" path or of a TAB path of id:name:"rank"."""
    parts = F.when(F.contains(path, F.lit("\t")), F.transform(F.split(path, "\t"), lambda p: F.regexp_extract(p, r'^[^:]+:(.+):"?([^":]+)"?$', 1))).otherwise(F.split(path, ";"))
    return F.filter(F.transform(parts, lambda p: F.regexp_replace(F.trim(p), r"\s+", " ")), lambda p: p != "")


def level(rank: Column) -> Column:
    return F.coalesce(*(F.when(rank == r, F.lit(i)) for i, r in enumerate(RANKS)))


def lineage_support(focal: DataFrame, rows: DataFrame, cfg: dict = DAMAGE, broad: tuple[str, ...] = BROAD_NAMES) -> DataFrame:
    """(taxon, library) where a damage-supported relative stands close enough in the lineage.

    focal: taxon, library, name, rank, path; rows: sample, tax_name, tax_rank, tax_path, damage, significance. Membership of
    a name in a path is an equi-join on exploded paths, both ways round.
    """
    good = rows.where(supported(F.col("damage"), F.col("significance"), cfg)).select(F.col("sample").alias("library"), F.col("tax_name").alias("c_name"), F.col("tax_rank").alias("c_rank"), lineage_names(F.col("tax_path")).alias("c_path")).distinct()
    mine = focal.select("taxon", "library", "name", "rank", lineage_names(F.col("path")).alias("names"))
    up = mine.select("*", F.explode("names").alias("c_name")).join(good.drop("c_path"), ["library", "c_name"]).select("taxon", "library", "name", "rank", "c_name", "c_rank")
    down = good.select("*", F.explode("c_path").alias("name")).drop("c_path").join(mine.where(F.size("names") > 0).drop("names"), ["library", "name"]).select("taxon", "library", "name", "rank", "c_name", "c_rank")
    a, b, top = level(F.col("rank")), level(F.col("c_rank")), RANKS.index(cfg["lineage_max_rank"])
    ok = (F.col("name") != F.col("c_name")) & ~F.col("name").isin(*broad) & ~F.col("c_name").isin(*broad) & (a <= top) & (b <= top) & (F.abs(a - b) <= cfg["lineage_max_steps"])
    return up.unionByName(down).where(ok).select("taxon", "library", "c_name", "c_rank").distinct()


def state(exact: Column, exact100: Column, strong: Column, some: Column, lineage: Column, blank: Column, qc: Column, top: Column, cfg: dict = DAMAGE) -> tuple[Column, Column]:
    """(state, basis), strictest first."""
    basis = F.array_join(F.array_compact(F.array(F.when(exact, F.lit("damage-supported (exact)")), F.when(lineage, F.lit("lineage-supported")), F.when(strong, F.lit("strong counts")).when(some, F.lit("some counts")), F.when(exact & (qc != "clean"), qc))), "; ")
    cases = (
        (blank, "Blank-associated", F.lit("blank-associated")),
        (exact100 & strong & (qc != "strong caution"), "Very high confidence", F.lit("exact damage-supported; strong counts; >=100 reads")),
        (exact & strong, "High confidence", F.when(qc == "clean", F.lit("exact damage-supported; strong counts")).otherwise(F.concat(F.lit("exact damage-supported; strong counts; "), qc))),
        (exact | strong | (lineage & some), "Supported", basis),
        (top >= cfg["tentative_min_reads"], "Tentative", F.lit("weak/incomplete DNA support")),
    )
    s = b = None
    for test, name, why in cases:
        s = F.when(test, name) if s is None else s.when(test, name)
        b = F.when(test, why) if b is None else b.when(test, why)
    return s.otherwise("Weak support"), b.otherwise(F.when(top >= 1, "very weak DNA support").otherwise("no non-control support"))


def broad_group(path: Column) -> Column:
    low = F.lower(F.coalesce(path, F.lit("")))
    out = None
    for name, words in GROUPS:
        test = reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words])
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise("other")


def library_label(count: Column, negative: Column, environmental: Column, exact: Column, reads: Column, qc: Column, lineage: Column, cfg: dict = DAMAGE) -> Column:
    many = (reads >= cfg["high_confidence_n_reads_min"]) & (qc != "strong caution")
    return F.when(count <= 0, "Not detected").when(negative, "Blank-library").when(environmental, "Environmental-control").when(exact, F.when(many, LABELS[0]).otherwise(LABELS[1])).when(lineage, LABELS[2]).otherwise(LABELS[3])


def classified(counts: DataFrame, damage: DataFrame, linker: DataFrame, lineage: DataFrame | None = None, cfg: dict = DAMAGE) -> DataFrame:
    """One row a taxon: count and blank figures, best damage row, state and basis.

    counts: taxon, tax_id, tax_name, tax_rank, library, count; linker: library, negative, environmental; lineage: (taxon, library) supported.
    """
    c = counts.join(linker.select("library", "negative", "environmental"), "library")
    real, blank = ~F.col("negative") & ~F.col("environmental"), F.col("negative")
    n = c.groupBy("taxon").agg(
        F.count_if(real & (F.col("count") > 0)).alias("n_positive"), F.coalesce(F.max(F.when(real, F.col("count"))), F.lit(0.0)).alias("max_count"),
        F.count_if(blank & (F.col("count") > 0)).alias("n_blank_positive"), F.coalesce(F.max(F.when(blank, F.col("count"))), F.lit(0.0)).alias("max_blank"),
        F.array_join(F.array_sort(F.collect_set(F.when(real & (F.col("count") > 0), F.col("library")))), "; ").alias("positive_libraries"),
    )
    hits = best_rows(matched(c.where("count > 0"), damage), cfg).withColumn("ok", supported(F.col("damage"), F.col("significance"), cfg))
    high = F.col("n_reads") >= cfg["high_confidence_n_reads_min"]
    d = hits.groupBy("taxon").agg(
        F.count_if(real & F.col("ok")).alias("n_damage"), F.count_if(real & F.col("ok") & high).alias("n_damage_100"), F.coalesce(F.bool_or(blank & F.col("ok")), F.lit(False)).alias("blank_damage"),
        F.array_join(F.array_sort(F.collect_set(F.when(real & F.col("ok"), F.col("library")))), "; ").alias("damage_libraries"), F.max(F.when(blank, F.col("n_reads"))).alias("blank_best_reads"),
    )
    top = best_rows(hits.where(real), cfg, ("taxon",)).select("taxon", F.col("library").alias("best_library"), F.col("damage").alias("best_damage"), F.col("significance").alias("best_significance"), F.col("n_reads").alias("best_reads"), F.when(F.col("n_reads") > 0, F.col("n_alignments") / F.col("n_reads")).alias("alignments_per_read"), quality(F.col("n_reads"), F.col("n_alignments"), F.col("map_valid"), F.col("rho"), cfg).alias("qc"))
    out = n.join(d, "taxon", "left").join(top, "taxon", "left").fillna(0, ["n_damage", "n_damage_100"]).fillna(False, ["blank_damage"]).fillna("not-applicable", ["qc"])
    if lineage is not None:
        kin = lineage.join(c.where(real & (F.col("count") > 0)).select("taxon", "library"), ["taxon", "library"]).groupBy("taxon").agg(F.count_distinct("library").alias("n_lineage"))
        out = out.join(kin, "taxon", "left").fillna(0, ["n_lineage"])
    else:
        out = out.withColumn("n_lineage", F.lit(0).cast("long"))
    strong = (F.col("n_positive") >= cfg["strong_count_min_libraries"]) & (F.col("max_count") >= cfg["strong_count_min_reads"])
    exact = F.col("n_damage") > 0
    ratio = F.when(F.col("max_count") > 0, F.col("max_blank") / F.col("max_count"))
    caution = (F.col("max_blank") >= cfg["blank_absolute_min"]) | F.coalesce(ratio >= cfg["blank_relative_min"], F.lit(False))
    blanks = F.col("blank_damage") | (caution & ~strong & (~exact | (F.col("qc") == "strong caution")))
    s, b = state(exact, F.col("n_damage_100") > 0, strong, F.col("n_positive") >= 1, F.col("n_lineage") > 0, blanks, F.col("qc"), F.col("max_count"), cfg)
    return out.withColumns({"blank_ratio": ratio, "state": s, "basis": b})


def pivoted(rows: DataFrame, keys: list[str], library: str, value: str, libraries: list[str]) -> DataFrame:
    """One column a library, in the given order; an explicit list, so no extra pass looks for it."""
    return rows.groupBy(*keys).pivot(library, libraries).agg(F.first(value))


def by_state(rows: DataFrame) -> list[Column]:
    """Sort columns: strongest state, largest count, name."""
    order = F.coalesce(*(F.when(F.col("state") == s, F.lit(i)) for i, s in enumerate(STATES)), F.lit(99))
    return [order.asc(), F.desc("max_count"), F.asc("taxon")]
