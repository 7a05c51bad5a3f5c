"""Library linker: columns of a matrix to metadata and to damage samples, by keys in order of preference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moraine.functions import names as N


def by_priority(rows: DataFrame, candidates: Column, known: DataFrame, key: str, ordinal: list[str]) -> DataFrame:
    """rows with the known row of their first candidate that exists, and its place as _tier; one equi-join over exploded candidates."""
    tries = rows.select(*ordinal, F.posexplode(candidates).alias("_tier", "_k")).where("_k is not null and _k <> ''")
    hit = tries.join(known.withColumnRenamed(key, "_k"), "_k")
    first = hit.withColumn("_n", F.row_number().over(Window.partitionBy(*ordinal).orderBy("_tier"))).where("_n = 1").drop("_n", "_k")
    return rows.join(first, ordinal, "left")


def stem_candidates(stem: Column) -> Column:
    """As written, with hyphens for underscores, without a replicate tag, both."""
    hyphen = lambda c: F.replace(c, F.lit("_"), F.lit("-"))
    beta = F.when(F.contains(stem, F.lit("-Beta-")), F.replace(stem, F.lit("-Beta-"), F.lit("-")))
    return F.array(stem, hyphen(stem), beta, hyphen(beta))


METHODS = ("exact-match", "stripped-extraction-suffix", "normalised-underscores", "stripped-leading-zeros", "stripped-suffix-normalised-underscores", "stripped-suffix-and-leading-zeros", "normalised-underscores-and-leading-zeros")


def sample_candidates(sample: Column) -> Column:
    """A sample id and its normal forms in the order of METHODS."""
    stripped = F.regexp_replace(F.regexp_replace(sample, "(?i)[cp]$", ""), "-+$", "")
    hyphen = F.replace(sample, F.lit("_"), F.lit("-"))
    return F.array(sample, stripped, hyphen, N.without_zeros(sample), F.replace(stripped, F.lit("_"), F.lit("-")), N.without_zeros(stripped), N.without_zeros(hyphen))


def damage_names(rows: DataFrame, known: DataFrame, overrides: DataFrame | None = None, sample: str = "sample_id", kind: str = "sample_type") -> DataFrame:
    """damage_name and derivation: blanks pooled, then manual overrides, then the first normal form that is known, then a marker."""
    out = by_priority(rows.withColumn("_s", F.coalesce(F.col(sample), F.lit(""))), sample_candidates(F.col("_s")), known.select(F.col("sample").alias("k"), F.col("sample").alias("_found")), "k", ["ordinal"])
    low = F.lower(F.coalesce(F.col(kind), F.lit("")))
    manual = F.lit(None).cast("string")
    if overrides is not None:
        out = out.join(overrides.select(F.col("sample_id").alias("_o"), F.col("name").alias("_manual")), F.col(sample) == F.col("_o"), "left").drop("_o")
        manual = F.col("_manual")
    blank, positive = F.contains(low, F.lit("blank")), F.contains(low, F.lit("positive"))
    names = F.array(*map(F.lit, METHODS))
    name = F.when(blank, "blanks").when(manual.isNotNull(), manual).when(F.col("_found").isNotNull(), F.col("_found")).when(positive, "NO_HOLI_DATA").otherwise(F.concat(F.lit("REVIEW_NEEDED:"), "_s"))
    how = F.when(blank, "blank-sample-type").when(manual.isNotNull(), "manual-override").when(F.col("_found").isNotNull(), F.get(names, F.col("_tier"))).when(positive, "positive-control-without-match").otherwise("no-match-found")
    return out.withColumns({"damage_name": name, "derivation": how}).drop("_s", "_found", "_tier", "_manual")


def control_type(sample: Column, kind: Column, site: Column, context: Column) -> Column:
    t = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    hay = F.concat_ws(" | ", t(sample), t(kind), t(site), t(context))
    return (
        F.when(hay.rlike("positive|pos[-_ ]?ctrl"), "positive_control").when(hay.rlike("web|wash|swab|surface|environmental control"), "environmental_control").when(hay.rlike("blank|negative"), "negative_control")
        .when(F.contains(t(kind), F.lit("control")) | F.contains(t(context), F.lit("control")), "control_unspecified").otherwise("not_control")
    )


def control_flags(positive: Column, environmental: Column, negative: Column) -> Column:
    """struct(positive, environmental, negative) of which at most one holds, in that order."""
    p, e, n = (F.coalesce(x, F.lit(False)) for x in (positive, environmental, negative))
    return F.struct(p.alias("positive"), (e & ~p).alias("environmental"), (n & ~p & ~e).alias("negative"))


def site_group(site: Column, kind: Column) -> Column:
    """"{site}_{kind}s", or the kind alone, for the usual kinds; "other" else."""
    s = F.trim(F.coalesce(site, F.lit("")))
    s, low = F.when(s.isin("NA", "nan"), "").otherwise(s), F.lower(F.coalesce(kind, F.lit("")))
    named = lambda what: F.when(s != "", F.concat(s, F.lit(f"_{what}"))).otherwise(what)
    out = F.when(F.contains(low, F.lit("blank")), "blanks").when(F.contains(low, F.lit("control")), F.when(F.contains(low, F.lit("positive")), "positive_controls").otherwise("blanks"))
    return out.when(F.contains(low, F.lit("bone")), named("bones")).when(low.rlike("sediment|web"), named("sediments")).when(low != "", named("other")).otherwise("other")


def plot_group(site: Column, kind: Column, biological: Column, control: Column) -> Column:
    s, low, bid = F.trim(F.coalesce(site, F.lit(""))), F.lower(F.trim(F.coalesce(kind, F.lit("")))), F.lower(F.trim(F.coalesce(biological, F.lit(""))))
    webs = F.when(s != "", F.concat(s, F.lit("_webs"))).otherwise("webs")
    return (
        F.when(control.isin("negative_control", "control_unspecified"), "negative_controls").when(control == "positive_control", "positive_controls")
        .when((control == "environmental_control") & (F.contains(low, F.lit("web")) | F.contains(bid, F.lit("web"))), webs)
        .when(F.contains(low, F.lit("undetermined")) | F.startswith(bid, F.lit("undetermined")), "undetermined").when(F.contains(low, F.lit("web")), webs).otherwise(site_group(site, kind))
    )


def linked(columns: DataFrame, metadata: DataFrame, known: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """One linker row a matrix column.

    columns: column, ordinal; metadata: stem, sample_id, sample_type, site, context and any extra; known: sample. Columns of
    undetermined reads get fixed values; those without metadata are UNKNOWN; extra metadata is carried.
    """
    c = columns.withColumn("stem", N.library_stem(F.col("column"))).withColumn("library", N.without_lane(F.col("stem")))
    odd = F.contains(F.lower("column"), F.lit("undetermined"))
    base = {"merged_name": N.without_batch(F.col("stem")), "chemistry": N.chemistry(F.col("library"))}
    lost = c.where(odd).withColumns(base).withColumns({"damage_name": F.lit("NO_HOLI_DATA"), "sample_id": F.lit("Undetermined"), "sample_type": F.lit("undetermined_indexes"), "site": F.lit("NA"), "context": F.lit(""), "group": F.lit("undetermined"), "derivation": F.lit("undetermined-indexes"), "control_type": F.lit("not_control")})
    meta = by_priority(c.where(~odd), stem_candidates(F.col("library")), metadata, "stem_key", ["ordinal"]).drop("_tier")
    meta = meta.fillna("UNKNOWN", ["sample_id", "sample_type", "site"]).fillna("", ["context"]).withColumns(base)
    meta = damage_names(meta, known, overrides)
    meta = meta.withColumn("control_type", control_type(F.col("sample_id"), F.col("sample_type"), F.col("site"), F.col("context"))).withColumn("biological_sample_id", N.biological_id(F.col("sample_id")))
    meta = meta.withColumn("group", plot_group(F.col("site"), F.col("sample_type"), F.col("biological_sample_id"), F.col("control_type")))
    return meta.unionByName(lost, allowMissingColumns=True).withColumn("is_negative_control", F.col("control_type") == "negative_control")


def issues(linker: DataFrame) -> DataFrame:
    """issue, key, n: rows without metadata or without a damage sample, library names that are not unique, rows by control type."""
    one = lambda name, rows, key: rows.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n")).select(F.lit(name).alias("issue"), "key", "n")
    out = one("control_type", linker, "control_type").unionByName(one("no_metadata", linker.where("sample_id = 'UNKNOWN'"), "column"))
    out = out.unionByName(one("no_damage_sample", linker.where(F.startswith("damage_name", F.lit("REVIEW_NEEDED"))), "sample_id"))
    return out.unionByName(one("duplicate_name", linker, "merged_name").where("n > 1"))


def common_name(taxon_id: Column, name: Column, by_id: dict, by_name: dict, built_in: dict) -> Column:
    """struct(common_name, source): override by id, by name, then the built-in table (and its genus)."""
    table = lambda d: F.create_map(*(F.lit(x) for kv in d.items() for x in kv)) if d else F.create_map().cast("map<string,string>")
    tries = ((table(by_id)[taxon_id.cast("string")], "override_id"), (table(by_name)[name], "override_name"), (table(built_in)[name], "builtin"), (table(built_in)[F.split_part(name, F.lit(" "), F.lit(1))], "builtin_genus"))
    return F.coalesce(*(F.when(v.isNotNull(), F.struct(v.alias("common_name"), F.lit(s).alias("source"))) for v, s in tries), F.struct(F.lit("").alias("common_name"), F.lit("none").alias("source")))
