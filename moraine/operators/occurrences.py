"""Occurrences of several sources to cleaned, grouped and merged taxon lists.

Sets become sorted lists joined by ";" only at the end of an aggregate; first-seen values go by the ordinal column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moraine.functions import names as N
from moraine.functions import presets as P


def first_filled(df: DataFrame, candidates: list[str]) -> Column:
    """The first candidate column that is filled; columns are found by name, then by squeezed name, once, on the driver."""
    import re

    squeeze = lambda s: re.sub("[^a-z0-9]+", "", s.lower())
    by = {squeeze(c): c for c in reversed(df.columns)}
    found = [c for c in candidates if c in df.columns] + [by[squeeze(c)] for c in candidates if squeeze(c) in by]
    cols = [F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) for c in dict.fromkeys(found)]
    return F.coalesce(*cols, F.lit("")) if cols else F.lit("")


def joined(values: Column, sep: str = ";") -> Column:
    """Aggregate: sorted distinct values that are not empty."""
    return F.array_join(F.array_sort(F.collect_set(F.nullif(values.cast("string"), F.lit("")))), sep)


def first_seen(value: Column, ordinal: str = "ordinal") -> Column:
    return F.min_by(value, F.col(ordinal))


def status_ok(extinct: Column, wanted: str, unknown_passes: bool) -> Column:
    """extinct is tri-state; what is unknown passes or not, as the source has it."""
    if wanted == "all":
        return F.lit(True)
    return F.coalesce(extinct if wanted == "extinct" else ~extinct, F.lit(unknown_passes))


def named(rows: DataFrame, cleaner: Column, raw: str = "name") -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): rows with the fields of a cleaned name, and the names that were not cleaned with the reason."""
    out = rows.withColumn("_c", cleaner)
    kept = out.where("_c.reason is null").select("*", *(F.col(f"_c.{f}").alias(f) for f in N.FIELDS[:5])).drop("_c")
    return kept, out.where("_c.reason is not null").select(F.col(raw).alias("name"), F.col("_c.reason").alias("reason"), "ordinal")


def collection_taxa(rows: DataFrame, min_occurrences: int = 1, min_sites: int = 1) -> DataFrame:
    """Buckets of collection records by search name in any case.

    rows: search_name, genus, rank, binomial, status, kingdom, phylum, taxon_id, name, site_id, dataset_id, database,
    dataset_type, age_young, age_old, ordinal.
    """
    out = rows.groupBy(F.lower("search_name").alias("key")).agg(
        *(first_seen(F.col(c)).alias(c) for c in ("search_name", "genus", "kingdom", "phylum", "binomial", "rank", "status")),
        F.count("*").alias("n_occurrences"), joined(F.col("taxon_id")).alias("taxon_ids"), joined(F.col("name"), "; ").alias("names"),
        F.count_distinct("site_id").alias("n_sites"), F.count_distinct("dataset_id").alias("n_datasets"), joined(F.col("site_id")).alias("site_ids"),
        joined(F.col("database")).alias("databases"), joined(F.col("dataset_type")).alias("dataset_types"),
        F.min("age_young").alias("age_young"), F.max("age_old").alias("age_old"),
    )
    return out.where((F.col("n_occurrences") >= min_occurrences) & (F.col("n_sites") >= min_sites))


def published_taxa(rows: DataFrame, min_records: int = 1) -> DataFrame:
    """Buckets of published records by search name; kingdom and phylum fill from the first row that knows them.

    rows: search_name, genus, rank, binomial, status, kingdom, phylum, taxon_key, identified_name, collection, country, early, late,
    min_ma, max_ma, ordinal.
    """
    known = lambda c: F.coalesce(F.min_by(c, F.when((F.col(c) != "") & (F.col(c) != "Unknown"), F.col("ordinal"))), first_seen(F.col(c)))
    out = rows.groupBy("search_name").agg(
        *(first_seen(F.col(c)).alias(c) for c in ("genus", "rank", "binomial", "status", "taxon_key")), known("kingdom").alias("kingdom"), known("phylum").alias("phylum"),
        F.count("*").alias("n_records"), joined(F.col("identified_name")).alias("identified_names"), joined(F.col("collection")).alias("collections"),
        F.count_distinct(F.nullif("collection", F.lit(""))).alias("n_collections"), joined(F.col("country")).alias("countries"),
        joined(F.col("early")).alias("early_intervals"), joined(F.col("late")).alias("late_intervals"), F.min("min_ma").alias("min_ma"), F.max("max_ma").alias("max_ma"),
    )
    return out.where(F.col("n_records") >= min_records)


def locality_taxa(rows: DataFrame, min_records: int = 1) -> DataFrame:
    """Buckets of locality records by search name: animals with a backbone, with their localities, countries and ages."""
    out = rows.groupBy("search_name").agg(
        *(first_seen(F.col(c)).alias(c) for c in ("genus", "rank", "binomial", "status")), F.count("*").alias("n_records"), joined(F.col("locality")).alias("localities"),
        joined(F.col("country")).alias("countries"), F.min("min_ma").alias("min_ma"), F.max("max_ma").alias("max_ma"),
    )
    return out.where(F.col("n_records") >= min_records).withColumns({"kingdom": F.lit("Animalia"), "phylum": F.lit("Chordata")})


def species_localities(species: DataFrame, localities: DataFrame, links: DataFrame, species_key: str, locality_key: str) -> DataFrame:
    """Link rows with the columns of their species and locality; where names clash the link's value wins, then the species'."""
    out = links
    for side, k in ((species, species_key), (localities, locality_key)):
        clash = [c for c in side.columns if c in out.columns and c != k]
        new = side.select(F.col(k).alias("_k"), *(F.col(c).alias(f"_{c}" if c in clash else c) for c in side.columns if c != k)).dropDuplicates(["_k"])
        out = out.join(new, out[k] == new["_k"], "left").drop("_k")
        for c in clash:
            out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_{c}"))).drop(f"_{c}")
    return out


def facets(rows: DataFrame, species: DataFrame, key: str, min_count: int = 1) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) of occurrence counts by species key joined with names (key, name, genus, kingdom, phylum); the least count applies before the join."""
    n = rows.groupBy(key).agg(F.count("*").alias("n_occurrences")).where(F.col("n_occurrences") >= min_count)
    out = n.join(species, key).withColumn("clean", N.facet_name(F.col("name")))
    words = F.split("clean", " ")
    kept = out.where("clean is not null").select(key, F.col("clean").alias("species"), F.coalesce(F.nullif("genus", F.lit("")), F.get(words, F.lit(0))).alias("genus"), "kingdom", "phylum", F.when(F.size(words) >= 2, "species").otherwise("genus_or_higher").alias("rank"), "n_occurrences", F.when(F.col("clean") == F.col("name"), "ok").otherwise("cleaned").alias("status"))
    return kept, out.where("clean is null").select("name", F.lit("could_not_clean").alias("reason"))


def chunk_maximum(parts: list[DataFrame], key: str, count: str) -> DataFrame:
    """Counts of one key from several chunked facets: the greatest."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy(key).agg(F.max(count).alias(count))


def union_distinct(parts: list[DataFrame], key: list[str]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.dropDuplicates(key)


def merged(rows: DataFrame, priority: list[str], mode: str = "binomial") -> DataFrame:
    """One row a canonical name over all sources, in input order.

    rows: name, source, kingdom, phylum, taxon_key, file, region, period, ordinal. The first row seen gives the base; the source
    of best priority (first on ties) is preferred and gives the taxon key where it has one; lists are distinct in order.
    """
    rank = F.coalesce(*(F.when(F.lower("source") == s.lower(), F.lit(i)) for i, s in enumerate(priority)), F.lit(999)) if priority else F.lit(999)
    r = rows.withColumn("key", N.canonical_key(F.col("name"), mode)).where("key <> ''").withColumn("_rank", rank)
    filled = lambda c: F.min_by(c, F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col("ordinal")))
    listed = lambda c: F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.coalesce(F.col(c), F.lit("")) != "", F.struct("ordinal", F.col(c).alias("v"))))), lambda x: x["v"])), ";")
    best = F.min_by("source", F.struct("_rank", "ordinal"))
    keyed = F.min_by("taxon_key", F.when(F.coalesce(F.col("taxon_key"), F.lit("")) != "", F.struct("_rank", "ordinal")))
    out = r.groupBy("key").agg(
        F.coalesce(filled("kingdom"), F.lit("")).alias("kingdom"), F.coalesce(filled("phylum"), F.lit("")).alias("phylum"), best.alias("preferred_source"), F.coalesce(keyed, F.lit("")).alias("taxon_key"),
        listed("source").alias("sources"), listed("file").alias("files"), listed("taxon_key").alias("taxon_keys"), listed("region").alias("regions"), listed("period").alias("periods"),
        F.count("*").alias("_n"), first_seen(F.col("source")).alias("_first"),
    )
    words = F.split("key", " ")
    status = F.when(F.col("_n") > 1, "merged_duplicate_sources").otherwise(F.concat(F.lit("merged_from_"), "_first"))
    return out.select(F.col("key").alias("species"), F.get(words, F.lit(0)).alias("genus"), F.when(F.size(words) >= 2, "species").otherwise("genus_or_higher").alias("rank"), "kingdom", "phylum", "preferred_source", "taxon_key", "sources", "files", "taxon_keys", "regions", "periods", status.alias("status"))


def search_list(rows: DataFrame, name: str = "species") -> DataFrame:
    return rows.select(F.col(name).alias("name")).where("name <> ''").distinct().orderBy("name")


def genus_fallback(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(names, map): species and their genera to search for, and kingdom with the first phylum that is filled of each species."""
    r = rows.where(F.trim("species") != "")
    names = r.select(F.trim("species").alias("name")).unionByName(r.select(F.split_part(F.trim("species"), F.lit(" "), F.lit(1)).alias("name"))).distinct()
    return names, r.groupBy(F.trim("species").alias("species")).agg(first_seen(F.col("kingdom")).alias("kingdom"), F.coalesce(F.min_by("phylum", F.when(F.coalesce("phylum", F.lit("")) != "", F.col("ordinal"))), F.lit("")).alias("phylum"))


def availability(assembly: Column, nucleotide: Column, reads: Column, has_taxid: Column) -> Column:
    return F.when(~has_taxid, "NO_TAXID").when(assembly > 0, "ASSEMBLY").when((nucleotide > 0) & (reads > 0), "NUCCORE+SRA").when(reads > 0, "SRA").when(nucleotide > 0, "NUCCORE").otherwise("NONE")


def counters(rows: DataFrame, **stages: Column) -> DataFrame:
    """One pass over rows: how many there are and how many meet each condition."""
    return rows.agg(F.count("*").alias("seen"), *(F.count_if(c).alias(n) for n, c in stages.items()))


def invertebrate(phylum: Column, klass: Column) -> Column:
    return (F.coalesce(phylum, F.lit("")) != "Chordata") & ~F.coalesce(klass, F.lit("")).isin(*P.VERTEBRATES)


def query_term(name: str, marker_clauses: list[str], exclude: list[str], low: int = 50, high: int = 400000) -> str:
    """A boolean search term: organism, any marker, length range, none of the exclusions."""
    markers = " OR ".join(f"({m})" for m in marker_clauses)
    term = f'("{name}"[Organism]) AND ({markers}) AND ({low}:{high}[SLEN])' if markers else f'("{name}"[Organism]) AND ({low}:{high}[SLEN])'
    return term + "".join(f" NOT {e}" for e in exclude)


def latest(rows: DataFrame, key: str, ordinal: str = "ordinal") -> DataFrame:
    """The last row of each key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(ordinal)))).where("_n = 1").drop("_n")


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows that only one of two frames has."""
    return a.subtract(b).unionByName(b.subtract(a))


def decoded_cache(entries: DataFrame, key: str = "key", entry: str = "entry") -> DataFrame:
    """key, name, source of cached lookups: an object with name and src, plain text of older caches, or nothing for a known miss."""
    e = F.col(entry)
    as_object = F.startswith(F.trim(e), F.lit("{"))
    name = F.when(as_object, F.nullif(F.get_json_object(e, "$.name"), F.lit(""))).otherwise(F.nullif(e, F.lit("")))
    source = F.when(F.coalesce(e, F.lit("")) == "", "cache-miss").when(as_object, F.coalesce(F.get_json_object(e, "$.src"), F.lit("cache"))).otherwise("cache")
    return entries.select(key, name.alias("name"), source.alias("source"))
