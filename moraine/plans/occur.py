"""Queries of the occurrence, name and linker operators.

events stands for occurrence records: user is the site, k of props the dataset, value the age.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from moraine.functions import names as N
from moraine.functions import presets as P
from moraine.operators import linker as L
from moraine.operators import occurrences as O
from moraine.plans.standins import table

QUERIES, ORACLES = {}, {}


def query(name, oracle=None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


EVENTS = """with e as (select event_id as ordinal, event_type as name, cast(user_id as varchar) as site_id, cast(json_extract_string(props, '$.k') as varchar) as dataset_id, value as age_young, value * 2 as age_old,
  (user_id % 360) - 180.0 as lon, (event_id % 180) - 90.0 as lat from events)"""


def events(spark, sf):
    e = table(spark, sf, "events")
    return e.select(F.col("event_id").alias("ordinal"), F.col("event_type").alias("name"), F.col("user_id").cast("string").alias("site_id"), F.get_json_object("props", "$.k").alias("dataset_id"), F.col("value").alias("age_young"), (F.col("value") * 2).alias("age_old"), (F.col("user_id") % 360 - F.lit(180.0)).alias("lon"), (F.col("event_id") % 180 - F.lit(90.0)).alias("lat"))


@query("q_occurrence_bucket", EVENTS + " select lower(name) as key, count(*) as n_occurrences, count(distinct site_id) as n_sites, count(distinct dataset_id) as n_datasets, string_agg(distinct dataset_id, ';' order by dataset_id) as databases, min(age_young) as age_young, max(age_old) as age_old from e group by 1")
def bucket(spark, sf):
    e = events(spark, sf)
    e = e.withColumns({"search_name": F.col("name"), "database": F.col("dataset_id"), "taxon_id": F.lit("1"), "dataset_type": F.lit("")} | {c: F.lit("") for c in ("genus", "kingdom", "phylum", "binomial", "rank", "status")})
    return O.collection_taxa(e).select("key", "n_occurrences", "n_sites", "n_datasets", "databases", "age_young", "age_old")


SPARSE = EVENTS + ", s as (select ordinal, case when ordinal % 11 > 0 then lat end as lat, case when ordinal % 13 > 0 then lon end as lon, case when ordinal % 5 > 0 then age_young end as y, case when ordinal % 7 > 0 then age_old end as o from e)"


def sparse(spark, sf):
    """Events of which some lack a coordinate or an age."""
    k = F.col("ordinal")
    return events(spark, sf).select("ordinal", F.when(k % 11 > 0, F.col("lat")).alias("lat"), F.when(k % 13 > 0, F.col("lon")).alias("lon"), F.when(k % 5 > 0, F.col("age_young")).alias("age_young"), F.when(k % 7 > 0, F.col("age_old")).alias("age_old"))


@query("q_bbox_age_filter", SPARSE + " select ordinal from s where (lat is null or lon is null or (lat between 5 and 85 and lon between -170 and -50)) and (y is null or o is null or (o >= 10 and y <= 60))")
def bbox(spark, sf):
    return sparse(spark, sf).where(P.inside(F.col("lat"), F.col("lon"), P.region("north_america"))).where(P.overlaps(F.col("age_young"), F.col("age_old"), (10, 60))).select("ordinal")


@query("q_required_area_age", SPARSE + " select ordinal from s where lat between 5 and 85 and lon between -170 and -50 and (y is not null or o is not null) and (y is null or o is null or (o >= 10 and y <= 60))")
def required(spark, sf):
    return sparse(spark, sf).where(P.inside(F.col("lat"), F.col("lon"), P.region("north_america"), require=True)).where(P.overlaps(F.col("age_young"), F.col("age_old"), (10, 60), require=True)).select("ordinal")


@query("q_antimeridian_filter", EVENTS + " select ordinal from e where lat between -20 and 20 and (lon >= 170 or lon <= -170)")
def antimeridian(spark, sf):
    return events(spark, sf).where(P.inside(F.col("lat"), F.col("lon"), (170.0, -20.0, -170.0, 20.0))).select("ordinal")


@query("q_min_support_having", EVENTS + " select site_id, count(*) as n, count(distinct dataset_id) as d from e group by 1 having count(*) >= 8 and count(distinct dataset_id) >= 7")
def having(spark, sf):
    e = events(spark, sf)
    e = e.withColumns({"search_name": F.col("site_id"), "site_id": F.col("dataset_id"), "database": F.lit(""), "taxon_id": F.lit("1"), "dataset_type": F.lit("")} | {c: F.lit("") for c in ("genus", "kingdom", "phylum", "binomial", "rank", "status")})
    return O.collection_taxa(e, 8, 7).select(F.col("key").alias("site_id"), F.col("n_occurrences").alias("n"), F.col("n_sites").alias("d"))


@query("q_filter_counters", EVENTS + " select count(*) as seen, count(*) filter (name = 'click') as named, count(*) filter (lat > 0) as north from e")
def counters(spark, sf):
    return O.counters(events(spark, sf), named=F.col("name") == "click", north=F.col("lat") > 0)


MERGE = """with r as (select 'C' as source, c_custkey as o, substr(c_mktsegment, 1, 1) || lower(substr(c_mktsegment, 2)) || ' ' || case c_nationkey % 4 when 0 then 'alba' when 1 then 'nigra' when 2 then 'rufa' else 'minor' end as name, case when c_custkey % 3 = 0 then '' else 'K' || cast(c_nationkey % 2 as varchar) end as kingdom, cast(c_nationkey as varchar) as taxon_key, 'a.csv' as file from customer
 union all select 'S', 100000000 + s_suppkey, 'Building' || ' ' || case s_nationkey % 4 when 0 then 'alba' when 1 then 'nigra' when 2 then 'rufa' else 'major' end, 'S', case when s_suppkey % 2 = 0 then '' else 's' || cast(s_suppkey as varchar) end, 'b.csv' from supplier),
f as (select *, case source when 'S' then 0 else 1 end as rk from r)
select name as species, split_part(name, ' ', 1) as genus, coalesce(min_by(kingdom, o) filter (kingdom <> ''), '') as kingdom, min_by(source, rk * 1000000000 + o) as preferred_source, coalesce(min_by(taxon_key, rk * 1000000000 + o) filter (taxon_key <> ''), '') as taxon_key,
  array_to_string(list_distinct([min_by(source, o), max_by(source, o)]), ';') as sources, case when count(*) > 1 then 'merged_duplicate_sources' else 'merged_from_' || min_by(source, o) end as status from f group by name"""


@query("q_source_priority_merge", MERGE.replace("array_to_string(list_distinct([min_by(source, o), max_by(source, o)]), ';')", "case when min_by(source, o) = max_by(source, o) then min_by(source, o) else min_by(source, o) || ';' || max_by(source, o) end"))
def merge(spark, sf):
    word = lambda k, last: F.when(k % 4 == 0, "alba").when(k % 4 == 1, "nigra").when(k % 4 == 2, "rufa").otherwise(last)
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    a = c.select(F.lit("C").alias("source"), F.col("c_custkey").alias("ordinal"), F.concat(N.capital(F.lower("c_mktsegment")), F.lit(" "), word(F.col("c_nationkey"), "minor")).alias("name"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.concat(F.lit("K"), F.col("c_nationkey") % 2)).alias("kingdom"), F.col("c_nationkey").cast("string").alias("taxon_key"), F.lit("a.csv").alias("file"))
    b = s.select(F.lit("S").alias("source"), (F.lit(100000000) + F.col("s_suppkey")).alias("ordinal"), F.concat(F.lit("Building "), word(F.col("s_nationkey"), "major")).alias("name"), F.lit("S").alias("kingdom"), F.when(F.col("s_suppkey") % 2 == 0, "").otherwise(F.concat(F.lit("s"), "s_suppkey")).alias("taxon_key"), F.lit("b.csv").alias("file"))
    rows = a.unionByName(b).withColumns({"phylum": F.lit(""), "region": F.lit("x"), "period": F.lit("y")})
    return O.merged(rows, ["S", "C"]).select("species", "genus", "kingdom", "preferred_source", "taxon_key", "sources", "status")


@query("q_union_dedup", "select l_orderkey, count(*) as n from (select distinct l_orderkey, l_partkey from lineitem where l_quantity > 20 union select l_orderkey, l_partkey from lineitem where l_discount > 0.05) group by 1")
def union_dedup(spark, sf):
    li = table(spark, sf, "lineitem")
    u = O.union_distinct([li.where("l_quantity > 20").select("l_orderkey", "l_partkey"), li.where("l_discount > 0.05").select("l_orderkey", "l_partkey")], ["l_orderkey", "l_partkey"])
    return u.groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("q_facet_counts", "select l_partkey, count(*) as n_occurrences, p_brand as raw from lineitem join part on l_partkey = p_partkey group by 1, 3 having count(*) >= 30")
def facet_counts(spark, sf):
    sp = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.concat(F.lit("Bison "), F.lit("bison")).alias("name"), F.lit("").alias("genus"), F.col("p_brand").alias("kingdom"), F.lit("").alias("phylum"))
    kept, _ = O.facets(table(spark, sf, "lineitem").select("l_partkey"), sp, "l_partkey", 30)
    return kept.select("l_partkey", "n_occurrences", F.col("kingdom").alias("raw"))


@query("q_chunk_maximum", "select k, max(n) as n from (select l_suppkey as k, count(*) as n from lineitem group by l_suppkey, l_returnflag) group by 1")
def chunks(spark, sf):
    li = table(spark, sf, "lineitem")
    return O.chunk_maximum([li.where(F.col("l_returnflag") == f).groupBy(F.col("l_suppkey").alias("k")).agg(F.count("*").alias("n")) for f in "ANR"], "k", "n")


@query("q_species_localities", "select o_orderkey, c_name, n_name, coalesce(nullif(o_orderstatus, 'F'), c_mktsegment) as tag from orders left join customer on o_custkey = c_custkey left join nation on o_custkey % 25 = n_nationkey")
def localities(spark, sf):
    links = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("sp"), (F.col("o_custkey") % 25).alias("loc"), F.nullif("o_orderstatus", F.lit("F")).alias("tag"))
    sp = table(spark, sf, "customer").select(F.col("c_custkey").alias("sp"), "c_name", F.col("c_mktsegment").alias("tag"))
    loc = table(spark, sf, "nation").select(F.col("n_nationkey").alias("loc"), "n_name")
    return O.species_localities(sp, loc, links, "sp", "loc").select("o_orderkey", "c_name", "n_name", "tag")


@query("q_priority_key_match", """with m as (select 'Supplier-' || cast(s_suppkey % 40 as varchar) as k, min(s_suppkey) as v from supplier where s_suppkey % 3 <> 0 group by 1),
c as (select s_suppkey, 'Supplier' || case s_suppkey % 4 when 0 then '_' else '-' end || case when s_suppkey % 5 = 0 then '0' else '' end || cast(s_suppkey % 40 as varchar) || case when s_suppkey % 7 = 0 then 'c' else '' end as sid from supplier),
t as (select *, regexp_replace(regexp_replace(sid, '(?i)[cp]$', ''), '-+$', '') as st from c),
x as (select s_suppkey, unnest([sid, st, replace(sid, '_', '-'), regexp_replace(sid, '-0+([0-9])', '-\\1', 'g'), replace(st, '_', '-'), regexp_replace(st, '-0+([0-9])', '-\\1', 'g'), regexp_replace(replace(sid, '_', '-'), '-0+([0-9])', '-\\1', 'g')]) as k, unnest([0, 1, 2, 3, 4, 5, 6]) as tier from t),
h as (select s_suppkey, min(tier) as tier from x join m using (k) group by 1)
select supplier.s_suppkey, cast(tier as integer) as tier from supplier left join h using (s_suppkey)""")  # fmt: skip
def priority_match(spark, sf):
    k = F.col("s_suppkey")
    s = table(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("Supplier"), F.when(k % 4 == 0, "_").otherwise("-"), F.when(k % 5 == 0, "0").otherwise(""), k % 40, F.when(k % 7 == 0, "c").otherwise("")).alias("sid"))
    known = table(spark, sf, "supplier").where("s_suppkey % 3 <> 0").groupBy(F.concat(F.lit("Supplier-"), k % 40).alias("k")).agg(F.min("s_suppkey").alias("v"))
    return L.by_priority(s, L.sample_candidates(F.col("sid")), known, "k", ["s_suppkey"]).select("s_suppkey", F.col("_tier").alias("tier"))


@query("q_control_types", "select p_partkey, case when regexp_matches(lower(p_name || ' | ' || p_type), 'positive|pos[-_ ]?ctrl') then 'positive_control' when regexp_matches(lower(p_name || ' | ' || p_type), 'web|wash|swab|surface|environmental control') then 'environmental_control' when regexp_matches(lower(p_name || ' | ' || p_type), 'blank|negative') then 'negative_control' when contains(lower(p_type), 'control') then 'control_unspecified' else 'not_control' end as control_type from part")
def controls(spark, sf):
    return table(spark, sf, "part").select("p_partkey", L.control_type(F.col("p_name"), F.col("p_type"), F.lit(""), F.lit("")).alias("control_type"))


@query("q_library_names", "with n as (select s_suppkey, 'AiL-SITE-0' || cast(s_suppkey as varchar) || '-c-' || case s_suppkey % 3 when 0 then 'Shg' when 1 then 'E-PNmp' else 'X' end || '_S' || cast(s_suppkey % 9 as varchar) || '_PE.mapped.min24' as col from supplier) select s_suppkey, regexp_replace(regexp_replace(regexp_replace(col, '_PE[.]mapped.*', ''), '_S[0-9]+$', ''), '^AiL-', '') as merged, case s_suppkey % 3 when 0 then 'Shg' when 1 then 'E-PNmp' else 'unknown' end as chemistry from n")
def library_names(spark, sf):
    k = F.col("s_suppkey")
    col = F.concat(F.lit("AiL-SITE-0"), k, F.lit("-c-"), F.when(k % 3 == 0, "Shg").when(k % 3 == 1, "E-PNmp").otherwise("X"), F.lit("_S"), k % 9, F.lit("_PE.mapped.min24"))
    stem = N.without_lane(N.library_stem(col))
    return table(spark, sf, "supplier").select("s_suppkey", N.without_batch(stem).alias("merged"), N.chemistry(stem).alias("chemistry"))


@query("q_linker_full")
def linker_full(spark, sf):
    k = F.col("s_suppkey")
    cols = table(spark, sf, "supplier").select(F.concat(F.lit("AiL-SITE-"), k, F.lit("-c-Shg_S"), k % 9, F.lit("_PE.mapped.x")).alias("column"), k.alias("ordinal"))
    meta = table(spark, sf, "supplier").where("s_suppkey % 4 <> 0").select(F.concat(F.lit("AiL-SITE-"), k, F.lit("-c-Shg")).alias("stem_key"), F.concat(F.lit("SITE-"), k, F.lit("c")).alias("sample_id"), F.when(k % 5 == 0, "extraction blank").otherwise("sediment").alias("sample_type"), F.lit("SITE").alias("site"), F.lit("").alias("context"), F.col("s_acctbal").alias("extra"))
    known = table(spark, sf, "supplier").where("s_suppkey % 3 = 0").select(F.concat(F.lit("SITE-"), k).alias("sample"))
    return L.linked(cols, meta, known).select("column", "sample_id", "damage_name", "derivation", "control_type", "group", "chemistry", "merged_name", "is_negative_control")


@query("q_canonical_keys", "select p_partkey, array_to_string(list_filter(string_split_regex(trim(regexp_replace(p_name, '[^A-Za-z -]+', ' ', 'g')), '\\s+'), lambda x: x <> '')[1:2], ' ') as key from part")
def canonical(spark, sf):
    return table(spark, sf, "part").select("p_partkey", N.canonical_key(F.col("p_name")).alias("key"))


@query("q_name_cleaner_collection")
def cleaner_a(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.split_part("text", F.lit("\n"), F.lit(1)).alias("name"))
    return d.select("doc_id", F.explode(N.slash_names(F.col("name"))).alias("name")).select("doc_id", N.collection_name(F.col("name"), "trinomial").alias("c")).select("doc_id", "c.*")


@query("q_name_cleaner_published")
def cleaner_b(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.split_part("text", F.lit("\n"), F.lit(1)).alias("name"))
    return d.select("doc_id", N.published_name(F.col("name"), "trinomial").alias("c")).select("doc_id", "c.*")


@query("q_organism_inference", "select p_partkey, case when p_size % 4 = 0 then 'Animalia' when contains(lower(p_type), 'brass') then 'Unknown' else 'Unknown' end as kingdom from part")
def organisms(spark, sf):
    g = P.group_of(F.when(F.col("p_size") % 4 == 0, "MAM").otherwise(""), F.lit(""), F.col("p_type"))
    return table(spark, sf, "part").select("p_partkey", g.alias("g")).select("p_partkey", "g.kingdom")


@query("q_search_list", "select distinct p_brand as name from part order by 1")
def search_list(spark, sf):
    return O.search_list(table(spark, sf, "part"), "p_brand")


@query("q_genus_fallback", "select count(*) as n from (select distinct p_name as n from part union select distinct split_part(p_name, ' ', 1) from part)")
def genus_fallback(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_name").alias("species"), F.lit("").alias("kingdom"), F.lit("").alias("phylum"), F.col("p_partkey").alias("ordinal"))
    return O.genus_fallback(p)[0].agg(F.count("*").alias("n"))


@query("q_availability", "select o_orderkey, case when o_custkey % 11 = 0 then 'NO_TAXID' when o_custkey % 5 > 0 then 'ASSEMBLY' when o_custkey % 3 > 0 and o_custkey % 7 > 0 then 'NUCCORE+SRA' when o_custkey % 7 > 0 then 'SRA' when o_custkey % 3 > 0 then 'NUCCORE' else 'NONE' end as label from orders")
def availability(spark, sf):
    k = F.col("o_custkey")
    return table(spark, sf, "orders").select("o_orderkey", O.availability(k % 5, k % 3, k % 7, k % 11 != 0).alias("label"))


@query("q_common_names", "select n_nationkey, case when n_nationkey = 3 then 'three' when n_name = 'CHINA' then 'china' else '' end as common_name, case when n_nationkey = 3 then 'override_id' when n_name = 'CHINA' then 'builtin' else 'none' end as source from nation")
def common(spark, sf):
    n = table(spark, sf, "nation")
    return n.select("n_nationkey", L.common_name(F.col("n_nationkey"), F.col("n_name"), {"3": "three"}, {"NOWHERE": "x"}, {"CHINA": "china"}).alias("c")).select("n_nationkey", "c.*")
