"""Queries of validation, filters, vocabularies and landed files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from moraine.config import CURATE
from moraine.functions import names as N
from moraine.functions import presets as P
from moraine.operators import curate as C
from moraine.operators import occurrences as O
from moraine.operators import report as R
from moraine.operators import redundancy as D
from moraine.operators import rules, screens
from moraine.operators import validate as V
from moraine.plans import curate as curated
from moraine.plans import panel
from moraine.plans.standins import RECORDS, records, table
from moraine.scratch import shared_dir
from moraine.sources import fasta, sinks, tables

QUERIES, ORACLES = {}, {}
WITH = "with " + RECORDS.strip()


def query(name, oracle=None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def landed(spark):
    return f"{shared_dir(spark)}/landed-{uuid.uuid4().hex}"


def one_of(key, *values):
    """The value at key modulo their number."""
    out = F.when(key % len(values) == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], 1):
        out = out.when(key % len(values) == i, F.lit(v))
    return out


def sql_one_of(key, *values):
    said = lambda v: "null" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return f"case {key} % {len(values)} " + " ".join(f"when {i} then {said(v)}" for i, v in enumerate(values)) + " end"


@query("q_status_filters", "with e as (select event_id, case event_id % 3 when 0 then true when 1 then false end as x from events) select event_id, coalesce(x, false) as collection_extinct, coalesce(not x, false) as collection_extant, coalesce(x, true) as published_extinct, coalesce(not x, true) as published_extant, coalesce(x, true) as locality_extinct, coalesce(not x, false) as locality_extant from e")
def statuses(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, True).when(F.col("event_id") % 3 == 1, False).alias("x"))
    x, missing = F.col("x"), F.coalesce("x", F.lit(True))
    each = {"collection": (x, False), "published": (x, True), "locality": (missing, True)}
    return e.select("event_id", *(O.status_ok(c, wanted, passes).alias(f"{n}_{wanted}") for n, (c, passes) in each.items() for wanted in ("extinct", "extant")))


PHYLA, KLASSES = ("Chordata", "Mollusca", None, "Tracheophyta", "Ascomycota"), ("Aves", "Insecta", None, "Mammalia")


@query("q_invertebrates", f"select p_partkey from part where coalesce({sql_one_of('p_size', *PHYLA)}, '') <> 'Chordata' and coalesce({sql_one_of('p_partkey', *KLASSES)}, '') not in ('Aves', 'Mammalia')")
def invertebrates(spark, sf):
    return table(spark, sf, "part").where(O.invertebrate(one_of(F.col("p_size"), *PHYLA), one_of(F.col("p_partkey"), *KLASSES))).select("p_partkey")


@query("q_kingdom_phylum", f"""with r as (select p_partkey, {sql_one_of('p_partkey', '', None, 'Protista')} as k, coalesce({sql_one_of('p_size', *PHYLA)}, '') as p, coalesce({sql_one_of('p_partkey', *KLASSES)}, '') as c from part)
select p_partkey, case when coalesce(k, '') <> '' then k when p in ('Chordata', 'Mollusca') or c in ('Aves', 'Mammalia') then 'Animalia' when p = 'Tracheophyta' then 'Plantae' when p = 'Ascomycota' then 'Fungi' else 'Unknown' end as kingdom,
  case when coalesce(k, '') = '' and p = '' and c in ('Aves', 'Mammalia') then 'Chordata' else p end as phylum from r""")
def kingdom_phylum(spark, sf):
    k = P.kingdom_phylum(one_of(F.col("p_partkey"), "", None, "Protista"), one_of(F.col("p_size"), *PHYLA), one_of(F.col("p_partkey"), *KLASSES))
    return table(spark, sf, "part").select("p_partkey", k.alias("k")).select("p_partkey", "k.*")


RECORD = """with r as (select 'S' || cast(l_suppkey as varchar) as search_name, (l_orderkey * 10 + l_linenumber) * 100000 + l_partkey as o, case l_partkey % 3 when 0 then '' when 1 then 'Unknown' else 'K' || cast(l_partkey % 4 as varchar) end as kingdom,
  'C' || cast(l_partkey % 7 as varchar) as country, case when l_linenumber = 1 then '' else 'L' || cast(l_linenumber as varchar) end as place, l_discount as min_ma, l_tax as max_ma from lineitem)"""


def published(spark, sf):
    k = F.col("l_partkey")
    blank = {c: F.lit("") for c in ("genus", "rank", "binomial", "status", "phylum", "taxon_key", "identified_name", "early", "late")}
    place = F.when(F.col("l_linenumber") == 1, "").otherwise(F.concat(F.lit("L"), "l_linenumber"))
    kingdom = F.when(k % 3 == 0, "").when(k % 3 == 1, "Unknown").otherwise(F.concat(F.lit("K"), k % 4))
    return table(spark, sf, "lineitem").select(F.concat(F.lit("S"), "l_suppkey").alias("search_name"), ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 100000 + k).alias("ordinal"), kingdom.alias("kingdom"), F.concat(F.lit("C"), k % 7).alias("country"), place.alias("collection"), place.alias("locality"), F.col("l_discount").alias("min_ma"), F.col("l_tax").alias("max_ma")).withColumns(blank)


@query("q_published_taxa", RECORD + " select search_name, coalesce(min_by(kingdom, o) filter (kingdom not in ('', 'Unknown')), min_by(kingdom, o)) as kingdom, count(*) as n_records, string_agg(distinct country, ';' order by country) as countries, count(distinct nullif(place, '')) as n_collections, min(min_ma) as min_ma, max(max_ma) as max_ma from r group by 1 having count(*) >= 3")
def published_taxa(spark, sf):
    return O.published_taxa(published(spark, sf), 3).select("search_name", "kingdom", "n_records", "countries", "n_collections", "min_ma", "max_ma")


@query("q_locality_taxa", RECORD + " select search_name, 'Animalia' as kingdom, 'Chordata' as phylum, count(*) as n_records, coalesce(string_agg(distinct nullif(place, ''), ';' order by nullif(place, '')), '') as localities, min(min_ma) as min_ma, max(max_ma) as max_ma from r group by 1 having count(*) >= 3")
def locality_taxa(spark, sf):
    rows = published(spark, sf).drop("kingdom", "phylum")
    return O.locality_taxa(rows, 3).select("search_name", "kingdom", "phylum", "n_records", "localities", "min_ma", "max_ma")


@query("q_numbers_and_truth", f"with r as (select c_custkey, {sql_one_of('c_custkey', '12.5', 'NA', '', ' 7 ', 'x', 'nan')} as n, {sql_one_of('c_custkey', 'Yes', 'no', 'extinct', 'extant', 'T', 'maybe', None)} as t from customer) select c_custkey, try_cast(case when n in ('NA', '', 'nan') then null else trim(n) end as double) as number, try_cast(case when n in ('NA', '', 'nan') then null else trim(n) end as double) / 1000.0::double as ma, case when lower(t) in ('yes', 'extinct', 't') then true when lower(t) in ('no', 'extant') then false end as truth from r")
def numbers(spark, sf):
    k = F.col("c_custkey")
    n = N.number(one_of(k, "12.5", "NA", "", " 7 ", "x", "nan"))
    return table(spark, sf, "customer").select("c_custkey", n.alias("number"), N.age_in_ma(n, "ka").alias("ma"), N.truth(one_of(k, "Yes", "no", "extinct", "extant", "T", "maybe", None)).alias("truth"))


@query("q_plain_texts", r"with r as (select p_partkey, '  ‘' || p_name || '`   x´' || p_type || ' ' as t from part) select p_partkey, regexp_replace(trim(translate(t, '‘’`´', '''''''''')), '\s+', ' ', 'g') as plain, regexp_replace(regexp_replace(lower(t), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') as slug, regexp_replace(lower(t), '[^a-z0-9]+', '', 'g') as squeezed, regexp_replace(regexp_replace(p_type, '(.{5})', '\1' || chr(10), 'g'), chr(10) || '$', '') as wrapped from r join part using (p_partkey)")
def texts(spark, sf):
    t = F.concat(F.lit("  ‘"), "p_name", F.lit("`   x´"), "p_type", F.lit(" "))
    return table(spark, sf, "part").select("p_partkey", N.plain(t).alias("plain"), N.slug(t).alias("slug"), N.squeezed(t).alias("squeezed"), N.wrapped(F.col("p_type"), 5).alias("wrapped"))


LABELS = ("Metazoa", "Viridiplantae", "true fungi", "Eubacteria", "archaea", "Protozoa", "Chromista", "", None, "Animals", "metazoans")


@query("q_kingdom_labels", f"select c_custkey, {sql_one_of('c_custkey', 'Animal', 'Plant', 'Fungi', 'Bacteria', 'Archaea', 'Protozoa', 'Protist', 'Unknown', 'Unknown', 'Animal', 'Unknown')} as kingdom from customer")
def kingdom_labels(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", rules.kingdom(one_of(F.col("c_custkey"), *LABELS)).alias("kingdom"))


@query("q_slash_names", "with r as (select p_partkey, case p_partkey % 3 when 0 then ['Pinus alba', 'Pinus nigra', 'Pinus rufa'] when 1 then ['Quercus', 'Fagus'] else [p_brand] end as x from part) select p_partkey, unnest(x) as name from r")
def slashes(spark, sf):
    raw = F.when(F.col("p_partkey") % 3 == 0, "Pinus alba/nigra/rufa").when(F.col("p_partkey") % 3 == 1, "Quercus/Fagus").otherwise(F.col("p_brand"))
    return table(spark, sf, "part").select("p_partkey", F.explode(N.slash_names(raw)).alias("name"))


@query("q_display_group", f"""with r as (select n_nationkey, n_name, r_name, {sql_one_of('n_nationkey', 'Animals', 'microbes', None)} as g, n_nationkey % 2 = 0 as fam, n_nationkey % 5 = 4 as bare from nation join region on n_regionkey = r_regionkey)
select n_nationkey, case when bare then coalesce(g, 'Other') when fam and coalesce(g, '') <> 'microbes' then n_name else r_name end as name, case when bare then '' when fam and coalesce(g, '') <> 'microbes' then 'family' else 'phylum' end as rank from r""")
def display_groups(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    path = F.concat(F.lit("1:"), "r_name", F.lit(':"phylum"'), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("\t2:"), "n_name", F.lit(':"family"'))).otherwise(""))
    got = R.display_group(F.when(F.col("n_nationkey") % 5 != 4, path), one_of(F.col("n_nationkey"), "Animals", "microbes", None))
    return n.select("n_nationkey", got.alias("g")).select("n_nationkey", "g.*")


@query("q_short_labels", f"select s_suppkey, 'SITE-' || cast(s_suppkey as varchar) || {sql_one_of('s_suppkey', '', '-x', '')} as label from supplier")
def short_labels(spark, sf):
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select("s_suppkey", R.short_label(F.concat(F.lit(" SITE_"), k, one_of(k, "_Beta-E-PNmp", "_x-shg", "-gamma"))).alias("label"))


@query("q_chimera_verdicts", "with v as (select l_partkey, bool_or(l_returnflag = 'R') as y, bool_or(l_returnflag = 'A') as b from lineitem group by 1) select p_partkey, concat_ws(';', case when y then 'chimera_detected' end, case when b then 'chimera_borderline' end) as reasons from part left join v on p_partkey = l_partkey")
def chimeras(spark, sf):
    r = table(spark, sf, "part").select("p_partkey", F.col("p_partkey").cast("string").alias("record_key"), F.array().cast("array<string>").alias("reasons"))
    v = table(spark, sf, "lineitem").select(F.col("l_partkey").cast("string").alias("query"), F.when(F.col("l_returnflag") == "R", "Y").when(F.col("l_returnflag") == "A", "?").otherwise("N").alias("verdict"))
    return screens.chimera_screen(r, v).select("p_partkey", F.array_join("reasons", ";").alias("reasons"))


@query("q_hook_table", "with v as (select l_suppkey, bool_or(l_returnflag = 'R') as y from lineitem where l_discount > 0.05 group by 1) select s_suppkey, case when y then 'foreign_hit' when not y then 'foreign_review' else '' end as reasons from supplier left join v on s_suppkey = l_suppkey")
def hook(spark, sf):
    r = table(spark, sf, "supplier").select("s_suppkey", F.col("s_suppkey").cast("string").alias("record_key"), F.col("s_name").alias("accession"), F.array().cast("array<string>").alias("reasons"))
    t = table(spark, sf, "lineitem").where("l_discount > 0.05").select(F.col("l_suppkey").cast("string").alias("qseqid"), F.when(F.col("l_returnflag") == "R", "Vector part").otherwise("fine").alias("note"))
    return screens.hook_screen(r, t, "foreign_hit", "foreign_review").select("s_suppkey", F.array_join("reasons", ";").alias("reasons"))


QCOV, FACTOR = CURATE["taxonomy"]["min_qcov"], 3 if CURATE["taxonomy"]["search_type"] == 2 else 1


@query("q_escalation_rescue", f"""with h as (select l_partkey, row_number() over (partition by l_partkey order by (l_orderkey * 10 + l_linenumber) * 10000 + l_suppkey) as n, l_suppkey % 2 = 0 as good from lineitem where 100 - l_discount * 400 >= 70.0 and cast(l_quantity as integer) * {FACTOR} * 100.0 / 50 >= {QCOV}),
r as (select p_partkey, p_size % 2 = 0 as crossed from part)
select p_partkey, case when crossed and good then 'ESCALATION_RESCUED' else 'OLD' end as taxonomy_status, case when crossed and good then 'taxonomy_rescued_second' when crossed then 'taxonomy_cross_kingdom' else '' end as reasons from r left join h on p_partkey = l_partkey and n = 1""")
def escalation(spark, sf):
    crossed = F.when(F.col("p_size") % 2 == 0, F.array(F.lit("taxonomy_cross_kingdom"))).otherwise(F.array().cast("array<string>"))
    r = table(spark, sf, "part").select("p_partkey", F.col("p_partkey").cast("string").alias("record_key"), F.lit("Bison").alias("genus"), F.lit("Bison alba").alias("species"), F.lit("Animal").alias("kingdom"), F.lit("OLD").alias("taxonomy_status"), crossed.alias("reasons"))
    h = curated.hits(spark, sf).withColumns({"qseqid": F.col("staxids"), "ordinal": (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 10000 + F.col("l_suppkey"), "sscinames": F.when(F.col("l_suppkey") % 2 == 0, "Bison priscus").otherwise("Salix alba")})
    out = screens.escalated(r, h, "second", 70.0)
    return out.select("p_partkey", "taxonomy_status", F.array_join("reasons", ";").alias("reasons"))


@query("q_fasta_round_trip", WITH + " select header, accession, sha256(seq) as seq_sha256, cast(length(seq) as bigint) as length from rec")
def round_trip(spark, sf):
    path = landed(spark)
    sinks.write_fasta(records(spark, sf), path)
    return fasta.read_fasta(spark, path).select("header", "accession", F.sha2("seq", 256).alias("seq_sha256"), F.length("seq").cast("long").alias("length"))


@query("q_last_record_wins", "select 'ACC' || cast(doc_id % 150 as varchar) as accession, max(doc_id) as ordinal from documents where doc_id % 7 <> 0 group by 1 union all select 'NC_' || cast(doc_id % 150 as varchar), max(doc_id) from documents where doc_id % 7 = 0 group by 1")
def last_wins(spark, sf):
    return fasta.as_map(records(spark, sf)).select("accession", "ordinal")


@query("q_taxdump", "select cast(s_suppkey + 1000 as bigint) as taxid, cast(s_nationkey + 100 as bigint) as parent, 'species' as rank, s_name as name from supplier union all select cast(n_nationkey + 100 as bigint), cast(n_regionkey + 10 as bigint), 'genus', n_name from nation union all select cast(r_regionkey + 10 as bigint), 1, 'domain', r_name from region union all select 1, 1, 'no rank', 'root'")
def taxdump(spark, sf):
    tree, path = curated.tree(spark, sf), landed(spark)
    line = lambda *cols: F.concat(F.concat_ws("\t|\t", *cols), F.lit("\t|"))
    bad = spark.createDataFrame([("x\t|\t1\t|\tgenus\t|",), ("",)], "value string")
    tree.select(line(F.col("taxid"), F.col("parent"), F.col("rank")).alias("value")).unionByName(bad).write.text(path + "/nodes.dmp")
    names = tree.select(line(F.col("taxid"), F.col("name"), F.lit(""), F.lit("scientific name")).alias("value"))
    names.unionByName(tree.select(line(F.col("taxid"), F.lit("other"), F.lit(""), F.lit("synonym")).alias("value"))).write.text(path + "/names.dmp")
    return tables.taxdump(spark, path + "/nodes.dmp", path + "/names.dmp")


@query("q_hit_table_file", "select cast(l_orderkey as varchar) as qseqid, count(*) as n, round(sum(100 - l_discount * 400), 4) as pident, cast(sum(cast(l_quantity as integer)) as bigint) as length from lineitem where l_suppkey % 5 > 1 group by 1")
def hit_file(spark, sf):
    h, path = curated.hits(spark, sf), landed(spark)
    names = [f.split()[0] for f in tables.TAXONOMY_HITS.split(",")]
    rows = h.select(*(F.col(n).cast("string").alias(n) if n in h.columns else F.lit("1").alias(n) for n in names), "l_suppkey")
    rows = rows.withColumn("pident", F.when(F.col("l_suppkey") % 5 == 0, "n/a").otherwise(F.col("pident")))
    cut = F.when(F.col("l_suppkey") % 5 == 1, F.concat_ws("\t", *names[:3])).otherwise(F.concat_ws("\t", *names))
    rows.select(cut.alias("value")).write.text(path)
    return tables.hits(spark, path).groupBy("qseqid").agg(F.count("*").alias("n"), F.round(F.sum("pident"), 4).alias("pident"), F.sum("length").alias("length"))


@query("q_rebuilt_summary", curated.ORACLES["q_curation_summary"])
def rebuilt(spark, sf):
    path = landed(spark)
    done = C.decided(curated.ready(spark, sf), curated.CFG)
    sinks.write_decisions(done, path)
    return C.rebuilt(tables.read_table(spark, path + "/decisions", sep="\t"))


HIT = """with h as (select l_orderkey as probe, 'T' || cast(l_suppkey % 7 as varchar) as target, l_partkey % 500 as subject_start, cast(l_quantity as integer) as identities, cast(l_quantity as integer) + l_linenumber as align_length, l_extendedprice as bits, l_linenumber from lineitem),
x as (select o_orderkey as probe, case when o_custkey % 3 > 0 then 'T' || cast(o_custkey % 7 as varchar) end as t, case when o_custkey % 4 > 0 then o_custkey % 500 end as s, o_orderkey % 2 = 0 as trusted from orders)"""
BEST = "min_by(struct_pack(target, subject_start, identities), row(case when t is not null and target <> t then 1 else 0 end, coalesce(abs(subject_start - s), 0), -identities, -align_length, -bits, subject_start, target))"


def panel_hits(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(F.col("l_orderkey").alias("probe"), F.concat(F.lit("T"), F.col("l_suppkey") % 7).alias("target"), (F.col("l_partkey") % 500).alias("subject_start"), F.col("l_quantity").cast("int").alias("identities"), (F.col("l_quantity").cast("int") + F.col("l_linenumber")).alias("align_length"), F.col("l_extendedprice").alias("bits"), F.expr("concat(repeat('|', l_linenumber), '   ')").alias("match"), F.when(F.col("l_suppkey") % 3 == 0, F.expr("concat(repeat('A', l_linenumber), 'C-G')")).when(F.col("l_suppkey") % 3 == 1, F.expr("concat(repeat('A', l_linenumber), '--G')")).otherwise(F.expr("concat(repeat('A', l_linenumber), 'CCG')")).alias("subject"), "l_suppkey")


def expected(spark, sf):
    k = F.col("o_custkey")
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("probe"), F.when(k % 3 > 0, F.concat(F.lit("T"), k % 7)).alias("target_id"), F.when(k % 4 > 0, k % 500).alias("start"), F.when(k % 4 > 0, k % 500 + 79).alias("end"), (F.col("o_orderkey") % 2 == 0).alias("trusted"))


@query("q_primary_hit", HIT + f" select probe, b.target as target, b.subject_start as subject_start, b.identities as identities from (select h.probe, {BEST} as b from h left join x using (probe) group by 1)")
def primary(spark, sf):
    return V.primary_hits(panel_hits(spark, sf).drop("l_suppkey", "match", "subject"), expected(spark, sf)).select("probe", "target", "subject_start", "identities")


@query("q_match_bits", "select l_orderkey, l_linenumber, l_suppkey, repeat('1', l_linenumber) || case l_suppkey % 3 when 0 then '00' when 1 then '0' else '000' end as bits from lineitem")
def bits(spark, sf):
    li = panel_hits(spark, sf).withColumn("l_linenumber", F.col("align_length") - F.col("identities"))
    return li.select(F.col("probe").alias("l_orderkey"), F.col("l_linenumber"), "l_suppkey", V.match_bits(F.col("match"), F.col("subject")).alias("bits"))


@query("q_probe_placements", HIT.replace("l_linenumber from lineitem", "l_linenumber, l_suppkey from lineitem") + f""", own as (select * from x where trusted and t is not null and s is not null),
b as (select h.probe, {BEST.replace('struct_pack(target, subject_start, identities)', "struct_pack(target, subject_start, n := l_linenumber + case l_suppkey % 3 when 0 then 2 else 3 end)")} as b from h left join x using (probe) where identities > 25 and l_suppkey % 3 <> 1 and h.probe not in (select probe from own) group by 1)
select probe, t as ref_id, cast(s as bigint) as ref_start, cast(s + 79 as bigint) as ref_end, 'id' as source from own union all select probe, b.target, cast(b.subject_start as bigint), cast(b.subject_start + b.n - 1 as bigint), 'hit' from b""")
def placed(spark, sf):
    return V.placements(expected(spark, sf), panel_hits(spark, sf), 40).withColumns({c: F.col(c).cast("long") for c in ("ref_start", "ref_end")})


@query("q_modal_query", "select l_suppkey, n from (select l_suppkey, count(*) as n from lineitem group by 1) order by n desc, l_suppkey desc limit 1")
def modal(spark, sf):
    return V.modal(table(spark, sf, "lineitem"), "l_suppkey")


HINTS = "case n_nationkey % 5 when 0 then n_name when 1 then '-' || lower(n_name) || '.' when 2 then 'pre ' || n_name || ' post' when 3 then substr(n_name, 1, 4) else 'qqq 77' end"


@query("q_target_resolution", f"""with t as (select n_name as t, regexp_replace(lower(n_name), '[^a-z0-9]', '', 'g') as tn from nation), h as (select distinct h, regexp_replace(lower(h), '[^a-z0-9]', '', 'g') as hn from (select {HINTS} as h from nation)),
a as (select h, t, 1 as tier from h join t on h = t union all select h, min(t), 2 from h join t on hn = tn group by h having count(*) = 1 union all select h, min(t), 3 from h join t on contains(tn, hn) or contains(hn, tn) group by h having count(*) = 1
  union all select h, min(t), 4 from (select h, unnest(regexp_extract_all(h, '[A-Z]{{1,4}}[_-]?[0-9]+')) as a from h) join t on contains(tn, regexp_replace(lower(a), '[^a-z0-9]', '', 'g')) group by h having count(*) = 1)
select h.h as ref_hint, min_by(t, tier) as target_id from h left join a using (h) group by 1""")
def resolution(spark, sf):
    n = table(spark, sf, "nation")
    return V.resolved(n.select(F.expr(HINTS.replace("varchar", "string")).alias("ref_hint")), n.select(F.col("n_name").alias("ref_id")))


@query("q_panel_hit_screen", panel.TILES + """, k as (select *, least(bait, reverse(translate(bait, 'ACGTN', 'TGCAN'))) as key from pr),
bad as (select distinct l_suppkey as r from lineitem where case when l_linestatus = 'F' then l_quantity >= 50 * 0.95 and l_quantity + l_linenumber >= 50 * 0.83 else l_quantity >= 49 and l_partkey % 3 = 0 end)
select bait_id from k where ref_id % 2 = 1 and key not in (select key from k where ref_id % 2 = 0) and bait_id not in (select bait_id from k join bad on ref_id = r)""")
def hit_screen(spark, sf):
    p = panel.probes(spark, sf)
    li = table(spark, sf, "lineitem")
    li = li.select(F.col("l_suppkey").alias("ref_id"), F.when(F.col("l_linestatus") == "F", "plus").otherwise("minus").alias("sstrand"), F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(F.when((F.col("l_quantity") >= 49) & (F.col("l_partkey") % 3 == 0), 30).otherwise(0)).alias("nident"), (F.col("l_quantity") + F.col("l_linenumber")).alias("length"), F.lit(50).alias("qlen")).distinct()
    hits = p.select("ref_id", F.col("bait_id").alias("qseqid")).join(li, "ref_id")
    return V.screened(p.where("ref_id % 2 = 1"), p.where("ref_id % 2 = 0"), hits).select("bait_id")


@query("q_recommendation_counts", f"select count(*) filter (severity <> 'info') as actionable, count(*) filter (severity = 'info') as informational from ({panel.ORACLES['q_recommendations_union']})")
def recommendation_counts(spark, sf):
    return V.recommendation_counts(panel.QUERIES["q_recommendations_union"](spark, sf))


@query("q_cut_regions", WITH + """, r as (select ordinal as ref_id, seq, length, length // 4 as a, length // 3 as b, length // 2 as c from met where length >= 12 and ordinal % 3 > 0),
p as (select ref_id, seq, unnest([0, c]) as s, unnest([a, length]) as e from r)
select cast(ref_id as varchar) || '_[' || cast(s as varchar) || ':' || cast(e as varchar) || ']' as ref_id, sha256(substr(seq, s + 1, e - s)) as seq_sha256 from p where e - s >= 20
union all select cast(ordinal as varchar), sha256(seq) from met where not (length >= 12 and ordinal % 3 > 0)""")
def cut(spark, sf):
    refs = panel.refs(spark, sf)
    n = F.col("length")
    some = refs.where((n >= 12) & (F.col("ref_id") % 3 > 0))
    q = lambda k: F.floor(n / k)
    regions = some.select("ref_id", F.explode(F.array(F.struct(q(4).alias("a"), q(3).alias("b")), F.struct((q(4) + F.floor((q(3) - q(4)) / 2)).alias("a"), q(2).alias("b")))).alias("x")).select("ref_id", "x.*")
    return V.cut_regions(refs, regions, 20).select("ref_id", F.sha2("seq", 256).alias("seq_sha256"))


@query("q_cluster_representatives")
def clustered(spark, sf):
    """Held against a sequential pass in tests."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    hits = li.alias("x").join(li.alias("y"), "l_orderkey").where("x.l_suppkey <> y.l_suppkey").select(F.col("x.l_suppkey").alias("qseqid"), F.col("y.l_suppkey").alias("sseqid"), F.col("x.l_quantity").alias("nident"), F.lit(50).alias("length"))
    probes = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("bait_id"), F.expr("repeat('A', cast(40 + s_suppkey % 20 as int))").alias("seq"))
    return D.cluster_representatives(probes, hits).select("bait_id")


@query("q_requested_area", f"with r as (select c_custkey, c_custkey % 180 - 90.0 as lat, c_custkey % 360 - 180.0 as lon, {sql_one_of('c_nationkey', 'de', 'FR', 'se', None)} as c, {sql_one_of('c_custkey', 'EUROPE', 'asia', 'AFRICA')} as k, {sql_one_of('c_custkey', 'OBSERVATION', 'FOSSIL_SPECIMEN')} as b from customer) select c_custkey from r where lon between -25 and 45 and lat between 34 and 72 and upper(c) in ('DE', 'FR') and upper(k) in ('EUROPE', 'ASIA') and b in ('HUMAN_OBSERVATION', 'OBSERVATION')")
def area(spark, sf):
    k = F.col("c_custkey")
    wanted = P.requested("europe", ["de", " fr "], ["eurasia"], "observed", with_coordinates=True)
    return table(spark, sf, "customer").where(P.matching(k % 180 - F.lit(90.0), k % 360 - F.lit(180.0), one_of(F.col("c_nationkey"), "de", "FR", "se", None), one_of(k, "EUROPE", "asia", "AFRICA"), one_of(k, "OBSERVATION", "FOSSIL_SPECIMEN"), wanted)).select("c_custkey")


@query("q_cache_entries", f"""with r as (select c_custkey, {sql_one_of('c_custkey', '{"name": "elk", "src": "a"}', 'elk', '', None, '{"name": ""}')} as e from customer) select c_custkey, case c_custkey % 5 when 0 then 'elk' when 1 then 'elk' end as name, case c_custkey % 5 when 0 then 'a' when 1 then 'cache' when 4 then 'cache' else 'cache-miss' end as source from r""")
def cache(spark, sf):
    k = F.col("c_custkey")
    return O.decoded_cache(table(spark, sf, "customer").select("c_custkey", one_of(k, '{"name": "elk", "src": "a"}', "elk", "", None, '{"name": ""}').alias("entry")), "c_custkey")
