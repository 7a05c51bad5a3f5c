"""Queries of the curation operators."""

from __future__ import annotations


from pyspark.sql import functions as F

from moraine.config import CURATE, DAMAGE, merged
from moraine.functions import sequence as S
from moraine.operators import curate as C
from moraine.operators import rules as R
from moraine.operators import damage, occurrences, screens, taxonomy
from moraine.plans.standins import RECORDS, records, table
from moraine.streaming import ingest

QUERIES, ORACLES = {}, {}
#: The driver's texts are not DNA: limits that split them.
CFG = merged(CURATE, {"qc": {"min_length": 60, "max_length": 2000, "max_n_fraction": 0.25, "min_entropy": 1.85, "max_run": 4, "min_length_by_class": {"Mito": 100}}, "caps": {"by_class": {"Mito": 2, "Plastid": 3, "NucMark": 1, "Other": 4}}})
KEYWORDS = [("UNVERIFIED", "review", "unverified"), ("clone", "reject", "clone")]
REASONS = """
rs as (
  select *, list_filter([case when dup_acc then 'duplicate_accession' end, case when dup_seq then 'duplicate_sequence' end,
    case when length < 60 then 'length_below_min' end, case when length > 2000 then 'length_above_max' end,
    case when marker_class = 'Mito' and length < 100 then 'length_below_class_min' end,
    case when n_fraction > 0.25 then 'n_fraction_high' end,
    case when length = 0 then 'non_iupac_fraction_high' end,
    case when round(entropy, 9) < 1.85 then 'low_complexity' end, case when run > 4 then 'homopolymer_long' end,
    case when accession like 'NC\\_%' escape '\\' then 'refseq_preferred' end, case when marker_class = 'Plastid' then 'voucher_keyword' end,
    case when marker_class = 'Mito' then 'complete_organelle' end, case when marker_class = 'Other' then 'bad_keyword_review' end],
    lambda x: x is not null) as reasons
  from dup join run using (ordinal)),
wt as (select * from (values ('duplicate_accession', -100), ('duplicate_sequence', -100), ('length_below_min', -100), ('length_above_max', -100),
  ('length_below_class_min', -100), ('n_fraction_high', -20), ('non_iupac_fraction_high', -40), ('low_complexity', -25), ('homopolymer_long', -20),
  ('refseq_preferred', 10), ('voucher_keyword', 5), ('complete_organelle', 5), ('bad_keyword_review', -30)) as t(reason, w)),
sc as (
  select rs.*, 100 + coalesce((select sum(w) from wt where list_contains(reasons, reason)), 0) as score,
    len(list_intersect(reasons, ['duplicate_accession', 'duplicate_sequence', 'length_below_min', 'length_above_max', 'length_below_class_min', 'non_iupac_fraction_high'])) > 0 as hard,
    len(list_intersect(reasons, ['low_complexity', 'homopolymer_long', 'bad_keyword_review'])) > 0 as rev
  from rs),
de as (select *, case when hard then 'REJECT' when score >= 65 and not rev then 'KEEP' when score >= 30 then 'REVIEW' else 'REJECT' end as decision from sc)
"""
RUN = """
ch as (select ordinal, unnest(generate_series(1, length)) as i, seq from met where length > 0),
cl as (select ordinal, i, substr(seq, i, 1) as c from ch),
gr as (select ordinal, c, i - row_number() over (partition by ordinal, c order by i) as g from cl),
rn as (select ordinal, count(*) as n from gr group by ordinal, c, g),
run as (select met.ordinal, cast(coalesce(max(n), 0) as integer) as run from met left join rn using (ordinal) group by met.ordinal)
"""
WITH = "with " + RECORDS.strip() + ", " + RUN.strip()
DECIDED = WITH + ", " + REASONS.strip()


def query(name, oracle=None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def ready(spark, sf):
    return C.annotated(records(spark, sf), CFG, keywords=KEYWORDS)


@query("q_seq_metrics", WITH + " select ordinal, length, n_count, round(n_fraction, 6) as n_fraction, round(gc_fraction, 6) as gc_fraction, round(entropy, 6) as entropy, run as longest_run from met join run using (ordinal)")
def seq_metrics(spark, sf):
    m = C.metrics(records(spark, sf))
    return m.select("ordinal", "length", "n_count", *(F.round(c, 6).alias(c) for c in ("n_fraction", "gc_fraction", "entropy")), "longest_run")


@query("q_seq_hash_revcomp", WITH + " select ordinal, sha256(seq) as seq_sha256, sha256(reverse(translate(seq, 'ACGTN', 'TGCAN'))) as rc_sha256 from rec")
def seq_hash(spark, sf):
    return records(spark, sf).select("ordinal", S.sequence_hash(F.col("seq")).alias("seq_sha256"), F.sha2(S.reverse_complement(F.col("seq")), 256).alias("rc_sha256"))


@query("q_unique_record_keys", WITH + ", k as (select *, row_number() over (partition by accession order by ordinal) as n from rec) select ordinal, accession, case when n > 1 then accession || '__dup' || cast(n as varchar) else accession end as record_key from k")
def keys(spark, sf):
    return C.unique_keys(records(spark, sf)).select("ordinal", "accession", "record_key")


@query("q_exact_dedup_flags", WITH + " select ordinal, dup_acc as duplicate_accession, dup_seq as duplicate_sequence from dup")
def dedup_flags(spark, sf):
    return C.duplicates(C.metrics(records(spark, sf))).select("ordinal", "duplicate_accession", "duplicate_sequence")


@query("q_header_names", WITH + " select ordinal, species, genus, marker_class from rec")
def header_names(spark, sf):
    r = records(spark, sf)
    return r.select("ordinal", R.species(F.col("header")).alias("s"), R.marker(F.col("header")).alias("m")).select("ordinal", "s.species", "s.genus", "m.marker_class")


@query("q_qc_reasons", DECIDED + " select ordinal, array_to_string(reasons, ';') as reasons from de")
def qc_reasons(spark, sf):
    return ready(spark, sf).select("ordinal", F.array_join("reasons", ";").alias("reasons"))


@query("q_score_decide", DECIDED + " select ordinal, cast(score as bigint) as decision_score, decision from de")
def score_decide(spark, sf):
    return C.decided(ready(spark, sf), CFG).select("ordinal", F.col("decision_score").cast("long").alias("decision_score"), "decision")


@query("q_decision_by_class", DECIDED + " select decision, marker_class, count(*) as n from de group by 1, 2")
def decision_by_class(spark, sf):
    return C.decided(ready(spark, sf), CFG).groupBy("decision", "marker_class").agg(F.count("*").alias("n"))


@query("q_decision_cube", DECIDED + " select decision, marker_class, lang, count(*) as n from de group by grouping sets ((decision), (decision, marker_class), (lang, decision), ())")
def decision_cube(spark, sf):
    C.decided(ready(spark, sf), CFG).createOrReplaceTempView("_decided")
    return spark.sql("select decision, marker_class, lang, count(*) as n from _decided group by grouping sets ((decision), (decision, marker_class), (lang, decision), ())")


@query("q_reason_frequency", DECIDED + ", r as (select unnest(reasons) as reason from de) select reason, count(*) as n from r group by 1")
def reason_frequency(spark, sf):
    return C.reason_frequency(ready(spark, sf))


@query("q_curation_summary", DECIDED + ", r as (select unnest(reasons) as reason from de) select 'decision' as section, decision as key, count(*) as value from de group by 2 union all select 'decision_by_class', decision || ':' || marker_class, count(*) from de group by 2 union all select 'reason', reason, count(*) from r group by 2")
def curation_summary(spark, sf):
    return C.summary(C.decided(ready(spark, sf), CFG))


@query("q_dup_rescue", DECIDED + """, w as (select *, max(case when not dup_seq and not dup_acc then 1 else 0 end) over (partition by species) as has, dup_seq and not dup_acc as can from de),
r as (select *, row_number() over (partition by species order by can desc, accession like 'NC\\_%' escape '\\' desc, length desc, n_count, ordinal) as n from w)
select ordinal, has = 0 and can and n = 1 as rescued from r""")  # fmt: skip
def dup_rescue(spark, sf):
    return C.rescued_duplicates(ready(spark, sf)).select("ordinal", F.array_contains("reasons", "rescued_duplicate").alias("rescued"))


CAPS = DECIDED + """, cr as (select *, case when decision <> 'REJECT' then row_number() over (partition by species, marker_class, decision <> 'REJECT' order by case when decision = 'KEEP' then 0 else 1 end, score desc, length desc, n_fraction, accession, ordinal) else 0 end as cap_rank,
  case marker_class when 'Mito' then 2 when 'Plastid' then 3 when 'NucMark' then 1 else 4 end as cap from de)"""


@query("q_cap_per_group", CAPS + " select ordinal, cast(cap_rank as bigint) as cap_rank, case when cap_rank > cap and decision = 'KEEP' then 'REVIEW' else decision end as decision, cap_rank > cap as over_cap from cr")
def cap(spark, sf):
    out = C.capped(C.decided(ready(spark, sf), CFG), CFG)
    return out.select("ordinal", F.col("cap_rank").cast("long").alias("cap_rank"), "decision", F.array_contains("reasons", "cap_exceeded").alias("over_cap"))


@query("q_sole_representative", DECIDED + """, w as (select *, max(case when decision = 'KEEP' then 1 else 0 end) over (partition by species, marker_class) as has from de),
r as (select *, row_number() over (partition by species, marker_class order by decision = 'REVIEW' desc, score desc, length desc, n_fraction, ordinal) as n from w)
select ordinal, case when has = 0 and decision = 'REVIEW' and n = 1 then 'KEEP' else decision end as decision from r""")  # fmt: skip
def sole(spark, sf):
    return C.sole_representatives(C.decided(ready(spark, sf), CFG)).select("ordinal", "decision")


@query("q_species_coverage", DECIDED + " select species as who, case when max(case when marker_class = 'Plastid' then 1 else 0 end) = 1 then 'Plant' else 'Unknown' end as kingdom, count(*) filter (decision = 'KEEP') as n_keep, count(*) filter (decision = 'REVIEW') as n_review, count(*) filter (decision = 'REJECT') as n_reject, count(*) as n_total, case when count(*) filter (decision = 'KEEP') = 0 then 'NO KEEP' else '' end as note from de group by species")
def coverage(spark, sf):
    return C.species_coverage(C.decided(ready(spark, sf), CFG))


@query("q_curate_full")
def full(spark, sf):
    out = C.run(records(spark, sf), CFG, keywords=KEYWORDS)
    return out.select("ordinal", "record_key", "decision", "decision_score", "cap_rank", F.array_join("reasons", ";").alias("reasons"))


@query("q_keyword_first_match", "select doc_id, case when contains(lower(text), 'licensed under') then 'licensed under' when contains(lower(text), 'all rights reserved') then 'all rights reserved' when contains(lower(text), 'the ') then 'the ' end as keyword, case when contains(lower(text), 'licensed under') then 'reject' when contains(lower(text), 'all rights reserved') then 'review' when contains(lower(text), 'the ') then 'review' end as action from documents")
def keyword(spark, sf):
    rules = [("Licensed under", "reject", "licence"), ("All rights reserved", "review", "rights"), ("the ", "review", "word")]
    k = R.keyword(F.col("text"), rules)
    return table(spark, sf, "documents").select("doc_id", k.alias("k")).select("doc_id", F.lower("k.keyword").alias("keyword"), "k.action")


@query("q_rule_first_match", "select p_partkey, case when regexp_matches(p_type, '(?i)brass') then 'brass' when regexp_matches(p_type, '(?i)^(small|medium)') then 'compact' when regexp_matches(p_name, '(?i)a.*e') then 'named' else 'none' end as rule from part")
def rule(spark, sf):
    rules = [("brass", "p_type", "(?i)brass"), ("compact", "p_type", "(?i)^(small|medium)"), ("named", "p_name", "(?i)a.*e")]
    return table(spark, sf, "part").select("p_partkey", R.first_match(rules, lambda r: F.col(r[1]).rlike(r[2]), lambda r: F.lit(r[0]), F.lit("none")).alias("rule"))


@query("q_kingdom_lookup", WITH + " select ordinal, case lower(species) when 'bison sp1' then 'Fungi' when 'equus sp2' then 'Animal' when 'bison sp9' then 'Plant' else case genus when 'Bison' then 'Animal' when 'Equus' then 'Animal' when 'Salix' then 'Plant' else case when marker_class = 'Plastid' then 'Plant' else 'Unknown' end end end as kingdom from rec")
def kingdom(spark, sf):
    known = [("Bison sp1", "Bison", "Animal", 1), ("Equus sp2", "", "animals", 2), ("", "Salix", "Viridiplantae", 3), ("Bison sp1", "", "fungi", 4), ("Bison sp9", "Bison", "Plant", 5)]
    sk = spark.createDataFrame(known, "species string, genus string, kingdom string, ordinal int")
    return C.annotated(records(spark, sf), CFG, species_kingdom=sk).select("ordinal", "kingdom")


ADAPTER = "TTAACTGGACTTATCGGTAT"


@query("q_adapter_exact_scan", WITH + " select ordinal, cast(case when instr(seq, 'ATTATTATTATT') > 0 then instr(seq, 'ATTATTATTATT') - 1 end as integer) as pos from rec")
def adapter_exact(spark, sf):
    return records(spark, sf).select("ordinal", screens.find(F.col("seq"), "ATTATTATTATT").alias("pos"))


HAMMING = WITH + """, s as (select ordinal, seq, unnest(generate_series(1, length - 11)) as i from met where length >= 12),
h as (select ordinal, min(i) - 1 as near from s where hamming(substr(seq, i, 12), 'ATTAGTCATTAN') <= 3 group by 1)
select rec.ordinal, cast(case when instr(seq, 'ATTAGTCATTAN') > 0 then instr(seq, 'ATTAGTCATTAN') - 1 else near end as integer) as pos from rec left join h using (ordinal)"""


@query("q_adapter_hamming", HAMMING)
def adapter_near(spark, sf):
    return records(spark, sf).select("ordinal", screens.find(F.col("seq"), "ATTAGTCATTAN", 3).alias("pos"))


@query("q_adapter_screen")
def adapter_screen(spark, sf):
    out = screens.adapter_screen(ready(spark, sf), [("one", "ATTAGTCATTAN", 2), ("two", ADAPTER, 6)], CFG)
    out = screens.trimmed(out, [("one", "ATTAGTCATTAN", 2), ("two", ADAPTER, 6)], CFG)
    return out.select("ordinal", "adapter_name", "adapter_position", "adapter_terminal", F.array_join("reasons", ";").alias("reasons"), F.length("seq").alias("n"))


@query("q_sliding_windows", WITH + ", l as (select ordinal, seq, length, greatest(length - 500, 0) as last from met where length >= 1000), s as (select ordinal, seq, unnest(list_sort(list_distinct(list_concat(generate_series(0, last, 250), [last::bigint])))) as st from l) select ordinal, cast(st + 1 as bigint) as start, cast(st + length(substr(seq, st + 1, 500)) as bigint) as \"end\", sha256(substr(seq, st + 1, 500)) as window_sha256 from s")
def sliding(spark, sf):
    w = screens.windows(records(spark, sf), CFG, key="ordinal")
    return w.select("ordinal", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.sha2("window", 256).alias("window_sha256"))


def hits(spark, sf):
    """lineitem as a hit table: an order is a query, its lines are hits in file order."""
    li = table(spark, sf, "lineitem")
    return li.select(F.col("l_orderkey").cast("string").alias("qseqid"), F.concat(F.lit("S"), "l_suppkey").alias("saccver"), (100 - F.col("l_discount") * 400).alias("pident"), F.col("l_quantity").cast("int").alias("length"), F.lit(50).alias("qlen"), F.col("l_partkey").cast("string").alias("staxids"), F.concat(F.col("l_returnflag"), F.lit(" "), "l_linestatus").alias("sscinames"), (F.col("l_linenumber") * 100000000000 + F.col("l_partkey") * 10000 + F.col("l_suppkey")).alias("ordinal"), "l_orderkey", "l_linenumber", "l_suppkey")


@query("q_top_hit", "with p as (select l_orderkey, l_linenumber, l_suppkey, row_number() over (partition by l_orderkey order by l_linenumber * 100000000000 + l_partkey * 10000 + l_suppkey) as n from lineitem where 100 - l_discount * 400 >= 70.0 and cast(l_quantity as integer) * 100.0 / 50 >= 50.0) select l_orderkey, cast(l_linenumber as integer) as l_linenumber, l_suppkey from p where n = 1")
def top_hit(spark, sf):
    return screens.top_hits(hits(spark, sf), 70.0, 50.0).select("l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"), "l_suppkey")


@query("q_window_conflict", "with w as (select l_orderkey as parent, l_returnflag || ' ' || l_linestatus as label from lineitem where 100 - l_discount * 400 >= 80.0) select cast(parent as varchar) as parent, count(*) as n_windows, count(distinct lower(label)) as n_labels, count(*) >= 2 and count(distinct lower(label)) >= 2 as conflict from w group by parent")
def window_conflict(spark, sf):
    h = hits(spark, sf).withColumn("qseqid", F.concat("qseqid", F.lit("|win"), "ordinal"))
    return screens.window_conflicts(h, CFG)


VERDICT = DECIDED + """, th as (select l_orderkey, l_suppkey, l_returnflag, l_linestatus, row_number() over (partition by l_orderkey order by l_linenumber * 100000000000 + l_partkey * 10000 + l_suppkey) as n from lineitem where 100 - l_discount * 400 >= 70.0 and cast(l_quantity as integer) * 100.0 / 50 >= 50.0),
tv as (select de.*, 'S' || cast(l_suppkey as varchar) as top, case when l_orderkey is null then 'NOT_CHECKED' when l_suppkey % 2 = 0 and contains('bison sp0', lower(species)) then 'PASS_SPECIES' when l_suppkey % 2 = 0 and genus = 'Bison' then 'PASS_GENUS' else 'NO_EXPECTED_MATCH' end as st from de left join th on ordinal = l_orderkey and n = 1)"""


@query("q_taxonomy_verdict", VERDICT + " select ordinal, st as taxonomy_status, top as taxonomy_top_hit, array_to_string(list_append(reasons, case st when 'NOT_CHECKED' then 'taxonomy_not_checked' when 'PASS_SPECIES' then 'taxonomy_same_species' when 'PASS_GENUS' then 'taxonomy_same_genus' else 'taxonomy_no_expected_match' end), ';') as reasons from tv")
def verdict(spark, sf):
    r = ready(spark, sf).withColumn("record_key", F.col("ordinal").cast("string"))
    out = screens.taxonomy_screen(r, hits(spark, sf).withColumn("sscinames", F.when(F.col("l_suppkey") % 2 == 0, F.lit("Bison sp0")).otherwise(F.col("sscinames"))), CFG)
    return out.select("ordinal", "taxonomy_status", "taxonomy_top_hit", F.array_join("reasons", ";").alias("reasons"))


@query("q_vector_verdict", "with h as (select l_orderkey, l_linenumber, cast(l_quantity as integer) as length, l_partkey % 90 as pos from lineitem where 100 - l_discount * 400 >= 90.0 and l_quantity >= 20) select o_orderkey, coalesce(bool_or(pos <= 25 or pos + length >= 120 - 25), false) as vector_terminal, coalesce(bool_or(not (pos <= 25 or pos + length >= 120 - 25)), false) as vector_internal from orders left join h on o_orderkey = l_orderkey group by 1")
def vector(spark, sf):
    r = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("record_key"), F.lit(120).alias("length"), F.array().cast("array<string>").alias("reasons"))
    h = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("qseqid"), (100 - F.col("l_discount") * 400).alias("pident"), F.col("l_quantity").cast("int").alias("length"), (F.col("l_partkey") % 90 + 1).alias("qstart"), (F.col("l_partkey") % 90 + F.col("l_quantity").cast("int")).alias("qend"))
    return screens.vector_screen(r, h, CFG).select("o_orderkey", "vector_terminal", "vector_internal")


@query("q_cluster_roles", "with last as (select l_partkey, max_by(l_suppkey, (l_orderkey * 10 + l_linenumber) * 10000 + l_suppkey) as c from lineitem group by 1), cent as (select l_suppkey as c, max_by(l_partkey, (l_orderkey * 10 + l_linenumber) * 10000 + l_suppkey) as k from lineitem where l_linenumber = 1 group by 1) select p_partkey, cast(c as varchar) as cluster_id, case when c is null then '' when k = p_partkey then 'centroid' else 'member' end as cluster_role from part left join last on p_partkey = l_partkey left join cent using (c)")
def clusters(spark, sf):
    r = table(spark, sf, "part").select("p_partkey", F.col("p_partkey").cast("string").alias("record_key"), F.array().cast("array<string>").alias("reasons"))
    c = table(spark, sf, "lineitem").select(F.when(F.col("l_linenumber") == 1, "S").otherwise("H").alias("type"), F.col("l_suppkey").cast("string").alias("cluster"), F.col("l_partkey").cast("string").alias("query"), ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 10000 + F.col("l_suppkey")).alias("ordinal"))
    return screens.cluster_roles(r, c).select("p_partkey", "cluster_id", "cluster_role")


def tree(spark, sf):
    """suppliers under nations under regions under a root."""
    s = table(spark, sf, "supplier").select((F.col("s_suppkey") + 1000).alias("taxid"), (F.col("s_nationkey") + 100).cast("long").alias("parent"), F.lit("species").alias("rank"), F.col("s_name").alias("name"))
    n = table(spark, sf, "nation").select((F.col("n_nationkey") + 100).cast("long").alias("taxid"), (F.col("n_regionkey") + 10).cast("long").alias("parent"), F.lit("genus").alias("rank"), F.col("n_name").alias("name"))
    r = table(spark, sf, "region").select((F.col("r_regionkey") + 10).cast("long").alias("taxid"), F.lit(1).cast("long").alias("parent"), F.lit("domain").alias("rank"), F.col("r_name").alias("name"))
    root = spark.range(1, 2).select(F.col("id").alias("taxid"), F.col("id").alias("parent"), F.lit("no rank").alias("rank"), F.lit("root").alias("name"))
    return s.unionByName(n).unionByName(r).unionByName(root)


@query("q_lineage_walk", "with recursive t as (select s_suppkey + 1000 as taxid, s_nationkey + 100 as parent from supplier union all select n_nationkey + 100, n_regionkey + 10 from nation union all select r_regionkey + 10, 1 from region union all select 1, 1), w as (select taxid, taxid as ancestor, 0 as depth from t union all select w.taxid, t.parent, depth + 1 from w join t on t.taxid = w.ancestor where t.parent <> t.taxid) select cast(taxid as bigint) as taxid, cast(ancestor as bigint) as ancestor, cast(depth as bigint) as depth from w")
def lineage_walk(spark, sf):
    return taxonomy.closure(tree(spark, sf)).select("taxid", "ancestor", F.col("depth").cast("long").alias("depth"))


@query("q_names_at_ranks", "select cast(s_suppkey + 1000 as bigint) as taxid, n_name as genus, r_name as domain from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey union all select cast(n_nationkey + 100 as bigint), n_name, r_name from nation join region on n_regionkey = r_regionkey union all select cast(r_regionkey + 10 as bigint), '', r_name from region union all select 1, '', ''")
def names_at_ranks(spark, sf):
    return taxonomy.at_ranks(tree(spark, sf), {"genus": ("genus",), "domain": ("domain", "superkingdom")})


@query("q_done_anti_join", "select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R')")
def done(spark, sf):
    finished = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return ingest.remaining(table(spark, sf, "orders"), finished, "o_orderkey").select("o_orderkey")


@query("q_symmetric_difference", "(select c_custkey as k from customer except select o_custkey from orders) union all (select o_custkey from orders except select c_custkey from customer)")
def symmetric(spark, sf):
    a, b = table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    return occurrences.symmetric_difference(a, b)


BEST_ROW = merged(DAMAGE, {"damage_min": 0.05, "significance_min": 0.02})


@query("q_best_row_argmax", "with r as (select l_orderkey, l_linenumber, row_number() over (partition by l_orderkey order by case when l_discount > 0.05 and l_tax > 0.02 then 1 else 0 end desc, l_tax desc, l_quantity desc, l_discount desc, l_linenumber) as n from lineitem) select l_orderkey, l_linenumber from r where n = 1")
def argmax(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_discount").alias("damage"), F.col("l_tax").alias("significance"), F.col("l_quantity").alias("n_reads"), F.col("l_linenumber").alias("ordinal"))
    return damage.best_rows(rows, BEST_ROW, ("l_orderkey",)).select("l_orderkey", "l_linenumber")
