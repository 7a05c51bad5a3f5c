"""Queries of the damage-merge, lineage and report operators.

lineitem stands for the count matrix (part x supplier), lineitem again for the damage table, supplier for the libraries.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from moraine.config import DAMAGE, merged
from moraine.operators import damage as D
from moraine.operators import report as R
from moraine.plans.standins import table

QUERIES, ORACLES = {}, {}
CFG = merged(DAMAGE, {"damage_min": 0.03, "significance_min": 25.0, "high_confidence_n_reads_min": 150000, "strong_count_min_reads": 90, "strong_count_min_libraries": 2, "blank_absolute_min": 45, "blank_relative_min": 0.6, "qc_ratio_clean_max": 0.00001, "qc_ratio_caution_max": 0.00002, "qc_rho_clean_max": 0.05, "qc_rho_caution_max": 0.07, "tentative_min_reads": 30})
BASE = """with cnt as (select l_partkey as taxon, l_partkey as tax_id, 'L' || cast(l_suppkey as varchar) as library, sum(l_quantity) as count from lineitem group by 1, 2, 3),
lk as (select 'L' || cast(s_suppkey as varchar) as library, s_suppkey % 5 = 0 as negative, s_suppkey % 7 = 0 and s_suppkey % 5 <> 0 as environmental from supplier),
dmg as (select 'L' || cast(l_suppkey as varchar) as sample, l_partkey - (l_partkey % 3) as tax_id, l_discount as damage, l_quantity as significance, l_extendedprice as n_reads, l_tax * 10 as n_alignments, l_tax as rho, l_linenumber % 4 <> 0 as map_valid, (l_orderkey * 10 + l_linenumber) * 100000 + l_partkey as ordinal from lineitem),
c as (select cnt.*, negative, environmental from cnt join lk using (library)),
h0 as (select c.*, damage, significance, n_reads, n_alignments, rho, map_valid, ordinal, damage > 0.03 and significance > 25.0 as ok from c join dmg on library = sample and c.tax_id = dmg.tax_id),
h1 as (select *, row_number() over (partition by taxon, library order by ok desc, significance desc nulls last, n_reads desc nulls last, damage desc nulls last, ordinal) as k from h0),
h as (select * from h1 where k = 1),
n as (select taxon, count(*) filter (not negative and not environmental and count > 0) as n_positive, coalesce(max(case when not negative and not environmental then count end), 0.0) as max_count,
  count(*) filter (negative and count > 0) as n_blank_positive, coalesce(max(case when negative then count end), 0.0) as max_blank from c group by 1),
d as (select taxon, count(*) filter (not negative and not environmental and ok) as n_damage, count(*) filter (not negative and not environmental and ok and n_reads >= 150000) as n_damage_100, coalesce(bool_or(negative and ok), false) as blank_damage from h group by 1),
t1 as (select *, row_number() over (partition by taxon order by ok desc, significance desc nulls last, n_reads desc nulls last, damage desc nulls last, ordinal) as k2 from h where not negative and not environmental),
t as (select taxon, library as best_library, damage as best_damage, case when not map_valid then 'strong caution' when (n_reads > 0 and n_alignments / n_reads > 0.00002) or abs(rho) > 0.07 then 'strong caution' when (n_reads > 0 and n_alignments / n_reads > 0.00001) or abs(rho) > 0.05 then 'caution' else 'clean' end as qc from t1 where k2 = 1),
j as (select n.*, coalesce(n_damage, 0) as n_damage, coalesce(n_damage_100, 0) as n_damage_100, coalesce(blank_damage, false) as blank_damage, coalesce(qc, 'not-applicable') as qc, best_library, best_damage,
  n_positive >= 2 and max_count >= 90 as strong, case when max_count > 0 then max_blank / max_count end as blank_ratio from n left join d using (taxon) left join t using (taxon)),
b as (select *, blank_damage or ((max_blank >= 45 or coalesce(blank_ratio >= 0.6, false)) and not strong and (n_damage = 0 or qc = 'strong caution')) as blanks from j),
s as (select *, case when blanks then 'Blank-associated' when n_damage_100 > 0 and strong and qc <> 'strong caution' then 'Very high confidence' when n_damage > 0 and strong then 'High confidence' when n_damage > 0 or strong then 'Supported' when max_count >= 30 then 'Tentative' else 'Weak support' end as state from b)
"""


def query(name, oracle=None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def counts(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.groupBy(F.col("l_partkey").alias("taxon"), F.concat(F.lit("L"), "l_suppkey").alias("library")).agg(F.sum("l_quantity").alias("count")).withColumns({"tax_id": F.col("taxon"), "tax_name": F.lit(None).cast("string"), "tax_rank": F.lit(None).cast("string")})


def rows(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(F.concat(F.lit("L"), "l_suppkey").alias("sample"), (F.col("l_partkey") - F.col("l_partkey") % 3).alias("tax_id"), F.lit("none").alias("tax_name"), F.lit("none").alias("tax_rank"), F.col("l_discount").alias("damage"), F.col("l_quantity").alias("significance"), F.col("l_extendedprice").alias("n_reads"), (F.col("l_tax") * 10).alias("n_alignments"), F.col("l_tax").alias("rho"), (F.col("l_linenumber") % 4 != 0).alias("map_valid"), ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 100000 + F.col("l_partkey")).alias("ordinal"))


def linker(spark, sf):
    k = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(F.concat(F.lit("L"), "s_suppkey").alias("library"), (k % 5 == 0).alias("negative"), ((k % 7 == 0) & (k % 5 != 0)).alias("environmental"))


@query("q_matrix_outer_merge", "select l_partkey, l_suppkey, sum(l_quantity) as count from lineitem group by 1, 2")
def outer_merge(spark, sf):
    li = table(spark, sf, "lineitem")
    part = lambda f: li.where(f).groupBy("l_partkey", F.col("l_suppkey").alias("library")).agg(F.sum("l_quantity").alias("count"))
    return D.merged_counts([part("l_returnflag = 'A'"), part("l_returnflag = 'N'"), part("l_returnflag = 'R'")], ["l_partkey"]).withColumnRenamed("library", "l_suppkey")


WIDE = "with w as (select o_custkey, sum(case when o_orderpriority = '1-URGENT' then o_totalprice else 0 end) as \"1-URGENT\", sum(case when o_orderpriority = '2-HIGH' then o_totalprice else 0 end) as \"2-HIGH\" from orders group by 1)"


@query("q_matrix_unpivot", WIDE + " select o_custkey, '1-URGENT' as library, round(\"1-URGENT\", 2) as count from w union all select o_custkey, '2-HIGH', round(\"2-HIGH\", 2) from w")
def unpivot(spark, sf):
    w = table(spark, sf, "orders").groupBy("o_custkey").pivot("o_orderpriority", ["1-URGENT", "2-HIGH"]).agg(F.sum("o_totalprice"))
    return D.counts_long(w, ["o_custkey"], ["1-URGENT", "2-HIGH"]).withColumn("count", F.round("count", 2))


@query("q_matrix_pivot", "select o_custkey, max(case when o_orderpriority = '1-URGENT' then n end) as urgent, max(case when o_orderpriority = '5-LOW' then n end) as low from (select o_custkey, o_orderpriority, count(*) as n from orders group by 1, 2) group by 1")
def pivot(spark, sf):
    n = table(spark, sf, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"))
    return D.pivoted(n, ["o_custkey"], "o_orderpriority", "n", ["1-URGENT", "5-LOW"]).withColumnsRenamed({"1-URGENT": "urgent", "5-LOW": "low"})


@query("q_missing_libraries", "with n as (select s_suppkey + case when s_suppkey % 3 = 0 then 1000000 else 0 end as s_suppkey from supplier) select s_suppkey from n where s_suppkey not in (select l_suppkey from lineitem)")
def missing(spark, sf):
    k = F.col("s_suppkey")
    listed = table(spark, sf, "supplier").select((k + F.when(k % 3 == 0, 1000000).otherwise(0)).alias("library"))
    return D.missing_libraries(table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("library")), listed).withColumnRenamed("library", "s_suppkey")


TIERS = """with k as (select l_orderkey as taxon, l_partkey % 50 as tax_id, l_returnflag as tax_name, l_linestatus as tax_rank, l_suppkey as library, l_linenumber from lineitem group by all),
f as (select taxon, library, max(tax_id) as tax_id, max(tax_name) as tax_name, max(tax_rank) as tax_rank from k group by 1, 2),
d as (select s_suppkey as sample, s_suppkey % 50 as tax_id, case s_suppkey % 3 when 0 then 'A' when 1 then 'N' else 'R' end as tax_name, case s_suppkey % 2 when 0 then 'F' else 'O' end as tax_rank from supplier)
select f.taxon, f.library, cast(case when f.tax_id = d.tax_id then 1 when f.tax_name = d.tax_name and f.tax_rank = d.tax_rank then 2 else 3 end as integer) as tier from f join d on f.library = d.sample and (f.tax_id = d.tax_id or f.tax_name = d.tax_name)"""


@query("q_three_tier_join", TIERS)
def three_tier(spark, sf):
    li = table(spark, sf, "lineitem")
    c = li.groupBy(F.col("l_orderkey").alias("taxon"), F.col("l_suppkey").alias("library")).agg(F.max(F.col("l_partkey") % 50).alias("tax_id"), F.max("l_returnflag").alias("tax_name"), F.max("l_linestatus").alias("tax_rank"))
    k = F.col("s_suppkey")
    nothing = {n: F.lit(None).cast("double") for n in ("damage", "significance", "n_reads", "n_alignments", "rho", "map_valid", "ordinal")}
    d = table(spark, sf, "supplier").select(k.alias("sample"), (k % 50).alias("tax_id"), F.when(k % 3 == 0, "A").when(k % 3 == 1, "N").otherwise("R").alias("tax_name"), F.when(k % 2 == 0, "F").otherwise("O").alias("tax_rank")).withColumns(nothing)
    return D.matched(c, d).select("taxon", "library", "tier")


@query("q_support_status", BASE + " select taxon, n_positive, max_count, n_blank_positive, max_blank, round(blank_ratio, 6) as blank_ratio, n_damage, n_damage_100, blank_damage, qc, best_library, best_damage, state from s")
def status(spark, sf):
    out = D.classified(counts(spark, sf), rows(spark, sf), linker(spark, sf), cfg=CFG)
    return out.select("taxon", "n_positive", "max_count", "n_blank_positive", "max_blank", F.round("blank_ratio", 6).alias("blank_ratio"), "n_damage", "n_damage_100", "blank_damage", "qc", "best_library", "best_damage", "state")


@query("q_status_counts", BASE + " select state, count(*) as n from s group by 1")
def status_counts(spark, sf):
    return D.classified(counts(spark, sf), rows(spark, sf), linker(spark, sf), cfg=CFG).groupBy("state").agg(F.count("*").alias("n"))


@query("q_blank_ratio", BASE + " select taxon, round(blank_ratio, 6) as blank_ratio, blanks from b")
def blank_ratio(spark, sf):
    return D.classified(counts(spark, sf), rows(spark, sf), linker(spark, sf), cfg=CFG).select("taxon", F.round("blank_ratio", 6).alias("blank_ratio"), (F.col("state") == "Blank-associated").alias("blanks"))


@query("q_library_label", BASE + ", q as (select taxon, library, ok, n_reads, case when not map_valid then 'strong caution' when (n_reads > 0 and n_alignments / n_reads > 0.00002) or abs(rho) > 0.07 then 'strong caution' else 'fine' end as qc from h) select c.taxon, c.library, case when count <= 0 then 'Not detected' when negative then 'Blank-library' when environmental then 'Environmental-control' when coalesce(ok, false) then case when n_reads >= 150000 and qc <> 'strong caution' then 'Damage-supported (>=100 reads)' else 'Damage-supported' end else 'Count-only' end as label from c left join q using (taxon, library)")
def label(spark, sf):
    c = counts(spark, sf).join(linker(spark, sf), "library")
    h = D.best_rows(D.matched(c, rows(spark, sf)), CFG).select("taxon", "library", D.supported(F.col("damage"), F.col("significance"), CFG).alias("ok"), "n_reads", D.quality(F.col("n_reads"), F.col("n_alignments"), F.col("map_valid"), F.col("rho"), CFG).alias("qc"))
    out = c.join(h, ["taxon", "library"], "left")
    return out.select("taxon", "library", D.library_label(F.col("count"), F.col("negative"), F.col("environmental"), F.coalesce("ok", F.lit(False)), F.col("n_reads"), F.col("qc"), F.lit(False), CFG).alias("label"))


@query("q_broad_group", "select n_nationkey, case when contains(lower(n_name || ';' || r_name), 'america') then 'x' else 'y' end as g, case when contains(lower(n_name), 'an') then 'other' else 'other' end as broad_group from nation join region on n_regionkey = r_regionkey")
def broad(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    p = F.concat_ws(";", "n_name", "r_name")
    return n.select("n_nationkey", F.when(F.contains(F.lower(p), F.lit("america")), "x").otherwise("y").alias("g"), D.broad_group(p).alias("broad_group"))


@query("q_lineage_support", """with f as (select distinct l_suppkey % 10 as library, s_suppkey, s_name, n_name, r_name from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
g as (select distinct l_orderkey % 10 as library, n_name, r_name from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
select distinct f.s_suppkey as taxon, f.library, g.n_name as c_name, 'genus' as c_rank from f join g on f.library = g.library and f.n_name = g.n_name""")  # fmt: skip
def lineage_support(spark, sf):
    li = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    focal = li.select(F.col("s_suppkey").alias("taxon"), (F.col("l_suppkey") % 10).alias("library"), F.col("s_name").alias("name"), F.lit("species").alias("rank"), F.concat_ws(";", "r_name", "n_name", "s_name").alias("path")).distinct()
    good = li.select((F.col("l_orderkey") % 10).alias("sample"), F.col("n_name").alias("tax_name"), F.lit("genus").alias("tax_rank"), F.concat_ws(";", "r_name", "n_name").alias("tax_path"), F.lit(1.0).alias("damage"), F.lit(99.0).alias("significance"))
    return D.lineage_support(focal, good, merged(DAMAGE, {"lineage_max_steps": 3}))


COLL = """with r as (select p_brand as taxon, 'U' || cast(l_suppkey % 20 as varchar) as unit, 'G' || cast(l_suppkey % 4 as varchar) as grp, 'L' || cast(l_suppkey as varchar) as library, case when l_quantity > 25 then l_quantity else 0 end as count, l_discount as damage,
  case when l_discount > 0.08 then 'Damage-supported' when l_tax > 0.05 then 'Lineage-supported' else 'Count-only' end as label from lineitem join part on l_partkey = p_partkey),
tot as (select unit, count(distinct library) as n_libraries from r group by 1),
co as (select taxon, unit, grp, sum(count) as count, case min(case label when 'Damage-supported' then 1 when 'Lineage-supported' then 2 else 3 end) when 1 then 'Damage-supported' when 2 then 'Lineage-supported' else 'Count-only' end as label, max(damage) as damage, string_agg(distinct library, '; ' order by library) as libraries from r where count > 0 group by 1, 2, 3)"""


def plot_rows(spark, sf):
    li = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    k = F.col("l_suppkey")
    return li.select(F.col("p_brand").alias("taxon"), F.concat(F.lit("U"), k % 20).alias("unit"), F.concat(F.lit("G"), k % 4).alias("group"), F.concat(F.lit("L"), k).alias("library"), F.when(F.col("l_quantity") > 25, F.col("l_quantity")).otherwise(0.0).alias("count"), F.col("l_discount").alias("damage"), F.when(F.col("l_discount") > 0.08, "Damage-supported").when(F.col("l_tax") > 0.05, "Lineage-supported").otherwise("Count-only").alias("label"))


@query("q_collapse_replicates", COLL + " select co.taxon, co.unit, co.grp as \"group\", co.count, co.label, co.damage, co.libraries, n_libraries from co join tot using (unit)")
def collapse(spark, sf):
    return R.collapsed(plot_rows(spark, sf))


@query("q_group_transforms", COLL + " select taxon, unit, count, sum(count) over (partition by taxon) as taxon_sum, max(count) over (partition by taxon) as taxon_max, sum(count) over (partition by grp, taxon) as subset_sum, max(count) over (partition by grp, label) as display_max from co")
def transforms(spark, sf):
    t = R.group_transforms(R.collapsed(plot_rows(spark, sf)), display="label")
    return t.select("taxon", "unit", "count", "taxon_sum", "taxon_max", "subset_sum", "display_max")


@query("q_top_n_pages", COLL + ", p as (select taxon, unit, grp, row_number() over (partition by grp order by count desc, taxon, unit) as row from co) select taxon, unit, grp as \"group\", cast(row as bigint) as \"row\", cast(ceil(row / 8.0) as bigint) as page from p where row <= 30")
def pages(spark, sf):
    p = R.paged(R.collapsed(plot_rows(spark, sf)), "group", [F.desc("count"), F.asc("taxon"), F.asc("unit")], 30, 8)
    return p.select("taxon", "unit", "group", F.col("row").cast("long").alias("row"), "page")


@query("q_count_bins", "select case when l_quantity >= 50 then '50-99' when l_quantity >= 10 then '10-49' when l_quantity >= 5 then '5-9' when l_quantity >= 0.5 then '1-4' else '0' end as count_bin, case when l_discount >= 0.1 then '0.10-0.20' when l_discount >= 0.05 then '0.05-0.10' when l_discount >= 0.01 then '0.01-0.05' else '<0.01' end as damage_bin, count(*) as n from lineitem group by 1, 2")
def bins(spark, sf):
    return table(spark, sf, "lineitem").groupBy(R.binned(F.col("l_quantity"), R.COUNT_BINS).alias("count_bin"), R.binned(F.col("l_discount"), R.DAMAGE_BINS).alias("damage_bin")).agg(F.count("*").alias("n"))


@query("q_bar_proportions", COLL + ", ld as (select taxon from co group by 1 order by sum(count) desc, taxon limit 5), tt as (select unit, sum(count) as total from co group by 1) select unit, taxon, sum(count) as count, any_value(total) as total, round(sum(count) / any_value(total), 6) as share from co join tt using (unit) where taxon in (select taxon from ld) group by 1, 2")
def bars(spark, sf):
    return R.bars(R.collapsed(plot_rows(spark, sf)), "unit", "taxon", 5).withColumn("share", F.round("share", 6))


@query("q_dense_grid", COLL + ", g as (select u.unit, t.taxon from (select distinct unit from co) u, (select distinct taxon from co) t) select unit, taxon, coalesce(sum(count), 0.0) as count from g left join co using (unit, taxon) group by 1, 2")
def grid(spark, sf):
    return R.dense(R.collapsed(plot_rows(spark, sf)), "unit", "taxon")


@query("q_order_table", "with r as (select s_nationkey % 3 as g, s_name, row_number() over (partition by s_nationkey % 3 order by s_acctbal, s_suppkey) as row from supplier) select cast(row as bigint) as \"row\", coalesce(max(case when g = 0 then s_name end), '') as g0, coalesce(max(case when g = 1 then s_name end), '') as g1, coalesce(max(case when g = 2 then s_name end), '') as g2 from r group by 1")
def order_table(spark, sf):
    s = table(spark, sf, "supplier").withColumn("g", F.concat(F.lit("g"), F.col("s_nationkey") % 3))
    return R.order_table(s, "g", "s_name", [F.asc("s_acctbal"), F.asc("s_suppkey")], ["g0", "g1", "g2"]).withColumn("row", F.col("row").cast("long"))


@query("q_label_once", "with r as (select n_nationkey, n_regionkey, n_nationkey // 10 as page, row_number() over (partition by n_nationkey // 10, n_regionkey order by n_nationkey) as k from nation) select n_nationkey, case when k = 1 then cast(n_regionkey as varchar) else '' end as shown from r")
def once(spark, sf):
    n = table(spark, sf, "nation").withColumn("page", F.floor(F.col("n_nationkey") / 10)).withColumn("g", F.col("n_regionkey").cast("string"))
    return R.label_once(n, "page", "g", [F.asc("n_nationkey")]).select("n_nationkey", "shown")


@query("q_rank_filter", "select p_partkey from part where p_size <= 8")
def rank_filter(spark, sf):
    ranks = F.array(*map(F.lit, R.DEPTHS))
    return table(spark, sf, "part").withColumn("rank", F.get(ranks, F.col("p_size"))).where(R.rank_allowed(F.col("rank"), "family")).select("p_partkey")


@query("q_taxon_info_two_tier", "with d as (select min_by(l_suppkey, (l_orderkey * 10 + l_linenumber) * 10000 + l_suppkey) as v, l_partkey as k from lineitem where l_partkey in (select p_partkey from part where p_size <= 25) group by 2), e as (select min_by(l_suppkey, (l_orderkey * 10 + l_linenumber) * 10000 + l_suppkey) as v, l_partkey % 10 as g from lineitem where l_partkey in (select p_partkey from part where p_size <= 25) group by 2) select p_partkey, coalesce(d.v, e.v) as info from part left join d on p_partkey = k left join e on p_partkey % 10 = g")
def info(spark, sf):
    li = table(spark, sf, "lineitem").join(table(spark, sf, "part").where("p_size <= 25").select(F.col("p_partkey").alias("l_partkey")), "l_partkey", "left_semi").withColumn("o", (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 10000 + F.col("l_suppkey"))
    by_id = li.groupBy(F.col("l_partkey").alias("k")).agg(F.min_by("l_suppkey", "o").alias("a"))
    by_name = li.groupBy((F.col("l_partkey") % 10).alias("g")).agg(F.min_by("l_suppkey", "o").alias("b"))
    p = table(spark, sf, "part").join(by_id, F.col("p_partkey") == F.col("k"), "left").join(by_name, F.col("p_partkey") % 10 == F.col("g"), "left")
    return p.select("p_partkey", F.coalesce("a", "b").alias("info"))


@query("q_display_order", COLL + " select taxon, unit, grp as \"group\", row_number() over (partition by grp order by sum_ desc, taxon, unit) as place from (select *, sum(count) over (partition by grp, taxon) as sum_ from co)")
def display_order(spark, sf):
    t = R.group_transforms(R.collapsed(plot_rows(spark, sf)), display="label")
    w = Window.partitionBy("group").orderBy(F.desc("subset_sum"), "taxon", "unit")
    return t.select("taxon", "unit", "group", F.row_number().over(w).cast("long").alias("place"))
