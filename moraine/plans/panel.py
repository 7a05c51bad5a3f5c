"""Queries of the probe-panel operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from moraine.functions import sequence as S
from moraine.operators import coverage as V
from moraine.operators import redundancy as D
from moraine.operators import tiles as T
from moraine.plans.standins import RECORDS, records, table

QUERIES, ORACLES = {}, {}
WITH = "with " + RECORDS.strip()
TILES = WITH + """, st as (select ordinal as ref_id, seq, length, unnest(case when length <= 70 then []::bigint[] when length < 80 then case when length >= 71 then [0::bigint] else []::bigint[] end
    else list_sort(list_distinct(list_concat(generate_series(0, length - 80, 27), [(length - 80)::bigint]))) end) as s from met),
ti as (select ref_id, length, s, row_number() over (partition by ref_id order by s) as i, case when length >= 80 then substr(seq, s + 1, 80) else rpad(seq, 80, 'T') end as bait from st),
pr as (select cast(ref_id as varchar) || '|b' || cast(i as varchar) || '|pos' || cast(s + 1 as varchar) || '-' || cast(s + 80 as varchar) as bait_id, ref_id, s + 1 as ref_start, case when length >= 80 then s + 80 else length end as ref_end, bait from ti)"""
RING = WITH + """, st as (select ordinal as ref_id, seq, unnest(generate_series(0, length - 1, 27)) as s from met where length >= 80),
pr as (select ref_id, s + 1 as ref_start, s + 80 as ref_end, substr(seq || substr(seq, 1, 80), s + 1, 80) as bait from st)"""
SWEEP = """, tg as (select ordinal as ref_id, length from met where length > 0), iv as (select pr.ref_id, (ref_start - 1) % length as a, least(ref_end - ref_start + 1, length) as n, length from pr join tg using (ref_id)),
pt as (select ref_id, a, least(a + n, length) as b from iv union all select ref_id, 0, a + n - length from iv where a + n > length),
ev as (select ref_id, a as pos, 1 as d from pt union all select ref_id, b, -1 from pt union all select ref_id, 0, 0 from tg union all select ref_id, length, 0 from tg),
ag as (select ref_id, pos, sum(d) as d from ev group by 1, 2),
sg as (select ref_id, pos as f, lead(pos) over (partition by ref_id order by pos) as t, sum(d) over (partition by ref_id order by pos rows unbounded preceding) as depth from ag),
sg2 as (select * from sg where t is not null)"""


def query(name, oracle=None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def refs(spark, sf):
    return records(spark, sf).select(F.col("ordinal").alias("ref_id"), "seq", F.length("seq").alias("length"))


def probes(spark, sf, **how):
    return T.tile(refs(spark, sf), **how)


@query("q_tile_linear", TILES + " select bait_id, ref_id, cast(ref_start as bigint) as ref_start, cast(ref_end as bigint) as ref_end, sha256(bait) as seq_sha256 from pr")
def tile_linear(spark, sf):
    return probes(spark, sf).select("bait_id", "ref_id", F.col("ref_start").cast("long").alias("ref_start"), F.col("ref_end").cast("long").alias("ref_end"), F.sha2("seq", 256).alias("seq_sha256"))


@query("q_tile_circular", RING + " select ref_id, cast(ref_start as bigint) as ref_start, cast(ref_end as bigint) as ref_end, sha256(bait) as seq_sha256 from pr")
def tile_ring(spark, sf):
    return probes(spark, sf, circular=True).join(refs(spark, sf).where("length >= 80").select("ref_id"), "ref_id", "left_semi").select("ref_id", F.col("ref_start").cast("long").alias("ref_start"), F.col("ref_end").cast("long").alias("ref_end"), F.sha2("seq", 256).alias("seq_sha256"))


NEIGHBOURS = ", ".join(f"('{k}', {h}, {e})" for k, (h, e) in S.RNA_DNA.items())
#: Probes with their metrics, as cased() makes them.
COUNTED = TILES + f""", pc as (select * replace (case when ref_id % 4 in (1, 2) then translate(bait, 'N', 'G') else bait end as bait) from pr),
nn as (select * from (values {NEIGHBOURS}) as t(pair, h, e)),
di as (select bait_id, substr(bait, i, 2) as pair from (select bait_id, bait, unnest(generate_series(1, 79)) as i from pc where not contains(bait, 'N'))),
th as (select bait_id, 1000 * ({S.INITIATION[0]}::double + sum(h::double)) / ({S.INITIATION[1]}::double + sum(e::double) + 0.368::double * 79 * ln(0.05::double) + 1.987::double * ln(12.5e-9::double)) - 273.15::double as tm from di join nn using (pair) group by 1),
pm as (select pc.*, (length(bait) - length(translate(bait, 'GC', ''))) / 80.0::double as gc, length(bait) - length(translate(bait, 'N', '')) as amb, bait like '%GAAGAGC%' or bait like '%GCTCTTC%' as site, ref_id % 4 = 0 as masked, coalesce(tm, 0.0) as tm from pc left join th using (bait_id))"""
LEAST_TM = 74.0


def cased(spark, sf):
    """Metrics of all probes: of every fourth reference they are in lower case, that is masked, and of two more N reads as G."""
    k = F.col("ref_id") % 4
    return T.metrics(probes(spark, sf).withColumn("seq", F.when(k == 0, F.lower("seq")).when(k < 3, F.translate("seq", "N", "G")).otherwise(F.col("seq"))))


@query("q_probe_stats", COUNTED + ", q as (select *, case when masked then (case when ref_end - ref_start < 79 then (ref_end - ref_start + 1) / 80.0 else 1.0 end)::double else 0.0::double end as mf from pm) select count(*) as n, round(avg(gc), 6) as gc_avg, min(gc) as gc_min, max(gc) as gc_max, round(avg(amb), 6) as amb_avg, round(avg(tm), 5) as tm_avg, round(min(tm), 5) as tm_min, round(max(tm), 5) as tm_max, round(avg(case when masked then 1.0::double else 0.0::double end), 6) as masked_avg from q")
def probe_stats(spark, sf):
    s = T.probe_stats(cased(spark, sf))
    tm = [F.round(f"tm_{x}", 5).alias(f"tm_{x}") for x in ("avg", "min", "max")]
    return s.select("n", F.round("gc_frac_avg", 6).alias("gc_avg"), F.col("gc_frac_min").alias("gc_min"), F.col("gc_frac_max").alias("gc_max"), F.round("ambiguous_count_avg", 6).alias("amb_avg"), *tm, F.round("masked_frac_avg", 6).alias("masked_avg"))


LEFT = "amb < 10 and not masked"


@query("q_stage_counts_pivot", COUNTED + f" select ref_id, count(*) as tiled, count(*) filter (amb < 10) as after_1, count(*) filter ({LEFT}) as after_2, count(*) filter ({LEFT} and round(tm, 6) >= {LEAST_TM}) as after_3, count(*) filter ({LEFT} and round(tm, 6) >= {LEAST_TM} and not site) as after_4 from pm group by 1")
def stage_counts(spark, sf):
    return T.stage_counts(T.funnel(cased(spark, sf).withColumn("tm", F.round("tm", 6)), min_tm=LEAST_TM))


@query("q_panel_filters", COUNTED + f" select bait_id from pm where amb < 30 and not masked and round(tm, 6) >= {LEAST_TM} and gc between 0.2 and 0.8 and not site")
def filters(spark, sf):
    return T.funnel(cased(spark, sf).withColumn("tm", F.round("tm", 6)), max_ambiguous=30, min_tm=LEAST_TM).where((F.col("stage") == 4) & F.col("gc_frac").between(0.2, 0.8)).select("bait_id")


@query("q_melting_range", COUNTED + " select bait_id, round(tm, 4) as tm from pm where amb = 0")
def melting(spark, sf):
    """One row a probe of plain bases."""
    return cased(spark, sf).where("ambiguous_count = 0").select("bait_id", F.round("tm", 4).alias("tm"))


@query("q_coverage_sweep", RING + SWEEP + " select ref_id, cast(f as bigint) as \"from\", cast(t as bigint) as \"to\", cast(depth as bigint) as depth from sg2")
def sweep(spark, sf):
    return V.segments(probes(spark, sf, circular=True).join(refs(spark, sf).where("length >= 80").select("ref_id"), "ref_id", "left_semi"), refs(spark, sf))


STATS = SWEEP + """, ts as (select ref_id, cast(sum(t - f) as bigint) as length, sum(case when depth > 0 then t - f else 0 end)::double / sum(t - f) as proportion_covered, sum((t - f) * depth)::double / sum(t - f) as mean_depth,
  sqrt(greatest(sum((t - f) * depth * depth)::double / sum(t - f) - (sum((t - f) * depth)::double / sum(t - f)) * (sum((t - f) * depth)::double / sum(t - f)), 0.0)) as std_dev, cast(min(depth) as bigint) as min_depth, cast(max(depth) as bigint) as max_depth from sg2 group by 1)"""


@query("q_target_info", TILES + STATS + " select ref_id, length, round(proportion_covered, 6) as proportion_covered, round(mean_depth, 6) as mean_depth, round(std_dev, 5) as std_dev, min_depth, max_depth from ts")
def target_info(spark, sf):
    t = V.target_stats(V.segments(probes(spark, sf), refs(spark, sf)))
    return t.select("ref_id", "length", F.round("proportion_covered", 6).alias("proportion_covered"), F.round("mean_depth", 6).alias("mean_depth"), F.round("std_dev", 5).alias("std_dev"), "min_depth", "max_depth")


@query("q_recommendations_union", COUNTED + STATS + """, ru as (select 'high' as severity, 'coverage_gap' as category, cast(ref_id as varchar) as target, proportion_covered as value from ts where proportion_covered < 0.95
  union all select 'medium', 'low_depth', cast(ref_id as varchar), mean_depth from ts where mean_depth < 2.5
  union all select 'medium', 'uneven_coverage', cast(ref_id as varchar), std_dev from ts where std_dev > greatest(mean_depth, 1.0)
  union all select 'medium', 'thermodynamics', 'panel', count(*)::double from pm where tm < 50 having count(*) > 0
  union all select 'low', 'gc_outliers', 'panel', count(*)::double from pm where gc > 0.8 or gc < 0.2 having count(*) > 0
  union all select 'high', 'opool_compatibility', 'panel', count(*)::double from pm where site having count(*) > 0)
select severity, category, target, round(value, 5) as value from ru union all select 'info', 'no_action', 'panel', 0.0 where not exists (select 1 from ru)""")  # fmt: skip
def recommend(spark, sf):
    p = cased(spark, sf)
    return V.recommendations(V.target_stats(V.segments(probes(spark, sf), refs(spark, sf))), p, 0.95, 2.5).withColumn("value", F.round("value", 5))


@query("q_probes_per_target", TILES + " select bait_seq, count(distinct ref_id) as n_targets, count(*) as n_probes from (select ref_id, bait as bait_seq from pr) group by 1")
def per_target(spark, sf):
    return T.per_sequence(probes(spark, sf))


@query("q_revcomp_pair_removal", "with b as (select o_orderkey, substr(translate(lpad(cast(o_orderkey % 999 as varchar), 4, '0'), '0123456789', 'ACGTACGTAC'), 1, 4) as s from orders), c as (select *, reverse(translate(s, 'ACGT', 'TGCA')) as rc from b), w as (select *, first_value(s) over (partition by least(s, rc) order by o_orderkey) as f, row_number() over (partition by least(s, rc) order by o_orderkey) as n from c) select o_orderkey, s as seq from w where s = f and (s <> rc or n = 1)")
def revcomp_pairs(spark, sf):
    b = table(spark, sf, "orders").select("o_orderkey", F.translate(F.lpad((F.col("o_orderkey") % 999).cast("string"), 4, "0"), "0123456789", "ACGTACGTAC").alias("seq"))
    return D.without_complements(b, order="o_orderkey").select("o_orderkey", "seq")


@query("q_seq_dedup", TILES + ", n as (select *, row_number() over (partition by bait order by bait_id) as k from pr) select bait_id from n where k = 1")
def seq_dedup(spark, sf):
    return D.distinct_sequences(probes(spark, sf)).select("bait_id")


@query("q_panel_screen", TILES + ", k as (select *, least(bait, reverse(translate(bait, 'ACGTN', 'TGCAN'))) as key from pr) select bait_id from k where ref_id % 2 = 1 and key not in (select key from k where ref_id % 2 = 0)")
def panel_screen(spark, sf):
    p = probes(spark, sf)
    return D.new_to_panel(p.where("ref_id % 2 = 1"), p.where("ref_id % 2 = 0")).select("bait_id")


@query("q_specificity_filter", "with bad as (select distinct l_partkey from lineitem where l_quantity > 80 * 0.6) select p_partkey from part where p_partkey not in (select l_partkey from bad)")
def specificity(spark, sf):
    h = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("qseqid"), (F.col("l_quantity") * 0.625 / 0.6).alias("nident"))
    return D.specific(table(spark, sf, "part").withColumnRenamed("p_partkey", "bait_id"), h, 80).select(F.col("bait_id").alias("p_partkey"))


@query("q_kmer_counts", WITH + ", k as (select substr(seq, i, 12) as kmer from (select seq, unnest(generate_series(1, length - 11)) as i from met where length >= 12)) select kmer, count(*) as n from k where kmer not like '%N%' group by 1 having count(*) >= 20")
def kmer_counts(spark, sf):
    return records(spark, sf).select(F.explode(S.kmers(F.col("seq"), 12)).alias("kmer")).groupBy("kmer").agg(F.count("*").alias("n")).where("n >= 20")


@query("q_softmask_fraction", WITH + """, pl as (select ordinal, i as p, substr(seq, i, 15) as kmer from (select ordinal, seq, unnest(generate_series(1, length - 14)) as i from met where length >= 15)),
ok as (select kmer from pl where kmer not like '%N%' group by 1 having count(*) >= 3), co as (select distinct ordinal, p + j as b from pl join ok using (kmer), (select unnest(range(15)) as j))
select met.ordinal as ref_id, cast(count(b) as bigint) as masked from met left join co using (ordinal) group by 1""")  # fmt: skip
def softmask(spark, sf):
    m = T.softmasked(refs(spark, sf))
    return m.select("ref_id", F.length(F.regexp_replace("seq", "[^a-z]", "")).cast("long").alias("masked"))


@query("q_preprocess", WITH + " select ordinal, sha256(translate(seq, 'N', 'T')) as seq_sha256, cast(n_count as bigint) as modified from met")
def preprocess(spark, sf):
    return records(spark, sf).select("ordinal", F.sha2(S.preprocessed(F.col("seq")), 256).alias("seq_sha256"), S.modified_bases(F.col("seq")).cast("long").alias("modified"))


@query("q_density_estimates", WITH + """, d as (select unnest([1.0, 2.0, 3.0, 4.0]) as density), s as (select density, cast(round_even(80 / density, 0) as integer) as step from d)
select cast(density as double) as density, cast(sum(case when length <= 70 then 0 when length < 80 then case when length >= 71 then 1 else 0 end else ((length - 80) // step) + 1 + case when ((length - 80) // step) * step <> length - 80 then 1 else 0 end end) as bigint) as n from met, s group by density""")  # fmt: skip
def densities(spark, sf):
    return T.estimated(refs(spark, sf), [1.0, 2.0, 3.0, 4.0])


def estimate(density):
    """SQL for the number of probes that linear tiling makes at a density."""
    step = f"greatest(1, cast(round_even(80 / ({density}), 0) as bigint))"
    return f"(select cast(sum(c * case when n <= 70 then 0 when n < 80 then case when n >= 71 then 1 else 0 end else ((n - 80 + {step} - 1) // {step}) + 1 end) as bigint) from ln)"


CHOICE = WITH.replace("with ", "with recursive ", 1) + f""", ln as (select length as n, count(*) as c from met group by 1),
b as (select 0 as i, 0.5::double as low, 4.0::double as high, 8.0::double as gap union all
  select i + 1, case when f <= 3000 then mid else low end, case when f <= 3000 then high else mid end, (high - low) / 2 from (select *, (low + high) / 2 as mid, {estimate('(low + high) / 2')} as f from b where i < 25 and gap >= 0.001)),
z as (select case when {estimate('4.0')} <= 3000 then 4.0 when {estimate('0.5')} > 3000 then 0.5 else (select low from b order by i desc limit 1) end as density)"""


@query("q_density_choice", CHOICE + f" select cast(density as double) as density, {estimate('density')} as n from z")
def density_choice(spark, sf):
    d, n = T.chosen_density(refs(spark, sf), 3000, 0.5, 4.0)
    return spark.createDataFrame([(float(d), int(n))], "density double, n long")


@query("q_probe_id_parse", TILES + " select bait_id, cast(ref_id as varchar) as ref_hint, cast(ref_start as bigint) as start, cast(ref_start + 79 as bigint) as \"end\", 'explicit_pos' as scheme, true as trusted from pr")
def probe_ids(spark, sf):
    return probes(spark, sf).select("bait_id", T.probe_place(F.col("bait_id"), F.length("seq")).alias("x")).select("bait_id", "x.*")


@query("q_greedy_cover")
def greedy(spark, sf):
    return V.greedy_cover(V.segments(probes(spark, sf, density=1.0), refs(spark, sf)), 2)


@query("q_augment_panel")
def augment(spark, sf):
    return V.augment(refs(spark, sf), probes(spark, sf, density=0.5), 1, rounds=2).groupBy("ref_id").agg(F.count("*").alias("n"))


@query("q_seed_hits")
def seeds(spark, sf):
    seq = F.translate(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), "[^acgtn]", ""), "acgtn", "ACGTN")
    p = T.tile(table(spark, sf, "benchmark").select(F.col("item_id").alias("ref_id"), seq.alias("seq")), bait_len=40, density=1.0, omit=20, pad_min=21)
    return D.seed_hits(p, p, k=8, min_ident=15)


@query("q_self_redundancy")
def self_redundancy(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    pairs = li.alias("x").join(li.alias("y"), "l_orderkey").where("x.l_partkey <> y.l_partkey").select(F.col("x.l_partkey").alias("a"), F.col("y.l_partkey").alias("b")).distinct()
    return D.greedy_representatives(pairs)


@query("q_primer_candidates", "with d as (select range as id from range(1048576)), p as (select array_to_string(list_transform([9, 8, 7, 6, 5, 4, 3, 2, 1, 0], lambda i: substr('ACGT', cast((id // cast(power(4, i) as bigint)) % 4 + 1 as integer), 1)), '') || 'GCTCTTCG' as primer from d) select substr(primer, 1, 2) as head, count(*) as n from p where not regexp_matches(primer, 'AAA|TTT|GGG|CCC') and not contains(primer, 'GAAGAGC') and not contains(substr(primer, 1, 16), 'GCTCTTC') group by 1")
def primers(spark, sf):
    return T.primer_candidates(spark).groupBy(F.substring("primer", 1, 2).alias("head")).agg(F.count("*").alias("n"))


PAIRS = {name: "map {" + ", ".join(f"'{p}': {v[i]}" for p, v in S.dna_pairs().items()) + "}" for i, name in enumerate(("h", "e"))}
TM = """1000 * (h + ta * 2.3 + (2 - ta) * 0.1) / (e + ta * 4.1 + (2 - ta) * -2.8 + 0.368 * (length(x) - 1) * ln((50 + 120 * sqrt(0.9)) / 1000)
  + 1.987 * ln(50 / 4e9)) - 273.15"""


@query("q_primer_window", f"""with d as (select range as id from range(1048576)), p as (select array_to_string(list_transform([9, 8, 7, 6, 5, 4, 3, 2, 1, 0], lambda i: substr('ACGT', cast((id // cast(power(4, i) as bigint)) % 4 + 1 as integer), 1)), '') || 'GCTCTTCG' as x from d),
k as (select x from p where not regexp_matches(x, 'AAA|TTT|GGG|CCC') and not contains(x, 'GAAGAGC') and not contains(substr(x, 1, 16), 'GCTCTTC') union all select 'GCTAATACGACTCACTATAGGG'),
s as (select x, list_sum(list_transform(range(1, length(x)), lambda i: cast({PAIRS["h"]}[substr(x, i, 2)] as double))) as h, list_sum(list_transform(range(1, length(x)), lambda i: cast({PAIRS["e"]}[substr(x, i, 2)] as double))) as e,
  cast(x[1] in ('A', 'T') as integer) + cast(x[-1] in ('A', 'T') as integer) as ta from k), t as (select x, {TM} as tm from s)
select x as primer, round(tm, 4) as tm from t where length(x) = 18 and abs(tm - (select tm from t where length(x) = 22)) < 0.1""")  # fmt: skip
def primers_of_one_temperature(spark, sf):
    return T.primer_candidates(spark, window=0.1).select("primer", F.round(S.dna_melting_point(F.col("primer")), 4).alias("tm"))


@query("q_best_primer", "select cast(min_by(l_suppkey, row(t, l_suppkey)) as varchar) as primer_id, cast(min(t) as bigint) as total from (select l_suppkey, sum(cast(l_quantity as bigint)) as t from lineitem group by 1)")
def best_primer(spark, sf):
    h = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("qseqid"), F.col("l_quantity").cast("long").alias("nident"))
    return T.best_primer(h).select(F.col("primer_id").cast("string").alias("primer_id"), "total")


@query("q_oligos", TILES + " select bait_id, sha256('GCTAATACGACTCACTATAGGG' || bait || 'CGAAGAGCTTGACTGATC') as oligo_sha256 from pr")
def oligos(spark, sf):
    return T.oligos(probes(spark, sf), "GATCAGTCAAGCTCTTCG").select("bait_id", F.sha2("oligo", 256).alias("oligo_sha256"))
