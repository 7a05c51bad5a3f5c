"""Command line over the operators: python -m moraine.cli {curate,explain,report,panel,audit,cluster,damage,check,linker,merge} --help."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from moraine.config import CURATE, DAMAGE, load
from moraine.operators import coverage, curate, damage, linker, occurrences, redundancy, screens, tiles, validate
from moraine.sources import fasta, sinks, tables


def run_curate(spark: SparkSession, a: argparse.Namespace) -> None:
    """FASTA files to decisions, a summary, coverage by species and FASTA by decision."""
    cfg = load(CURATE, a.config)
    kingdoms = tables.species_kingdom(spark, a.species_kingdom) if a.species_kingdom else None
    recs = fasta.read_fasta(spark, a.fasta)
    out = curate.rescued_duplicates(curate.annotated(recs, cfg, tables.regions(spark, a.regions) if a.regions else (), tables.keywords(spark, a.keywords) if a.keywords else (), kingdoms))
    if a.adapters:
        ads = tables.adapters(spark, a.adapters)
        out = screens.adapter_screen(out, ads, cfg)
        out = screens.trimmed(out, ads, cfg) if a.trim else out
    if a.hits:
        out = screens.taxonomy_screen(out, tables.hits(spark, a.hits), cfg)
    if a.vector_hits:
        out = screens.vector_screen(out, tables.hits(spark, a.vector_hits, tables.VECTOR_HITS), cfg)
    if a.window_hits:
        out = screens.window_screen(out, tables.hits(spark, a.window_hits), cfg)
    if a.clusters:
        out = screens.cluster_roles(out, tables.clusters(spark, a.clusters))
    if a.chimeras:
        out = screens.chimera_screen(out, tables.chimeras(spark, a.chimeras))
    out = curate.decided(out, cfg)
    out = curate.decided(curate.capped(out, cfg), cfg) if a.cap else out
    out = curate.sole_representatives(out).persist()
    sinks.write_decisions(out, a.out)
    sinks.write_tsv(curate.summary(out), f"{a.out}/summary")
    sinks.write_tsv(curate.species_coverage(out).orderBy((F.col("note") == "").cast("int"), F.desc("n_total")), f"{a.out}/species_coverage")
    sinks.snapshot(spark, f"{a.out}/config", cfg, sys.argv)


def run_explain(spark: SparkSession, a: argparse.Namespace) -> None:
    curate.explained(spark.read.csv(f"{a.out}/decisions", sep="\t", header=True), a.name).show(truncate=False, vertical=True)


def run_panel(spark: SparkSession, a: argparse.Namespace) -> None:
    """References to probes, counts by stage, coverage and recommendations."""
    refs = fasta.distinct_ids(fasta.read_fasta(spark, a.fasta)).select(F.col("accession").alias("ref_id"), "seq").withColumn("seq", F.translate("seq", "UN", "TT"))
    refs = refs.withColumn("length", F.length("seq")).persist()
    density, n = tiles.chosen_density(refs, a.most, a.least_density, a.density)
    masked = tiles.softmasked(refs) if a.mask else refs
    ring = F.col("ref_id").isin(*a.circular.split(",")) if a.circular else False
    probes = tiles.funnel(tiles.metrics(tiles.tile(masked, density=density, circular=ring)), min_tm=a.min_tm).persist()
    kept = redundancy.distinct_sequences(redundancy.without_complements(probes.where("stage = 4")))
    info = coverage.target_stats(coverage.segments(kept, refs))
    sinks.write_fasta(kept.withColumn("header", F.concat(F.lit(">"), "bait_id")), f"{a.out}/probes")
    for name, df in {"stages": tiles.stage_counts(probes), "targets": info, "recommendations": coverage.recommendations(info, kept, a.goal, a.depth)}.items():
        sinks.write_tsv(df, f"{a.out}/{name}")
    print(f"density {density:g}, about {n} probes before filters")


def run_damage(spark: SparkSession, a: argparse.Namespace) -> None:
    """A count matrix, a damage table and a linker to classified taxa."""
    cfg = load(DAMAGE, a.config)
    links = tables.read_table(spark, a.linker).select(F.col("library"), *(F.coalesce(F.lower(n).isin("true", "1", "yes"), F.lit(False)).alias(n) for n in ("negative", "environmental")))
    wide = tables.aliased(tables.read_table(spark, a.counts), {"tax_id": ["tax_id", "taxon_id", "#Datasets"], "tax_name": ["tax_name", "Name", "Taxon"], "tax_rank": ["tax_rank", "rank"]}, ("tax_id",))
    libs = [r[0] for r in links.select("library").distinct().collect()]  # one row a library of a study
    long_ = damage.counts_long(wide, [c for c in ("tax_id", "tax_name", "tax_rank") if c in wide.columns], [c for c in libs if c in wide.columns]).withColumn("taxon", F.col("tax_id"))
    d = tables.damage_table(spark, a.damage)
    sinks.write_tsv(damage.inputs_summary(long_, d), f"{a.out}/inputs")
    sinks.write_tsv(damage.warnings(long_, links, d), f"{a.out}/warnings")
    if lost := [r[0] for r in damage.missing_libraries(long_, links).collect()]:
        raise SystemExit(f"libraries without counts: {', '.join(sorted(lost))}")
    if a.command == "check":
        return
    out = damage.classified(long_, d.drop("tax_path"), links, cfg=cfg)
    sinks.write_tsv(out.orderBy(*damage.by_state(out)), f"{a.out}/taxa")
    sinks.write_tsv(out.groupBy("state").agg(F.count("*").alias("n")), f"{a.out}/states")


def run_report(spark: SparkSession, a: argparse.Namespace) -> None:
    """The summary of a decisions table, anew."""
    sinks.write_tsv(curate.rebuilt(tables.read_table(spark, a.decisions, sep="\t")), f"{a.out}/summary")


def run_audit(spark: SparkSession, a: argparse.Namespace) -> None:
    """A panel against its targets and a table of hits: placements, coverage by target, recommendations and their counts."""
    refs = fasta.distinct_ids(fasta.read_fasta(spark, a.targets)).select(F.col("accession").alias("ref_id"), "seq", F.length("seq").alias("length")).persist()
    probes = fasta.distinct_ids(fasta.read_fasta(spark, a.probes)).select(F.col("accession").alias("probe"), "seq").persist()
    size = validate.uniform_length(probes)
    said = probes.select("probe", tiles.probe_place(F.col("probe"), F.length("seq")).alias("p")).select("probe", "p.*")
    found = validate.resolved(said.select("ref_hint"), refs)
    meta = said.join(found, said["ref_hint"].eqNullSafe(found["ref_hint"])).select("probe", "target_id", "start", "end", "trusted")
    t = tables.read_table(spark, a.hits)
    n = lambda c: F.col(c).try_cast("long")
    hits = t.select("probe", "target", validate.subject_start(n("sstart"), n("send"), F.col("strand") == "plus").alias("subject_start"), n("identities").alias("identities"), n("length").alias("align_length"), F.col("bits").try_cast("double").alias("bits"), "match", "subject")
    at = validate.placements(meta, hits, size).persist()
    info = coverage.target_stats(coverage.segments(at, refs))
    advice = coverage.recommendations(info, tiles.metrics(probes), a.goal, a.depth)
    for name, df in {"placements": at, "targets": info, "recommendations": advice, "counts": validate.recommendation_counts(advice)}.items():
        sinks.write_tsv(df, f"{a.out}/{name}")


def run_cluster(spark: SparkSession, a: argparse.Namespace) -> None:
    """Probes less those that longer, similar ones stand for, by a table of hits (qseqid, sseqid, nident, length)."""
    probes = fasta.distinct_ids(fasta.read_fasta(spark, a.probes)).select(F.col("accession").alias("bait_id"), "seq", "header")
    t = tables.read_table(spark, a.hits)
    hits = t.select("qseqid", "sseqid", F.col("nident").try_cast("long").alias("nident"), F.col("length").try_cast("long").alias("length"))
    sinks.write_fasta(redundancy.cluster_representatives(probes, hits, a.identity, a.overlap), f"{a.out}/probes")


def run_linker(spark: SparkSession, a: argparse.Namespace) -> None:
    """Columns of count matrices, metadata and damage samples to a linker and its issues."""
    columns = tables.matrix_columns(spark, tables.expanded(spark, a.counts)).select("column", "ordinal")
    meta = tables.aliased(tables.read_table(spark, a.metadata, ordinal=False), {"stem_key": ["stem_key", "library"], "sample_id": ["sample_id", "sample"], "sample_type": ["sample_type", "type"], "site": ["site"], "context": ["context"]}, ("stem_key", "sample_id", "sample_type", "site", "context"))
    out = linker.linked(columns, meta, tables.sample_names(spark, a.damage)).persist()
    sinks.write_tsv(out, f"{a.out}/linker")
    sinks.write_tsv(linker.issues(out), f"{a.out}/issues")


def run_merge(spark: SparkSession, a: argparse.Namespace) -> None:
    """Taxon lists of several sources to one, with a search list."""
    rows = None
    for i, path in enumerate(a.tables):
        t = tables.read_table(spark, path)
        get = lambda *c: occurrences.first_filled(t, list(c))  # noqa: E731, B023
        one = t.select(get("ncbi_search_name", "species", "scientificName").alias("name"), get("source", "source_database").alias("source"), get("kingdom").alias("kingdom"), get("phylum").alias("phylum"), get("taxonKey", "taxon_key").alias("taxon_key"), F.lit(path).alias("file"), get("region").alias("region"), get("period").alias("period"), (F.lit(i << 40) + F.col("ordinal")).alias("ordinal"))
        rows = one if rows is None else rows.unionByName(one)
    out = occurrences.merged(rows, a.priority.split(",") if a.priority else [], a.mode).persist()
    sinks.write_csv(out.orderBy("species"), f"{a.out}/taxa")
    sinks.write_tsv(occurrences.search_list(out), f"{a.out}/search_list")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="moraine")
    s = p.add_subparsers(dest="command", required=True)
    c = s.add_parser("curate")
    c.add_argument("fasta", nargs="+")
    for name in ("config", "regions", "keywords", "adapters", "species-kingdom", "hits", "vector-hits", "window-hits", "clusters", "chimeras"):
        c.add_argument(f"--{name}")
    c.add_argument("--trim", action="store_true")
    c.add_argument("--cap", action="store_true")
    e = s.add_parser("explain")
    e.add_argument("name")
    b = s.add_parser("panel")
    b.add_argument("fasta", nargs="+")
    b.add_argument("--circular")
    b.add_argument("--mask", action="store_true")
    b.add_argument("--most", type=int, default=0)
    for name, value in (("density", 3.0), ("least-density", 1.0), ("min-tm", 50.0), ("goal", 0.95), ("depth", 2.0)):
        b.add_argument(f"--{name}", type=float, default=value)
    flows = [c, e, b]
    for command in ("damage", "check"):
        d = s.add_parser(command)
        for name in ("counts", "damage", "linker"):
            d.add_argument(name)
        d.add_argument("--config")
        flows.append(d)
    r = s.add_parser("report")
    r.add_argument("decisions")
    u = s.add_parser("audit")
    for name in ("probes", "targets", "hits"):
        u.add_argument(name)
    u.add_argument("--goal", type=float, default=0.95)
    u.add_argument("--depth", type=float, default=2.0)
    k = s.add_parser("cluster")
    k.add_argument("probes")
    k.add_argument("hits")
    k.add_argument("--identity", type=float, default=0.95)
    k.add_argument("--overlap", type=float, default=0.83)
    n = s.add_parser("linker")
    n.add_argument("counts", nargs="+")
    n.add_argument("--metadata", required=True)
    n.add_argument("--damage", required=True)
    m = s.add_parser("merge")
    m.add_argument("tables", nargs="+")
    m.add_argument("--priority", default="")
    m.add_argument("--mode", default="binomial", choices=("binomial", "trinomial", "genus"))
    for x in (*flows, r, u, k, n, m):
        x.add_argument("--out", required=True)
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("moraine").getOrCreate()
    {
        "curate": run_curate, "explain": run_explain, "report": run_report, "panel": run_panel, "audit": run_audit, "cluster": run_cluster,
        "damage": run_damage, "check": run_damage, "linker": run_linker, "merge": run_merge,
    }[a.command](spark, a)


if __name__ == "__main__":
    main()
