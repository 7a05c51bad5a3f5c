"""Contamination and taxonomy screens: approximate adapter search, and verdicts over hit tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moraine.config import CURATE
from moraine.functions import sequence as S
from moraine.operators.curate import added

# Domains expected of a kingdom label; labels not named here are never in conflict.
DOMAINS = {"Animal": "Eukaryota", "Plant": "Eukaryota", "Fungi": "Eukaryota", "Protist": "Eukaryota", "Bacteria": "Bacteria", "Archaea": "Archaea"}


def _revcomp(s: str) -> str:
    return s.translate(str.maketrans(S.IUPAC, S.COMPLEMENT))[::-1]


def find(seq: Column, pattern: str, mismatches: int = 0) -> Column:
    """0-based place of the first exact occurrence, else of the first window within the mismatches; null without any.

    Windows are compared only where one of mismatches + 1 pieces of the pattern occurs at all, as one must.
    """
    n = len(pattern)
    exact = F.instr(seq, pattern)
    out = F.when(F.length(seq) < n, None).when(exact > 0, exact - 1)
    if mismatches <= 0:
        return out
    cuts = [round(i * n / (mismatches + 1)) for i in range(mismatches + 2)]
    some = F.lit(False)
    for a, b in zip(cuts, cuts[1:], strict=False):
        some = some | F.contains(seq, F.lit(pattern[a:b]))
    letters = F.array(*map(F.lit, pattern))
    off = lambda chars, j: F.size(F.filter(F.zip_with(F.slice(chars, j, n), letters, lambda a, b: a != b), lambda x: x))
    close = lambda t, c, k: S.let(F.split(t, ""), lambda chars: F.transform(F.filter(F.sequence(F.lit(1), k), lambda j: off(chars, j) <= mismatches), lambda j: c + j - 1))
    near = F.array_min(S.by_blocks(seq, n, close))
    return out.when(some, near)


def terminal(pos: Column, size: Column, length: Column, window: int) -> Column:
    return (pos <= window) | (pos + size >= length - window)


def adapter_hit(seq: Column, adapters: list[tuple[str, str, int]], cfg: dict = CURATE) -> Column:
    """struct(name, pos, size, strand) of the first adapter (name, sequence, mismatches) found, + strand before -; null without."""
    a, tries = cfg["adapter"], []
    for name, pattern, mm in adapters:
        for strand, p in (("+", pattern), ("-", _revcomp(pattern)))[: 2 if a["scan_reverse"] else 1]:
            if len(p) >= a["min_pattern"]:
                at = find(seq, p, mm)
                tries.append(F.when(at.isNotNull(), F.struct(F.lit(name).alias("name"), at.alias("pos"), F.lit(len(p)).alias("size"), F.lit(strand).alias("strand"))))
    return F.coalesce(*tries) if tries else F.lit(None).cast("struct<name:string,pos:int,size:int,strand:string>")


def adapter_screen(records: DataFrame, adapters: list[tuple[str, str, int]], cfg: dict = CURATE, seq: str = "seq") -> DataFrame:
    """adapter_name, adapter_position ("start-end(strand)", 1-based), adapter_terminal, and the reason."""
    out = records.withColumn("_hit", adapter_hit(F.upper(seq), adapters, cfg))
    h = F.col("_hit")
    end = terminal(h["pos"], h["size"], F.length(seq), cfg["adapter"]["terminal_window"])
    out = out.withColumns({"adapter_name": h["name"], "adapter_position": F.when(h.isNotNull(), F.concat(h["pos"] + 1, F.lit("-"), h["pos"] + h["size"], F.lit("("), h["strand"], F.lit(")"))), "adapter_terminal": end})
    reason = F.when(h.isNull(), F.array().cast("array<string>")).when(F.col("adapter_terminal"), F.array(F.lit("adapter_terminal"))).otherwise(F.array(F.lit("adapter_internal")))
    return out.withColumn("reasons", added(F.col("reasons"), reason)).drop("_hit")


def trimmed(records: DataFrame, adapters: list[tuple[str, str, int]], cfg: dict = CURATE, seq: str = "seq") -> DataFrame:
    """Records with an internal adapter are cut to their longer flank of at least the least length (5' on ties) and kept so if it has no internal adapter left."""
    least = cfg["qc"]["min_length"]
    a = F.regexp_extract("adapter_position", r"^(\d+)-", 1).cast("int")
    b = F.regexp_extract("adapter_position", r"-(\d+)\(", 1).cast("int")
    left, right = F.substring(F.col(seq), F.lit(1), a - 1), F.substring(F.col(seq), b + 1, F.length(seq))
    best = F.when((F.length(left) >= least) & (F.length(left) >= F.length(right)), left).when(F.length(right) >= least, right)
    inside = F.array_contains("reasons", "adapter_internal")
    out = records.withColumn("_cut", F.when(inside, best)).withColumn("_again", adapter_hit(F.upper("_cut"), adapters, cfg))
    end = terminal(F.col("_again.pos"), F.col("_again.size"), F.length("_cut"), cfg["adapter"]["terminal_window"])
    ok = F.col("_cut").isNotNull() & (F.col("_again").isNull() | end)
    reasons = added(F.array_except("reasons", F.array(F.lit("adapter_internal"))), F.when(F.col("_again").isNull(), F.array(F.lit("adapter_trimmed_rescued"))).otherwise(F.array(F.lit("adapter_terminal"), F.lit("adapter_trimmed_rescued"))))
    out = out.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    return out.withColumn("reasons", F.when(F.col("_ok"), reasons).otherwise(F.col("reasons"))).withColumn(seq, F.when(F.col("_ok"), F.col("_cut")).otherwise(F.col(seq))).drop("_cut", "_again", "_ok")


def windows(records: DataFrame, cfg: dict = CURATE, key: str = "record_key", seq: str = "seq") -> DataFrame:
    """key, win, start (1-based), end, window: overlapping windows of long records, the last one flush with the end."""
    w = cfg["windows"]
    long_ = records.where(F.length(seq) >= w["min_length"]).withColumn("_last", F.greatest(F.length(seq) - w["size"], F.lit(0)))
    starts = F.array_distinct(F.concat(F.sequence(F.lit(0), F.col("_last"), F.lit(w["step"])), F.array("_last")))
    size = F.least(F.lit(w["size"]), F.length(seq))
    cut = S.let(F.encode(F.col(seq), "UTF-32"), lambda wide: F.transform(starts, lambda s, i: F.struct((i + 1).alias("win"), (s + 1).alias("start"), F.decode(F.substring(wide, 4 * s + 1, 4 * size), "UTF-32").alias("window"))))
    rows = long_.select(key, F.explode(cut).alias("x")).select(key, "x.*").withColumn("end", F.col("start") + F.length("window") - 1)
    return rows.where(F.length("window") >= min(100, max(1, w["size"] // 2)))


def top_hits(hits: DataFrame, min_pident: float, min_qcov: float | None, search_type: int = 1, query: str = "qseqid", ordinal: str = "ordinal") -> DataFrame:
    """The first hit of each query, in file order, that passes identity and coverage (lengths in amino acids count thrice)."""
    ok = F.col("pident") >= min_pident
    if min_qcov is not None:
        ok &= F.when(F.col("qlen") > 0, F.col("length") * (3 if search_type == 2 else 1) * 100 / F.col("qlen")).otherwise(0.0) >= min_qcov
    return hits.where(ok).withColumn("_n", F.row_number().over(Window.partitionBy(query).orderBy(ordinal))).where("_n = 1").drop("_n")


def first_taxid(ids: Column) -> Column:
    return F.try_to_number(F.regexp_extract(F.split_part(ids, F.lit(";"), F.lit(1)), r"^\s*(\d+)\s*$", 1), F.lit("999999999999")).cast("long")


def taxonomy_screen(records: DataFrame, hits: DataFrame, cfg: dict = CURATE, lineage: DataFrame | None = None, key: str = "record_key") -> DataFrame:
    """taxonomy_status and its reason from hit tables (11 columns and ordinal).

    With lineage (taxid, domain, genus) known for a hit: other domain, then genus, then species; without: species, then
    genus, by name.
    """
    t = cfg["taxonomy"]
    top = top_hits(hits, t["min_pident"], t["min_qcov"], t["search_type"]).select(F.col("qseqid").alias("_q"), F.col("saccver").alias("taxonomy_top_hit"), F.trim("sscinames").alias("taxonomy_top_name"), F.col("pident").alias("taxonomy_top_pident"), first_taxid(F.col("staxids")).alias("_taxid"))
    out = records.join(top, F.col(key) == F.col("_q"), "left")
    if lineage is None:
        out = out.withColumn("_domain", F.lit(None).cast("string")).withColumn("_genus", F.lit(None).cast("string"))
    else:
        out = out.join(lineage.select(F.col("taxid").alias("_taxid"), F.coalesce("domain", F.lit("")).alias("_domain"), F.coalesce("genus", F.lit("")).alias("_genus")), "_taxid", "left")
    name, sp, gen = F.lower("taxonomy_top_name"), F.lower("species"), F.lower("genus")
    expected = F.coalesce(*(F.when(F.col("kingdom") == k, F.lit(d)) for k, d in DOMAINS.items()))
    cross = F.lit(t["reject_cross_kingdom"]) & (F.col("_domain") != "") & expected.isNotNull() & (F.col("_domain") != expected)
    by_species = (sp != "") & F.contains(name, sp)
    status = (
        F.when(F.col("_q").isNull(), "NOT_CHECKED")
        .when(F.col("_domain").isNotNull(), F.when(cross, "REJECT_CROSS_KINGDOM").when((gen != "") & (F.lower("_genus") == gen), "PASS_GENUS").when(by_species, "PASS_SPECIES").otherwise("NO_EXPECTED_MATCH"))
        .otherwise(F.when(by_species, "PASS_SPECIES").when((gen != "") & F.contains(name, gen), "PASS_GENUS").otherwise("NO_EXPECTED_MATCH"))
    )
    reason = F.create_map(*map(F.lit, ("NOT_CHECKED", "taxonomy_not_checked", "REJECT_CROSS_KINGDOM", "taxonomy_cross_kingdom", "PASS_GENUS", "taxonomy_same_genus", "PASS_SPECIES", "taxonomy_same_species", "NO_EXPECTED_MATCH", "taxonomy_no_expected_match")))
    out = out.withColumn("taxonomy_status", status)
    return out.withColumn("reasons", added(F.col("reasons"), F.array(reason[F.col("taxonomy_status")]))).drop("_q", "_taxid", "_domain", "_genus")


def escalated(records: DataFrame, hits: DataFrame, label: str, min_pident: float, cfg: dict = CURATE, lineage: DataFrame | None = None, key: str = "record_key") -> DataFrame:
    """Cross-kingdom rejections that another hit table clears: expected domain, or species or genus by name where no lineage is known."""
    t = cfg["taxonomy"]
    top = top_hits(hits, min_pident, t["min_qcov"], t["search_type"]).select(F.col("qseqid").alias("_q"), F.lower(F.trim("sscinames")).alias("_name"), first_taxid(F.col("staxids")).alias("_taxid"))
    out = records.join(top, F.col(key) == F.col("_q"), "left")
    known = F.lit(None).cast("string")
    if lineage is not None:
        out = out.join(lineage.select(F.col("taxid").alias("_taxid"), F.coalesce("domain", F.lit("")).alias("_domain")), "_taxid", "left")
        known = F.col("_domain")
    expected = F.coalesce(*(F.when(F.col("kingdom") == k, F.lit(d)) for k, d in DOMAINS.items()))
    by_name = ((F.lower("genus") != "") & F.contains("_name", F.lower("genus"))) | ((F.lower("species") != "") & F.contains("_name", F.lower("species")))
    clear = F.array_contains("reasons", "taxonomy_cross_kingdom") & F.col("_q").isNotNull() & F.when(known.isNotNull(), F.coalesce(known == expected, F.lit(False))).otherwise(by_name)
    out = out.withColumn("_ok", F.coalesce(clear, F.lit(False)))
    out = out.withColumn("reasons", F.when(F.col("_ok"), added(F.array_except("reasons", F.array(F.lit("taxonomy_cross_kingdom"))), F.array(F.lit(f"taxonomy_rescued_{label}")))).otherwise(F.col("reasons")))
    return out.withColumn("taxonomy_status", F.when(F.col("_ok"), "ESCALATION_RESCUED").otherwise(F.col("taxonomy_status"))).drop("_q", "_name", "_taxid", "_domain", "_ok")


def window_conflicts(hits: DataFrame, cfg: dict = CURATE, lineage: DataFrame | None = None) -> DataFrame:
    """parent, n_windows, n_labels, conflict from the first passing hit of each window ("key|winN|start-end").

    Labels are names at a rank where lineage (taxid, name) has them, else first words; two words where no lineage is given.
    """
    w = cfg["windows"]
    top = top_hits(hits, w["min_pident"], None).select(F.split_part("qseqid", F.lit("|"), F.lit(1)).alias("parent"), F.trim("sscinames").alias("name"), first_taxid(F.col("staxids")).alias("taxid"))
    if lineage is None:
        label = F.lower(F.array_join(F.slice(F.split("name", r"\s+"), 1, 2), " "))
    else:
        top = top.join(lineage.select("taxid", F.col("name").alias("at_rank")), "taxid", "left")
        label = F.lower(F.coalesce(F.nullif("at_rank", F.lit("")), F.split_part("name", F.lit(" "), F.lit(1))))
    out = top.withColumn("label", label).groupBy("parent").agg(F.count("*").alias("n_windows"), F.count_distinct(F.nullif("label", F.lit(""))).alias("n_labels"))
    return out.withColumn("conflict", (F.col("n_windows") >= w["min_windows"]) & (F.col("n_labels") >= 2))


def window_screen(records: DataFrame, hits: DataFrame, cfg: dict = CURATE, lineage: DataFrame | None = None, key: str = "record_key") -> DataFrame:
    w = cfg["windows"]
    found = window_conflicts(hits, cfg, lineage).select(F.col("parent").alias("_p"), "conflict")
    out = records.join(found, F.col(key) == F.col("_p"), "left")
    bad = F.coalesce("conflict", F.lit(False))
    out = out.withColumn("windowed_status", F.when(bad, "WINDOWED_CONFLICT").when(F.col("_p").isNotNull() | (F.col("length") >= w["min_length"]), "WINDOWED_OK").otherwise("NOT_CHECKED"))
    more = [F.lit("windowed_blast_conflict")] + [F.lit("taxonomy_cross_kingdom")] * (w["action"] == "reject")
    return out.withColumn("reasons", F.when(bad, added(F.col("reasons"), F.array(*more))).otherwise(F.col("reasons"))).drop("_p", "conflict")


def vector_screen(records: DataFrame, hits: DataFrame, cfg: dict = CURATE, key: str = "record_key") -> DataFrame:
    """vector_terminal and vector_internal from hits of qseqid, pident, length, qstart, qend; both may hold."""
    v = cfg["vector"]
    long_ = hits.where((F.col("pident") >= v["min_pident"]) & (F.col("length") >= v["min_hit_length"])).select(F.col("qseqid").alias("_q"), (F.least("qstart", "qend") - 1).alias("_pos"), F.col("length").alias("_len"))
    sizes = records.select(F.col(key).alias("_k"), F.col("length").alias("_n"))
    end = terminal(F.col("_pos"), F.col("_len"), F.col("_n"), v["terminal_window"])
    per = long_.join(sizes, F.col("_q") == F.col("_k")).groupBy("_k").agg(F.bool_or(end).alias("vector_terminal"), F.bool_or(~end).alias("vector_internal"))
    out = records.join(per, F.col(key) == F.col("_k"), "left").drop("_k").fillna(False, ["vector_terminal", "vector_internal"])
    reason = F.array_compact(F.array(F.when(F.col("vector_terminal"), F.lit("vector_terminal")), F.when(F.col("vector_internal"), F.lit("vector_internal"))))
    return out.withColumn("reasons", added(F.col("reasons"), reason))


def cluster_roles(records: DataFrame, clusters: DataFrame, key: str = "record_key") -> DataFrame:
    """cluster_id and role from cluster lines (type, cluster, query, ordinal); a query's last line wins, S lines name centroids."""
    last = clusters.groupBy("query").agg(F.max_by("cluster", "ordinal").alias("cluster_id"))
    cent = clusters.where("type = 'S'").groupBy(F.col("cluster").alias("_c")).agg(F.max_by("query", "ordinal").alias("_cent"))
    out = records.join(last, F.col(key) == F.col("query"), "left").drop("query").join(cent, F.col("cluster_id") == F.col("_c"), "left")
    role = F.when(F.col("cluster_id").isNull(), "").when(F.col("_cent") == F.col(key), "centroid").otherwise("member")
    out = out.withColumn("cluster_role", role)
    reason = F.when(F.col("cluster_role") == "centroid", F.array(F.lit("cluster_representative"))).when(F.col("cluster_role") == "member", F.array(F.lit("cluster_nonrepresentative"))).otherwise(F.array().cast("array<string>"))
    return out.withColumn("reasons", added(F.col("reasons"), reason)).drop("_c", "_cent")


def chimera_screen(records: DataFrame, verdicts: DataFrame, key: str = "record_key") -> DataFrame:
    """Reasons from (query, verdict): Y is a chimera, ? is borderline."""
    per = verdicts.groupBy(F.col("query").alias("_q")).agg(F.bool_or(F.col("verdict") == "Y").alias("_y"), F.bool_or(F.col("verdict") == "?").alias("_b"))
    out = records.join(per, F.col(key) == F.col("_q"), "left")
    reason = F.array_compact(F.array(F.when(F.col("_y"), F.lit("chimera_detected")), F.when(F.col("_b"), F.lit("chimera_borderline"))))
    return out.withColumn("reasons", added(F.col("reasons"), reason)).drop("_q", "_y", "_b")


def hook_screen(records: DataFrame, table: DataFrame, hit: str, review: str, accession: str = "accession", key: str = "record_key") -> DataFrame:
    """Reasons from a tool's table: rows that say reject, contaminant, adapter, vector or foreign are hits, others review."""
    name = next(c for c in ("accession", "qseqid", "query", "record_key") if c in table.columns)
    said = F.lower(F.concat_ws(" ", *(F.col(c).cast("string") for c in table.columns)))
    per = table.select(F.col(name).alias("_n"), said.rlike("reject|contaminant|adapter|vector|foreign").alias("_h")).groupBy("_n").agg(F.bool_or("_h").alias("_h"))
    out = records.join(per, (F.col(key) == F.col("_n")) if name in ("record_key", "qseqid", "query") else (F.col(accession) == F.col("_n")), "left")
    reason = F.when(F.col("_h").isNull(), F.array().cast("array<string>")).when(F.col("_h"), F.array(F.lit(hit))).otherwise(F.array(F.lit(review)))
    return out.withColumn("reasons", added(F.col("reasons"), reason)).drop("_n", "_h")
