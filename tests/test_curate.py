from pyspark.sql import functions as F

from moraine.config import CURATE, load, merged
from moraine.operators import curate as C
from moraine.operators import rules as R
from moraine.operators import screens, taxonomy

HEAD = "accession string, header string, seq string, ordinal long"
GOOD = "ACGTTGCAACGGTCATTGCAGGATCCATAGACGTTCAGGACTTACGATCGATTACAGGCATCGATTCAGCTAGC"


def table(spark, rows):
    return spark.createDataFrame([(a, h, s, i) for i, (a, h, s) in enumerate(rows)], HEAD)


def test_keys_and_duplicates(spark):
    df = table(spark, [("A", ">A", GOOD), ("A", ">A", GOOD + "A"), ("B", ">B", GOOD)])
    out = {r.ordinal: r for r in C.duplicates(C.metrics(C.unique_keys(df))).collect()}
    assert [out[i].record_key for i in range(3)] == ["A", "A__dup2", "B"]
    assert [(out[i].duplicate_accession, out[i].duplicate_sequence) for i in range(3)] == [(False, False), (True, False), (False, True)]


def test_fixture_records_end_to_end(spark):
    rows = [
        ("NC_000001.1", ">NC_000001.1 Bison bison mitochondrion, complete genome", GOOD),
        ("DUP.1", ">DUP.1 Bison bison", GOOD + "ACT"),
        ("DUP.1", ">DUP.1 Bison bison", GOOD + "ACG"),
        ("SEQDUPB.1", ">SEQDUPB.1 Equus ferus", GOOD),
        ("LOWN.1", ">LOWN.1 Equus ferus", "A" * 70 + "N" * 30),
        ("BAD.1", ">BAD.1 Canis lupus UNVERIFIED", GOOD + "TT"),
    ]
    got = {r.record_key: r for r in C.decided(C.annotated(table(spark, rows), keywords=[("unverified", "review", "x")])).collect()}
    assert got["NC_000001.1"].reasons == ["refseq_preferred", "complete_organelle"] and (got["NC_000001.1"].decision_score, got["NC_000001.1"].decision) == (115, "KEEP")
    assert (got["DUP.1__dup2"].decision_score, got["DUP.1__dup2"].decision) == (0, "REJECT")
    assert got["SEQDUPB.1"].reasons == ["duplicate_sequence"]
    assert got["LOWN.1"].reasons == ["n_fraction_high", "low_complexity", "homopolymer_long"] and (got["LOWN.1"].decision_score, got["LOWN.1"].decision) == (35, "REVIEW")
    assert (got["BAD.1"].decision_score, got["BAD.1"].decision) == (70, "REVIEW")


def test_cross_species_rescue_and_sole_representative(spark):
    rows = [("A", ">A Bison bison", GOOD), ("B", ">B Equus ferus", GOOD), ("NC_9", ">NC_9 Equus ferus", GOOD)]
    out = {r.accession: r for r in C.run(table(spark, rows)).collect()}
    assert "rescued_duplicate" in out["NC_9"].reasons and not out["NC_9"].duplicate_sequence and out["B"].duplicate_sequence


def test_caps_push_down_beyond_the_limit(spark):
    rows = [(f"R{i}", f">R{i} Bison bison mitochondrion", GOOD + "ACGT" * i) for i in range(4)]
    cfg = merged(CURATE, {"caps": {"by_class": {"Mito": 2}}})
    out = C.capped(C.decided(C.annotated(table(spark, rows), cfg), cfg), cfg)
    assert {r.accession: r.decision for r in out.collect()} == {"R3": "KEEP", "R2": "KEEP", "R1": "REVIEW", "R0": "REVIEW"}


def test_names_and_markers(spark):
    heads = [">X1 Bison bison 18S rRNA", ">X2 something [Equus ferus caballus]", ">X3 lower case", ">X4 chloroplast"]
    df = spark.createDataFrame([(h,) for h in heads], "h string")
    got = df.select(R.species(F.col("h")).alias("s"), R.marker(F.col("h")).alias("m")).collect()
    assert [(r.s.species, r.s.genus) for r in got] == [("Bison bison", "Bison"), ("Equus ferus", "Equus"), ("", ""), ("", "")]
    assert [r.m.marker_class for r in got] == ["NucMark", "Other", "Other", "Plastid"]
    assert [r[0] for r in spark.createDataFrame([("Metazoa",), ("metazoans",), ("Viridiplantae",), (None,)], "k string").select(R.kingdom(F.col("k"))).collect()] == ["Animal", "Unknown", "Plant", "Unknown"]


def test_adapter_search_against_brute_force(spark):
    import random

    rng = random.Random(3)
    pattern = "ACGTACGGTTCA"
    seqs = ["".join(rng.choice("ACGT") for _ in range(rng.randint(5, 60))) for _ in range(30)]
    seqs += [s[:10] + pattern[:5] + "T" + pattern[6:] + s for s in seqs[:10]] + [s + pattern for s in seqs[:5]]

    def brute(s, mm):
        if len(s) < len(pattern):
            return None
        if pattern in s:
            return s.index(pattern)
        return next((i for i in range(len(s) - len(pattern) + 1) if sum(a != b for a, b in zip(s[i:], pattern)) <= mm), None)

    df = spark.createDataFrame(list(enumerate(seqs)), "i int, s string").orderBy("i")
    for mm in (0, 1, 3):
        assert [r[0] for r in df.select(screens.find(F.col("s"), pattern, mm)).collect()] == [brute(s, mm) for s in seqs]


def test_adapter_terminal_internal_and_trim(spark):
    ad = [("ad", "TTTTGGGGCCCCAAAATTTT", 0)]
    rows = [("T", ">T", "TTTTGGGGCCCCAAAATTTT" + GOOD * 2), ("I", ">I", GOOD + "TTTTGGGGCCCCAAAATTTT" + GOOD)]
    out = screens.adapter_screen(C.annotated(table(spark, rows)), ad)
    got = {r.accession: r for r in out.collect()}
    assert got["T"].adapter_position == "1-20(+)" and "adapter_terminal" in got["T"].reasons and "adapter_internal" in got["I"].reasons
    cut = {r.accession: r for r in screens.trimmed(out, ad).collect()}
    assert cut["I"].seq == GOOD and "adapter_trimmed_rescued" in cut["I"].reasons and "adapter_internal" not in cut["I"].reasons


HITS = "qseqid string, saccver string, pident double, length int, qlen int, staxids string, sscinames string, ordinal long"


def test_taxonomy_verdicts(spark):
    rows = [("A", ">A Bison bison", GOOD), ("B", ">B Bison bison", GOOD + "A"), ("C", ">C Equus ferus", GOOD + "C"), ("D", ">D Canis lupus", GOOD + "G")]
    recs = C.annotated(table(spark, rows)).withColumn("kingdom", F.lit("Animal"))
    hits = spark.createDataFrame([("A", "x", 60.0, 70, 72, "1", "Bison bison", 0), ("A", "y", 99.0, 70, 72, "1", "Bison bison", 1), ("B", "z", 99.0, 70, 72, "2", "Bison priscus", 2), ("C", "w", 99.0, 70, 72, "3", "Escherichia coli", 3)], HITS)
    plain = {r.accession: r.taxonomy_status for r in screens.taxonomy_screen(recs, hits).collect()}
    assert plain == {"A": "PASS_SPECIES", "B": "PASS_GENUS", "C": "NO_EXPECTED_MATCH", "D": "NOT_CHECKED"}
    lineage = spark.createDataFrame([(1, "Eukaryota", "Bison"), (3, "Bacteria", "Escherichia")], "taxid long, domain string, genus string")
    out = screens.taxonomy_screen(recs, hits, lineage=lineage)
    assert {r.accession: r.taxonomy_status for r in out.collect()} == {"A": "PASS_GENUS", "B": "PASS_GENUS", "C": "REJECT_CROSS_KINGDOM", "D": "NOT_CHECKED"}
    second = spark.createDataFrame([("C", "v", 95.0, 70, 72, "1", "Bison", 0)], HITS)
    back = {r.accession: r for r in screens.escalated(out, second, "nt_blast", 80.0, lineage=lineage).collect()}
    assert back["C"].taxonomy_status == "ESCALATION_RESCUED" and "taxonomy_cross_kingdom" not in back["C"].reasons


def test_window_conflict_and_windows(spark):
    w = [("P|win1|1-500", "x", 90.0, 1, 1, "0", "Bison bison", 0), ("P|win2|250-749", "x", 90.0, 1, 1, "0", "Equus ferus", 1), ("Q|win1|1-500", "x", 90.0, 1, 1, "0", "Bison bison", 2)]
    got = {r.parent: r.conflict for r in screens.window_conflicts(spark.createDataFrame(w, HITS)).collect()}
    assert got == {"P": True, "Q": False}
    recs = spark.createDataFrame([("a", "A" * 1300), ("b", "A" * 999)], "record_key string, seq string")
    assert sorted((r.record_key, r.start, r.end) for r in screens.windows(recs).collect()) == [("a", s, s + 499) for s in (1, 251, 501, 751, 801)]


def test_tree_walks(spark):
    nodes = spark.createDataFrame([(1, 1, "no rank", "root"), (2, 1, "superkingdom", "Eukaryota"), (3, 2, "genus", "Bison"), (4, 3, "species", "Bison bison"), (8, 9, "x", "loop"), (9, 8, "y", "loop2")], "taxid long, parent long, rank string, name string")
    got = {r.taxid: (r.genus, r.domain) for r in taxonomy.at_ranks(nodes, {"genus": ("genus",), "domain": ("domain", "superkingdom")}, 8).collect()}
    assert got[4] == ("Bison", "Eukaryota") and got[1] == ("", "")
    assert [tuple(x) for x in taxonomy.lineages(nodes, 8).where("taxid = 4").first().lineage] == [("species", "Bison bison"), ("genus", "Bison"), ("superkingdom", "Eukaryota"), ("no rank", "root")]


def test_config_is_layered_and_fixed(tmp_path):
    f = tmp_path / "c.yml"
    f.write_text("qc: {min_length: 9}\n")
    got = load(CURATE, str(f), windows=None)
    assert got["qc"]["min_length"] == 9 and got["qc"]["max_run"] == 60 and CURATE["qc"]["min_length"] == 50
