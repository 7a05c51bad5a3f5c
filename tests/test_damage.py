import pytest
from pyspark.sql import functions as F

from moraine.config import DAMAGE
from moraine.operators import damage as D
from moraine.operators import linker as L
from moraine.operators import report as R

COUNTS = "taxon string, tax_id string, tax_name string, tax_rank string, library string, count double"
ROWS = "sample string, tax_id string, tax_name string, tax_rank string, damage double, significance double, n_reads double, n_alignments double, rho double, map_valid boolean, ordinal long"
LINKER = "library string, negative boolean, environmental boolean"


def classify(spark, counts, rows, negatives=("BLK",)):
    c = spark.createDataFrame([("t", "1", "Bison", "genus", lib, float(n)) for lib, n in counts.items()], COUNTS)
    link = spark.createDataFrame([(lib, lib in negatives, False) for lib in counts], LINKER)
    return D.classified(c, spark.createDataFrame(rows, ROWS), link).first()


def row(sample, damage=0.1, significance=3.0, reads=150.0, alignments=300.0, tax_id="1"):
    return (sample, tax_id, "Bison", "genus", damage, significance, reads, alignments, 0.1, True, 0)


def test_damage_and_counts_give_the_top_state(spark):
    got = classify(spark, {"A": 100, "B": 20, "BLK": 0}, [row("A")])
    assert got.state == "Very high confidence" and got.qc == "clean" and got.n_damage_100 == 1


def test_damage_in_the_blank_wins(spark):
    assert classify(spark, {"A": 0, "BLK": 100}, [row("BLK")]).state == "Blank-associated"


def test_multimapping_does_not_override_the_blank(spark):
    got = classify(spark, {"A": 6, "BLK": 77}, [row("A", reads=28012.0, alignments=1140245.0)])
    assert got.qc == "strong caution" and got.state == "Blank-associated"


def test_weaker_states(spark):
    assert classify(spark, {"A": 6, "BLK": 0}, []).state == "Tentative"
    assert classify(spark, {"A": 2, "BLK": 0}, []).state == "Weak support"
    assert classify(spark, {"A": 60, "B": 3, "BLK": 0}, []).state == "Supported"


def test_tiers_fall_back_only_without_better(spark):
    c = spark.createDataFrame([("t", "1", "Bison", "genus", "A", 5.0), ("u", "7", "Bison", "genus", "A", 5.0), ("v", "8", "Bison", "family", "A", 5.0)], COUNTS)
    got = {r.taxon: r.tier for r in D.matched(c, spark.createDataFrame([row("A")], ROWS)).collect()}
    assert got == {"t": 1, "u": 2, "v": 3}


@pytest.mark.parametrize(("focal", "other", "ok"), [
    (("Bovidae", "family", "Bovidae"), ("Bison", "genus", "Bovidae;Bison"), False),
    (("Bison", "genus", "Bovidae;Bison"), ("Bison bison", "species", "Bovidae;Bison;Bison bison"), False),
    (("Bison", "genus", "Bovidae;Bison"), ("Bison", "genus", "Bovidae;Bison"), False),
    (("Mammalia", "class", "Mammalia"), ("Bison", "genus", "Mammalia;Bison"), False),
    (("Bison", "genus", "Bovidae;Bison"), ("Equus", "genus", "Equidae;Equus"), False),
    (("Bison", "genus", "Bovidae;Bison"), ("subBison", "subgenus", "Bovidae;Bison;subBison"), True),
])
def test_lineage_rule(spark, focal, other, ok):
    f = spark.createDataFrame([("t", "A", *focal)], "taxon string, library string, name string, rank string, path string")
    o = spark.createDataFrame([("A", *other, 0.5, 9.0)], "sample string, tax_name string, tax_rank string, tax_path string, damage double, significance double")
    steps = abs(D.RANKS.index(focal[1]) - D.RANKS.index(other[1]))
    assert (D.lineage_support(f, o).count() == 1) is (ok and steps <= DAMAGE["lineage_max_steps"])


def test_lineage_reads_both_path_forms(spark):
    p = spark.createDataFrame([("a;b ; ;c",), ('1:Bos taurus:"species"\t2:Bos:"genus"',)], "p string")
    assert [r[0] for r in p.select(D.lineage_names(F.col("p"))).collect()] == [["a", "b", "c"], ["Bos taurus", "Bos"]]
    got = p.select(R.display_group(F.col("p"), F.lit("animals")).alias("g")).collect()
    assert [r.g.name for r in got] == ["animals", "Bos taurus"]


def test_report_pieces(spark):
    rows = spark.createDataFrame([("t", "u", "g", "L1", 5.0, 0.1, "Count-only"), ("t", "u", "g", "L2", 3.0, None, "Damage-supported"), ("t", "u", "g", "L3", 0.0, 0.9, "Not detected")], "taxon string, unit string, `group` string, library string, count double, damage double, label string")
    got = R.collapsed(rows).first()
    assert (got["count"], got.label, got.damage, got.n_libraries, got.libraries) == (8.0, "Damage-supported", 0.1, 3, "L1; L2")
    b = spark.createDataFrame([(0.0,), (1.0,), (5.0,), (12000.0,)], "v double").select(R.binned(F.col("v"), R.COUNT_BINS)).collect()
    assert [r[0] for r in b] == ["0", "1-4", "5-9", ">=10000"]
    s = spark.createDataFrame([("PROJ_S01c-Beta", False), ("Undetermined_S0", False)], "s string, n boolean")
    assert [r[0] for r in s.select(R.plot_sample(F.col("s"), F.lit(""), F.lit(""), F.lit(""), F.lit(""), F.col("n"))).collect()] == ["PROJ-S01", "Undetermined"]


def test_linker(spark):
    cols = spark.createDataFrame([("AiL-SITE-04-c-Shg_S1_PE.mapped.x", 0), ("AiL-SITE-9-p-Beta-Shg_S2_PE.mapped", 1), ("Undetermined_S0", 2), ("X_S3", 3), ("AiL-BLK-1-Shg_S4", 4)], "column string, ordinal long")
    meta = spark.createDataFrame([("AiL-SITE-04-c-Shg", "SITE-04c", "sediment", "SITE", "", 1), ("AiL-SITE-9-p-Shg", "SITE-9p", "bone", "SITE", "", 2), ("AiL-BLK-1-Shg", "BLK-1", "extraction blank", "", "", 3)], "stem_key string, sample_id string, sample_type string, site string, context string, extra int")
    known = spark.createDataFrame([("SITE-4",), ("SITE-9",)], "sample string")
    got = {r.ordinal: r for r in L.linked(cols, meta, known).collect()}
    assert (got[0].damage_name, got[0].derivation, got[0].group, got[0].extra) == ("SITE-4", "stripped-suffix-and-leading-zeros", "SITE_sediments", 1)
    assert (got[1].damage_name, got[1].sample_type) == ("SITE-9", "bone")
    assert (got[2].damage_name, got[2].group) == ("NO_HOLI_DATA", "undetermined")
    assert (got[3].sample_id, got[3].damage_name) == ("UNKNOWN", "REVIEW_NEEDED:UNKNOWN")
    assert (got[4].damage_name, got[4].is_negative_control, got[4].group) == ("blanks", True, "negative_controls")
    assert {(r.issue, r.n) for r in L.issues(L.linked(cols, meta, known)).where("issue <> 'control_type'").collect()} == {("no_metadata", 1), ("no_damage_sample", 1)}
