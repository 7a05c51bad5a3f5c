import io
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from moraine import config
from moraine.functions import presets as P
from moraine.operators import redundancy as D
from moraine.operators import tiles as T
from moraine.operators import taxonomy
from moraine.operators import validate as V
from moraine.scratch import components
from moraine.sources import tables


def test_hit_choice_and_bits(spark):
    hits = spark.createDataFrame([("p", "a", 5, 70, 80, 90.0), ("p", "b", 9, 60, 80, 90.0), ("p", "b", 30, 80, 80, 90.0), ("q", "a", 1, 10, 80, 1.0), ("q", "a", 1, 10, 80, 2.0)], "probe string, target string, subject_start long, identities int, align_length int, bits double")
    meta = spark.createDataFrame([("p", "b", 8), ("q", None, None)], "probe string, target_id string, start long")
    got = {r.probe: (r.target, r.subject_start, r.bits) for r in V.primary_hits(hits, meta).collect()}
    assert got == {"p": ("b", 9, 90.0), "q": ("a", 1, 2.0)}
    assert {r.probe: r.target for r in V.primary_hits(hits).collect()} == {"p": "b", "q": "a"}
    one = spark.range(1).select(V.match_bits(F.lit("|| |"), F.lit("AC-G")).alias("b"), V.subject_start(F.lit(7), F.lit(3), F.lit(False)).alias("s")).first()
    assert (one.b, one.s) == ("111", 3)


def test_names_of_targets(spark):
    targets = spark.createDataFrame([("NC_001.1 chr",), ("Bison-b",), ("bison_b2",)], "ref_id string")
    hints = spark.createDataFrame([("Bison-b",), ("BISON b",), ("bison_b2 x",), ("see NC_001",), ("none",), ("",), (None,)], "ref_hint string")
    got = {r.ref_hint: r.target_id for r in V.resolved(hints, targets).collect()}
    assert got == {"Bison-b": "Bison-b", "BISON b": "Bison-b", "bison_b2 x": None, "see NC_001": "NC_001.1 chr", "none": None, "": None, None: None}
    assert {r.target_id for r in V.resolved(hints, targets.limit(1)).collect()} == {targets.first().ref_id}


def test_regions_are_cut_until_no_hit_is_left(spark):
    refs = spark.createDataFrame([("a", "A" * 50 + "C" * 30 + "G" * 50), ("b", "T" * 40)], "ref_id string, seq string")
    cut = spark.createDataFrame([("a", 50, 70), ("a", 60, 80)], "ref_id string, a int, b int")
    assert {(r.ref_id, r.seq) for r in V.cut_regions(refs, cut, 40).collect()} == {("a_[0:50]", "A" * 50), ("a_[80:130]", "G" * 50), ("b", "T" * 40)}

    def search(now):
        c = F.instr("seq", "CCC")
        return now.where(c > 0).select(F.lit("q").alias("qseqid"), F.col("ref_id").alias("sseqid"), F.lit(30).alias("nident"), (c + 9).alias("sstart"), (c - 1).alias("send"))

    out = V.without_complementary_regions(refs, search, 20)
    assert out.where("seq like '%CCC%'").count() == 0 and out.where("ref_id = 'b'").count() == 1
    with pytest.raises(RuntimeError):
        V.without_complementary_regions(refs, lambda now: now.limit(1).select(F.lit("q").alias("qseqid"), F.lit("zz").alias("sseqid"), F.lit(30).alias("nident"), F.lit(1).alias("sstart"), F.lit(2).alias("send")), 20, rounds=2)


def test_greedy_rounds_are_the_sequential_pass(spark):
    rng = random.Random(5)
    near = {(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(90)} | {(100, i) for i in range(101, 160)} | {(i, i + 1) for i in range(200, 260)}
    both = {(a, b) for a, b in near if a != b} | {(b, a) for a, b in near if a != b}
    by = {}
    for a, b in both:
        by.setdefault(a, set()).add(b)
    gone = set()
    for x in sorted(by, key=lambda x: (len(by[x]), x), reverse=True):
        if x not in gone:
            gone |= by[x]
    df = spark.createDataFrame(sorted(both), "a int, b int")
    assert {r.id for r in D.greedy_representatives(df).collect()} == gone
    assert D.greedy_representatives(df.limit(0)).count() == 0
    assert {r.root for r in components(df).where("id > 200").collect()} == {200}


def test_clusters_and_complements(spark):
    probes = spark.createDataFrame([("a", "A" * 80), ("b", "A" * 70), ("c", "C" * 80), ("d", "G" * 80)], "bait_id string, seq string")
    hits = spark.createDataFrame([("a", "b", "plus", 69, 70), ("c", "d", "plus", 60, 80), ("c", "d", "minus", 40, 80)], "qseqid string, sseqid string, sstrand string, nident int, length int")
    assert sorted(r.bait_id for r in D.cluster_representatives(probes, hits.where("sstrand = 'plus'")).collect()) == ["a", "c", "d"]
    assert sorted(r.bait_id for r in D.without_similar(probes, hits, 30, (65, 60)).collect()) == ["b", "d"]
    assert sorted(r.bait_id for r in V.screened(probes, probes.where("bait_id = 'd'"), hits.withColumn("qlen", F.lit(70))).collect()) == ["b"]


def test_limits_of_a_panel(spark):
    df = spark.createDataFrame([("ACGT",), ("ACG",)], "seq string")
    with pytest.raises(ValueError):
        V.uniform_length(df)
    with pytest.raises(ValueError):
        V.within_total(df, 6)
    assert V.uniform_length(df.limit(1)) == 4 and V.within_total(df, 7) == 7


def test_tiles_of_long_references_take_linear_time(spark):
    import time

    def seconds(n):
        df = spark.createDataFrame([("r", "ACGT" * (n // 4))], "ref_id string, seq string")
        at = time.time()
        T.tile(df).agg(F.sum(F.xxhash64("seq").cast("decimal(38,0)"))).collect()
        return time.time() - at

    seconds(1000)
    assert seconds(1_600_000) < 6 * seconds(400_000) + 2


def test_long_lineages_are_an_error(spark):
    nodes = spark.createDataFrame([(i, max(0, i - 1)) for i in range(20)], "taxid long, parent long")
    assert taxonomy.closure(nodes).where("depth = 19").count() == 1
    with pytest.raises(RuntimeError):
        taxonomy.closure(nodes, max_depth=6)


def test_area_words():
    assert P.continents(["eurasia", "na", "europe", "moon"]) == ["EUROPE", "ASIA", "NORTH_AMERICA", "MOON"]
    got = P.requested("europe", ["de"], ["eu"], "fossil", (1900, 2000), True)
    assert [c["type"] for c in got] == ["and", "equals", "equals", "equals", "range", "equals"] and P.requested() == []
    square = [[0, 0], [1, 0], [1, 1]]
    assert P.geojson_wkt({"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [square]}}) == "POLYGON ((0.0 0.0, 1.0 0.0, 1.0 1.0, 0.0 0.0))"
    assert P.geojson_wkt({"type": "MultiPolygon", "coordinates": [[square], [square]]}).startswith("MULTIPOLYGON (((0.0")
    for bad in ({"type": "Point"}, {"type": "FeatureCollection", "features": []}, {"type": "Polygon", "coordinates": [[]]}):
        with pytest.raises(ValueError):
            P.geojson_wkt(bad)


def test_bounds_that_are_not_known(spark):
    df = spark.createDataFrame([(None, 5000.0), (200000.0, None), (5000.0, 6000.0), (None, None)], "y double, o double")
    ok = lambda **k: [r[0] for r in df.select(P.overlaps(F.col("y"), F.col("o"), (11700, 129000), **k)).collect()]
    assert ok() == [True, True, False, True] and ok(require=True) == [True, True, False, False]
    at = spark.createDataFrame([(None, 100.0), (50.0, None), (50.0, 100.0), (50.0, 10.0)], "lat double, lon double")
    assert [r[0] for r in at.select(P.inside(F.col("lat"), F.col("lon"), P.region("europe"))).collect()] == [True, True, False, True]


def test_settings_that_do_not_exist(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"qc": {"min_length": 7, "min_lenght": 7}, "caps": {"by_class": {"X": 1}}, "more": 1}))
    with pytest.raises(ValueError, match="more, qc.min_lenght"):
        config.load(config.CURATE, str(tmp_path / "c.json"))


def test_workbooks_and_zipped_exports(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    book = io.BytesIO()
    with zipfile.ZipFile(book, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="one"/></sheets></workbook>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>id</t></si><si><t>name</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row><c r="A2"><v>7</v></c><c r="C2" t="inlineStr"><is><t> elk </t></is></c></row></sheetData></worksheet>')
    (tmp_path / "b.xlsx").write_bytes(book.getvalue())
    assert [tuple(r) for r in tables.read_excel(spark, str(tmp_path / "b.xlsx"), "one").collect()] == [("7", "elk")]
    with zipfile.ZipFile(tmp_path / "e.zip", "w") as z:
        z.writestr("x/species.csv", "SpeciesID,Species\n1,Bison bison\n")
        z.writestr("x/localities.tsv", "Locality\tLatitude\nhill\t4\n")
    got = tables.read_export(spark, str(tmp_path / "e.zip"))
    assert got["species"].first().Species == "Bison bison" and got["localities"].first().Locality == "hill"
    (tmp_path / "f").mkdir()
    for name in ("b.csv", "a.tsv", "note.md"):
        (tmp_path / "f" / name).write_text("tax_id\tL1_S3_PE.mapped.x\tL2\n")
    paths = tables.expanded(spark, [str(tmp_path / "f"), str(tmp_path / "e.zip")])
    assert [p.rsplit("/", 1)[-1] for p in paths] == ["a.tsv", "b.csv", "e.zip"]
    assert sorted(r.stem for r in tables.matrix_columns(spark, paths[:2]).collect()) == ["L1_S3", "L2"]
    with pytest.raises(ValueError):
        tables.expanded(spark, [str(tmp_path / "none")])
