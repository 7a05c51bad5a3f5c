import json

import pytest
from pyspark.sql import functions as F

from moraine.functions import names as N
from moraine.functions import presets as P
from moraine.operators import occurrences as O
from moraine.sources import tables


def cleaned(spark, names, cleaner):
    df = spark.createDataFrame(list(enumerate(names)), "i int, n string").orderBy("i")
    return [r[0] for r in df.select(cleaner(F.col("n")).alias("c")).collect()]


def test_collection_cleaner(spark):
    names = ["Bison bison", "Mammuthus cf. primigenius", "Ambrosia-type", "Canis sp.", "Bovidae", "A/B", "", "unknown", "bison priscus antiquus"]
    got = cleaned(spark, names, N.collection_name)
    assert [g.search_name for g in got] == ["Bison bison", "Mammuthus primigenius", "Ambrosia", "Canis", None, None, None, None, "Bison priscus"]
    assert got[4].reason == "higher taxon excluded" and got[6].reason == "empty taxon name"
    assert cleaned(spark, ["bison priscus antiquus"], lambda c: N.collection_name(c, "trinomial"))[0].rank == "subspecies"
    assert cleaned(spark, ["Canis sp."], lambda c: N.collection_name(c, genus_only=False))[0].reason == "genus-only taxon excluded"
    assert cleaned(spark, ["Ostrya/Carpinus", "Bison bison/latifrons", "Bison"], N.slash_names) == [["Ostrya", "Carpinus"], ["Bison bison", "Bison latifrons"], ["Bison"]]


def test_published_and_facet_cleaners(spark):
    got = cleaned(spark, ["†Smilodon fatalis", "Equus_caballus L.", "Canis", "Felidae", "lower case", None], N.published_name)
    assert [g.search_name for g in got] == ["Smilodon fatalis", "Equus caballus", "Canis", None, None, None]
    assert [g.status for g in got][:3] == ["cleaned;normalized", "cleaned;normalized", "single_name"]
    assert cleaned(spark, ["Canis lupus (L.)", "canis  LUPUS sensu lato", "(x)", "Ursus"], N.facet_name) == ["Canis lupus", "Canis lupus", None, "Ursus"]
    assert cleaned(spark, ["Canis lupus familiaris", "", None], lambda c: N.canonical_key(c, "trinomial")) == ["Canis lupus familiaris", "", ""]


def test_nested_records_to_taxa(spark, tmp_path):
    occ = lambda i, t, name, site, young, old: {"occid": i, "sample": {"taxonid": t, "taxonname": name}, "site": {"siteid": site, "datasetid": i, "database": "d", "datasettype": "vertebrate fauna"}, "age": {"ageyounger": young, "ageolder": old}}
    rows = [occ(1, 1, "Bison bison", 1, 11000, 15000), occ(2, 1, "Bison cf. bison", 2, 12000, 18000), occ(3, 2, "Mammuthus primigenius", 1, None, 20000), occ(3, 2, "Mammuthus primigenius", 1, None, 20000), occ(4, 3, "Bovidae", 1, 1, 2)]
    path = tmp_path / "a.json"
    path.write_text(json.dumps({"data": rows}))
    flat = tables.collection_records(tables.landed_json(spark, str(path)))
    g = flat.withColumn("g", P.group_of(F.lit(""), F.col("dataset_type"), F.col("name"))).select("*", "g.kingdom", "g.phylum").drop("g")
    kept, gone = O.named(g, N.collection_name(F.col("name")))
    got = {r.search_name: r for r in O.collection_taxa(kept).collect()}
    assert set(got) == {"Bison bison", "Mammuthus primigenius"} and gone.count() == 1
    b = got["Bison bison"]
    assert (b.n_occurrences, b.n_sites, b.age_young, b.age_old, b.kingdom, b.names) == (2, 2, 11000, 18000, "Animalia", "Bison bison; Bison cf. bison")
    assert O.collection_taxa(kept, min_sites=2).count() == 1


def test_merge_prefers_by_priority_and_keeps_order(spark):
    rows = [("Bison bison", "NOW", "", "", "", "a", "", "", 0), ("Bison bison alba", "PBDB", "Animalia", "", "p1", "b", "r", "", 1), ("Canis", "PBDB", "", "", "", "b", "", "", 2)]
    df = spark.createDataFrame(rows, "name string, source string, kingdom string, phylum string, taxon_key string, file string, region string, period string, ordinal long")
    got = {r.species: r for r in O.merged(df, ["pbdb", "now"]).collect()}
    b = got["Bison bison"]
    assert (b.preferred_source, b.taxon_key, b.sources, b.files, b.kingdom, b.status) == ("PBDB", "p1", "NOW;PBDB", "a;b", "Animalia", "merged_duplicate_sources")
    assert (got["Canis"].rank, got["Canis"].status) == ("genus_or_higher", "merged_from_PBDB")


def test_presets(spark):
    df = spark.createDataFrame([(50.0, 175.0), (50.0, -175.0), (50.0, 0.0), (None, None)], "lat double, lon double")
    inside = lambda box, **k: [r[0] for r in df.select(P.inside(F.col("lat"), F.col("lon"), box, **k)).collect()]
    assert inside((170.0, 0.0, -170.0, 90.0)) == [True, True, False, True]
    assert inside((-10.0, 0.0, 10.0, 90.0), require=True) == [False, False, True, False]
    assert P.period("late-pleistocene", unit="ma") == pytest.approx((0.0117, 0.129)) and P.region("United States") == P.region("usa")
    with pytest.raises(ValueError):
        P.period(young=5, old=1)
    assert P.wkt((0, 0, 1, 1)).startswith("POLYGON((") and P.wkt((170, 0, -170, 10)).startswith("MULTIPOLYGON(")
    ages = spark.createDataFrame([(1.0, 2.0), (5.0, 9.0), (None, None)], "y double, o double")
    assert [r[0] for r in ages.select(P.overlaps(F.col("y"), F.col("o"), (2.0, 4.0))).collect()] == [True, False, True]


def test_species_localities_link_wins(spark):
    sp = spark.createDataFrame([("s1", "Bison", "sp")], "sid string, species string, note string")
    loc = spark.createDataFrame([("l1", "Cave", "loc")], "lid string, locality string, note string")
    link = spark.createDataFrame([("s1", "l1", "link"), ("s1", "l9", None)], "sid string, lid string, note string")
    got = sorted((r.lid, r.species, r.locality, r.note) for r in O.species_localities(sp, loc, link, "sid", "lid").collect())
    assert got == [("l1", "Bison", "Cave", "link"), ("l9", "Bison", None, "sp")]
