import gzip
import json

import pytest
from pyspark.sql import functions as F

from moraine.sources import fasta, pages, sinks, tables
from moraine.streaming import ingest


def test_fasta_round_trip(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">A one\nACGT\nac gt\n\n>B\nNNNN\n>A again\r\nTT\r\n")
    with gzip.open(tmp_path / "b.fa.gz", "wt") as f:
        f.write(">B other\nGG\n")
    df = fasta.records(spark, [str(tmp_path / "a.fa"), str(tmp_path / "b.fa.gz")])
    got = [(r.record_key, r.header, r.seq) for r in df.orderBy("ordinal").collect()]
    assert got == [("A", ">A one", "ACGTACGT"), ("B", ">B", "NNNN"), ("A__dup2", ">A again", "TT"), ("B__dup2", ">B other", "GG")]
    sinks.write_fasta(spark.createDataFrame([(">x y", "acgt" * 41)], "header string, seq string"), str(tmp_path / "out"))
    lines = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*")).split("\n")
    assert lines[0] == ">x y" and [len(x) for x in lines[1:4]] == [80, 80, 4]
    assert fasta.as_map(df).where("accession = 'A'").first().seq == "TT"
    with pytest.raises(Exception, match="duplicate sequence id"):
        fasta.distinct_ids(df).collect()


def test_tables_and_rules(spark, tmp_path):
    (tmp_path / "t.csv").write_text("Taxon ID;Name\n 1 ; Bison \n")
    df = tables.aliased(tables.read_table(spark, str(tmp_path / "t.csv")), {"tax_id": ["taxon_id", "Taxon ID"], "name": ["Name"]}, ("tax_id",))
    assert (df.first().tax_id, df.first().name) == ("1", "Bison")
    with pytest.raises(ValueError, match="no column for"):
        tables.aliased(df, {"rank": ["rank"]}, ("rank",))
    (tmp_path / "ad.tsv").write_text("name\tsequence\tmax_mismatch\taction\n# note\nx\tac gt\t2\treject\ny\t\t0\treject\n")
    assert tables.adapters(spark, str(tmp_path / "ad.tsv")) == [("x", "ACGT", 2)]
    (tmp_path / "k.tsv").write_text("Bison bison\tAnimalia\tChordata\nSalix alba\tSalix\tPlantae\n")
    assert sorted((r.species, r.genus, r.kingdom) for r in tables.species_kingdom(spark, str(tmp_path / "k.tsv")).collect()) == [("Bison bison", "Bison", "Animalia"), ("Salix alba", "Salix", "Plantae")]
    (tmp_path / "h.tsv").write_text("q\ts\t99.5\t70\t80\t1\t70\t0\t50\t9606;1\tHomo sapiens\nbad\ts\tx\t70\t80\t1\t70\t0\t50\t1\tz\nshort\ts\n")
    assert [r.qseqid for r in tables.hits(spark, str(tmp_path / "h.tsv")).collect()] == ["q"]
    (tmp_path / "nodes").write_text("1\t|\t1\t|\tno rank\t|\n9\t|\t1\t|\tgenus\t|\nx\t|\t1\t|\ty\t|\n")
    (tmp_path / "names").write_text("9\t|\tBison\t|\t\t|\tscientific name\t|\n9\t|\tbuffalo\t|\t\t|\tcommon name\t|\n")
    assert {(r.taxid, r.name) for r in tables.taxdump(spark, str(tmp_path / "nodes"), str(tmp_path / "names")).collect()} == {(1, None), (9, "Bison")}
    assert tables.sniff("a\tb,c\td") == "\t" and tables.kind_of_export("localities.csv", ["Locality"]) == "localities"


def test_pages_land_once_and_read_in_parallel(spark, tmp_path):
    calls = []

    def fetch(offset, size):
        calls.append(offset)
        if len(calls) == 1:
            raise OSError("try again")
        return [{"id": i, "name": f"n{i}"} for i in range(offset, min(offset + size, 25))]

    assert pages.land(fetch, str(tmp_path), 10, pause=0) == 25 and pages.land(fetch, str(tmp_path), 10) == 25 and len(calls) == 4
    spark.dataSource.register(pages.PageSource)
    df = spark.read.format("moraine_pages").option("dir", str(tmp_path)).option("fields", "id,name").load()
    assert df.count() == 25 and df.rdd.getNumPartitions() == 3
    assert pages.cache_name("e", {"a": 1, "b": ""}) == pages.cache_name("e", {"a": 1})


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("A", ">A", "ACGT", "KEEP", ["x", "y"], "A", 0), ("B", ">B", "GG", "REJECT", [], "B", 1)], "accession string, header string, seq string, decision string, reasons array<string>, record_key string, ordinal long")
    sinks.write_decisions(df, str(tmp_path), keep_reject=False)
    assert spark.read.csv(str(tmp_path / "decisions"), sep="\t", header=True).where("accession = 'A'").first().reasons == "x;y"
    assert [p.name for p in (tmp_path / "fasta").glob("decision=*")] == ["decision=KEEP"]
    sinks.snapshot(spark, str(tmp_path / "snap"), {"a": {"b": (1, 2)}})
    assert json.loads(spark.read.text(str(tmp_path / "snap")).first()[0])["config"] == {"a": {"b": [1, 2]}}
    assert "<td>A</td>" in sinks.html_report("t", {"d": df.select("accession")})


def test_only_new_input_is_processed(spark, tmp_path):
    src, out, chk = (str(tmp_path / n) for n in ("src", "out", "chk"))
    schema = "k int, t timestamp, v int"
    spark.sql("select 1 as k, timestamp'2024-01-01 00:00:00' as t, 1 as v union all select 1, timestamp'2024-01-01 00:00:05', 2").write.parquet(src)
    run = lambda: ingest.run_available(ingest.first_seen(ingest.stream(spark, src, schema), ["k"], "t"), out, chk)
    run()
    assert spark.read.parquet(out).count() == 1
    spark.sql("select 1 as k, timestamp'2024-01-01 00:00:09' as t, 3 as v union all select 2, timestamp'2024-01-01 00:00:05', 4").write.mode("append").parquet(src)
    run()
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == [1, 2]
    w = ingest.windowed(ingest.stream(spark, src, schema), "t", "1 minute", "0 seconds", ["k"], n=F.count("*"))
    ingest.run_available(w, str(tmp_path / "w"), str(tmp_path / "wc"))
    assert "window_start" in spark.read.parquet(str(tmp_path / "w")).columns
    assert ingest.remaining(spark.range(4), spark.range(2), "id").count() == 2
