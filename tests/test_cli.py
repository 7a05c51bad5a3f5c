import random

from moraine import cli


def test_flows_on_small_files(spark, tmp_path):
    rng = random.Random(2)
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    fa, out = tmp_path / "r.fa", lambda n: str(tmp_path / n)
    fa.write_text("".join(f">R{i} Bison bison mitochondrion\n{dna(300)}\n" for i in range(4)) + ">R0 Bison bison\n" + dna(300) + "\n")
    (tmp_path / "ad.tsv").write_text("name\tsequence\tmax_mismatch\taction\nx\t" + dna(24) + "\t2\treject\n")
    (tmp_path / "k.tsv").write_text("keyword\taction\treason\nUNVERIFIED\treview\tx\n")
    cli.main(["curate", str(fa), "--out", out("c"), "--adapters", str(tmp_path / "ad.tsv"), "--keywords", str(tmp_path / "k.tsv"), "--cap", "--trim"])
    got = {r.record_key: r.decision for r in spark.read.csv(out("c/decisions"), sep="\t", header=True).collect()}
    assert got["R1"] == "KEEP" and got["R0__dup2"] == "REJECT"
    cli.main(["explain", "R1", "--out", out("c")])
    one = tmp_path / "p.fa"
    one.write_text(f">a\n{dna(400)}\n>b\n{dna(200)}\n")
    cli.main(["panel", str(one), "--out", out("p"), "--mask", "--circular", "b", "--min-tm", "0"])
    assert {r.ref_id for r in spark.read.csv(out("p/targets"), sep="\t", header=True).collect()} == {"a", "b"}
    (tmp_path / "counts.tsv").write_text("#Datasets\tName\trank\tA\tB\tBLK\n1\tBison\tgenus\t100\t20\t0\n")
    (tmp_path / "dmg.csv").write_text('sample,tax_id,tax_name,tax_rank,N_reads,N_alignments,damage,significance,rho_Ac,MAP_valid,tax_path\nA,1,Bison,genus,150,300,0.1,3,0.1,True,"Bovidae;Bison"\n')
    (tmp_path / "link.csv").write_text("library,negative,environmental\nA,false,false\nB,false,false\nBLK,true,false\n")
    cli.main(["damage", str(tmp_path / "counts.tsv"), str(tmp_path / "dmg.csv"), str(tmp_path / "link.csv"), "--out", out("d")])
    assert spark.read.csv(out("d/taxa"), sep="\t", header=True).first().state == "Very high confidence"
    (tmp_path / "m1.csv").write_text("species,source,kingdom\nBison bison,now,\n")
    (tmp_path / "m2.csv").write_text("scientificName,source,kingdom\nBison bison alba,pbdb,Animalia\n")
    cli.main(["merge", str(tmp_path / "m1.csv"), str(tmp_path / "m2.csv"), "--priority", "pbdb,now", "--out", out("m")])
    assert spark.read.csv(out("m/taxa"), header=True).first().preferred_source == "pbdb"
    cli.main(["report", out("c/decisions"), "--out", out("r")])
    assert {(r.section, r.key) for r in spark.read.csv(out("r/summary"), sep="\t", header=True).collect()} == {(r.section, r.key) for r in spark.read.csv(out("c/summary"), sep="\t", header=True).collect()}
    cli.main(["check", str(tmp_path / "counts.tsv"), str(tmp_path / "dmg.csv"), str(tmp_path / "link.csv"), "--out", out("k")])
    assert {(r.section, r.key): r.value for r in spark.read.csv(out("k/inputs"), sep="\t", header=True).collect()}["counts", "libraries"] == "3"
    assert spark.read.csv(out("k/warnings"), sep="\t", header=True).first().kind == "none"
    p = dna(80)
    (tmp_path / "pr.fa").write_text(f">T|b1|pos1-80\n{p}\n>odd\n{dna(80)}\n>far\n{dna(80)}\n")
    (tmp_path / "tg.fa").write_text(f">T\n{p + dna(220)}\n>U\n{dna(100)}\n")
    (tmp_path / "hits.tsv").write_text("probe\ttarget\tsstart\tsend\tstrand\tidentities\tlength\tbits\tmatch\tsubject\n" + f"odd\tU\t11\t70\tplus\t60\t60\t99\t{'|' * 60}\t{'A' * 60}\nfar\tU\t1\t9\tplus\t9\t9\t9\t|||\tAAA\n")
    cli.main(["audit", str(tmp_path / "pr.fa"), str(tmp_path / "tg.fa"), str(tmp_path / "hits.tsv"), "--out", out("a")])
    assert {r.probe: (r.ref_id, r.ref_start, r.ref_end, r.source) for r in spark.read.csv(out("a/placements"), sep="\t", header=True).collect()} == {"T|b1|pos1-80": ("T", "1", "80", "id"), "odd": ("U", "11", "70", "hit")}
    (tmp_path / "near.tsv").write_text("qseqid\tsseqid\tnident\tlength\nodd\tfar\t78\t80\n")
    cli.main(["cluster", str(tmp_path / "pr.fa"), str(tmp_path / "near.tsv"), "--out", out("cl")])
    assert spark.read.text(out("cl/probes")).where("value like '>%'").count() == 2
    (tmp_path / "meta.tsv").write_text("library\tsample\ttype\tsite\tcontext\nA\tS-1\tsediment\tS\t\nBLK\tS-9\textraction blank\tS\t\n")
    cli.main(["linker", str(tmp_path / "counts.tsv"), "--metadata", str(tmp_path / "meta.tsv"), "--damage", str(tmp_path / "dmg.csv"), "--out", out("l")])
    assert {r.column: r.control_type for r in spark.read.csv(out("l/linker"), sep="\t", header=True).collect()} == {"A": "not_control", "B": "not_control", "BLK": "negative_control"}
