import random

import pytest
from pyspark.sql import functions as F

from moraine.operators import coverage as V
from moraine.operators import redundancy as D
from moraine.operators import tiles as T

RNG = random.Random(11)


def dna(n):
    return "".join(RNG.choice("ACGT") for _ in range(n))


def refs(spark, lengths):
    return spark.createDataFrame([(f"r{n}", dna(n)) for n in lengths], "ref_id string, seq string").withColumn("length", F.length("seq")).persist()


@pytest.mark.parametrize("n", [1, 69, 70, 71, 79, 80, 81, 137, 200, 333])
def test_linear_tiles_cover_everything(spark, n):
    r = refs(spark, [n])
    got = sorted(T.tile(r).collect(), key=lambda x: x.ref_start)
    if n <= 70:
        assert not got
    elif n < 80:
        assert len(got) == 1 and got[0].ref_end == n and got[0].seq.endswith("T" * (80 - n)) and len(got[0].seq) == 80
    else:
        text = r.first().seq
        assert got[-1].ref_end == n and all(x.seq == text[x.ref_start - 1 : x.ref_end] for x in got)
        assert all(b.ref_start - a.ref_start <= 27 for a, b in zip(got, got[1:]))


def test_known_starts(spark):
    assert sorted(x.ref_start - 1 for x in T.tile(refs(spark, [137])).collect()) == [0, 27, 54, 57]
    ring = T.tile(refs(spark, [200]), circular=True).collect()
    assert sorted(x.ref_start - 1 for x in ring) == list(range(0, 190, 27)) and all(len(x.seq) == 80 for x in ring)
    assert [T.step_of(80, d) for d in (3.0, 2.0, 1.0)] == [27, 40, 80]


def test_density_choice_matches_tiling(spark):
    r = refs(spark, [75, 100, 300, 500])
    for d in (0.7, 1.0, 2.3, 4.0):
        want = T.tile(r, density=d).count()
        assert T.chosen_density(r, 0, 0.5, d)[1] == want and T.estimated(r, [d]).first().n == want
    d, n = T.chosen_density(r, 20, 0.5, 8.0)
    assert n <= 20 and T.tile(r, density=d).count() == n


def test_coverage_against_arrays(spark):
    import numpy as np

    lengths = {"a": 50, "b": 30, "c": 7}
    iv = [(t, s := RNG.randint(1, n), s + RNG.randint(0, n - 1)) for t, n in lengths.items() if t != "c" for _ in range(12)]
    depth = {t: np.zeros(n, int) for t, n in lengths.items()}
    for t, s, e in iv:
        for p in range(s - 1, e):
            depth[t][p % lengths[t]] += 1
    targets = spark.createDataFrame(list(lengths.items()), "ref_id string, length int")
    segs = V.segments(spark.createDataFrame(iv, "ref_id string, ref_start int, ref_end int"), targets)
    got = {t: np.zeros(n, int) - 1 for t, n in lengths.items()}
    for r in segs.collect():
        got[r.ref_id][r["from"] : r.to] = r.depth
    assert all((got[t] == depth[t]).all() for t in lengths)
    for r in V.target_stats(segs).collect():
        d = depth[r.ref_id]
        assert (r.mean_depth, r.std_dev, r.proportion_covered) == pytest.approx((d.mean(), d.std(), (d > 0).mean()))


def test_greedy_cover_ends_the_deficit(spark):
    targets = spark.createDataFrame([("a", 200, dna(200)), ("b", 60, dna(60))], "ref_id string, length int, seq string")
    none = spark.createDataFrame([], "ref_id string, ref_start int, ref_end int, seq string")
    panel = V.augment(targets, none, 2, rounds=4)
    stats = {r.ref_id: r.min_depth for r in V.target_stats(V.segments(panel, targets)).collect()}
    assert stats["a"] >= 1


def test_complements_like_the_sequential_rule(spark):
    comp = str.maketrans("ACGT", "TGCA")
    seqs = [dna(3) for _ in range(200)]
    kept, seen = [], set()
    for i, s in enumerate(seqs):
        if s.translate(comp)[::-1] not in seen:
            kept.append(i)
            seen.add(s)
    df = spark.createDataFrame(list(enumerate(seqs)), "bait_id int, seq string")
    assert sorted(r.bait_id for r in D.without_complements(df).collect()) == kept


def test_representatives_and_seed_hits(spark):
    pairs = [(1, 2), (2, 3), (4, 5)]
    both = spark.createDataFrame(pairs + [(b, a) for a, b in pairs], "a int, b int")
    assert sorted(r.id for r in D.greedy_representatives(both).collect()) == [1, 3, 4]
    s = dna(80)
    p = spark.createDataFrame([("x", s), ("y", "A" * 5 + s[:75]), ("z", s.translate(str.maketrans("ACGT", "TGCA"))[::-1]), ("w", dna(80))], "bait_id string, seq string")
    got = {(r.qseqid, r.sseqid, r.sstrand): r.nident for r in D.seed_hits(p, p, 12).collect()}
    assert got[("x", "y", "plus")] >= 75 and got[("x", "z", "minus")] == 80 and not any("w" in k[:2] for k in got)


def test_probe_ids_and_oligos(spark):
    ids = ["r|b1|pos3-82", "r_pos3-82", "r_2", "plain"]
    df = spark.createDataFrame([(i,) for i in ids], "p string").select(T.probe_place(F.col("p"), F.lit(80)).alias("x"))
    assert [(r.x.ref_hint, r.x.start, r.x.end, r.x.trusted) for r in df.collect()] == [("r", 3, 82, True), ("r", 3, 82, True), ("r", 3, 82, False), (None, None, None, False)]
    out = T.oligos(spark.createDataFrame([("acgt",)], "seq string"), "AAGCTCTTCG").first().oligo
    assert out == "GCTAATACGACTCACTATAGGG" + "ACGT" + "CGAAGAGCTT"
    with pytest.raises(ValueError):
        T.oligos(spark.createDataFrame([("acgt",)], "seq string"), "AAAA")


def test_windows_are_taken_as_by_a_scan_of_the_whole_target():
    import numpy as np

    from moraine.operators.coverage import windows_taken

    def scan(lack, k):
        out = []
        while len(lack) >= k:
            score = np.convolve(lack, np.ones(k, np.int64), "valid")
            at = int(np.argmax(score))
            if score[at] <= 0:
                break
            out.append(at)
            lack[at : at + k] = np.maximum(0, lack[at : at + k] - 1)
        return out

    rng = np.random.default_rng(3)
    for n, k in ((0, 5), (4, 5), (5, 5), (300, 7), (4175, 80), (4176, 80), (9000, 80)):
        lack = rng.integers(0, 4, n) * (rng.random(n) < 0.3)
        assert windows_taken(lack.copy(), k) == scan(lack.copy(), k), (n, k)
