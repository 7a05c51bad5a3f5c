import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moraine.functions import sequence as S


def rows(spark, seqs):
    return spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "i int, s string")


def values(spark, seqs, column):
    return [r[0] for r in rows(spark, seqs).orderBy("i").select(column).collect()]


def test_metrics_by_hand(spark):
    s = F.col("s")
    assert values(spark, ["AACGTN", "NNNN", "", "GGCC"], S.entropy(s)) == pytest.approx([1.9219280948873623, 0.0, 0.0, 1.0])
    assert values(spark, ["AACGTN", "NNNN", "", "GGCC"], S.gc_of_bases(s)) == pytest.approx([0.4, 0, 0, 1])
    assert values(spark, ["AACGTN", ""], S.gc_of_length(s)) == pytest.approx([2 / 6, 0])
    assert values(spark, ["AANN", ""], S.n_fraction(s)) == [0.5, 1.0]
    assert values(spark, ["AAX!", ""], S.non_iupac_fraction(s)) == [0.5, 1.0]
    assert values(spark, ["acGT", ""], S.masked_fraction(s)) == [0.5, 0.0]
    assert values(spark, ["ACGTRYN", "acgt"], S.ambiguous_count(s)) == [3, 0]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ACGTN", max_size=60), min_size=1, max_size=20))
def test_runs_complements_and_kmers(spark, seqs):
    longest = lambda t: max((len(m) for m in __import__("itertools").chain([""], ["".join(g) for _, g in __import__("itertools").groupby(t)])), default=0)
    assert values(spark, seqs, S.longest_run(F.col("s"))) == [longest(t) for t in seqs]
    comp = str.maketrans("ACGTN", "TGCAN")
    assert values(spark, seqs, S.reverse_complement(F.col("s"))) == [t.translate(comp)[::-1] for t in seqs]
    assert values(spark, seqs, S.kmers(F.col("s"), 4)) == [[t[i : i + 4] for i in range(len(t) - 3) if "N" not in t[i : i + 4]] for t in seqs]


def test_preprocess_reads_n_and_u_as_t(spark):
    assert values(spark, ["acuNN"], S.preprocessed(F.col("s"))) == ["ACTTT"]
    assert values(spark, ["acuNN"], S.modified_bases(F.col("s"))) == [3]


def test_melting_point_ranges(spark):
    tm = S.melting_point(F.col("s"))
    mixed, rich, poor, empty, bad = values(spark, ["ACGT" * 20, "GC" * 40, "AT" * 40, "", "N" * 80], tm)
    assert 40 < mixed < 100 and rich > mixed > poor and empty is None and bad is None
    assert values(spark, ["acgt" * 20], tm) == pytest.approx([mixed])


def test_softmask_against_brute_force(spark):
    from moraine.operators.tiles import softmasked

    rng = random.Random(5)
    seqs = ["".join(rng.choice("ACGTN") for _ in range(rng.randint(0, 60))) for _ in range(12)] + ["ACACACACACAC"]
    k, least, seen = 4, 3, {}
    for t in seqs:
        for i in range(len(t) - k + 1):
            if "N" not in t[i : i + k]:
                seen[t[i : i + k]] = seen.get(t[i : i + k], 0) + 1
    expected = []
    for t in seqs:
        low = {j for i in range(len(t) - k + 1) if seen.get(t[i : i + k], 0) >= least for j in range(i, i + k)}
        expected.append("".join(c.lower() if j in low else c for j, c in enumerate(t)))
    got = softmasked(rows(spark, seqs), k, least, "i", "s").orderBy("i").collect()
    assert [r.s for r in got] == expected
    assert math.isfinite(len(got))


def test_dna_melting_point(spark):
    seqs = ["GCTAATACGACTCACTATAGGG", "AGTC", "ACGT", "acgtta", "", "A", "ACNT"]
    pairs = S.dna_pairs()
    assert len(pairs) == 16

    def plain(t):
        t = t.upper()
        if len(t) < 2 or set(t) - set("ACGT"):
            return None
        own = t == t.translate(str.maketrans("ACGT", "TGCA"))[::-1]
        ends = [S.END_AT if c in "AT" else S.END_GC for c in (t[0], t[-1])]
        h, e = (sum(pairs[t[i : i + 2]][x] for i in range(len(t) - 1)) + sum(v[x] for v in ends) for x in (0, 1))
        e += S.SYMMETRY if own else 0
        e += 0.368 * (len(t) - 1) * math.log((50 + 120 * 0.9**0.5) / 1000)
        return 1000 * h / (e + 1.987 * math.log(50e-9 / (1 if own else 4))) - 273.15

    got = values(spark, seqs, S.dna_melting_point(F.col("s")))
    assert got == [None if plain(t) is None else pytest.approx(plain(t)) for t in seqs]
    assert 50 < got[0] < 65
