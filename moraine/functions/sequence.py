"""Column functions on nucleotide strings."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The IUPAC alphabet with complements, and the characters counted as ambiguous.
IUPAC, COMPLEMENT = "ACGTRYSWKMBDHVNacgtryswkmbdhvn", "TGCAYRSWMKVHDBNtgcayrswmkvhdbn"
AMBIGUOUS = "NRYWSMKHBVDnrywsmkhbvd"


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, IUPAC, COMPLEMENT))


def sequence_hash(seq: Column) -> Column:
    return F.sha2(F.upper(seq), 256)


def count_in(seq: Column, letters: str) -> Column:
    """How many characters of seq are among the letters."""
    return F.length(seq) - F.length(F.translate(seq, letters, ""))


def _share(part: Column, whole: Column, empty: float) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(empty))


def gc_of_bases(seq: Column) -> Column:
    """G and C among A, C, G, T; 0 without any."""
    return _share(count_in(seq, "GCgc"), count_in(seq, "ACGTacgt"), 0.0)


def gc_of_length(seq: Column) -> Column:
    return _share(count_in(seq, "GCgc"), F.length(seq), 0.0)


def entropy(seq: Column) -> Column:
    """Shannon entropy of A, C, G, T in bits; 0 without any."""
    total = count_in(seq, "ACGTacgt")
    parts = [count_in(seq, b + b.lower()) / total for b in "ACGT"]
    terms = [F.when(p > 0, -p * F.log2(p)).otherwise(F.lit(0.0)) for p in parts]
    return F.when(total > 0, terms[0] + terms[1] + terms[2] + terms[3]).otherwise(F.lit(0.0))


def longest_run(seq: Column) -> Column:
    """Length of the longest run of one character, N included."""
    runs = F.regexp_extract_all(seq, F.lit(r"((.)\2*+)"), F.lit(1))
    return F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0))


def n_fraction(seq: Column) -> Column:
    return _share(count_in(seq, "N"), F.length(seq), 1.0)


def non_iupac_fraction(seq: Column) -> Column:
    return _share(F.length(F.translate(seq, IUPAC[:15], "")), F.length(seq), 1.0)


def masked_fraction(seq: Column) -> Column:
    """Share of lower-case letters."""
    return _share(F.length(F.regexp_replace(seq, r"[^\p{Ll}]", "")), F.length(seq), 0.0)


def ambiguous_count(seq: Column) -> Column:
    return count_in(seq, AMBIGUOUS)


def preprocessed(seq: Column) -> Column:
    """Upper case, U and every N read as T."""
    return F.translate(F.upper(seq), "UN", "TT")


def modified_bases(seq: Column) -> Column:
    return count_in(F.upper(seq), "UN")


BLOCK = 512


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def by_blocks(seq: Column, k: int, make) -> Column:
    """One array of make(block, first, n) over blocks of the text: n window starts, block holding the text of their windows of
    k characters and first the 0-based place of the first start.

    Taking a substring costs its distance from the start of the text, so windows are cut from short blocks.
    """
    starts = F.sequence(F.lit(0), F.length(seq) - k, F.lit(BLOCK))
    one = lambda c: let(F.substring(seq, c + 1, F.lit(BLOCK + k - 1)), lambda t: make(t, c, F.least(F.lit(BLOCK), F.length(t) - k + 1)))
    return F.when(F.length(seq) >= k, F.flatten(F.transform(starts, one)))


def places(seq: Column, k: int) -> Column:
    """array<struct<p,kmer>> of all windows of k characters with their 1-based places; null for shorter texts."""
    return by_blocks(seq, k, lambda t, c, n: F.transform(F.sequence(F.lit(1), n), lambda j: F.struct((c + j).alias("p"), F.substring(t, j, F.lit(k)).alias("kmer"))))


def kmers(seq: Column, k: int) -> Column:
    """All k-mers without N, in order; an empty array for shorter sequences."""
    all_ = by_blocks(seq, k, lambda t, c, n: F.transform(F.sequence(F.lit(1), n), lambda j: F.substring(t, j, F.lit(k))))
    return F.coalesce(F.filter(all_, lambda x: ~F.contains(x, F.lit("N"))), F.array().cast("array<string>"))


# RNA/DNA nearest-neighbour enthalpy (kcal/mol) and entropy (cal/mol/K), Sugimoto et al. 1995, by RNA strand 5' to 3'.
RNA_DNA = {
    "AA": (-7.8, -21.9), "AC": (-5.9, -12.3), "AG": (-9.1, -23.5), "AT": (-8.3, -23.9), "CA": (-9.0, -26.1), "CC": (-9.3, -23.2),
    "CG": (-16.3, -47.1), "CT": (-7.0, -19.7), "GA": (-5.5, -13.5), "GC": (-8.0, -17.1), "GG": (-12.8, -31.9), "GT": (-7.8, -21.6),
    "TA": (-7.8, -23.2), "TC": (-8.6, -22.9), "TG": (-10.4, -28.4), "TT": (-11.5, -36.4),
}
INITIATION = (1.9, -3.9)


# Enthalpy and entropy of DNA pairs (SantaLucia 1998), of ends and of a sequence that is its own complement.
DNA_DNA = {
    "AA": (-7.9, -22.2), "AT": (-7.2, -20.4), "TA": (-7.2, -21.3), "CA": (-8.5, -22.7), "GT": (-8.4, -22.4),
    "CT": (-7.8, -21.0), "GA": (-8.2, -22.2), "CG": (-10.6, -27.2), "GC": (-9.8, -24.4), "GG": (-8.0, -19.9),
}
END_GC, END_AT, SYMMETRY = (0.1, -2.8), (2.3, 4.1), -1.4


def dna_pairs() -> dict[str, tuple[float, float]]:
    """The values of all sixteen pairs; a pair and its reverse complement stack alike."""
    return DNA_DNA | {p.translate(str.maketrans("ACGT", "TGCA"))[::-1]: v for p, v in DNA_DNA.items()}


def _stacked(s: Column, pairs: dict[str, tuple[float, float]], start: tuple[float, float]) -> Column:
    """struct(h, s): start and the values of every pair of neighbours."""
    each = F.transform(F.sequence(F.lit(1), F.length(s) - 1), lambda i: F.substring(s, i, F.lit(2)))
    table = F.create_map(*(x for p, v in pairs.items() for x in (F.lit(p), F.struct(F.lit(v[0]).alias("h"), F.lit(v[1]).alias("s")))))
    begin = F.struct(F.lit(start[0]).alias("h"), F.lit(start[1]).alias("s"))
    return F.aggregate(each, begin, lambda acc, p: F.struct((acc["h"] + table[p]["h"]).alias("h"), (acc["s"] + table[p]["s"]).alias("s")))


def melting_point(seq: Column, strand_nM: float = 25.0, other_nM: float = 25.0, sodium_mM: float = 50.0) -> Column:
    """Nearest-neighbour melting temperature in degrees Celsius of an RNA probe on DNA; null for empty sequences or other letters."""
    s = F.upper(seq)
    total = _stacked(s, RNA_DNA, INITIATION)
    k = (strand_nM - other_nM / 2) * 1e-9
    salt = 0.368 * (F.length(s) - 1) * math.log(sodium_mM / 1000)
    tm = 1000 * total["h"] / (total["s"] + salt + 1.987 * math.log(k)) - 273.15
    return F.when((F.length(s) > 1) & s.rlike("^[ACGT]+$"), tm)


def dna_melting_point(seq: Column, strand_nM: float = 50.0, monovalent_mM: float = 50.0, divalent_mM: float = 1.5, dntp_mM: float = 0.6) -> Column:
    """Nearest-neighbour melting temperature in degrees Celsius of a DNA primer; null for empty sequences or other letters.

    Divalent ions that the nucleotides leave free count as 120 times the root of their concentration.
    """
    s = F.upper(seq)
    total = _stacked(s, dna_pairs(), (0.0, 0.0))
    ends = [F.substring(s, 1, 1).isin("A", "T").cast("int"), F.substring(s, -1, 1).isin("A", "T").cast("int")]
    at = ends[0] + ends[1]
    h = total["h"] + at * END_AT[0] + (2 - at) * END_GC[0]
    own = s == reverse_complement(s)
    e = total["s"] + at * END_AT[1] + (2 - at) * END_GC[1] + F.when(own, F.lit(SYMMETRY)).otherwise(F.lit(0.0))
    salt_mM = monovalent_mM + 120 * math.sqrt(max(0.0, divalent_mM - dntp_mM))
    strands = F.when(own, F.lit(math.log(strand_nM / 1e9))).otherwise(F.lit(math.log(strand_nM / 4e9)))
    tm = 1000 * h / (e + 0.368 * (F.length(s) - 1) * math.log(salt_mM / 1000) + 1.987 * strands) - 273.15
    return F.when((F.length(s) > 1) & s.rlike("^[ACGT]+$"), tm)
