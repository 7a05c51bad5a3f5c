"""Ordered rules: the first that holds wins, as one CASE expression."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name prefixes of curated accessions and header terms that add to a score.
CURATED_PREFIXES = ("NC_", "NM_", "NR_", "NZ_", "NG_", "XM_", "XR_", "WP_", "XP_", "NP_", "AC_", "NW_", "NT_")
VOUCHER_TERMS = ("voucher", "type strain", "holotype", "paratype", "type specimen", "neotype", "lectotype", "syntype")
COMPLETE_TERMS = ("complete genome", "complete mitochondrial", "complete plastid", "complete sequence", "complete cds", "complete coding sequence")
# Built-in marker patterns on the lower-cased header, tried after the rules of a table.
BUILT_IN_MARKERS = (
    ("Mito", "MITO_BUILTIN", r"mitochondr|\[location=mitochondrion\]"),
    ("Plastid", "PLASTID_BUILTIN", r"chloroplast|plastid|plastome|\[location=chloroplast\]"),
    ("NucMark", "NUCMARK_BUILTIN", r"\b18s\b|\b28s\b|small subunit ribosomal|ssu rrna|ssu rna|large subunit ribosomal|lsu rrna|lsu rna|\bits1\b|\bits2\b|internal transcribed spacer|5\.8s|histone h3|\bh3\b"),
)
# Kingdom names by what the lower-cased label holds, in order; "=" marks whole labels.
KINGDOMS = (("Animal", ("animal", "=metazoa")), ("Plant", ("plant", "viridiplantae")), ("Fungi", ("fung",)), ("Bacteria", ("bacteria",)), ("Archaea", ("archaea",)), ("Protozoa", ("protozoa",)), ("Protist", ("protist", "chromista")))


def first_match(rules: Iterable, test: Callable[..., Column], result: Callable[..., Column], default: Column | None = None) -> Column:
    """CASE WHEN test(r1) THEN result(r1) WHEN ... ELSE default."""
    out = None
    for r in rules:
        out = F.when(test(r), result(r)) if out is None else out.when(test(r), result(r))
    default = F.lit(None) if default is None else default
    return default if out is None else out.otherwise(default)


def any_of(text: Column, terms: Iterable[str]) -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | F.contains(text, F.lit(t))
    return out


def keyword(text: Column, rules: list[tuple[str, str, str]], case_sensitive: bool = False) -> Column:
    """struct(keyword, action, reason) of the first (keyword, action, reason) whose keyword the text holds, or null."""
    own = text if case_sensitive else F.lower(text)
    made = lambda r: F.struct(F.lit(r[0]).alias("keyword"), F.lit(r[1]).alias("action"), F.lit(r[2]).alias("reason"))
    return first_match(rules, lambda r: F.contains(own, F.lit(r[0] if case_sensitive else r[0].lower())), made)


def marker(header: Column, rules: list[tuple[str, str, str]] = (), default: str = "Other") -> Column:
    """struct(marker_class, region_id): first of (class, id, regex) found in any case, else the built-in patterns, else the default."""
    made = lambda r: F.struct(F.lit(r[0]).alias("marker_class"), F.lit(r[1]).alias("region_id"))
    every = [(c or "Other", i, f"(?i){x}") for c, i, x in rules if x] + [(c, i, f"(?i){x}") for c, i, x in BUILT_IN_MARKERS]
    return first_match(every, lambda r: header.rlike(r[2]), made, made((default, "OTHER_BUILTIN")))


def kingdom(label: Column) -> Column:
    low = F.lower(F.coalesce(label, F.lit("")))

    def test(rule):
        out = F.lit(False)
        for t in rule[1]:
            out = out | (low == t[1:] if t[0] == "=" else F.contains(low, F.lit(t)))
        return out

    return first_match(KINGDOMS, test, lambda r: F.lit(r[0]), F.lit("Unknown"))


def species(header: Column) -> Column:
    """struct(species, genus) of "ACC Genus epithet ..." or a trailing "[Genus epithet ...]"; empty strings without either."""
    h = F.regexp_replace(header, "^>", "")
    words = F.split(F.trim(h), r"\s+")
    second, third = F.get(words, F.lit(1)), F.regexp_replace(F.get(words, F.lit(2)), "^[,;]+|[,;]+$", "")
    plain = second.rlike(r"^[A-Z][\w.-]+$") & third.rlike(r"^[a-z][\w.-]+")
    tail = F.regexp_extract(h, r"\[([A-Z][\w.-]+\s+[a-z][\w.-]+)[^\]]*\]\s*$", 1)
    made = lambda s, g: F.struct(s.alias("species"), g.alias("genus"))
    return F.when(plain, made(F.concat_ws(" ", second, third), second)).otherwise(made(tail, F.regexp_extract(tail, r"^(\S*)", 1)))
