"""Taxon-name cleaners and label normalisers as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and word lists of the cleaners (A for collection names, B for published names).
QUALIFIER = r"(?i)\b(cf|aff|nr|near|ex gr|gr|group|complex)\.?\b"
SPECIES_A = r"(?i)\b(spp|sp|species|undiff|undifferentiated)\.?\b"
SPECIES_B = r"(?i)\b(spp|sp|species|indet|indeterminate|undiff|undifferentiated)\.?\b"
MORPHOTYPE = r"(?i)(?:-type\b|\btype\b|\bmorphotype\b)"
BAD_A, BAD_B = r"[\[\]{}<>≈~;:,=+*#@!]", r"[\[\]{}<>≈~;:=+*#@!]"
WORDS_A = ("unknown", "indeterminate", "undetermined", "unidentified", "other", "charcoal", "organic", "inorganic", "water", "sediment", "sample")
WORDS_B = ("unknown", "indeterminate", "undetermined", "unidentified", "other", "fossil", "sample")
HIGHER_A = ("idae", "inae", "ini", "aceae", "ales", "iformes", "phyta", "mycota", "oda", "ata", "opsida", "idae/", "aceae/")
HIGHER_B = ("idae", "inae", "ini", "aceae", "ales", "iformes", "phyta", "mycota", "oda", "ata", "opsida", "oidea", "ina", "inae/")
FIELDS = ("search_name", "genus", "rank", "binomial", "status", "reason")


def tidy(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def capital(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.substring(word, F.lit(2), F.length(word)))


def ends_with(word: Column, suffixes: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.endswith(word, F.lit(s)) for s in suffixes])


def _name(search, genus, rank, binomial, status) -> Column:
    vals = [search, genus, F.lit(rank) if isinstance(rank, str) else rank, binomial, F.lit(status) if isinstance(status, str) else status, F.lit(None).cast("string")]
    return F.struct(*(v.alias(n) for v, n in zip(vals, FIELDS, strict=True)))


def _rejected(reason: str) -> Column:
    return F.struct(*(F.lit(reason if n == "reason" else None).cast("string").alias(n) for n in FIELDS))


def let(value: Column, body) -> Column:
    """body(value), with value computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _first(cases: list[tuple[Column, Column]], last: Column) -> Column:
    out = None
    for test, value in cases:
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(last)


def base_name(name: Column) -> Column:
    """Blanks squeezed, parentheses, question marks, qualifiers and odd characters dropped."""
    s = tidy(F.replace(F.coalesce(name, F.lit("")), F.lit("×"), F.lit("x")))
    s = F.regexp_replace(F.replace(F.regexp_replace(s, r"\([^)]*\)", " "), F.lit("?"), F.lit(" ")), QUALIFIER, " ")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(s, BAD_A, " "), r"\s+", " "), r"^[ ._\-;,]+|[ ._\-;,]+$", "")


def collection_name(name: Column, mode: str = "binomial", genus_only: bool = True, higher: bool = False, morphotypes: bool = True) -> Column:
    """Cleaner A: struct of FIELDS; reason is set where the name is rejected."""
    def cleaned(x):
        raw, s0, s, tokens = x["raw"], x["s0"], x["s"], x["tokens"]
        morph = raw.rlike(MORPHOTYPE)
        genus = capital(F.get(tokens, F.lit(0)))
        second, third = F.lower(F.get(tokens, F.lit(1))), F.lower(F.get(tokens, F.lit(2)))
        is_higher = (F.length(genus) > 3) & ends_with(F.lower(genus), HIGHER_A)
        one = raw.rlike(SPECIES_A) | (F.size(tokens) == 1)
        bucket = _name(genus, genus, "genus", genus, "genus_bucket") if genus_only else _rejected("genus-only taxon excluded")
        odd = _name(genus, genus, "genus", genus, "fallback_genus_bucket_bad_species_epithet") if genus_only else _rejected("bad species epithet")
        top = _name(genus, genus, "higher", genus, "higher_taxon_kept") if higher else _rejected("higher taxon excluded")
        two = F.concat_ws(" ", genus, second)
        last = _name(two, genus, "species", two, "binomial")
        if mode == "trinomial":
            sub = third.rlike(r"^[a-z][a-z\-]+$") & ~third.isin("subsp", "ssp", "var", "forma", "cf", "aff")
            last = F.when(F.coalesce(sub, F.lit(False)), _name(F.concat_ws(" ", two, third), genus, "subspecies", two, "trinomial")).otherwise(last)
        elif mode == "as-is":
            last = _name(s, genus, "taxon", two, "cleaned_as_is")
        cases = [
            (raw == "", _rejected("empty taxon name")),
            (F.contains(raw, F.lit("/")), _rejected("slash/alternative taxon name; split it first")),
            (F.lower(raw).isin(*WORDS_A), _rejected("uninformative taxon name")),
            (s0 == "", _rejected("empty after cleaning qualifiers")),
            *([] if morphotypes else [(morph, _rejected("morphotype/type taxon excluded"))]),
            (F.size(tokens) == 0, _rejected("no Latin-like tokens")),
            (F.lower(genus).isin(*WORDS_A), _rejected("uninformative first token")),
            (one & is_higher, top),
            (one, bucket),
            (second.isin("sp", "spp", "species", "undiff", "undifferentiated", "type"), bucket),
            (~second.rlike(r"^[a-z][a-z\-]+$"), odd),
        ]
        return _first(cases, last)

    raw = F.struct(F.trim(F.coalesce(name, F.lit(""))).alias("raw"), base_name(name).alias("s0"))
    bare = lambda a: F.when(a["raw"].rlike(MORPHOTYPE), F.regexp_replace(F.regexp_replace(a["s0"], MORPHOTYPE, " "), r"^[ \-_.]+|[ \-_.]+$", "")).otherwise(a["s0"])
    words = lambda b: F.struct(b["raw"].alias("raw"), b["s0"].alias("s0"), b["s"].alias("s"), F.regexp_extract_all(b["s"], F.lit(r"[A-Za-z][A-Za-z\-]*"), F.lit(0)).alias("tokens"))
    return let(raw, lambda a: let(F.struct(a["raw"].alias("raw"), a["s0"].alias("s0"), bare(a).alias("s")), lambda b: let(words(b), cleaned)))


def slash_names(name: Column) -> Column:
    """Array of the names that "A/B" or "Genus a/b" stand for; others alone."""
    raw = F.trim(F.coalesce(name, F.lit("")))
    parts = F.filter(F.transform(F.split(base_name(name), "/"), F.trim), lambda p: p != "")
    head = F.split(F.get(parts, F.lit(0)), r"\s+")
    full = lambda p: F.when((F.size(head) == 2) & p.rlike(r"^[a-z]\S*$"), F.concat_ws(" ", F.get(head, F.lit(0)), p)).otherwise(p)
    many = F.concat(F.slice(parts, 1, 1), F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), full))
    return F.when(F.contains(raw, F.lit("/")) & (F.size(parts) >= 2), many).otherwise(F.array(raw))


def published_name(name: Column, mode: str = "binomial", genus_only: bool = True, higher: bool = False, drop_morphotypes: bool = False, split_slash: bool = False) -> Column:
    """Cleaner B: struct of FIELDS; reason "could_not_clean_name" where nothing is left."""
    raw = F.trim(F.coalesce(name, F.lit("")))
    s = tidy(F.regexp_replace(F.replace(F.replace(raw, F.lit("†"), F.lit("")), F.lit("_"), F.lit(" ")), BAD_B, " "))
    bad = (s == "") | F.lower(s).isin(*WORDS_B)
    s = F.trim(F.get(F.split(s, r"\b[x×]\b"), F.lit(0)))
    morph = s.rlike(MORPHOTYPE)
    if split_slash:
        s = F.trim(F.split_part(s, F.lit("/"), F.lit(1)))
    s = F.regexp_replace(s, QUALIFIER, " ")
    marked = s.rlike(SPECIES_B)
    s = F.regexp_replace(F.regexp_replace(s, SPECIES_B, " "), r"\([^)]*\)", " ")
    s = tidy(F.regexp_replace(s, r"\b[a-z]\.?\s+(?=[A-Z][a-z])", " "))
    tokens = F.split(s, " ")
    t0, t1, t2 = (F.get(tokens, F.lit(i)) for i in range(3))
    n = F.size(tokens)
    two, three = F.concat_ws(" ", t0, t1), F.concat_ws(" ", t0, t1, t2)
    sub = F.coalesce(t2.rlike("^[a-z][a-z-]+$"), F.lit(False))
    search = {"as-is": F.when(sub, three).otherwise(two), "trinomial": F.when(sub, three).otherwise(two), "genus": t0}.get(mode, two)
    status = F.array_join(F.array_compact(F.array(F.lit("cleaned"), F.when(raw != search, F.when((search == two) & sub, "collapsed").otherwise("normalized")), F.when(morph, F.lit("morphotype_kept")))), ";")
    no = _rejected("could_not_clean_name")
    single = _name(t0, t0, "genus_or_higher", F.lit(""), F.when(marked, "genus_only").otherwise("single_name"))
    unsure = _name(t0 if mode == "genus" else two, t0, "higher_or_uncertain", F.lit(""), "higher_or_uncertain") if higher else no
    cases = [
        (bad | (s == ""), no),
        *([(morph, no)] if drop_morphotypes else []),
        *([] if higher else [(~t0.rlike("^[A-Z][A-Za-z-]+$"), no), ((n == 1) & ends_with(F.lower(t0), HIGHER_B), no)]),
        (n == 1, single if genus_only or higher else no),
        (~t1.rlike("^[a-z][a-z-]+$"), unsure),
    ]
    return _first(cases, _name(search, t0, F.when(sub, "subspecies_or_trinomial").otherwise("species"), two, status))


def facet_name(name: Column) -> Column:
    """Cleaner C: "Genus epithet" or "Genus", null where no letters are left."""
    s = F.regexp_replace(tidy(F.coalesce(name, F.lit(""))), r"\([^)]*\)", " ")
    s = F.regexp_replace(F.regexp_replace(s, r"(?i)\s+(sensu|auct|agg|sl|ss)\b.*", ""), r"[^A-Za-z \-]", " ")
    words = F.filter(F.split(F.trim(s), r"\s+"), lambda w: F.length(w) > 1)
    first = F.get(words, F.lit(0))
    cap = F.concat(F.upper(F.substring(first, 1, 1)), F.lower(F.substring(first, F.lit(2), F.length(first))))
    return F.when(F.size(words) >= 2, F.concat_ws(" ", cap, F.lower(F.get(words, F.lit(1))))).when(F.size(words) == 1, cap)


def canonical_key(name: Column, mode: str = "binomial") -> Column:
    words = F.filter(F.split(F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), "[^A-Za-z -]+", " ")), r"\s+"), lambda w: w != "")
    n = {"genus": 1, "trinomial": 3}.get(mode, 2)
    return F.array_join(F.slice(words, 1, n), " ")


def query_name(name: Column, mode: str = "binomial") -> Column:
    """A search name: txid terms pass, blanks and underscores are squeezed, then as many words as the mode has."""
    s = tidy(F.replace(F.coalesce(name, F.lit("")), F.lit("_"), F.lit(" ")))
    n = {"genus": 1, "trinomial": 3}.get(mode, 2)
    return F.when(s.rlike(r"(?i)^txid\d+"), s).otherwise(F.array_join(F.slice(F.split(s, " "), 1, n), " "))


def plain(text: Column) -> Column:
    """Trimmed, curly quotes and back-ticks straight, blanks squeezed."""
    return tidy(F.translate(F.coalesce(text, F.lit("")), "‘’`´", "''''"))


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def squeezed(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", "")


def wrapped(text: Column, width: int = 80) -> Column:
    """Lines of width characters."""
    return F.regexp_replace(F.regexp_replace(text, f"(.{{{width}}})", "$1\n"), "\n$", "")


# Library names.
def library_stem(column: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(column, r"(?i)[_.]PE\.mapped.*|[_.]SE\.mapped.*|[_.]mapped\..*", ""), r"\.+$", "")


def without_lane(stem: Column) -> Column:
    return F.regexp_replace(stem, r"_S\d+$", "")


def without_batch(stem: Column) -> Column:
    return F.regexp_replace(stem, r"^(?:AiL|BiL|iL)-", "")


def chemistry(library: Column) -> Column:
    low = F.lower(library)
    return F.when(F.contains(low, F.lit("shg")), "Shg").when(F.contains(low, F.lit("e-pnmp")), "E-PNmp").when(F.contains(low, F.lit("e-pnm")), "E-PNm").otherwise("unknown")


def without_zeros(sample: Column) -> Column:
    return F.regexp_replace(sample, r"-0+(\d)", "-$1")


def biological_id(sample: Column) -> Column:
    s = F.regexp_replace(F.replace(F.trim(F.coalesce(sample, F.lit(""))), F.lit("_"), F.lit("-")), "(?i)-(?:Alpha|Beta|Gamma)$", "")
    return F.regexp_replace(F.regexp_replace(s, "([A-Za-z0-9])[cp]$", "$1"), "^[- ]+|[- ]+$", "")


def truth(value: Column) -> Column:
    """True, False or null of the usual words."""
    s = F.lower(F.trim(value.cast("string")))
    return F.when(s.isin("1", "true", "t", "yes", "y", "extinct"), True).when(s.isin("0", "false", "f", "no", "n", "extant"), False)


def number(value: Column) -> Column:
    """A double; null for blanks, NA words and what does not parse."""
    s = F.trim(value.cast("string"))
    d = F.when(~s.isin("", "NA", "N/A", "null"), s.try_cast("double"))
    return F.when(~F.isnan(d), d)


def age_in_ma(value: Column, unit: str) -> Column:
    return value / {"ma": 1.0, "ka": 1000.0, "bp": 1_000_000.0}[unit]
