"""Settings as plain data: defaults, deep merge, YAML files."""

from __future__ import annotations

import copy
from types import MappingProxyType

# Reasons, weights and thresholds of the curation score.
HARD_REJECT = (
    "adapter_internal", "vector_internal", "duplicate_accession", "duplicate_sequence", "length_below_min", "length_above_max",
    "length_below_class_min", "non_iupac_fraction_high", "bad_keyword_reject", "taxonomy_cross_kingdom", "chimera_detected",
    "fcs_adaptor_hit", "fcs_gx_contaminant",
)
REVIEW = (
    "adapter_terminal", "vector_terminal", "low_complexity", "homopolymer_long", "bad_keyword_review", "taxonomy_no_expected_match",
    "taxonomy_not_checked", "windowed_blast_conflict", "chimera_borderline", "cluster_nonrepresentative", "cap_exceeded",
    "fcs_adaptor_review", "fcs_gx_review",
)
WEIGHTS = {
    "adapter_internal": -100, "adapter_terminal": -40, "vector_internal": -100, "vector_terminal": -50, "duplicate_accession": -100,
    "duplicate_sequence": -100, "length_below_min": -100, "length_above_max": -100, "length_below_class_min": -100,
    "n_fraction_high": -20, "non_iupac_fraction_high": -40, "low_complexity": -25, "homopolymer_long": -20,
    "bad_keyword_reject": -100, "bad_keyword_review": -30, "taxonomy_cross_kingdom": -100, "taxonomy_no_expected_match": -10,
    "taxonomy_same_species": 20, "taxonomy_same_genus": 10, "refseq_preferred": 10, "voucher_keyword": 5, "complete_organelle": 5,
    "chimera_detected": -100, "chimera_borderline": -60, "rescued_duplicate": 0, "adapter_trimmed_rescued": 5,
    "taxonomy_rescued_nr_protein": 0, "taxonomy_rescued_nt_blast": 0, "sole_representative": 10, "cluster_representative": 5,
    "cluster_nonrepresentative": -25, "cap_exceeded": -30, "windowed_blast_conflict": -60, "fcs_adaptor_hit": -100,
    "fcs_adaptor_review": -40, "fcs_gx_contaminant": -100, "fcs_gx_review": -40,
}

# The thresholds that users know, of curation and of damage.
CURATE = {
    "qc": {"min_length": 50, "max_length": 400000, "min_length_by_class": {}, "max_n_fraction": 0.20, "max_non_iupac_fraction": 0.01, "min_entropy": 1.2, "max_run": 60},
    "adapter": {"scan_reverse": True, "terminal_window": 25, "min_pattern": 12},
    "vector": {"min_hit_length": 20, "min_pident": 90.0, "terminal_window": 25},
    "taxonomy": {"min_qcov": 50.0, "min_pident": 70.0, "search_type": 1, "reject_cross_kingdom": True},
    "windows": {"min_length": 1000, "size": 500, "step": 250, "min_pident": 80.0, "min_windows": 2, "action": "review", "rank": "family"},
    "caps": {"by_class": {"Mito": 20, "Plastid": 20, "NucMark": 10, "Other": 5}, "total": 50, "action": "review", "uncapped": [], "mode": "species_marker"},
    "score": {"start": 100, "keep_min": 65, "review_min": 30, "weights": WEIGHTS, "hard_reject": list(HARD_REJECT), "review": list(REVIEW)},
}

DAMAGE = {
    "damage_min": 0.01, "significance_min": 2.0, "high_confidence_n_reads_min": 100, "strong_count_min_reads": 50,
    "strong_count_min_libraries": 2, "blank_absolute_min": 10, "blank_relative_min": 0.10, "qc_ratio_clean_max": 10.0,
    "qc_ratio_caution_max": 20.0, "qc_rho_clean_max": 0.30, "qc_rho_caution_max": 0.50, "lineage_max_steps": 2,
    "lineage_max_rank": "family", "tentative_min_reads": 5,
}
# Ranks from most specific to most general, and names too broad to support anything.
RANKS = (
    "no rank", "clade", "subspecies", "species", "species group", "subgenus", "genus", "subtribe", "tribe", "subfamily", "family",
    "superfamily", "infraorder", "suborder", "order", "superorder", "class", "phylum", "kingdom", "domain", "superkingdom",
)
BROAD_NAMES = (
    "root", "cellular organisms", "Eukaryota", "Bacteria", "Archaea", "Bilateria", "Deuterostomia", "Protostomia", "Amniota",
    "Mammalia", "Theria", "Eutheria", "Placentalia", "Boreoeutheria", "Euarchontoglires", "Laurasiatheria", "Chordata", "Metazoa",
    "Animalia",
)


def merged(base: dict, override: dict | None) -> dict:
    """A new dict: nested dicts merge, everything else is replaced whole."""
    out = copy.deepcopy(dict(base))
    for k, v in (override or {}).items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else copy.deepcopy(v)
    return out


#: Settings whose keys are names of the user's own.
FREE = ("min_length_by_class", "by_class", "weights")


def unknown(base: dict, over: dict, at: str = "") -> list[str]:
    """Settings that the defaults do not have."""
    out = []
    for k, v in over.items():
        if k not in base:
            out.append(at + str(k))
        elif isinstance(v, dict) and isinstance(base[k], dict) and k not in FREE:
            out += unknown(base[k], v, f"{at}{k}.")
    return out


def load(base: dict, path: str | None = None, **flags) -> MappingProxyType:
    """Defaults under a YAML file under flags that are not None; the result cannot be changed. A key that the defaults lack is an error."""
    over = {}
    if path:
        import yaml

        with open(path, encoding="utf-8") as f:
            over = yaml.safe_load(f) or {}
    if strange := sorted(unknown(base, over)):
        raise ValueError(f"unknown settings: {', '.join(strange)}")
    return MappingProxyType(merged(merged(base, over), {k: v for k, v in flags.items() if v is not None}))
