"""Long report tables: technical libraries collapsed to plotting units, ranks, pages, bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moraine.operators.damage import LABELS

# Depth of ranks (0 most specific) and the ranks preferred for a display group.
DEPTHS = ("subspecies", "species", "species group", "subgenus", "genus", "subtribe", "tribe", "subfamily", "family", "superfamily", "infraorder", "suborder", "order", "superorder", "class", "subphylum", "phylum", "kingdom", "domain")
PREFERRED = {"animals": ("family", "subfamily", "tribe", "order", "class", "phylum"), "plants": ("family", "subfamily", "tribe", "order", "class", "phylum"), "fungi": ("family", "order", "class", "phylum"), "microbes": ("phylum", "class", "order", "family"), "other": ("family", "order", "class", "phylum")}
# Left edges of count bins with their labels, and of damage bins.
COUNT_BINS = ((-0.1, "0"), (0.5, "1-4"), (5, "5-9"), (10, "10-49"), (50, "50-99"), (100, "100-499"), (500, "500-999"), (1000, "1000-9999"), (10000, ">=10000"))
DAMAGE_BINS = ((0.0, "<0.01"), (0.01, "0.01-0.05"), (0.05, "0.05-0.10"), (0.10, "0.10-0.20"), (0.20, "0.20-0.30"), (0.30, ">=0.30"))


def rank_allowed(rank: Column, broadest: str = "family") -> Column:
    """The rank is at most as inclusive as the broadest one."""
    return F.lower(rank).isin(*DEPTHS[: DEPTHS.index(broadest if broadest in DEPTHS else "family") + 1])


def path_ranks(path: Column) -> Column:
    """array<struct<name,rank>> of a TAB path of id:name:"rank"."""
    rx = r'^[^:]+:([^:]+):"?([^":]+)"?$'
    parts = F.filter(F.split(F.coalesce(path, F.lit("")), "\t"), lambda p: p.rlike(rx))
    return F.transform(parts, lambda p: F.struct(F.trim(F.regexp_extract(p, rx, 1)).alias("name"), F.lower(F.trim(F.regexp_extract(p, rx, 2))).alias("rank")))


def display_group(path: Column, group: Column) -> Column:
    """struct(name, rank): the lineage's name at the first preferred rank of the broad group, else its first, else the group."""
    ranks = path_ranks(path)
    out = F.when(F.size(ranks) == 0, F.struct(F.coalesce(group, F.lit("Other")).alias("name"), F.lit("").alias("rank")))
    for g, prefs in PREFERRED.items():
        tries = [F.get(F.filter(ranks, (lambda pref: lambda x: x["rank"] == pref)(pref)), F.lit(0)) for pref in prefs]
        found = F.coalesce(*tries, F.get(ranks, F.lit(0)))
        out = out.when(F.coalesce(F.lower(group), F.lit("other")) == g, found) if g != "other" else out.otherwise(found)
    return out


def short_label(name: Column) -> Column:
    s = F.replace(F.trim(F.coalesce(name, F.lit(""))), F.lit("_"), F.lit("-"))
    s = F.regexp_replace(s, "(?i)-(?:E-PNmp|E-PNm|Shg)$", "")
    return F.regexp_replace(s, "(?i)-(?:Alpha|Beta|Gamma)$", "")


def plot_sample(sample: Column, biological: Column, damage_name: Column, library: Column, kind: Column, negative: Column) -> Column:
    """The unit that technical libraries collapse to."""
    t = lambda c: F.trim(F.coalesce(c, F.lit("")))
    usable = ~negative & (t(damage_name) != "") & ~t(damage_name).isin("blanks", "NO_HOLI_DATA") & ~F.startswith(t(damage_name), F.lit("REVIEW_NEEDED"))
    base = F.when(t(biological) != "", t(biological)).when(usable, t(damage_name)).when(t(sample) != "", t(sample)).otherwise(t(library))
    base = F.regexp_replace(F.replace(base, F.lit("_"), F.lit("-")), "(?i)-(?:Alpha|Beta|Gamma)$", "")
    base = F.regexp_replace(F.regexp_replace(base, "([A-Za-z0-9])[cp]$", "$1"), "-(Cob|Web)-", "-$1")
    base = F.regexp_replace(F.regexp_replace(base, r"\s+", " "), "^[- ]+|[- ]+$", "")
    odd = F.contains(F.lower(t(kind)), F.lit("undetermined")) | F.startswith(F.lower(base), F.lit("undetermined"))
    return F.when(odd, "Undetermined").otherwise(F.coalesce(F.nullif(base, F.lit("")), F.nullif(t(library), F.lit("")), F.lit("unknown")))


def best_label(labels: Column) -> Column:
    """Aggregate: the strongest library label."""
    order = F.coalesce(*(F.when(labels == x, F.lit(i)) for i, x in enumerate(LABELS)), F.lit(999))
    return F.coalesce(F.min_by(labels, F.struct(order, labels)), F.lit("Not detected"))


def collapsed(rows: DataFrame, taxon: str = "taxon", unit: str = "unit", group: str = "group", library: str = "library") -> DataFrame:
    """One row a taxon, unit and group: counts summed, best label, greatest damage, and the number of libraries of the unit
    counted before rows without counts leave."""
    total = rows.groupBy(unit).agg(F.count_distinct(library).alias("n_libraries"))
    out = rows.where("count > 0").groupBy(taxon, unit, group).agg(F.sum("count").alias("count"), best_label(F.col("label")).alias("label"), F.max("damage").alias("damage"), F.array_join(F.array_sort(F.collect_set(library)), "; ").alias("libraries"))
    return out.join(total, unit)


def joined_values(value: Column, ordinal: Column) -> Column:
    """Aggregate: distinct values that are not blank, in order, joined by "; "; null without any."""
    kept = F.transform(F.array_sort(F.collect_list(F.when(F.trim(value) != "", F.struct(ordinal.alias("o"), F.trim(value).alias("v"))))), lambda x: x["v"])
    return F.nullif(F.array_join(F.array_distinct(kept), "; "), F.lit(""))


def group_transforms(rows: DataFrame, taxon: str = "taxon", group: str = "group", display: str = "display") -> DataFrame:
    over = lambda *k: Window.partitionBy(*k)
    return rows.withColumns({"taxon_sum": F.sum("count").over(over(taxon)), "taxon_max": F.max("count").over(over(taxon)), "subset_sum": F.sum("count").over(over(group, taxon)), "subset_max": F.max("count").over(over(group, taxon)), "display_sum": F.sum("count").over(over(group, display)), "display_max": F.max("count").over(over(group, display))})


def binned(value: Column, bins: tuple) -> Column:
    """Label of the last left edge that the value reaches; null below the first."""
    out = None
    for edge, label in reversed(bins):
        out = F.when(value >= edge, label) if out is None else out.when(value >= edge, label)
    return out


def paged(rows: DataFrame, group: str, order: list[Column], top: int, page_rows: int) -> DataFrame:
    """The first ``top`` rows of each group with their page."""
    out = rows.withColumn("row", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("row") <= top)
    return out.withColumn("page", F.ceil(F.col("row") / page_rows))


def bars(rows: DataFrame, sample: str, taxon: str, top: int) -> DataFrame:
    """Counts of the most abundant taxa in each sample with their share of the sample's total over all taxa."""
    leading = rows.groupBy(taxon).agg(F.sum("count").alias("_s")).orderBy(F.desc("_s"), taxon).limit(top)  # the feature: a top-n report
    all_ = rows.groupBy(sample).agg(F.sum("count").alias("total"))
    return rows.join(leading, taxon, "left_semi").groupBy(sample, taxon).agg(F.sum("count").alias("count")).join(all_, sample).withColumn("share", F.when(F.col("total") > 0, F.col("count") / F.col("total")))


def dense(rows: DataFrame, sample: str, taxon: str) -> DataFrame:
    """Every sample with every taxon, 0 where there is no count. The output is that grid, so the pairing is the feature."""
    grid = rows.select(sample).distinct().join(rows.select(taxon).distinct(), how="cross")
    return grid.join(rows.groupBy(sample, taxon).agg(F.sum("count").alias("count")), [sample, taxon], "left").fillna(0, ["count"])


def label_once(rows: DataFrame, page: str, group: str, order: list[Column]) -> DataFrame:
    """The group's name on its first row of a page, empty on the others."""
    first = F.row_number().over(Window.partitionBy(page, group).orderBy(*order)) == 1
    return rows.withColumn("shown", F.when(first, F.col(group)).otherwise(""))


def order_table(rows: DataFrame, group: str, sample: str, order: list[Column], groups: list[str]) -> DataFrame:
    """Ragged columns, one a group, of samples in order, padded with empty strings."""
    r = rows.withColumn("row", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return r.groupBy("row").pivot(group, groups).agg(F.first(sample)).fillna("", groups)


def order_long(wide: DataFrame, groups: list[str]) -> DataFrame:
    return wide.unpivot(["row"], groups, "group", "sample").where("sample <> ''")


def control_tier(negative: Column, environmental: Column, positive: Column) -> Column:
    return negative.cast("int") * 4 + environmental.cast("int") * 2 + positive.cast("int")
