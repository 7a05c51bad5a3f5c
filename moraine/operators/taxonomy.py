"""Taxonomy trees: ancestor closure with a cycle guard, names at ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moraine.scratch import stored

MAX_DEPTH = 100


def closure(nodes: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(taxid, ancestor, depth) of nodes (taxid, parent), each its own ancestor at depth 0, by doubling: each round joins once.

    A walk ends at a node that is its own parent, has no known parent, or was met before. Rounds are stored; a lineage of
    more than max_depth steps is an error.
    """
    edges = nodes.select("taxid", "parent").where("parent is not null and taxid <> parent").join(nodes.select(F.col("taxid").alias("parent")).distinct(), "parent", "left_semi")
    all_ = nodes.select("taxid", F.col("taxid").alias("ancestor"), F.lit(0).alias("depth")).unionByName(edges.select("taxid", F.col("parent").alias("ancestor"), F.lit(1).alias("depth")))
    reach = 1
    while reach < max_depth:
        far = all_.where(F.col("depth") == reach).select("taxid", F.col("ancestor").alias("mid"))
        if not far.limit(1).count():
            break
        step = all_.where("depth > 0").select(F.col("taxid").alias("mid"), F.col("ancestor"), "depth")
        more = far.join(step, "mid").select("taxid", "ancestor", (F.col("depth") + reach).alias("depth"))
        all_ = stored(all_.unionByName(more).groupBy("taxid", "ancestor").agg(F.min("depth").alias("depth")), "closure")
        reach *= 2
    if reach >= max_depth and all_.where(F.col("depth") > max_depth).limit(1).count():
        raise RuntimeError(f"a lineage has more than {max_depth} steps")
    return all_


def at_ranks(nodes: DataFrame, ranks: dict[str, tuple[str, ...]], max_depth: int = MAX_DEPTH) -> DataFrame:
    """taxid and one column a name: the nearest ancestor's name at the first of its ranks that the lineage has, or "".

    ``ranks`` maps column names to ranks in order of preference, e.g. {"domain": ("domain", "superkingdom")}.
    """
    known = closure(nodes, max_depth).join(nodes.select(F.col("taxid").alias("ancestor"), "rank", F.coalesce("name", F.lit("")).alias("name")), "ancestor")
    def pick(names):
        order = F.coalesce(*(F.when(F.col("rank") == r, F.lit(i)) for i, r in enumerate(names)))
        return F.coalesce(F.min_by("name", F.when(order.isNotNull(), F.struct(order.alias("o"), F.col("depth")))), F.lit(""))
    return known.groupBy("taxid").agg(*(pick(names).alias(c) for c, names in ranks.items()))


def lineages(nodes: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """taxid, lineage: array of (rank, name) from the taxon up to the root."""
    known = closure(nodes, max_depth).join(nodes.select(F.col("taxid").alias("ancestor"), "rank", "name"), "ancestor")
    rows = F.array_sort(F.collect_list(F.struct("depth", "rank", "name")))
    return known.groupBy("taxid").agg(F.transform(rows, lambda x: F.struct(x["rank"].alias("rank"), x["name"].alias("name"))).alias("lineage"))
