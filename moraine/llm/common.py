"""What the operators share: table access, and the scratch tables, broadcasts and components of moraine.scratch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.scratch import components, drop, fresh, small, stored, workspace

__all__ = ["components", "drop", "fresh", "marked", "marks", "small", "stored", "table", "workspace"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def marks(starts: Column, ends: Column) -> Column:
    """Bytes, of which the n-th is "1" where a range covers the 0-based place n; for ranges sorted and apart, up to the last end.

    Binary, as its n-th byte is found without a walk from the start.
    """
    before = F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.greatest(F.size(ends) - 1, F.lit(0))))
    gap = F.zip_with(starts, before, lambda a, e: F.repeat(F.lit("0"), a - e))
    runs = F.zip_with(gap, F.zip_with(starts, ends, lambda a, e: F.repeat(F.lit("1"), e - a)), lambda g, r: F.concat(g, r))
    return F.array_join(runs, "").cast("binary")


def marked(bits: Column, place: Column) -> Column:
    """Whether marks() has a "1" at a 0-based place."""
    return F.coalesce(F.substring(bits, place + 1, F.lit(1)) == F.lit(b"1"), F.lit(False))
