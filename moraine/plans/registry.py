"""All registered queries and the SQL each is held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from moraine.plans import checks, curate, damage, occur, panel

QUERIES: dict = {**curate.QUERIES, **panel.QUERIES, **damage.QUERIES, **occur.QUERIES, **checks.QUERIES}
ORACLES: dict = {**curate.ORACLES, **panel.ORACLES, **damage.ORACLES, **occur.ORACLES, **checks.ORACLES}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions by marker class after the whole curation of metrics, duplicates, reasons and score."""
    return curate.QUERIES["q_decision_by_class"](spark, sf_dir)
