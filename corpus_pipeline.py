"""From raw documents to token ids: quality filter, line dedup, near-duplicates, decontamination, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.llm import decontaminate, jaccard, linededup, quality, sentencepieces
from moraine.llm.common import drop, fresh, stored, table, workspace


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on labelled ones of the training folds, does not reject."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    (own,) = fresh(docs, "_score")
    return quality.score(docs, model, into=own).where(F.col(own) >= 0.5).select(*docs.columns)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of lines; a document of which nothing is left goes."""
    (was,) = fresh(docs, "_was_blank")
    blank = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"\S")
    out = linededup.dedup_lines(docs.withColumn(was, blank)).where(F.col(was) | ~blank).drop(was)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a Jaccard similarity of 0.8."""
    return jaccard.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of the texts."""
    ids = sentencepieces.encode(docs.select("doc_id", "lang", "source", "text"), sentencepieces.read_model(sentencepieces.MODEL_PATH))
    return ids.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", fresh_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("SentencePiece encoding", encoded),
]
#: Stages that SQL cannot express; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    was = None
    for name, stage in STAGES:
        with workspace(spark) as keep:
            docs = keep(stored(stage(spark, docs, sf_dir), name.replace(" ", "-")))
        if was:
            drop(was)
        was = docs
    return docs
