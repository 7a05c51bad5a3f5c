"""FASTA files as DataFrames, split at record starts so that plain files are read in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moraine.operators.curate import unique_keys


def read_fasta(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """ordinal, source_file, accession, header (with ">"), seq (upper case, no blanks), in the order of the paths and of each file.

    Gzip files are read too, each by one task. ordinal is the file's number times 2**40 plus the place in the file.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    out = None
    for i, path in enumerate(paths):
        raw = spark.read.text(path, lineSep="\n>").select("value", F.col("_metadata.file_path").alias("source_file"), F.monotonically_increasing_id().alias("_at"))
        one = raw.withColumn("ordinal", F.lit(i << 40) + F.col("_at"))
        out = one if out is None else out.unionByName(one)
    body = F.regexp_replace(F.regexp_replace("value", "^>", ""), "\r", "")
    cut = F.instr("body", "\n")
    rows = out.withColumn("body", body).where(F.trim("body") != "")
    head = F.when(cut > 0, F.substring("body", F.lit(1), cut - 1)).otherwise(F.col("body"))
    seq = F.when(cut > 0, F.substring("body", cut + 1, F.length("body"))).otherwise("")
    rows = rows.select("ordinal", "source_file", F.concat(F.lit(">"), F.trim(head)).alias("header"), F.upper(F.regexp_replace(seq, r"\s+", "")).alias("seq"))
    return rows.withColumn("accession", F.regexp_extract("header", r"^>(\S*)", 1))


def records(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """With record_key: repeated accessions get __dup2, __dup3, ... in input order."""
    return unique_keys(read_fasta(spark, paths))


def as_map(df: DataFrame) -> DataFrame:
    """The last record of each id."""
    w = Window.partitionBy("accession").orderBy(F.desc("ordinal"))
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def distinct_ids(df: DataFrame) -> DataFrame:
    """The same rows; using them fails where an id occurs twice."""
    n = F.count("*").over(Window.partitionBy("accession"))
    return df.withColumn("_ok", F.assert_true(n == 1, F.concat(F.lit("duplicate sequence id: "), "accession"))).where("_ok is null").drop("_ok")


def circular(df: DataFrame, ids: list[str], probe_len: int) -> DataFrame:
    """Circular references extended by probe_len - 1 bases of their start."""
    ring = F.col("accession").isin(*ids) if ids else F.lit(False)
    return df.withColumn("seq", F.when(ring, F.concat("seq", F.substring("seq", 1, probe_len - 1))).otherwise(F.col("seq")))
