"""The driver's tables read as the engine's entities, in Spark and as SQL prefixes for the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GENERA = {"en": "Bison", "de": "Equus", "fr": "Salix", "es": "Betula"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as sequence records: the letters a, c, g, t and n of a text are its sequence."""
    d = table(spark, sf_dir, "documents")
    genus = F.coalesce(*(F.when(F.col("lang") == k, F.lit(v)) for k, v in GENERA.items()), F.lit("Homo"))
    seq = F.translate(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), "[^acgtn]", ""), "acgtn", "ACGTN")
    d = d.select(F.col("doc_id").alias("ordinal"), F.concat(F.when(F.col("doc_id") % 7 == 0, "NC_").otherwise("ACC"), F.col("doc_id") % 150).alias("accession"), "lang", "source", genus.alias("g"), seq.alias("seq"))
    return d.select("ordinal", "accession", "lang", "source", F.concat(F.lit(">"), F.col("accession"), F.lit(" "), "g", F.lit(" sp"), F.regexp_replace("source", "[^0-9]", ""), F.when(F.col("ordinal") % 5 == 0, " mitochondrion, complete genome").when(F.col("ordinal") % 5 == 1, " chloroplast partial voucher X").when(F.col("ordinal") % 5 == 2, " 18S ribosomal RNA").otherwise(" UNVERIFIED: clone")).alias("header"), "seq")


RECORDS = """
base as (
  select doc_id as ordinal, (case when doc_id % 7 = 0 then 'NC_' else 'ACC' end) || cast(doc_id % 150 as varchar) as accession, lang, source,
    case lang when 'en' then 'Bison' when 'de' then 'Equus' when 'fr' then 'Salix' when 'es' then 'Betula' else 'Homo' end as g,
    translate(regexp_replace(lower(coalesce(text, '')), '[^acgtn]', '', 'g'), 'acgtn', 'ACGTN') as seq
  from documents),
rec as (
  select ordinal, accession, lang, source, g as genus, g || ' sp' || regexp_replace(source, '[^0-9]', '', 'g') as species,
    '>' || accession || ' ' || g || ' sp' || regexp_replace(source, '[^0-9]', '', 'g') ||
      case ordinal % 5 when 0 then ' mitochondrion, complete genome' when 1 then ' chloroplast partial voucher X' when 2 then ' 18S ribosomal RNA' else ' UNVERIFIED: clone' end as header,
    case ordinal % 5 when 0 then 'Mito' when 1 then 'Plastid' when 2 then 'NucMark' else 'Other' end as marker_class, seq
  from base),
cnt as (
  select *, cast(length(seq) as integer) as length, cast(length(seq) - length(replace(seq, 'N', '')) as integer) as n_count,
    length(seq) - length(replace(seq, 'A', '')) as ca, length(seq) - length(replace(seq, 'C', '')) as cc,
    length(seq) - length(replace(seq, 'G', '')) as cg, length(seq) - length(replace(seq, 'T', '')) as ct from rec),
met as (
  select *, case when length > 0 then n_count * 1.0::double / length else 1.0 end as n_fraction,
    case when ca + cc + cg + ct > 0 then (cg + cc) * 1.0::double / (ca + cc + cg + ct) else 0.0 end as gc_fraction,
    case when ca + cc + cg + ct > 0 then
      abs(case when ca > 0 then (ca * 1.0::double / (ca + cc + cg + ct)) * log2(ca * 1.0::double / (ca + cc + cg + ct)) else 0.0 end
       + case when cc > 0 then (cc * 1.0::double / (ca + cc + cg + ct)) * log2(cc * 1.0::double / (ca + cc + cg + ct)) else 0.0 end
       + case when cg > 0 then (cg * 1.0::double / (ca + cc + cg + ct)) * log2(cg * 1.0::double / (ca + cc + cg + ct)) else 0.0 end
       + case when ct > 0 then (ct * 1.0::double / (ca + cc + cg + ct)) * log2(ct * 1.0::double / (ca + cc + cg + ct)) else 0.0 end) else 0.0 end as entropy
  from cnt),
dup as (
  select *, row_number() over (partition by accession order by ordinal) > 1 as dup_acc, row_number() over (partition by seq order by ordinal) > 1 as dup_seq from met)
"""
