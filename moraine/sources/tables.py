"""Delimited tables, rule tables, tool tables, taxonomy dumps and landed JSON."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moraine.functions.names import library_stem, plain

# Columns of tool tables in their order.
TAXONOMY_HITS = "qseqid string, saccver string, pident string, length string, qlen string, qstart string, qend string, evalue string, bitscore string, staxids string, sscinames string"
VECTOR_HITS = "qseqid string, sseqid string, pident string, length string, qstart string, qend string, sstart string, send string, evalue string, bitscore string"


def head(spark: SparkSession, path: str) -> str:
    """The first line of a file or folder, through Spark, so that any store works."""
    got = spark.read.text(path).limit(1).collect()
    return got[0][0].lstrip("﻿") if got else ""


def sniff(line: str) -> str:
    """Tab, semicolon or comma, by which is commonest; comma where none is there."""
    return max((",", "\t", ";"), key=lambda c: (line.count(c), c == ","))


def read_table(spark: SparkSession, path: str, sep: str | None = None, ordinal: bool = True, comment: str | None = None) -> DataFrame:
    """A delimited table with a header, all strings, trimmed; ordinal is the row's place in a single file. Lines that begin with the comment sign are skipped."""
    df = spark.read.csv(path, header=True, sep=sep or sniff(head(spark, path)), multiLine=False, comment=comment)
    df = df.select(*(F.trim(F.col(f"`{c}`")).alias(c.strip().lstrip("﻿")) for c in df.columns))
    return df.withColumn("ordinal", F.monotonically_increasing_id()) if ordinal else df


def _content(spark: SparkSession, path: str) -> bytes:
    """A small file's bytes, through Spark, so that any store works."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def read_excel(spark: SparkSession, path: str, sheet: str | int = 0) -> DataFrame:
    """A workbook's sheet as strings, blanks null, its first row being the header. A workbook is one zip of XML, small by nature, so it goes through the driver."""
    ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(_content(spark, path))) as z:
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        names = [s.get("name") for s in book.iter(ns + "sheet")]
        at = names.index(sheet) if isinstance(sheet, str) else sheet
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(ns + "t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(ns + "si")]
        rows = []
        for row in ElementTree.fromstring(z.read(f"xl/worksheets/sheet{at + 1}.xml")).iter(ns + "row"):
            cells = {}
            for i, c in enumerate(row.iter(ns + "c")):
                letters = re.match("[A-Z]*", c.get("r") or "").group()
                place = sum((ord(x) - 64) * 26**k for k, x in enumerate(reversed(letters))) - 1 if letters else i
                value = c.findtext(ns + "v")
                text = "".join(t.text or "" for t in c.iter(ns + "t")) if c.get("t") == "inlineStr" else shared[int(value)] if c.get("t") == "s" and value else value
                cells[place] = (text or "").strip() or None
            rows.append(cells)
    if not rows:
        raise ValueError(f"an empty sheet: {path}")
    columns = [(i, n) for i, n in sorted(rows[0].items()) if n]
    return spark.createDataFrame([tuple(r.get(i) for i, _ in columns) for r in rows[1:]], ", ".join(f"`{n}` string" for _, n in columns))


def read_export(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables of a zipped export by kind (kind_of_export); an export is small, so its files go through the driver."""
    out = {}
    with zipfile.ZipFile(io.BytesIO(_content(spark, path))) as z:
        for name in sorted(z.namelist()):
            if name.lower().endswith((".csv", ".tsv", ".txt")):
                lines = z.read(name).decode("utf-8-sig", "replace").splitlines()
                if len(lines) > 1:
                    rows = list(csv.reader(lines, delimiter=sniff(lines[0])))
                    columns = [c.strip() for c in rows[0]]
                    kind = kind_of_export(name.rsplit("/", 1)[-1], columns)
                    got = [tuple((r + [""] * len(columns))[i].strip() or None for i in range(len(columns))) for r in rows[1:]]
                    out.setdefault(kind, spark.createDataFrame(got, ", ".join(f"`{c}` string" for c in columns)))
    return out


def expanded(spark: SparkSession, paths: list[str]) -> list[str]:
    """Folders replaced by their tables: .tsv files by name, then .csv files; files stay. A path without any is an error."""
    jvm, out = spark._jvm, []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(p):
            raise ValueError(f"no such path: {path}")
        found = sorted(s.getPath().toString() for s in fs.listStatus(p)) if fs.getFileStatus(p).isDirectory() else None
        inside = [path] if found is None else [f for e in (".tsv", ".csv") for f in found if f.lower().endswith(e)]
        if not inside:
            raise ValueError(f"no tables in {path}")
        out += inside
    return out


def matrix_columns(spark: SparkSession, paths: list[str], keys: tuple[str, ...] = ("tax_id", "tax_name", "tax_rank", "taxon_id", "#Datasets", "Name", "Taxon", "rank")) -> DataFrame:
    """column, stem, file, ordinal of the libraries of count matrices, from their header lines only; the first of a stem wins."""
    rows = []
    for path in paths:
        line = head(spark, path)
        rows += [(c.strip().strip('"'), path) for c in line.split(sniff(line)) if c.strip().strip('"') not in keys]
    df = spark.createDataFrame([(c, f, i) for i, (c, f) in enumerate(rows)], "column string, file string, ordinal long")
    return df.groupBy(library_stem(F.col("column")).alias("stem")).agg(*(F.min_by(c, "ordinal").alias(c) for c in ("column", "file")), F.min("ordinal").alias("ordinal"))


def damage_table(spark: SparkSession, path: str) -> DataFrame:
    """sample, tax_id, tax_name, tax_rank, tax_path, n_reads, n_alignments, damage, significance, rho, map_valid, ordinal.

    Only these columns are read; names lose blanks and ranks case, and a fit that is not said to be valid is not.
    """
    numbers = {"N_reads": "n_reads", "N_alignments": "n_alignments", "damage": "damage", "significance": "significance", "rho_Ac": "rho"}
    t = read_table(spark, path)
    has = lambda c: F.col(c) if c in t.columns else F.lit(None).cast("string")
    num = [has(c).try_cast("double").alias(n) for c, n in numbers.items()]
    return t.select("sample", "tax_id", plain(F.col("tax_name")).alias("tax_name"), F.lower(plain(F.col("tax_rank"))).alias("tax_rank"), has("tax_path").alias("tax_path"), *num, F.coalesce(F.lower(has("MAP_valid")).isin("true", "1"), F.lit(False)).alias("map_valid"), "ordinal")


def sample_names(spark: SparkSession, path: str) -> DataFrame:
    """The distinct samples of a damage table; no other column is read."""
    return read_table(spark, path, ordinal=False).select("sample").where("sample <> ''").distinct()


def aliased(df: DataFrame, aliases: dict[str, list[str]], required: tuple[str, ...] = ()) -> DataFrame:
    """Columns renamed to the first alias that is there; others stay. A required one without any is an error."""
    picked = {name: next((c for c in cand if c in df.columns), None) for name, cand in aliases.items()}
    if lost := [n for n in required if picked.get(n) is None]:
        raise ValueError(f"no column for {', '.join(lost)}; there are {', '.join(df.columns)}")
    taken = {c for c in picked.values() if c}
    return df.select(*(F.col(f"`{c}`").alias(n) for n, c in picked.items() if c), *(F.col(f"`{c}`") for c in df.columns if c not in taken))


def rules(spark: SparkSession, path: str, columns: list[str], needed: tuple[str, ...]) -> list[dict]:
    """Rows of a small rule table in order; rows without a needed value go. Rules become expressions, so they are read on the driver."""
    df = read_table(spark, path, "\t", comment="#")
    cols = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]
    ok = F.lit(True)
    for c in needed:
        ok = ok & (F.coalesce(F.col(c), F.lit("")) != "")
    return [r.asDict() for r in df.where(ok).orderBy("ordinal").select(*cols).collect()]


def adapters(spark: SparkSession, path: str) -> list[tuple[str, str, int]]:
    got = rules(spark, path, ["name", "sequence", "max_mismatch"], ("name", "sequence"))
    return [(r["name"], re.sub(r"\s+", "", r["sequence"]).upper(), int(r["max_mismatch"] or 0)) for r in got]


def keywords(spark: SparkSession, path: str) -> list[tuple[str, str, str]]:
    return [(r["keyword"], (r["action"] or "review").lower(), r["reason"] or "") for r in rules(spark, path, ["keyword", "action", "reason"], ("keyword",))]


def regions(spark: SparkSession, path: str, enable: set[str] = frozenset(), disable: set[str] = frozenset()) -> list[tuple[str, str, str]]:
    """(class, id, regex) of rules enabled by the table or by name."""
    got = rules(spark, path, ["region_id", "class", "enabled_default", "regex"], ("region_id",))
    on = lambda r: (r["region_id"] in enable or (r["enabled_default"] or "1").lower() in ("1", "true", "yes", "y")) and r["region_id"] not in disable
    return [(r["class"] or "Other", r["region_id"], r["regex"]) for r in got if on(r) and r["regex"]]


def species_kingdom(spark: SparkSession, path: str) -> DataFrame:
    """species, genus, kingdom, ordinal. Without a header, a second column that reads as a kingdom is one, else it is the genus."""
    from moraine.operators.rules import kingdom

    first = head(spark, path)
    if first.lower().startswith("species"):
        df = read_table(spark, path, "\t")
        low = {c.lower(): c for c in df.columns}
        get = lambda n: F.col(low[n]) if n in low else F.lit("")
        return df.select(get("species").alias("species"), get("genus").alias("genus"), get("kingdom").alias("kingdom"), "ordinal")
    parts = F.split("value", "\t")
    df = spark.read.text(path).where(F.trim("value") != "").select(F.transform(parts, F.trim).alias("p"), F.monotonically_increasing_id().alias("ordinal"))
    b, c = F.get("p", F.lit(1)), F.get("p", F.lit(2))
    short = c.isNull() | (kingdom(b) != "Unknown")
    return df.where(F.size("p") >= 2).select(F.get("p", F.lit(0)).alias("species"), F.when(short, F.substring_index(F.get("p", F.lit(0)), " ", 1)).otherwise(b).alias("genus"), F.when(short, b).otherwise(c).alias("kingdom"), "ordinal")


def hits(spark: SparkSession, path: str, schema: str = TAXONOMY_HITS) -> DataFrame:
    """A tool's table without header; rows that are short or whose numbers do not parse are left out."""
    names = [f.name for f in T._parse_datatype_string(schema).fields]
    df = spark.read.csv(path, sep="\t", schema=schema, mode="PERMISSIVE").withColumn("ordinal", F.monotonically_increasing_id())
    kinds = {"pident": "double", "bitscore": "double", **dict.fromkeys(("length", "qlen", "qstart", "qend", "sstart", "send"), "int")}
    df = df.select(*(F.col(n).try_cast(kinds[n]).alias(n) if n in kinds else F.col(n) for n in names), "ordinal")
    must = [n for n in ("pident", "length", "qlen") if n in names] + [names[-1]]
    ok = F.lit(True)
    for n in must:
        ok = ok & F.col(n).isNotNull()
    return df.where(ok)


def clusters(spark: SparkSession, path: str) -> DataFrame:
    """type, cluster, query, target, ordinal of a cluster file."""
    p = F.split("value", "\t")
    df = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("ordinal")).where(~F.startswith("value", F.lit("#")) & (F.size(p) >= 9))
    return df.select(F.get(p, F.lit(0)).alias("type"), F.get(p, F.lit(1)).alias("cluster"), F.get(p, F.lit(8)).alias("query"), F.get(p, F.lit(9)).alias("target"), "ordinal")


def chimeras(spark: SparkSession, path: str) -> DataFrame:
    p = F.split("value", "\t")
    return spark.read.text(path).where(F.size(p) >= 18).select(F.get(p, F.lit(1)).alias("query"), F.trim(F.get(p, F.lit(17))).alias("verdict"))


def taxdump(spark: SparkSession, nodes: str, names: str) -> DataFrame:
    """taxid, parent, rank, name of a pipe-delimited dump; scientific names only, bad numbers left out."""
    col = lambda i: F.btrim(F.get(F.split("value", r"\|"), F.lit(i)), F.lit(" \t"))
    n = spark.read.text(nodes).select(col(0).try_cast("long").alias("taxid"), col(1).try_cast("long").alias("parent"), col(2).alias("rank")).where("taxid is not null and parent is not null")
    m = spark.read.text(names).where(col(3) == "scientific name").select(col(0).try_cast("long").alias("taxid"), col(1).alias("name")).where("taxid is not null")
    return n.join(m.groupBy("taxid").agg(F.last("name").alias("name")), "taxid", "left")


def landed_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Rows of landed JSON: a list, an object with data or records, or one object a line."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.json(path, multiLine=True)
    for wrapper in ("data", "records"):
        if wrapper in df.columns and isinstance(df.schema[wrapper].dataType, T.ArrayType):
            return df.select(F.explode(wrapper).alias("r")).select("r.*")
    return df


def collection_records(rows: DataFrame) -> DataFrame:
    """Nested collection occurrences as flat rows; ordinal by id, repeated ids once."""
    has = {f.name: {g.name for g in f.dataType.fields} for f in rows.schema.fields if isinstance(f.dataType, T.StructType)}
    get = lambda a, b: F.col(f"{a}.{b}") if b in has.get(a, ()) else F.lit(None)
    flat = rows.select(F.col("occid").cast("long").alias("ordinal"), get("sample", "taxonid").cast("string").alias("taxon_id"), get("sample", "taxonname").cast("string").alias("name"), get("site", "siteid").cast("string").alias("site_id"), get("site", "datasetid").cast("string").alias("dataset_id"), get("site", "database").cast("string").alias("database"), get("site", "datasettype").cast("string").alias("dataset_type"), get("age", "ageyounger").cast("double").alias("age_young"), get("age", "ageolder").cast("double").alias("age_old"))
    return flat.dropDuplicates(["ordinal"])


def best_of(df: DataFrame, candidates: list[str]) -> Column:
    from moraine.operators.occurrences import first_filled

    return first_filled(df, candidates)


def kind_of_export(name: str, columns: list[str]) -> str:
    """species, localities, links or merged, by a file's name, then by its columns."""
    low, cols = name.lower(), {re.sub("[^a-z]", "", c.lower()) for c in columns}
    species, locality = bool(cols & {"species", "speciesid", "sciname", "taxon"}), bool(cols & {"locality", "localityid", "latitude"})
    if "link" in low or ("loc" in low and "sp" in low and "ecies" in low):
        return "links"
    if low.startswith("loc") or (locality and not species):
        return "localities"
    if low.startswith("sp") and not locality:
        return "species"
    return "merged" if species and locality else "species"
