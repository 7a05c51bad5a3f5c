"""Writers: FASTA, delimited tables, splits, snapshots and a static report."""

from __future__ import annotations

import html
import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moraine.functions.names import wrapped


def fasta_text(header: Column, seq: Column, width: int = 80) -> Column:
    return F.concat(F.when(F.startswith(header, F.lit(">")), header).otherwise(F.concat(F.lit(">"), header)), F.lit("\n"), wrapped(F.upper(seq), width))


def write_fasta(df: DataFrame, path: str, header: str = "header", seq: str = "seq", mode: str = "overwrite") -> None:
    """One file a partition; order within them is that of the rows."""
    df.select(fasta_text(F.col(header), F.col(seq)).alias("value")).write.mode(mode).text(path)


def write_split_fasta(df: DataFrame, path: str, by: str, header: str = "header", seq: str = "seq", accession: str = "accession", mode: str = "append") -> None:
    """A folder for each value of ``by``; the first record of an accession wins."""
    from pyspark.sql import Window

    first = df.withColumn("_n", F.row_number().over(Window.partitionBy(accession).orderBy("ordinal"))).where("_n = 1")
    safe = F.regexp_replace(F.col(by), "[^A-Za-z0-9_.:-]", "_")
    first.select(safe.alias(by), fasta_text(F.col(header), F.col(seq)).alias("value")).write.mode(mode).partitionBy(by).text(path)


def write_decisions(df: DataFrame, folder: str, keep_review: bool = True, keep_reject: bool = True) -> None:
    """The decisions table and FASTA folders by decision."""
    write_tsv(df.drop("seq").withColumn("reasons", F.array_join("reasons", ";")), f"{folder}/decisions")
    kept = ["KEEP"] + ["REVIEW"] * keep_review + ["REJECT"] * keep_reject
    write_split_fasta(df.where(F.col("decision").isin(*kept)).withColumn("accession", F.col("record_key")), f"{folder}/fasta", "decision", mode="overwrite")


def flat(df: DataFrame) -> DataFrame:
    """Arrays joined by ";" and other nested values as JSON, for text formats."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        out.append((F.array_join(c, ";") if kind == "array<string>" else F.to_json(c) if kind.startswith(("array", "struct", "map")) else c).alias(name))
    return df.select(*out)


def write_tsv(df: DataFrame, path: str, columns: list[str] | None = None, mode: str = "overwrite") -> None:
    flat(df.select(*columns) if columns else df).write.mode(mode).csv(path, sep="\t", header=True, emptyValue="", nullValue="")


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, mode: str = "overwrite") -> None:
    flat(df.select(*columns) if columns else df).write.mode(mode).csv(path, header=True, emptyValue="", nullValue="")


def write_sheets(sheets: dict[str, DataFrame], folder: str) -> None:
    """A workbook as one table a sheet."""
    for name, df in sheets.items():
        write_tsv(df, f"{folder}/{name}")


def write_groups(df: DataFrame, folder: str, group: str) -> None:
    """One folder a group, in one pass."""
    flat(df).write.mode("overwrite").partitionBy(group).csv(folder, sep="\t", header=True)


def write_text(spark, lines: Iterable[str], path: str) -> None:
    """A few driver-made lines, through Spark so that any store works."""
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(path)


def snapshot(spark, path: str, config: dict, command: list[str] = ()) -> None:
    plain = lambda v: {k: plain(x) for k, x in v.items()} if hasattr(v, "items") else [plain(x) for x in v] if isinstance(v, (list, tuple, set, frozenset)) else v
    write_text(spark, [json.dumps({"config": plain(config), "command": list(command)}, sort_keys=True)], path)


def html_report(title: str, tables: dict[str, DataFrame], most_rows: int = 500) -> str:
    """A static page over small aggregates; a table's first rows only, as a page shows no more."""
    out = [f"<!doctype html><meta charset='utf-8'><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>"]
    for name, df in tables.items():
        rows = df.limit(most_rows).collect()
        out.append(f"<h2>{html.escape(name)}</h2><table><tr>{''.join(f'<th>{html.escape(c)}</th>' for c in df.columns)}</tr>")
        out += [f"<tr>{''.join(f'<td>{html.escape(str(v))}</td>' for v in r)}</tr>" for r in rows]
        out.append("</table>")
    return "\n".join(out)
