"""Scratch tables in the shared folder, sizes before broadcasts, and components of a graph."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20

_roots: dict[str, str] = {}
_open: list[list[str]] = []


def _filesystem(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application in the one that spark.checkpoint.dir names; it goes when the session ends.

    Where the setting is missing a local session gets a temporary folder; a cluster must name one that all machines see.
    """
    app = spark.sparkContext.applicationId
    if app not in _roots:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if spark.sparkContext.master.split("[")[0] != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            named = "file://" + tempfile.mkdtemp(prefix="moraine-")
        _roots[app] = f"{named.rstrip('/')}/moraine-{uuid.uuid4().hex}"
        fs, p = _filesystem(spark, _roots[app])
        fs.deleteOnExit(p)
    return _roots[app]


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends here and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _open:
        _open[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for t in tables:
        fs, p = _filesystem(t.sparkSession, t._scratch)
        fs.delete(p, True)


@contextlib.contextmanager
def workspace(spark: SparkSession) -> Iterator[Callable]:
    """Tables stored inside are deleted at its end, but for those given to the function that it yields."""
    kept: set[str] = set()

    def keep(*tables: DataFrame):
        kept.update(t._scratch for t in tables)
        return tables[0] if len(tables) == 1 else tables

    _open.append([])
    try:
        yield keep
    finally:
        for path in _open.pop():
            if path in kept:
                if _open:
                    _open[-1].append(path)
            else:
                fs, p = _filesystem(spark, path)
                fs.delete(p, True)


def width(value: Column, kind: T.DataType) -> Column:
    """Bytes that a value takes in memory, roughly."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long") + 16
    if isinstance(kind, T.StructType):
        return sum((width(value[f.name], f.dataType) for f in kind.fields), F.lit(16).cast("long"))
    if isinstance(kind, T.ArrayType):
        each = F.aggregate(F.coalesce(value, F.array().cast(kind)), F.lit(0).cast("long"), lambda acc, x: acc + width(x, kind.elementType))
        return each + 24
    return F.lit(8).cast("long")


def small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a stored df only if its rows take at most ``most`` bytes in memory; otherwise the join is left to the planner."""
    total = sum((width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(16).cast("long"))
    return F.broadcast(df) if (df.agg(F.sum(total)).first()[0] or 0) <= most else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until df has no column called so."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, root) for every id in edges (a, b); root is the smallest id reachable. Stored.

    Alternating large-star and small-star rounds: each round links every vertex and its larger
    (then smaller) neighbours to the smallest one near by, so a chain shortens geometrically and no
    vertex list is gathered into one row. Every round is stored; nothing is collected.
    """
    with workspace(edges.sparkSession) as keep:
        pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
        pairs = stored(pairs, "cc")
        seen = None
        for _ in range(max_rounds):
            # large star: every larger neighbour of x is tied to the smallest of x and its neighbours
            both = pairs.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(pairs.select(F.col("v").alias("x"), F.col("u").alias("y")))
            least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
            large = both.where("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
            # small star: every smaller neighbour of x, and x, is tied to the smallest of them
            low = large.groupBy("u").agg(F.min("v").alias("m"))
            tied = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
            was, pairs = pairs, stored(tied.where("u <> v").distinct(), "cc")
            drop(was)
            now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
            if now == seen:
                break
            seen = now
        else:
            raise RuntimeError("components did not settle")
        keep(pairs)
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("root"))
