"""Multi-party perspective rotation of dialogues, with DataFrame operations only.

For every participant of a conversation the dialogue is rendered with that speaker as assistant and all others as named
users; messages of ``narrators`` (system) stay what they are and are nobody's perspective. The result is one row a message
and perspective with its segment, the segment's place in the rendered dialogue (characters, end exclusive) and whether it
is trained on, so a conversation of any length never meets in one row: places are sums within blocks of turns plus sums
over blocks. Concatenating segments in msg order is the rendered dialogue, which rendered() does. There are as many rows as
messages times participants, as every perspective has every message.

Messages are ordered by turn (nulls last), speaker, text; equal rows are separate messages. A null speaker is "unknown", a
null text is empty, a null conversation id is a conversation of its own. Conversations of narrators alone have no
perspectives. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moraine.llm.common import table

BLOCK = 64


def rotate(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text", narrators: tuple[str, ...] = ("system",)) -> DataFrame:
    """conv_id, perspective, msg, turn, role, name, segment, seg_start, seg_end, mask_start, mask_end, train."""
    who = F.coalesce(F.col(speaker), F.lit("unknown"))
    said = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), who.alias("name"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    narrator = F.col("name").isin(*narrators)
    people = said.where(~narrator).select(F.col("conv_id").alias("c"), F.col("name").alias("perspective")).distinct()
    rows = said.join(people, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    role = F.when(narrator, F.col("name")).when(F.col("name") == F.col("perspective"), F.lit("assistant")).otherwise(F.lit("user"))
    rows = rows.withColumn("role", role).withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(9223372036854775807)))
    head = F.when(F.col("role") == "user", F.concat(F.lit("<|user name="), F.col("name"), F.lit("|>"))).otherwise(F.concat(F.lit("<|"), F.col("role"), F.lit("|>")))
    rows = rows.withColumn("segment", F.concat(head, F.col("text"), F.lit("<|end|>\n"))).withColumn("h", F.length(head))
    size = F.length("segment").cast("long")
    sums = rows.groupBy("conv_id", "perspective", "block").agg(F.sum(size).alias("chars"), F.count("*").alias("msgs"))
    before = Window.partitionBy("conv_id", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("conv_id").alias("c"), F.col("perspective").alias("p"), F.col("block").alias("b"), F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("chars0"), F.coalesce(F.sum("msgs").over(before), F.lit(0)).alias("msgs0"))
    order = Window.partitionBy("conv_id", "perspective", "block").orderBy(F.col("turn").asc_nulls_last(), "name", "text")
    rows = rows.withColumn("own", F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("nth", F.row_number().over(order))
    rows = rows.join(sums, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("perspective") == F.col("p")) & (F.col("block") == F.col("b")))
    start = F.col("chars0") + F.col("own")
    train = F.col("role") == "assistant"
    return rows.select(
        "conv_id", "perspective", (F.col("msgs0") + F.col("nth") - 1).alias("msg"), "turn", "role", "name", "segment",
        start.alias("seg_start"), (start + size).alias("seg_end"),
        F.when(train, start + F.col("h")).alias("mask_start"), F.when(train, start + size - 1).alias("mask_end"), train.alias("train"),
    )


def rendered(turns: DataFrame, **how) -> DataFrame:
    """conv_id, perspective, dialogue, masks (array of struct start, end): whole dialogues, each in one row, so it must fit one."""
    part = rotate(turns, **how)
    listed = F.array_sort(F.collect_list(F.struct("msg", "segment", "mask_start", "mask_end", "train")))
    got = part.groupBy("conv_id", "perspective").agg(listed.alias("m"))
    masks = F.transform(F.filter("m", lambda x: x["train"]), lambda x: F.struct(x["mask_start"].alias("start"), x["mask_end"].alias("end")))
    return got.select("conv_id", "perspective", F.array_join(F.transform("m", lambda x: x["segment"]), "").alias("dialogue"), masks.alias("masks"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))


ORACLE = """
with said as (select conv_id, turn, coalesce(role, 'unknown') as name, coalesce(text, '') as text from conversations),
people as (select distinct conv_id as c, name as perspective from said where name <> 'system'),
seg as (
  select conv_id, perspective, turn, name, text,
    case when name = 'system' then name when name = perspective then 'assistant' else 'user' end as role
  from said join people on conv_id is not distinct from c),
headed as (select *, case when role = 'user' then '<|user name=' || name || '|>' else '<|' || role || '|>' end as head from seg),
placed as (
  select *, head || text || '<|end|>' || chr(10) as segment,
    coalesce(sum(length(head) + length(text) + 8) over (partition by conv_id, perspective order by turn nulls last, name, text
      rows between unbounded preceding and 1 preceding), 0) as seg_start,
    row_number() over (partition by conv_id, perspective order by turn nulls last, name, text) as nth
  from headed)
select conv_id, perspective, cast(nth - 1 as bigint) as msg, turn, role, name, segment,
  cast(seg_start as bigint) as seg_start, cast(seg_start + length(segment) as bigint) as seg_end,
  cast(case when role = 'assistant' then seg_start + length(head) end as bigint) as mask_start,
  cast(case when role = 'assistant' then seg_start + length(segment) - 1 end as bigint) as mask_end,
  role = 'assistant' as train
from placed
"""
