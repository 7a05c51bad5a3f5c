"""Places of regex matches with built-in functions only, in time linear in the text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from moraine.functions.sequence import let

BLOCK = 256


def located(text: Column, pattern: str, pre: int = 0, post: int = 0) -> Column:
    """array<struct<start,end,value,pre,post>> of the leftmost non-overlapping matches, in code points, end exclusive.

    pre and post hold that many characters around the match, up to the neighbouring match. Matches come from one pass of
    the pattern, the gaps between them from another; offsets are summed over blocks of BLOCK matches first, so a text with
    very many matches costs no quadratic copying. The pattern must not match the empty string.
    """
    kind = "array<struct<start:int,end:int,value:string,pre:string,post:string>>"

    def paired(gaps):
        both = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), gaps, lambda v, g: F.struct(v.alias("v"), g.alias("g")))
        return F.zip_with(both, F.slice(gaps, 2, F.size(gaps)), lambda x, h: F.struct(x["v"].alias("v"), x["g"].alias("g"), F.left(h, F.lit(post)).alias("h")))

    def step(acc, x):
        at = acc["at"] + F.length(x["g"])
        end = at + F.length(F.coalesce(x["v"], F.lit("")))
        keep = F.struct(at.alias("start"), end.alias("end"), x["v"].alias("value"), F.right(x["g"], F.lit(pre)).alias("pre"), x["h"].alias("post"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(keep)).alias("out"))

    def join(acc, x):
        moved = F.transform(x["out"], lambda s: F.struct((s["start"] + acc["at"]).alias("start"), (s["end"] + acc["at"]).alias("end"), s["value"].alias("value"), s["pre"].alias("pre"), s["post"].alias("post")))
        return F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], moved).alias("out"))

    empty = lambda: F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {kind})").alias("out"))
    blocks = lambda pairs, size: F.transform(F.sequence(F.lit(0), F.size(pairs) - 1, F.lit(size)), lambda b: F.aggregate(F.slice(pairs, b + 1, size), empty(), step))

    def gathered(parts, size):  # blocks of blocks, so that lists grow by copying a few times each
        some = F.transform(F.sequence(F.lit(0), F.size(parts) - 1, F.lit(size)), lambda b: F.aggregate(F.slice(parts, b + 1, size), empty(), join))
        return F.aggregate(some, empty(), join, lambda acc: F.filter(acc["out"], lambda s: s["value"].isNotNull()))

    return let(F.split(text, pattern, -1), lambda gaps: let(paired(gaps), lambda pairs: let(blocks(pairs, BLOCK), lambda parts: gathered(parts, BLOCK))))


def cut_out(text: Column, spans: Column, fill: str) -> Column:
    """The text with spans (sorted, apart) overwritten with fill, at its old length. Linear: characters of four bytes have known places."""

    def parts(wide):
        ends = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
        piece = lambda a, n: F.decode(F.substring(wide, 4 * a + 1, 4 * n), "UTF-32")
        return F.zip_with(ends, spans, lambda e, s: F.concat(piece(e, F.coalesce(s["start"], F.length(wide) / 4).cast("int") - e), F.repeat(F.lit(fill), F.coalesce(s["end"] - s["start"], F.lit(0)))))

    return F.when(F.size(spans) > 0, let(F.encode(text, "UTF-32"), lambda wide: F.array_join(parts(wide), ""))).otherwise(text)
