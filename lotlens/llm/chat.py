"""Chat formatting after cumulative snapshots are collapsed.

A conversation logged after every turn appears as a chain of prefixes. Each turn
gets the rolling hash of all turns up to it (two 64-bit sums without carry over hashes of place, role and text). A
conversation whose whole hash is the hash of a proper prefix of another is anti-joined away, of equal
conversations the one of the smallest id stays; the turns of the rest are rendered with their offsets.

Running values are computed in two levels, inside stretches of CHUNK turn numbers and over the totals of
stretches, so no conversation is ever one task's whole work; repeated prefixes are
made distinct before they are joined.

Edges: a null text or role is empty; turns are ordered by number (null first), then role, then text, and repeated rows are turns of
their own; all rows of a null id are one conversation, which yields to equal ones with an id; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

CHUNK = 1024
SEGMENT = "<|im_start|>{role}\n{text}<|im_end|>\n"


def segments(turns: DataFrame) -> DataFrame:
    """key, conv_id, chunk, turn, role, text, segment of every row."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    head, rest = SEGMENT.split("{role}")
    middle, tail = rest.split("{text}")
    return turns.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"), F.col("conv_id").cast("long").alias("conv_id"),
        F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / CHUNK).alias("chunk"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), text.alias("text"), F.concat(F.lit(head), role, F.lit(middle), text, F.lit(tail)).alias("segment"),
    )


def rolled(turns: DataFrame) -> DataFrame:
    """Per row its place (from 1), offset, prefix hashes p1 and p2, and its conversation's number of turns."""
    own = Window.partitionBy("key", "chunk").orderBy("turn", "role", "text")
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    rows = segments(turns)
    sizes = rows.groupBy("key", "chunk").agg(F.count("*").alias("n"), F.sum(F.length("segment")).alias("chars"))
    before = sizes.select(
        "key", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("chars_before"), F.sum("n").over(Window.partitionBy("key")).alias("turns"),
    )
    placed = rows.withColumns({"_rn": F.row_number().over(own), "_to": F.sum(F.length("segment")).over(upto)}).join(before, ["key", "chunk"])
    place = F.col("_rn") + F.col("n_before")
    placed = placed.select(
        "key", "conv_id", "chunk", place.alias("place"), "turns", "role", "segment",
        (F.col("chars_before") + F.col("_to") - F.length("segment")).alias("offset"),
        F.xxhash64(place, "role", "text").alias("h1"), F.xxhash64("text", place, "role", F.lit(1)).alias("h2"),
    )
    totals = placed.groupBy("key", "chunk").agg(F.bit_xor("h1").alias("t1"), F.bit_xor("h2").alias("t2"))
    sums = totals.select("key", "chunk", *[F.coalesce(F.bit_xor(f"t{i}").over(earlier), F.lit(0)).alias(f"b{i}") for i in (1, 2)])
    inside = Window.partitionBy("key", "chunk").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    hashed = placed.withColumns({f"w{i}": F.bit_xor(f"h{i}").over(inside) for i in (1, 2)}).join(sums, ["key", "chunk"])
    return hashed.select(
        "key", "conv_id", "place", "turns", "role", "segment", "offset",
        *[F.col(f"w{i}").bitwiseXOR(F.col(f"b{i}")).alias(f"p{i}") for i in (1, 2)],
    )


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id, turn_no (from 0), role, segment, offset of the turns of all conversations that prefix no other."""
    rows = written(rolled(turns))
    prefixes = rows.filter("place < turns").select("place", "p1", "p2").distinct()
    whole = rows.filter("place = turns").groupBy("place", "p1", "p2").agg(F.min(F.struct(F.col("conv_id").isNull(), "conv_id", "key"))["key"].alias("key"))
    kept = written(whole.join(prefixes, ["place", "p1", "p2"], "left_anti").select("key"))
    return rows.join(kept, "key", "left_semi").select("conv_id", (F.col("place") - 1).alias("turn_no"), "role", "segment", "offset")
