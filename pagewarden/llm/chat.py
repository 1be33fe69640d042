"""Chat formatting after a collapse of cumulative snapshots, with DataFrame functions only.

A logged conversation that is the beginning of a longer one is a snapshot of it. Each turn's content (place, role, text) is
hashed twice; the running exclusive-or over the turns is a rolling hash of every prefix. A conversation whose whole hash is
a proper prefix's hash of another one goes by an anti-join against the distinct prefixes; of equal conversations the one
with the smallest conv_id stays. What remains is rendered, turn by turn, into segments of at most ``SEGMENT`` turns.

Turns are ordered by (turn, role, text), nulls first; a repeated row is one turn more; null roles and texts are values of
their own and render as empty. Turns with a null conv_id form one conversation. Places and hashes of a conversation come
from two levels of windows, over its part in each range partition and over the parts, so a conversation with a third of all
turns is not gathered in one task. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .blocks import stored, width

SEGMENT = 500
# The marks around a rendered turn.
START, MIDDLE, STOP = "<|im_start|>", "\n", "<|im_end|>\n"


def _content(*columns: str) -> list[Column]:
    """Values and their nullness, as xxhash64 passes over nulls."""
    return [x for c in columns for x in (F.col(c).isNull(), F.coalesce(F.col(c), F.lit("")))]


def prefixes(turns: DataFrame) -> DataFrame:
    """Every turn with its place (from 1) and the hashes a, b of the conversation up to it, and n, all_a, all_b of the whole."""
    turns = turns.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    dealt = turns.select("*", F.xxhash64(*_content("role", "text")).alias("h"))
    n = width(turns.sparkSession)
    dealt = stored(dealt.repartitionByRange(n, "conv_id", "turn", "h").withColumn("part", F.spark_partition_id()), "chat-turns")

    inside = W.partitionBy("conv_id", "part").orderBy("turn", "role", "text", "h")
    keyed = dealt.select("conv_id", "part", "turn", "role", "text", "h")
    counted = keyed.groupBy("conv_id", "part").agg(F.count("*").alias("own"))
    over = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    counted = counted.select("conv_id", "part", F.coalesce(F.sum("own").over(over), F.lit(0)).alias("before"))
    placed = keyed.join(counted.select(F.col("conv_id").alias("c2"), F.col("part").alias("p2"), "before"), F.col("conv_id").eqNullSafe(F.col("c2")) & (F.col("part") == F.col("p2")))
    placed = placed.select("conv_id", "part", "turn", "role", "text", "h", (F.col("before") + F.row_number().over(inside)).alias("place"))
    hashed = placed.withColumn("a", F.xxhash64(F.lit(1), "place", *_content("role", "text"))).withColumn("b", F.xxhash64(F.lit(2), "h", "place"))
    hashed = hashed.drop("h")

    local = W.partitionBy("conv_id", "part").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    whole = hashed.groupBy("conv_id", "part").agg(F.bit_xor("a").alias("pa"), F.bit_xor("b").alias("pb"), F.count("*").alias("pn"))
    every = W.partitionBy("conv_id")
    whole = whole.select(F.col("conv_id").alias("c2"), F.col("part").alias("p2"), F.coalesce(F.bit_xor("pa").over(over), F.lit(0)).alias("oa"), F.coalesce(F.bit_xor("pb").over(over), F.lit(0)).alias("ob"), F.sum("pn").over(every).alias("n"), F.bit_xor("pa").over(every).alias("all_a"), F.bit_xor("pb").over(every).alias("all_b"))
    run = hashed.select("*", F.bit_xor("a").over(local).alias("la"), F.bit_xor("b").over(local).alias("lb"))
    run = run.join(whole, F.col("conv_id").eqNullSafe(F.col("c2")) & (F.col("part") == F.col("p2")))
    return run.select("conv_id", "turn", "role", "text", "place", F.col("la").bitwiseXOR(F.col("oa")).alias("a"), F.col("lb").bitwiseXOR(F.col("ob")).alias("b"), "n", "all_a", "all_b")


def maximal(turns: DataFrame) -> DataFrame:
    """The turns, with place and n, of the conversations that no other one contains as a beginning."""
    every = stored(prefixes(turns), "chat-prefixes")
    whole = every.where("place = n").groupBy("n", "a", "b").agg(F.min(F.struct(F.col("conv_id").isNull().alias("last"), "conv_id")).alias("kept"))
    longer = every.where("place < n").select(F.col("place").alias("n"), "a", "b").distinct()
    kept = whole.join(longer, ["n", "a", "b"], "left_anti").select(F.col("kept.conv_id").alias("k"))
    return every.join(kept, F.col("conv_id").eqNullSafe(F.col("k")), "left_semi").select("conv_id", "turn", "role", "text", "place", "n")


def render(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Rows (conv_id, segment, n_turns, n_assistant, rendered): the maximal conversations as chat text."""
    line = F.concat(F.lit(START), F.coalesce("role", F.lit("")), F.lit(MIDDLE), F.coalesce("text", F.lit("")), F.lit(STOP))
    rows = maximal(turns).select("conv_id", F.floor((F.col("place") - 1) / segment).cast("int").alias("segment"), F.struct("place", line.alias("line")).alias("x"), (F.col("role") == "assistant").alias("answer"), "n")
    out = rows.groupBy("conv_id", "segment").agg(F.max("n").cast("long").alias("n_turns"), F.count_if("answer").alias("n_assistant"), F.sort_array(F.collect_list("x")).alias("x"))
    return out.select("conv_id", "segment", "n_turns", "n_assistant", F.array_join(F.transform("x", lambda x: x["line"]), "").alias("rendered"))
