"""Collapse of cumulative conversation logs, then rendering.

A chat is often logged after every turn, so that one conversation is stored as many
that are prefixes of each other. Each turn gets rolling hashes of the conversation up to
it; a conversation whose last hash is another's hash before its end is a prefix and goes.
Of equal ones the smallest id stays. The rest is rendered, a row per turn, which
concatenate in order to the training text.

Turns are numbered within blocks of ``BLOCK`` turn numbers, and blocks within the
conversation, so that a conversation with very many turns is spread over tasks. Hashes
combine by exclusive or, each turn's hash having its number in it; there are two of 64
bits.

Edge cases: order is by (turn, role, text), NULLs first; turns need not be
numbered without gaps. Rows equal in id, turn, role and text are one. Rows without a
conversation id belong to none and are left out. A NULL role renders as ``unknown``, a
NULL text as empty; both differ from the written-out value. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

BLOCK = 256


def prefixes(conversations: DataFrame) -> DataFrame:
    """Turns with ``position`` from 1, ``n_turns`` and the hashes ``h, g`` of the
    conversation up to here."""
    rows = (
        conversations.select("conv_id", "turn", "role", "text")
        .where("conv_id IS NOT NULL")
        .distinct()
        .withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 40))))
    )
    inside = W.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    so_far = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    blocks = W.partitionBy("conv_id").orderBy("block")
    earlier = blocks.rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy("conv_id")
    numbered = cut(rows.withColumn("place", F.row_number().over(inside)))
    counts = numbered.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id",
        "block",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"),
        F.sum("n").over(every).alias("n_turns"),
    )
    turn_hash = lambda salt: F.xxhash64(
        F.lit(salt), "position", F.col("role").isNull(), "role", F.col("text").isNull(), "text"
    )
    hashed = (
        numbered.join(counts, ["conv_id", "block"])
        .withColumn("position", F.col("ahead") + F.col("place"))
        .drop("ahead")
        .withColumns({"own_h": turn_hash(1), "own_g": turn_hash(2)})
    )
    sums = hashed.groupBy("conv_id", "block").agg(F.bit_xor("own_h").alias("h"), F.bit_xor("own_g").alias("g")).select(
        "conv_id",
        "block",
        F.coalesce(F.bit_xor("h").over(earlier), F.lit(0)).alias("ahead_h"),
        F.coalesce(F.bit_xor("g").over(earlier), F.lit(0)).alias("ahead_g"),
    )
    return hashed.join(sums, ["conv_id", "block"]).select(
        "conv_id",
        "role",
        "text",
        "position",
        "n_turns",
        F.col("ahead_h").bitwiseXOR(F.bit_xor("own_h").over(so_far)).alias("h"),
        F.col("ahead_g").bitwiseXOR(F.bit_xor("own_g").over(so_far)).alias("g"),
    )


def maximal(turns: DataFrame) -> DataFrame:
    """``conv_id`` of the conversations that are no other's prefix, once each."""
    shorter = turns.where("position < n_turns").select("position", "h", "g").distinct()
    whole = turns.where("position = n_turns").groupBy("position", "h", "g").agg(F.min("conv_id").alias("conv_id"))
    return whole.join(shorter, ["position", "h", "g"], "left_anti").select("conv_id")


def rendered(conversations: DataFrame) -> DataFrame:
    """``conv_id, position, n_turns, rendered`` of the conversations that stay."""
    turns = cut(prefixes(conversations))
    line = F.concat(
        F.lit("<|"),
        F.coalesce("role", F.lit("unknown")),
        F.lit("|>\n"),
        F.coalesce("text", F.lit("")),
        F.lit("<|end|>\n"),
    )
    return turns.join(maximal(turns), "conv_id", "left_semi").select(
        "conv_id", "position", "n_turns", line.alias("rendered")
    )
