"""Operator 3 [native]: chat formatting of maximal conversations.

A client that logs the whole conversation after each turn leaves snapshots that
are prefixes of the last one. Every turn's place in its conversation and the
rolling hash of the conversation up to it are window values; a conversation
whose whole hash is the prefix hash of a longer one is removed by an anti-join,
as are all but the first of equal conversations. What remains is rendered in
segments of at most ``SEGMENT`` turns.

The rolling hash is the exclusive-or of two position-tagged 64-bit hashes of
the turns (128 bits), so it is a running aggregate. Long conversations are
split: a turn's place is its rank in a block of ``BLOCK`` turn numbers plus the
number of turns in earlier blocks, and prefix hashes combine the same way, so no
window holds more than a block (and the block table). Prefixes are made distinct
before the join, so a first turn that very many conversations share is one row.
DataFrame functions only.

Defined results: turns that are equal in conversation, number, role and text
are one turn; turns with equal numbers are ordered by role, then a digest of role and text; a null
number comes first; a null role is ``unknown``, a null text empty; a null conv_id
is one conversation like any other. The markers' text inside a turn is broken
by a space after ``<``. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import written

BLOCK = 1024
SEGMENT = 64


def _slim(turns: DataFrame) -> DataFrame:
    """``conv`` (the id as text, nulls told apart), ``turn, role, text, digest``."""
    role = F.coalesce(F.col("role").cast("string"), F.lit("unknown"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return turns.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null")).alias("conv"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(-(1 << 62))).alias("turn"), role.alias("role"), text.alias("text"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"))


def turns_in_place(turns: DataFrame) -> DataFrame:
    """``conv, turn, digest, at`` (from 0), ``n, pa, pb, wa, wb``: each turn's
    place, the conversation's length, the rolling hash up to the turn and that of
    the whole conversation. Texts are not shuffled, only their digests."""
    t = _slim(turns).select("conv", "turn", "role", "digest").distinct()
    t = t.withColumn("block", F.floor(F.col("turn") / BLOCK))
    own, whole = Window.partitionBy("conv", "block"), Window.partitionBy("conv")
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("rank", F.row_number().over(own.orderBy("turn", "role", "digest")))
    blocks = t.groupBy("conv", "block").agg(F.count("*").alias("size")).select(
        "conv", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"), F.sum("size").over(whole).alias("n"))
    t = t.join(blocks, ["conv", "block"]).withColumn("at", F.col("start") + F.col("rank") - 1)
    for c, seed in (("a", 1), ("b", 2)):
        t = t.withColumn(f"h{c}", F.xxhash64(F.lit(seed), "at", "digest"))
    sums = t.groupBy("conv", "block").agg(F.bit_xor("ha").alias("xa"), F.bit_xor("hb").alias("xb")).select(
        "conv", "block", *[F.coalesce(F.bit_xor(f"x{c}").over(before), F.lit(0)).alias(f"o{c}") for c in "ab"],
        *[F.bit_xor(f"x{c}").over(whole).alias(f"w{c}") for c in "ab"])
    inside = own.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    t = t.join(sums, ["conv", "block"])
    for c in "ab":
        t = t.withColumn(f"p{c}", F.bit_xor(f"h{c}").over(inside).bitwiseXOR(F.col(f"o{c}")))
    return t.select("conv", "turn", "digest", "at", "n", "pa", "pb", "wa", "wb")


def maximal_conversations(placed: DataFrame) -> DataFrame:
    """``conv, n, copies``: the conversations that are no prefix of a longer one,
    the first of each set of equal ones (the shortest, then smallest id as text),
    with the number of these."""
    whole = placed.filter("at = 0").groupBy("n", "wa", "wb").agg(
        F.min(F.struct(F.length("conv").alias("size"), "conv")).alias("first"), F.count("*").alias("copies"))
    prefixes = placed.filter(F.col("at") + 1 < F.col("n")).select(
        (F.col("at") + 1).alias("n"), F.col("pa").alias("wa"), F.col("pb").alias("wb")).distinct()
    return whole.join(prefixes, ["n", "wa", "wb"], "left_anti").select(
        F.col("first.conv").alias("conv"), "n", "copies")


def rendered(role: Column, text: Column) -> Column:
    """One turn in chat markup."""
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|im_start|>"), safe(role), F.lit("\n"), safe(text), F.lit("<|im_end|>\n"))


def chat_segments(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``conv_id, segment`` (from 0), ``n_turns`` of the whole conversation,
    ``copies`` and ``chat``: maximal conversations, rendered."""
    placed = written(turns_in_place(turns), "turns")
    kept = placed.join(maximal_conversations(placed), ["conv", "n"]).select("conv", "turn", "digest", "at", "n", "copies")
    t = _slim(turns).select("conv", "turn", "digest", rendered(F.col("role"), F.col("text")).alias("chat"))
    kind = turns.schema["conv_id"].dataType
    return (kept.join(t, ["conv", "turn", "digest"])
            .withColumn("segment", F.floor(F.col("at") / segment))
            .groupBy("conv", "segment")
            .agg(F.first("n").alias("n_turns"), F.first("copies").alias("copies"),
                 F.sort_array(F.collect_set(F.struct("at", "chat"))).alias("parts"))
            .select(F.when(F.col("conv") != "null", F.substring("conv", 2, 1 << 20).cast(kind)).alias("conv_id"),
                    "segment", "n_turns", "copies",
                    F.concat_ws("", F.transform("parts", lambda x: x["chat"])).alias("chat")))
