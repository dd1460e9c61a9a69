"""Mergeable token diversity (M2, approximate).

A batch's distinct tokens are kept as an HLL sketch: a few kilobytes, written beside the
batch's totals. Sketches of batches, languages or runs are merged without reading a text
again, and running totals of unique tokens are unions in levels, as in M5.

``LG_K`` = 14 gives a standard error of 0.83 / sqrt(2^14) = 0.65 %; estimates are held to
``TOLERANCE`` (more than seven standard errors) wherever an exact count is at hand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from synthtext.functions.ratios import safe_div

LG_K = 14
TOLERANCE = 0.05


def token_sketches(df: DataFrame, tokens: Column | str, group_cols: Sequence[str] = ()) -> DataFrame:
    """``(group_cols, sketch, total_tokens)``; a group without tokens has a null sketch.
    Sketches are combined map-side: a hot group costs one row a map task."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    rows = df.select(*group_cols, F.explode_outer(t).alias("__token"))
    return rows.groupBy(*group_cols).agg(
        F.when(F.count("__token") > 0, F.hll_sketch_agg("__token", LG_K)).alias("sketch"),
        F.count("__token").alias("total_tokens"))


def merge_sketches(sketches: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """The sketches and totals of coarser groups."""
    return sketches.groupBy(*group_cols).agg(
        F.when(F.count("sketch") > 0, F.hll_union_agg("sketch")).alias("sketch"),
        F.coalesce(F.sum("total_tokens"), F.lit(0)).cast("bigint").alias("total_tokens"))


def unique_tokens(sketch: Column | str) -> Column:
    """Estimated distinct tokens of a sketch, 0 for none."""
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0)).cast("bigint")


def approx_diversity(sketches: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """``(group_cols, unique_tokens, total_tokens, unique_ratio)``, the unique tokens estimated."""
    d = sketches.select(*group_cols, unique_tokens("sketch").alias("unique_tokens"), "total_tokens")
    return d.withColumn("unique_ratio", safe_div("unique_tokens", "total_tokens"))


def running_sketches(sketches: DataFrame, order_col: str, partition_cols: Sequence[str] = (),
                     block_size: int = 256, levels: int = 2, exclusive: bool = False) -> DataFrame:
    """Per row the union of the sketches up to it (``sketch``) and the running ``total_tokens``.

    A scan in levels: blocks of ``block_size`` consecutive ``order_col`` values are united,
    each block's carry is the same problem one level up, and each row adds what its
    own block holds so far. A window holds one block; the top one ``rows / block_size^levels``.
    ``order_col`` is integral and unique per partition group.
    """
    end = -1 if exclusive else Window.currentRow

    def so_far(w):
        return [F.hll_union_agg("sketch").over(w).alias("__own"), F.coalesce(F.sum("total_tokens").over(w), F.lit(0)).alias("__n"),
                F.count("sketch").over(w).alias("__any")]

    keys = [*partition_cols, order_col]
    if levels <= 0:
        w = Window.partitionBy(*partition_cols).orderBy(order_col).rowsBetween(Window.unboundedPreceding, end)
        return sketches.select(*keys, *so_far(w)).select(
            *keys, F.when(F.col("__any") > 0, F.col("__own")).alias("sketch"), F.col("__n").alias("total_tokens"))
    block = f"__block{levels}"
    keyed = sketches.withColumn(block, F.floor(F.col(order_col) / F.lit(block_size)))
    carry = running_sketches(merge_sketches(keyed, [*partition_cols, block]), block, partition_cols, block_size,
                             levels - 1, exclusive=True).withColumnsRenamed({"sketch": "__before", "total_tokens": "__sum"})
    w = Window.partitionBy(*partition_cols, block).orderBy(order_col).rowsBetween(Window.unboundedPreceding, end)
    own = F.when(F.col("__any") > 0, F.col("__own"))
    both = F.when(F.col("__before").isNull(), own).when(own.isNull(), F.col("__before")).otherwise(
        F.hll_union("__before", own))
    return keyed.select(*keys, block, *so_far(w)).join(carry, [*partition_cols, block]).select(
        *keys, both.alias("sketch"), (F.col("__n") + F.col("__sum")).cast("bigint").alias("total_tokens"))
