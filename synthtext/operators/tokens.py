"""Token array operators on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def batch_width(tokens_col: str, batch_col: str = "batch_id"):
    """The longest token array of the row's batch (a window per batch,
    bounded by the batch size)."""
    return F.max(F.size(F.col(tokens_col))).over(Window.partitionBy(batch_col))


def pad_batch(
    df: DataFrame, tokens_col: str, pad, side: str = "right", batch_col: str = "batch_id",
    out_col: str = "input_ids", mask_col: str = "attention_mask",
) -> DataFrame:
    """Pad every row to the longest row of its batch, with an attention mask.

    ``pad`` is the pad token (the end-of-sequence token when the tokenizer has
    no pad token); ``side`` is the tokenizer's padding side.
    """
    if side not in ("left", "right"):
        raise ValueError("padding side must be 'left' or 'right'")
    w = "__width"
    d = df.withColumn(w, batch_width(tokens_col, batch_col))
    t = F.col(tokens_col)
    missing = F.col(w) - F.size(t)
    fill = F.array_repeat(F.lit(pad), missing)
    ones = F.array_repeat(F.lit(1), F.size(t))
    zeros = F.array_repeat(F.lit(0), missing)
    if side == "right":
        ids, mask = F.concat(t, fill), F.concat(ones, zeros)
    else:
        ids, mask = F.concat(fill, t), F.concat(zeros, ones)
    return d.withColumn(out_col, ids).withColumn(mask_col, mask).drop(w)


def token_stream(df: DataFrame, tokens_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """T5: one row per token, in order: ``(keep..., position, token)``."""
    return df.select(*keep, F.posexplode(F.col(tokens_col)).alias("position", "token"))
