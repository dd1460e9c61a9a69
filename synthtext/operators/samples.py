"""Logged samples and log cadence.

Batches are contiguous in the dense ordinal, so "the first n rows of a batch"
is the filter ``ordinal - batch_id * batch_size < n``: no window, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from synthtext.functions.text import preview


def logged_batches(batch_id: Column, log_interval: int) -> Column:
    """batches on the log cadence (``batch_id % log_interval == 0``)."""
    return F.pmod(batch_id, F.lit(int(log_interval))) == 0


def sampled_batches(batch_id: Column, log_samples: int) -> Column:
    """batches that still log samples (row index i < log_samples * batch_size)."""
    return (F.lit(int(log_samples)) > 0) & (batch_id < F.lit(int(log_samples)))


def position_in_batch(batch_size: int) -> Column:
    return F.col("ordinal") - F.col("batch_id") * F.lit(int(batch_size))


def sample_table(
    batched: DataFrame, batch_size: int, log_samples: int, log_interval: int,
    cols: tuple[str, ...] = ("prompt", "generated_text"),
) -> DataFrame:
    """Per logged batch, its first ``min(log_samples, len)`` rows."""
    b = F.col("batch_id")
    keep = (
        logged_batches(b, log_interval)
        & sampled_batches(b, log_samples)
        & (position_in_batch(batch_size) < F.lit(int(log_samples)))
    )
    return batched.where(keep).select("batch_id", position_in_batch(batch_size).alias("position"), *cols)


def sample_pick(
    batched: DataFrame, batch_size: int, log_samples: int, log_interval: int,
    prompt_col: str = "prompt", text_col: str = "generated_text",
) -> DataFrame:
    """W2 + P6: per logged batch, the row at ``min(log_samples - 1, len - 1)``
    with a 100-character prompt preview and a 200-character text preview.

    The batch length needs the row total: the ``total`` column of
    ``assign_batches(..., total_col="total")`` when present, else a scalar
    subquery.
    """
    total = F.col("total") if "total" in batched.columns else batched.select(F.count(F.lit(1))).scalar()
    b = F.col("batch_id")
    bs = F.lit(int(batch_size))
    batch_len = F.least(bs, total - b * bs)
    pick = F.least(F.lit(int(log_samples) - 1), batch_len - 1)
    keep = logged_batches(b, log_interval) & sampled_batches(b, log_samples) & (
        position_in_batch(batch_size) == pick
    )
    return batched.where(keep).select(
        "batch_id",
        preview(F.col(prompt_col), 100).alias("prompt_preview"),
        preview(F.col(text_col), 200).alias("text_preview"),
    )
