"""Corpus and run metrics.

All of these are hash aggregates with map-side partial aggregation, so a
token or run that holds a large share of the rows is combined inside each
map task before the shuffle. Running totals use a multi-level scan so one hot
run never lands in a single window task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from synthtext.functions.ratios import safe_div, throughput_columns
from synthtext.functions.tokens import tokenize

TOKEN = "token"
COUNT = "count"


def token_histogram(
    df: DataFrame,
    tokens: Column | str,
    group_cols: Sequence[str] = (),
    keep_empty_groups: bool = False,
) -> DataFrame:
    """M1: occurrences per (group, token).

    With ``keep_empty_groups`` a group whose texts have no token keeps one
    row with a null token and count 0, so M2 can report it.
    """
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    explode = F.explode_outer if keep_empty_groups else F.explode
    exploded = df.select(*group_cols, explode(t).alias(TOKEN))
    return exploded.groupBy(*group_cols, TOKEN).agg(F.count(TOKEN).alias(COUNT))


def diversity_from_histogram(hist: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """M2 from an M1 table: unique tokens, total tokens, unique ratio, entropy (bits).

    entropy = log2(N) - sum(c * log2 c) / N with N the total, which equals
    -sum(p log2 p); 0 when there are no tokens.
    """
    c = F.col(COUNT)
    agg = hist.groupBy(*group_cols).agg(
        F.count(F.when(c > 0, 1)).cast("long").alias("unique_tokens"),
        F.coalesce(F.sum(c), F.lit(0)).cast("long").alias("total_tokens"),
        F.coalesce(F.sum(F.when(c > 0, c * F.log2(c))), F.lit(0.0)).alias("__clogc"),
    )
    n = F.col("total_tokens")
    return agg.select(
        *group_cols,
        "unique_tokens",
        "total_tokens",
        safe_div("unique_tokens", "total_tokens").alias("unique_ratio"),
        F.when(n > 0, F.log2(n) - F.col("__clogc") / n).otherwise(F.lit(0.0)).alias("entropy"),
    )


def token_diversity(
    df: DataFrame,
    text_col: str | None = None,
    tokens_col: str | None = None,
    group_cols: Sequence[str] = (),
    tokenizer=tokenize,
) -> DataFrame:
    """M2 (and M6 with ``group_cols=['batch_id']``) over texts or token arrays."""
    if tokens_col is None:
        if text_col is None:
            raise ValueError("give text_col or tokens_col")
        toks = tokenizer(F.col(text_col))
    else:
        toks = F.col(tokens_col)
    hist = token_histogram(df, toks, group_cols, keep_empty_groups=bool(group_cols))
    return diversity_from_histogram(hist, group_cols)


def run_totals(timing: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """M4: totals over a batch-timing table ``(seconds, num_tokens, num_samples)``
    plus the M3 ratios, one row per group."""
    agg = timing.groupBy(*group_cols).agg(
        F.coalesce(F.sum("num_tokens"), F.lit(0)).cast("long").alias("total_tokens"),
        F.coalesce(F.sum("num_samples"), F.lit(0)).cast("long").alias("total_samples"),
        F.coalesce(F.sum("seconds"), F.lit(0.0)).cast("double").alias("total_time"),
    )
    return agg.select(
        *group_cols,
        "total_tokens",
        "total_samples",
        "total_time",
        *throughput_columns("total_tokens", "total_time", "total_samples"),
    )


def running_totals(
    df: DataFrame,
    order_col: str,
    value_cols: Sequence[str],
    partition_cols: Sequence[str] = (),
    block_size: int = 4096,
    prefix: str = "cum_",
    levels: int = 2,
    exclusive: bool = False,
) -> DataFrame:
    """Running sums of ``value_cols`` in ``order_col`` order (M5 building block).

    Multi-level scan: rows are cut into blocks of ``block_size`` consecutive
    ``order_col`` values; each block's carry (the sum of all earlier blocks) is
    the same problem one level up on the much smaller block table, solved
    recursively; each row then adds its running sum inside its own block.
    Every window task sees at most one block, except the top level, which
    sees ``rows / block_size**levels`` rows per partition group - so a run
    holding most of the rows is still spread over many tasks. The join and the
    in-block window share one hash partitioning on (partition, block).
    ``order_col`` must be integral and unique per partition group;
    ``exclusive`` sums strictly earlier rows.
    """
    end = -1 if exclusive else Window.currentRow
    if levels <= 0:
        w = Window.partitionBy(*partition_cols).orderBy(order_col).rowsBetween(Window.unboundedPreceding, end)
        return df.select(
            *df.columns, *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(prefix + c) for c in value_cols]
        )
    blk = f"__blk{levels}"
    keys = [*partition_cols, blk]
    keyed = df.withColumn(blk, F.floor(F.col(order_col) / F.lit(block_size)))
    blocks = keyed.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in value_cols])
    carry = running_totals(
        blocks, blk, value_cols, partition_cols, block_size, "__cy_", levels - 1, exclusive=True
    ).select(*keys, *[f"__cy_{c}" for c in value_cols])
    within = Window.partitionBy(*keys).orderBy(order_col).rowsBetween(Window.unboundedPreceding, end)
    joined = keyed.join(carry, keys)
    return joined.select(
        *df.columns,
        *[(F.col(f"__cy_{c}") + F.coalesce(F.sum(c).over(within), F.lit(0))).alias(prefix + c) for c in value_cols],
    )


def running_metrics(
    timing: DataFrame, run_cols: Sequence[str] = ("run_id",), order_col: str = "batch_id",
    block_size: int = 4096,
) -> DataFrame:
    """M5: the cumulative metrics logged after every batch.

    One row per batch: running totals of tokens, samples and seconds, and the
    M3 ratios of those running totals.
    """
    cum = running_totals(
        timing, order_col, ["num_tokens", "num_samples", "seconds"], run_cols, block_size
    )
    return cum.select(
        *run_cols,
        order_col,
        F.col("cum_num_tokens").cast("long").alias("total_tokens"),
        F.col("cum_num_samples").cast("long").alias("total_samples"),
        F.col("cum_seconds").cast("double").alias("total_time"),
        *throughput_columns("cum_num_tokens", "cum_seconds", "cum_num_samples"),
    )


RATIOS = ("tokens_per_second", "samples_per_second", "tokens_per_sample", "seconds_per_sample")


def name_spaced(df: DataFrame, prefix: str, cols: Sequence[str]) -> DataFrame:
    """``cols`` renamed to ``prefix/col``, the names metrics are logged under."""
    return df.withColumnsRenamed({c: f"{prefix}/{c}" for c in cols})


def generation_report(totals: DataFrame, batch_size: int | Column, group_cols: Sequence[str] = ()) -> DataFrame:
    """M7: report row of throughput/*, generation/* and time/* values over M4 output."""
    bs = batch_size if isinstance(batch_size, Column) else F.lit(int(batch_size))
    return totals.select(
        *group_cols,
        safe_div("total_tokens", "total_time").alias("throughput/tokens_per_second"),
        safe_div("total_samples", "total_time").alias("throughput/samples_per_second"),
        safe_div("total_tokens", "total_samples").alias("generation/tokens_per_sample"),
        F.col("total_tokens").alias("generation/total_tokens"),
        F.col("total_samples").alias("generation/total_samples"),
        bs.cast("long").alias("generation/batch_size"),
        F.col("total_time").alias("time/total_seconds"),
        safe_div("total_time", "total_samples").alias("time/seconds_per_sample"),
    )


_GIB = float(1024**3)


def device_usage(samples: DataFrame) -> DataFrame:
    """M8 per sample: GiB allocated / reserved and utilisation (0 if nothing reserved)."""
    return samples.select(
        *[c for c in samples.columns if c not in ("allocated_bytes", "reserved_bytes")],
        (F.col("allocated_bytes") / F.lit(_GIB)).alias("allocated_gb"),
        (F.col("reserved_bytes") / F.lit(_GIB)).alias("reserved_gb"),
        safe_div("allocated_bytes", "reserved_bytes").alias("utilization"),
    )


def device_usage_summary(samples: DataFrame, device_col: str = "device") -> DataFrame:
    """M8 per device: peak and mean of the per-sample values."""
    u = device_usage(samples)
    return u.groupBy(device_col).agg(
        F.count(F.lit(1)).cast("long").alias("n_samples"),
        F.max("allocated_gb").alias("max_allocated_gb"),
        F.max("reserved_gb").alias("max_reserved_gb"),
        F.avg("utilization").alias("avg_utilization"),
        F.max("utilization").alias("max_utilization"),
    )


def flatten_metrics(
    df: DataFrame, id_cols: Sequence[str], prefix: str | None = None,
    name_col: str = "name", value_col: str = "value",
) -> DataFrame:
    """M9: wide metric row(s) to long ``(name, value)`` with an optional
    ``prefix/`` name-space (``throughput/``, ``memory/``, ``diversity/``)."""
    metric_cols = [c for c in df.columns if c not in id_cols]
    long = df.select(*id_cols, *[F.col(f"`{c}`").cast("double").alias(c) for c in metric_cols]).unpivot(
        list(id_cols), metric_cols, name_col, value_col
    )
    if prefix:
        long = long.withColumn(name_col, F.concat(F.lit(prefix + "/"), F.col(name_col)))
    return long


def _total(batched: DataFrame, total_col: str) -> Column:
    """The row total: the column the ordinal pass attached, else a scalar
    subquery (which re-runs the input plan once)."""
    if total_col in batched.columns:
        return F.col(total_col)
    return batched.select(F.count(F.lit(1))).scalar()


def progress(batched: DataFrame, total_col: str = "total") -> DataFrame:
    """After each batch, how many rows are done out of the total.

    Batches are contiguous in the ordinal, so rows done after batch b is the
    largest ordinal in b plus one. The total comes from the ordinal pass
    (``assign_batches(..., total_col="total")``) - no join, no second pass.
    """
    has_total = total_col in batched.columns
    per = batched.groupBy("batch_id").agg(
        F.count(F.lit(1)).cast("long").alias("batch_samples"),
        (F.max("ordinal") + 1).cast("long").alias("done"),
        *([F.first(total_col).alias(total_col)] if has_total else []),
    )
    return per.select("batch_id", "batch_samples", "done", _total(per if has_total else batched, total_col).cast("long").alias("total"))
