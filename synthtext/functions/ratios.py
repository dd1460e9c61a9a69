"""Guarded ratios (M3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from synthtext.functions.text import _c


def safe_div(num: Column | str, den: Column | str) -> Column:
    """``num / den`` as DOUBLE, 0.0 when the divisor is not positive (or null)."""
    n, d = _c(num), _c(den)
    return F.when(d > 0, n.cast("double") / d.cast("double")).otherwise(F.lit(0.0))


def throughput_columns(
    total_tokens: Column | str, total_time: Column | str, total_samples: Column | str
) -> list[Column]:
    """M3: tokens/s, samples/s, tokens/sample, seconds/sample."""
    return [
        safe_div(total_tokens, total_time).alias("tokens_per_second"),
        safe_div(total_samples, total_time).alias("samples_per_second"),
        safe_div(total_tokens, total_samples).alias("tokens_per_sample"),
        safe_div(total_time, total_samples).alias("seconds_per_sample"),
    ]
