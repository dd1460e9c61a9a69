"""Prompt shaping and request parameters.

Templates are resolved on the driver into a ``concat`` of literals and the
prompt column, so templating is a plain projection inside codegen.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from synthtext.config import Generation

IDENTITY_TEMPLATE = "{prompt}"


def template_column(template: str, prompt: Column) -> Column:
    """P1 as a Column: Python ``str.format(prompt=...)`` semantics.

    ``{{``/``}}`` are escapes. Any field other than ``{prompt}``, and any
    conversion or format spec, is rejected here, at plan time.
    """
    if template == IDENTITY_TEMPLATE:
        return prompt
    parts: list[Column] = []
    for literal, field, spec, conv in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is None:
            continue
        if field != "prompt":
            raise KeyError(f"template field {{{field}}} is not supported; only {{prompt}}")
        if spec or conv:
            raise ValueError("format specs and conversions are not supported in prompt templates")
        parts.append(prompt)
    if not parts:
        return F.lit("")
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def apply_template(df: DataFrame, template: str, col: str = "prompt") -> DataFrame:
    """Format every prompt with ``template``; skipped for ``{prompt}``."""
    if template == IDENTITY_TEMPLATE:
        return df
    return df.withColumn(col, template_column(template, F.col(col)))


def prepend_bos(df: DataFrame, bos: str, enabled: bool = True, col: str = "prompt") -> DataFrame:
    """Add ``bos`` unless the prompt already starts with it (only if enabled)."""
    if not enabled or not bos:
        return df
    p = F.col(col)
    return df.withColumn(col, F.when(p.startswith(bos), p).otherwise(F.concat(F.lit(bos), p)))


def parameters_struct(gen: Generation) -> Column:
    """The ``parameters`` block of an output record."""
    p = gen.record_parameters()
    return F.struct(
        F.lit(p["temperature"]).cast("double").alias("temperature"),
        F.lit(p["top_p"]).cast("double").alias("top_p"),
        F.lit(p["top_k"]).cast("int").alias("top_k"),
        F.lit(p["max_length"]).cast("int").alias("max_length"),
    )


def build_output_record(
    df: DataFrame, model: str, gen: Generation, text_col: str = "generated_text",
    keep: tuple[str, ...] = (), with_timestamp: bool = True,
) -> DataFrame:
    """``prompt, generated_text, timestamp, model, parameters``.

    ``timestamp`` is epoch seconds (DOUBLE) of the query's current time: one
    value per query instead of one per batch (documented change).
    """
    cols = [*keep, F.col("prompt"), F.col(text_col).alias("generated_text")]
    if with_timestamp:
        cols.append((F.unix_micros(F.current_timestamp()) / F.lit(1e6)).alias("timestamp"))
    cols += [F.lit(model).alias("model"), parameters_struct(gen).alias("parameters")]
    return df.select(*cols)


# Defaults filled into generation requests (P5).
GENERATION_DEFAULTS = {
    "max_length": ("int", 1024),
    "min_length": ("int", 10),
    "do_sample": ("boolean", True),
    "temperature": ("double", 0.8),
    "top_p": ("double", 0.92),
    "top_k": ("int", 50),
    "repetition_penalty": ("double", 1.0),
    "num_return_sequences": ("int", 1),
}


def with_generation_defaults(df: DataFrame) -> DataFrame:
    """P5: fill missing request parameters (absent column or null) with defaults."""
    out = df
    for name, (typ, default) in GENERATION_DEFAULTS.items():
        val = F.lit(default).cast(typ)
        if name in df.columns:
            out = out.withColumn(name, F.coalesce(F.col(name).cast(typ), val))
        else:
            out = out.withColumn(name, val)
    return out


def sampling_params(df: DataFrame) -> DataFrame:
    """Inference-engine sampling parameters per request row.

    ``max_tokens = max_length``; ``presence_penalty = 0`` when the repetition
    penalty is 1, else ``penalty - 1``; ``frequency_penalty = 0``;
    ``n = num_return_sequences``; beam search when not sampling, and then
    ``best_of = n``.
    """
    d = with_generation_defaults(df)
    rp = F.col("repetition_penalty")
    sample = F.col("do_sample")
    return d.select(
        *[c for c in df.columns if c not in GENERATION_DEFAULTS],
        F.col("temperature"),
        F.col("top_p"),
        F.col("top_k"),
        F.col("max_length").alias("max_tokens"),
        F.when(rp == 1.0, F.lit(0.0)).otherwise(rp - 1.0).alias("presence_penalty"),
        F.lit(0.0).alias("frequency_penalty"),
        F.col("num_return_sequences").alias("n"),
        (~sample).alias("use_beam_search"),
        F.when(~sample, F.col("num_return_sequences")).alias("best_of"),
    )
