"""Batch inference through a user backend.

One ``mapInPandas`` stage: Arrow ships each partition's rows to a Python
worker, the backend is built once per worker, and rows are cut into calls. Rows
are laid out by ``batch_id``, and a batch that arrives in several Arrow frames is
joined again, so a call holds exactly the rows of one batch (without
``batch_id``: ``batch_size`` rows, fewer only at a partition's end).
Every row carries its share of the call time (``gen_seconds``), so per-batch
timing is a plain aggregate of the written output.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from synthtext.config import Generation
from synthtext.functions.tokens import count_tokens
from synthtext.operators.backends import BackendSpec, get_backend
from synthtext.session import ship_package

GEN_SECONDS = "gen_seconds"


def request_params(gen: Generation) -> dict:
    """P4 for one run: the sampling parameters handed to the backend."""
    return {
        "temperature": gen.temperature,
        "top_p": gen.top_p,
        "top_k": gen.top_k,
        "max_tokens": gen.max_length,
        "min_length": gen.min_length,
        "presence_penalty": 0.0 if gen.repetition_penalty == 1.0 else gen.repetition_penalty - 1.0,
        "frequency_penalty": 0.0,
        "n": gen.num_return_sequences,
        "use_beam_search": not gen.do_sample,
        "best_of": gen.num_return_sequences if not gen.do_sample else None,
    }


def _whole_batches(frames, batch_size: int, batch_col: str | None) -> Iterator:
    """The rows of a partition, one frame for each call of the backend. What an
    Arrow frame leaves unfinished waits for the next one."""
    import pandas as pd

    held, rows = [], 0
    for pdf in frames:
        if not len(pdf):
            continue
        if batch_col:
            cut = [0, *(pdf[batch_col].ne(pdf[batch_col].shift()).to_numpy().nonzero()[0][1:]), len(pdf)]
            parts = [pdf.iloc[a:b] for a, b in zip(cut, cut[1:])]
        else:
            parts = [pdf]
        for part in parts:
            if batch_col and held and held[-1][batch_col].iloc[-1] != part[batch_col].iloc[0]:
                yield pd.concat(held)
                held, rows = [], 0
            while len(part):
                take = part.iloc[: batch_size - rows]
                held.append(take)
                rows += len(take)
                part = part.iloc[len(take):]
                if rows == batch_size:
                    yield pd.concat(held)
                    held, rows = [], 0
    if held:
        yield pd.concat(held)


def _generate_fn(spec, params, batch_size, prompt_col, out_col, batch_col, seed_col, many, clock=time.perf_counter):
    def run(frames):
        backend = get_backend(spec)
        for pdf in _whole_batches(frames, batch_size, batch_col):
            n = len(pdf)
            prompts = pdf[prompt_col].tolist()
            seeds = pdf[seed_col].tolist() if seed_col else None
            texts: list = [None] * n
            t0 = clock()
            out = backend.generate(prompts, params, seeds)
            dt = clock() - t0
            # Texts align with prompts by position; missing ones stay null.
            for i, seqs in zip(range(n), out):
                texts[i] = list(seqs) if many else (seqs[0] if seqs else None)
            pdf = pdf.reset_index(drop=True)
            pdf[out_col] = texts
            pdf[GEN_SECONDS] = dt / n
            yield pdf

    return run


def generate(
    df: DataFrame,
    backend: BackendSpec,
    gen: Generation | None = None,
    prompt_col: str = "prompt",
    out_col: str = "generated_text",
    batch_col: str | None = "batch_id",
    seed_col: str | None = None,
    clock: Callable[[], float] = time.perf_counter,
) -> DataFrame:
    """U1 (and U3 when ``num_return_sequences > 1``): one text per prompt
    (``ARRAY<STRING>`` of k texts for k > 1) plus ``gen_seconds``.

    The output is non-deterministic for a real model: write it once and
    compute metrics from the written table.
    """
    gen = gen or Generation()
    many = gen.num_return_sequences > 1
    if batch_col and batch_col not in df.columns:
        batch_col = None
    out_type = T.ArrayType(T.StringType()) if many else T.StringType()
    schema = T.StructType(
        [f for f in df.schema.fields if f.name not in (out_col, GEN_SECONDS)]
        + [T.StructField(out_col, out_type, True), T.StructField(GEN_SECONDS, T.DoubleType(), False)]
    )
    src = df.drop(out_col, GEN_SECONDS) if out_col in df.columns else df
    if batch_col:
        # a batch lies in one partition; the fixed count keeps the stage parallel
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        order = [batch_col, "ordinal"] if "ordinal" in src.columns else [batch_col]
        src = src.repartition(n, batch_col).sortWithinPartitions(*order)
    fn = _generate_fn(
        backend, request_params(gen), int(gen.batch_size), prompt_col, out_col, batch_col, seed_col, many,
        clock,
    )
    ship_package(df.sparkSession)
    return src.mapInPandas(fn, schema)


def predict_batches(
    df: DataFrame, make_predict: Callable[[], Callable], out_col: str = "prediction", out_type: str = "bigint",
    ids_col: str = "input_ids", mask_col: str = "attention_mask", batch_col: str = "batch_id",
) -> DataFrame:
    """U1, tensor form: ``predict(ids, mask)`` once for each batch, with the padded id matrix and
    mask of T3 (``pad_batch``) as numpy arrays of shape (rows, width); it returns a value a row.

    ``make_predict()`` builds the function once a worker's task. A batch lies in one
    partition, rows in ``ordinal`` order. The matrices stay in the worker: the two array
    columns are not handed back.
    """
    keep = [f for f in df.schema.fields if f.name not in (ids_col, mask_col, out_col)]
    schema = T.StructType([*keep, T.StructField(out_col, T._parse_datatype_string(out_type))])
    names = [f.name for f in keep]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [batch_col, "ordinal"] if "ordinal" in df.columns else [batch_col]
    src = df.drop(out_col).repartition(n, batch_col).sortWithinPartitions(*order)

    def run(frames):
        import numpy as np

        predict = make_predict()
        for pdf in _whole_batches(frames, 1 << 31, batch_col):
            ids, mask = (np.stack([np.asarray(x, np.int64) for x in pdf[c]]) for c in (ids_col, mask_col))
            got = pdf[names].reset_index(drop=True)
            values = np.asarray(predict(ids, mask))
            if len(values) != len(got):
                raise ValueError(f"{len(values)} values for a batch of {len(got)} rows")
            got[out_col] = list(values)
            yield got

    ship_package(df.sparkSession)
    return src.mapInPandas(run, schema)


def attach_outputs(prompts: DataFrame, outputs: DataFrame, key: str = "prompt_id",
                   how: str = "left") -> DataFrame:
    """B3 for backends that return a separate ``(key, generated_text, ...)``
    table: an equi-join on the prompt key (Catalyst/AQE pick the strategy and
    split skewed partitions). ``how="inner"`` drops prompts without output,
    as a positional zip would; the default keeps them with null text."""
    return prompts.join(outputs, key, how)


def explode_sequences(df: DataFrame, col: str = "generated_text", index_col: str = "seq_index") -> DataFrame:
    """``(…, seq_index, text)`` rows from the k texts of each prompt."""
    others = [c for c in df.columns if c != col]
    return df.select(*others, F.posexplode(F.col(col)).alias(index_col, col))


def generate_one(spark: SparkSession, prompt: str, backend: BackendSpec, gen: Generation | None = None) -> str:
    """A single prompt through U1."""
    one = spark.createDataFrame([(0, prompt)], "prompt_id long, prompt string")
    return generate(one, backend, gen, batch_col=None).first()["generated_text"]


def timing_table(generated: DataFrame, text_col: str = "generated_text",
                 group_cols: tuple[str, ...] = ()) -> DataFrame:
    """U5 input for M3/M4/M5: per batch ``seconds, num_tokens, num_samples``."""
    tok = F.col("num_tokens") if "num_tokens" in generated.columns else count_tokens(text_col)
    return generated.groupBy(*group_cols, "batch_id").agg(
        F.sum(GEN_SECONDS).alias("seconds"),
        F.sum(tok).cast("long").alias("num_tokens"),
        F.count(F.lit(1)).cast("long").alias("num_samples"),
    )
