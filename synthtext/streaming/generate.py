"""Structured Streaming form of generation (ST1-ST5, F4).

    readStream prompts (S10) -> chunks via the backend (ST1, ST3 fallback)
        -> finished chunks post-processed (ST2), or finished-only (F4)
        -> foreachBatch: write the micro-batch once, with per-batch metric
           events observed in the same pass (ST5), then the user callback (ST4)

Each micro-batch writes records and metric events to its own ``epoch=<id>``
folders with overwrite, so a micro-batch that is replayed after a failure replaces its own output
instead of duplicating it.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from synthtext.config import Generation, PostProcessing
from synthtext.functions.tokens import count_tokens
from synthtext.functions.ratios import throughput_columns
from synthtext.operators.backends import BackendSpec, get_backend
from synthtext.operators.batching import with_row_seed
from synthtext.operators.generate import _whole_batches, request_params
from synthtext.operators.metrics import RATIOS, flatten_metrics, name_spaced
from synthtext.operators.postprocess import apply_post_processing
from synthtext.session import ship_package

CHUNK_FIELDS = [
    T.StructField("request_id", T.LongType(), False),
    T.StructField("seq_index", T.LongType(), False),
    T.StructField("seq", T.LongType(), False),
    T.StructField("text", T.StringType(), True),
    T.StructField("finished", T.BooleanType(), False),
    T.StructField("chunk_seconds", T.DoubleType(), False),
]

TOTALS = ("seconds", "num_tokens", "num_samples")

#: Characters and chunks after which a worker hands on what it holds.
FRAME_CHARS = 1 << 20
FRAME_CHUNKS = 1024


def _stream_fn(spec, params, batch_size, id_col, prompt_col, seed_col, keep, only_finished):
    def run(frames):
        backend = get_backend(spec)
        streaming = callable(getattr(backend, "stream", None))

        def chunks(prompts, seeds):
            """(prompt, sequence, chunk, text, finished, seconds)"""
            t0 = time.perf_counter()
            if streaming:  # ST1: chunks as the backend produces them
                for i, k, seq, text, done in backend.stream(prompts, params, seeds):
                    t1 = time.perf_counter()
                    yield i, k, seq, text, bool(done), t1 - t0
                    t0 = t1
            else:  # ST3: no streaming support -> one finished chunk for each text
                outs = backend.generate(prompts, params, seeds)
                dt = (time.perf_counter() - t0) / max(sum(map(len, outs)), 1)
                for i, texts in enumerate(outs):
                    for k, text in enumerate(texts):
                        yield i, k, 0, text, True, dt

        def frame(part, rows):
            idx = [r[0] for r in rows]
            out = part.iloc[idx][[*keep]].reset_index(drop=True)
            out["request_id"] = part[id_col].iloc[idx].to_numpy()
            for at, name in enumerate(("seq_index", "seq", "text", "finished", "chunk_seconds"), 1):
                out[name] = [r[at] for r in rows]
            return out

        for part in _whole_batches(frames, batch_size, None):
            rows, held, seconds = [], 0, 0.0
            for i, k, seq, text, done, dt in chunks(part[prompt_col].tolist(), part[seed_col].tolist()):
                seconds += dt
                if only_finished and not done:
                    continue  # its time goes to the next chunk kept
                rows.append((i, k, seq, text, done, seconds))
                held, seconds = held + len(text or ""), 0.0
                if held >= FRAME_CHARS or len(rows) >= FRAME_CHUNKS:
                    yield frame(part, rows)
                    rows, held = [], 0
            if rows:
                yield frame(part, rows)

    return run


def generate_stream(
    prompts: DataFrame, backend: BackendSpec, gen: Generation | None = None,
    id_col: str = "prompt_id", prompt_col: str = "prompt", keep: tuple[str, ...] = ("prompt",),
    spread_to: int | None = None, only_finished: bool = False,
) -> DataFrame:
    """ST1/ST3: ``(keep..., request_id, seq_index, seq, text, finished,
    chunk_seconds)`` chunks of every text of every prompt.

    Works on batch and streaming DataFrames alike (``mapInPandas``). Each prompt
    has the seed of B4. ``spread_to`` round-robins each micro-batch over that many
    partitions first (a micro-batch of one file is one partition otherwise).
    ``only_finished`` (F4) drops intermediate chunks where they arise; a worker
    holds at most ``FRAME_CHARS`` characters of chunks.
    """
    if spread_to:
        prompts = prompts.repartition(int(spread_to))
    gen = gen or Generation()
    keep_fields = [prompts.schema[c] for c in keep]
    schema = T.StructType(keep_fields + CHUNK_FIELDS)
    seeded = with_row_seed(prompts, gen.seed, id_col, "__seed")
    fn = _stream_fn(backend, request_params(gen), int(gen.batch_size), id_col, prompt_col, "__seed", list(keep),
                    only_finished)
    ship_package(prompts.sparkSession)
    return seeded.mapInPandas(fn, schema)


def finalize_responses(chunks: DataFrame, pp: PostProcessing | None, text_col: str = "text") -> DataFrame:
    """ST2: intermediate chunks pass through raw; a finished chunk's text is
    post-processed when post-processing is enabled. Stateless per chunk."""
    if pp is None or not pp.enabled:
        return chunks
    # Only finished chunks reach X6 (null for the rest costs nothing).
    staged = chunks.withColumn("__final", F.when(F.col("finished"), F.col(text_col)))
    done = apply_post_processing(staged, "__final", pp)
    return done.withColumn(
        text_col, F.when(F.col("finished"), F.col("__final")).otherwise(F.col(text_col))
    ).drop("__final")


def finished_only(chunks: DataFrame) -> DataFrame:
    """keep the finished chunk of every request."""
    return chunks.where(F.col("finished"))


def batch_totals(text_col: str = "text") -> list[Column]:
    """ST5: what is summed over a micro-batch: the time of all chunks, the tokens of its
    finished texts and their number. Aggregates that a write can observe."""
    done = F.col("finished")
    return [
        F.coalesce(F.sum("chunk_seconds"), F.lit(0.0)).alias("seconds"),
        F.coalesce(F.sum(F.when(done, count_tokens(text_col))), F.lit(0)).cast("double").alias("num_tokens"),
        F.count_if(done).cast("double").alias("num_samples"),
    ]


def micro_batch_metrics(totals: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """ST5: one micro-batch as one timing row (``batch_totals``) -> long metric events ``(name,
    value)``: its own sums, and the run's totals and ratios (M5). ``before``: the events of
    the epoch before."""
    agg = totals
    sums = {"total_tokens": "num_tokens", "total_samples": "num_samples", "total_time": "seconds"}
    if before is None:
        agg = agg.withColumns({t: F.col(c) for t, c in sums.items()})
    else:
        old = before.groupBy().pivot("name", list(sums)).sum("value")
        for t, c in sums.items():
            agg = agg.withColumn(t, F.col(c) + F.coalesce(old.select(t).scalar(), F.lit(0.0)))
    rows = agg.select("*", *throughput_columns("total_tokens", "total_time", "total_samples"))
    rows = name_spaced(rows, "throughput", RATIOS)
    return flatten_metrics(rows, [])


def start_stream(
    df: DataFrame,
    out_dir: str,
    checkpoint: str,
    run_id: str,
    fmt: str = "parquet",
    callback: Callable[[DataFrame, int], None] | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """ST1 sink + ST4 + ST5: write every micro-batch once (idempotently),
    then its metric events, and hand the written rows to ``callback``."""
    spark = df.sparkSession
    out = out_dir.rstrip("/")

    def each(batch: DataFrame, epoch: int) -> None:
        path = f"{out}/records/run_id={run_id}/epoch={epoch}"
        seen = Observation()  # summed while the rows are written: they are read once
        w = batch.observe(seen, *batch_totals()).write.mode("overwrite")
        if fmt == "jsonl":
            w.option("ignoreNullFields", False).json(path)
            written = spark.read.schema(batch.schema).json(path)
        else:
            w.parquet(path)
            written = spark.read.parquet(path)
        events = f"{out}/metric_events/run_id={run_id}"
        before = spark.read.schema("name string, value double").parquet(f"{events}/epoch={epoch - 1}") if epoch else None
        got = seen.get
        totals = spark.createDataFrame([tuple(float(got[c]) for c in TOTALS)], ", ".join(f"{c} double" for c in TOTALS))
        micro_batch_metrics(totals, before).write.mode("overwrite").parquet(f"{events}/epoch={epoch}")
        if callback is not None:
            callback(written, epoch)

    writer = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
