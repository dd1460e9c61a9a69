"""The batch generation job and its run metrics.

    prompts -> batches -> generate -> post-process -> record -> write
    written records -> timing per batch -> totals, running metrics, diversity,
                       samples, metric events

Prompts are taken as they are: templates belong to ``load_prompts`` or the
caller (``apply_template``). Generation runs once: its output is written, then every metric reads the
written table, so a re-evaluated plan never calls the model again. Everything a run
writes lies in folders of its ``run_id`` and replaces what an earlier try of that
run left there.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from synthtext.config import RunConfig
from synthtext.functions.tokens import count_tokens, tokenize, tokenize_clean
from synthtext.operators import batching as B
from synthtext.operators import metrics as M
from synthtext.operators import samples as W
from synthtext.operators.backends import BackendSpec
from synthtext.operators.generate import GEN_SECONDS, explode_sequences, generate, timing_table
from synthtext.operators.postprocess import post_process_stage
from synthtext.operators.prompts import build_output_record
from synthtext.sinks import records as K
from synthtext.sinks import runs as R


def prepare_prompts(prompts: DataFrame, cfg: RunConfig, num_partitions: int | None = None) -> DataFrame:
    """Contiguous batches (B1) and per-row seeds (B4). ``prompt_id`` identifies a prompt (as
    every source sees to), so ordinals are computed on ids alone and texts move once."""
    batched = B.assign_batches(prompts, cfg.generation.batch_size, ["prompt_id"], num_partitions, unique_keys=True)
    return B.with_row_seed(batched, cfg.generation.seed, "prompt_id")


def generated_records(prompts: DataFrame, cfg: RunConfig, backend: BackendSpec,
                      num_partitions: int | None = None, with_timestamp: bool = True) -> DataFrame:
    """The lazy record plan: U1/U3 -> F5/X6 -> token count -> P3. With several
    texts a prompt there is a record for each (``seq_index``), which carries its
    share of the prompt's time."""
    batched = prepare_prompts(prompts, cfg, num_partitions)
    gen = generate(batched, backend, cfg.generation, seed_col="seed")
    many = cfg.generation.num_return_sequences
    if many > 1:
        gen = explode_sequences(gen).withColumn(GEN_SECONDS, F.col(GEN_SECONDS) / many)
    else:
        gen = gen.withColumn("seq_index", F.lit(0))
    processed = post_process_stage(gen, "generated_text", cfg.post_processing)
    # Post-processed text is whitespace-clean, so the plain-space tokenizer applies.
    tok = tokenize_clean if cfg.post_processing.enabled else tokenize
    counted = processed.withColumn("num_tokens", count_tokens("generated_text", tok))
    return build_output_record(
        counted, cfg.model_name, cfg.generation,
        keep=("prompt_id", "batch_id", "ordinal", "seq_index", "num_tokens", GEN_SECONDS),
        with_timestamp=with_timestamp,
    )


@dataclass
class RunOutputs:
    run_id: str
    records: str
    metrics: str
    events: str
    samples: str
    config: str


def run_batch_job(spark: SparkSession, prompts: DataFrame, cfg: RunConfig, backend: BackendSpec,
                  run_id: str | None = None, num_partitions: int | None = None) -> RunOutputs:
    """Run generation once, write the records, then write the run's metrics."""
    run_id = run_id or uuid.uuid4().hex[:12]
    out = cfg.output.dir.rstrip("/")
    paths = RunOutputs(
        run_id,
        K.records_path(out, run_id),
        f"{out}/metrics/run_id={run_id}",
        f"{out}/metric_events/run_id={run_id}",
        f"{out}/samples/run_id={run_id}",
        f"{out}/runs/run_id={run_id}",
    )
    K.write_run_config(spark, run_id, cfg.to_dict(), paths.config)
    recs = generated_records(prompts, cfg, backend, num_partitions)
    # Records keep the bookkeeping columns (batch_id, ordinal, seq_index,
    # num_tokens, gen_seconds) next to the five record fields.
    K.write_records(recs, paths.records, cfg.output.format, mode="overwrite")
    written = K.read_records(spark, paths.records, cfg.output.format, recs.schema)
    write_run_metrics(written, cfg, run_id, paths)
    return paths


def run_shared_job(spark: SparkSession, prompts: DataFrame, cfg: RunConfig, backend: BackendSpec, run_id: str,
                   attempt: str | None = None, num_partitions: int | None = None) -> str:
    """A run whose records and events go to the tables of all runs below the output folder
    (``sinks.runs``, Parquet); returns its try. Visible to readers once it is finished."""
    out, attempt = cfg.output.dir, attempt or uuid.uuid4().hex[:12]
    R.write_attempt(generated_records(prompts, cfg, backend, num_partitions), out, R.RECORDS, run_id, attempt)
    written = R.read_attempt(spark, out, R.RECORDS, run_id, attempt)
    R.write_attempt(run_metrics(written, cfg, run_id)["events"], out, R.EVENTS, run_id, attempt)
    R.finish_run(spark, out, run_id, attempt, cfg.to_dict())
    return attempt


def run_metrics(written: DataFrame, cfg: RunConfig, run_id: str) -> dict[str, DataFrame]:
    """Metric tables of one run, all computed from the written records."""
    timing = timing_table(written).withColumn("run_id", F.lit(run_id))
    totals = M.name_spaced(M.run_totals(timing, ["run_id"]), "throughput", M.RATIOS)
    running = M.name_spaced(M.running_metrics(timing, ["run_id"], "batch_id"), "throughput", M.RATIOS)
    tok = tokenize_clean if cfg.post_processing.enabled else tokenize
    diversity = M.token_diversity(written, text_col="generated_text", group_cols=["batch_id"], tokenizer=tok)
    diversity = M.name_spaced(diversity, "diversity", [c for c in diversity.columns if c != "batch_id"])
    lg = cfg.logging
    samples = W.sample_table(written, cfg.generation.batch_size, lg.log_samples, lg.log_interval,
                             ("seq_index", "prompt", "generated_text"))
    # one event for each metric of each batch
    events = M.flatten_metrics(running, ["run_id", "batch_id"])
    if lg.token_diversity:
        events = events.union(M.flatten_metrics(
            diversity.withColumn("run_id", F.lit(run_id)).select("run_id", *diversity.columns), ["run_id", "batch_id"]))
    return {"timing": timing, "totals": totals, "running": running, "diversity": diversity,
            "samples": samples.withColumn("run_id", F.lit(run_id)), "events": events}


def write_run_metrics(written: DataFrame, cfg: RunConfig, run_id: str, paths: RunOutputs) -> None:
    m = run_metrics(written, cfg, run_id)
    K.write_metrics_snapshot(m["totals"], paths.metrics)
    K.write_metric_events(m["events"].drop("run_id"), paths.events)
    K.write_samples(m["samples"].drop("run_id"), paths.samples)
