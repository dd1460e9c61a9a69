"""The generator surface of the reference, on Spark.

``TextGenerator(spark, cfg)`` offers ``load_prompts``, ``generate_batch``,
``generate`` and ``generate_streaming`` as compositions of this package's
DataFrame operators: prompts are DataFrames, generation is the mapInPandas
stage, a run is the batch job, a stream is a StreamingQuery.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from synthtext.config import RunConfig
from synthtext.operators.backends import BackendSpec
from synthtext.operators.generate import explode_sequences, generate
from synthtext.operators.postprocess import post_process_stage
from synthtext.plans.job import RunOutputs, run_batch_job
from synthtext.sources.prompts import load_prompts
from synthtext.streaming.generate import finalize_responses, generate_stream, start_stream


class TextGenerator:
    def __init__(self, spark: SparkSession, cfg: RunConfig, backend: BackendSpec | None = None):
        self.spark = spark
        self.cfg = cfg
        self._backend = backend

    @property
    def backend(self) -> BackendSpec:
        """The given backend, or the registered one that the configuration names."""
        if self._backend is None and self.cfg.backend is None:
            raise ValueError("give a backend, or the name of a registered one as cfg.backend")
        return self._backend or BackendSpec.of(self.cfg.backend)

    def load_prompts(self) -> DataFrame:
        """Prompts from the configured file, or synthetic ones, templated."""
        return load_prompts(self.spark, self.cfg.generation)

    def generate_batch(self, prompts: DataFrame) -> DataFrame:
        """Texts for a prompt DataFrame (``prompt`` column), post-processed
        when enabled, a row for each of several texts (``seq_index``); lazy -
        write it once before computing on it."""
        out = generate(prompts, self.backend, self.cfg.generation, batch_col="batch_id")
        if self.cfg.generation.num_return_sequences > 1:
            out = explode_sequences(out)
        return post_process_stage(out, "generated_text", self.cfg.post_processing)

    def generate(self, prompts: DataFrame | None = None, run_id: str | None = None) -> RunOutputs:
        """The whole run: records, metrics snapshot, metric events, samples
        and run configuration under ``cfg.output.dir``. Given prompts are used
        as they are (no template), like the reference."""
        return run_batch_job(self.spark, prompts if prompts is not None else self.load_prompts(), self.cfg,
                             self.backend, run_id)

    def generate_streaming(self, prompts: DataFrame, checkpoint: str, run_id: str,
                           callback: Callable[[DataFrame, int], None] | None = None,
                           available_now: bool = True) -> StreamingQuery:
        """Chunks of a streaming prompt DataFrame (``prompt_id``, ``prompt``);
        finished chunks post-processed; ``callback(batch_df, epoch)`` per
        micro-batch after it is written."""
        chunks = finalize_responses(generate_stream(prompts, self.backend, self.cfg.generation),
                                    self.cfg.post_processing)
        return start_stream(chunks, self.cfg.output.dir, checkpoint, run_id, callback=callback,
                            available_now=available_now)
