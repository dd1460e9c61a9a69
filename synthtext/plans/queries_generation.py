"""Generation through deterministic stand-ins, batch and streaming (U1-U5, B3,
B4, P3, ST1-ST5, S10, F4, K4-K8).

The echo doubles stand for a model: their output is a fixed function of the
prompt and seed, so the oracle can state it in SQL. Every query runs over all
conversation turns.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from synthtext.config import Generation, Output, PostProcessing, RunConfig
from synthtext.functions.tokens import count_tokens, tokenize, tokenize_clean
from synthtext.operators import batching as B
from synthtext.operators.backends import register_backend
from synthtext.operators.generate import attach_outputs, explode_sequences, generate, generate_one, predict_batches, timing_table
from synthtext.operators.metrics import run_totals
from synthtext.operators.postprocess import apply_post_processing
from synthtext.operators.tokens import pad_batch
from synthtext.operators.prompts import apply_template, build_output_record
from synthtext.plans import oracle as O
from synthtext.plans.doubles import EchoBackend, batch_only_echo, echo, even_seed_echo
from synthtext.plans.generator import TextGenerator
from synthtext.plans.job import generated_records, run_batch_job, run_shared_job
from synthtext.plans.queries_text import FULL
from synthtext.plans.registry import r6, register, table
from synthtext.session import scratch_path
from synthtext.sinks import runs as R
from synthtext.sources.prompts import prompts_from_list, read_prompts_stream
from synthtext.streaming.callbacks import JsonLines, consume_stream
from synthtext.streaming.responses import RESPONSE, assemble_responses, attach_outputs_stream
from synthtext.streaming.generate import finalize_responses, finished_only, generate_stream, start_stream

ECHO = echo("Answer: {prompt}")
GEN = Generation(prompt_template="Q: {prompt}", batch_size=16)
_ID = "conv_id * 1000 + turn"
_ORD = f"(row_number() OVER (ORDER BY {_ID}) - 1)"


def _prompts(spark, d):
    conv = table(spark, d, "conversations")
    return conv.select("conv_id", "turn", F.expr(_ID).alias("prompt_id"), F.col("text").alias("prompt"))


def _output_record_oracle():
    src = "(SELECT conv_id, turn, 'Q: ' || text AS prompt, 'Answer: Q: ' || text AS text FROM conversations)"
    ctes, last = O.post_process_ctes(src, "conv_id, turn, prompt", 2048, True, True)
    return (
        f"WITH {ctes}\nSELECT conv_id, turn, prompt, t AS generated_text, 'echo' AS model, "
        "0.8::DOUBLE AS temperature, 0.92::DOUBLE AS top_p, 50::INTEGER AS top_k, 1024::INTEGER AS max_length, "
        f"len({O.tokens_clean('t')})::BIGINT AS num_tokens FROM {last}"
    )


@register("q_output_record", _output_record_oracle())
def q_output_record(spark, d):
    prompts = apply_template(_prompts(spark, d), GEN.prompt_template)
    batched = B.assign_batches(prompts, GEN.batch_size, ["prompt_id"])
    gen = generate(batched, ECHO, GEN)
    processed = apply_post_processing(gen, "generated_text", FULL)
    counted = processed.withColumn("num_tokens", count_tokens("generated_text", tokenize_clean))
    rec = build_output_record(counted, "echo", GEN, keep=("conv_id", "turn", "num_tokens"), with_timestamp=False)
    return rec.select("conv_id", "turn", "prompt", "generated_text", "model", "parameters.*", "num_tokens")


@register(
    "q_multi_sequence",
    "SELECT conv_id, turn, unnest(range(3))::INTEGER AS seq_index, "
    "text || ' #' || unnest(range(3))::VARCHAR AS generated_text FROM conversations",
)
def q_multi_sequence(spark, d):
    gen = Generation(num_return_sequences=3)
    out = generate(_prompts(spark, d), echo("{prompt} #{index}"), gen, batch_col=None)
    return explode_sequences(out).select("conv_id", "turn", "seq_index", "generated_text")


@register(
    "q_attach_outputs",
    f"SELECT {_ID} AS prompt_id, text AS prompt, CASE WHEN turn % 2 = 0 THEN 'Answer: ' || text END AS generated_text "
    "FROM conversations",
)
def q_attach_outputs(spark, d):
    """B3, join form: every turn goes to a backend that has no answer for odd ones."""
    prompts = _prompts(spark, d)
    seen = generate(prompts, even_seed_echo("Answer: {prompt}"), batch_col=None, seed_col="turn")
    outputs = seen.where("generated_text IS NOT NULL").select("prompt_id", "generated_text")
    return attach_outputs(prompts.select("prompt_id", "prompt"), outputs)


@register(
    "q_attach_all_outputs",
    f"SELECT {_ID} AS prompt_id, text AS prompt, 'Answer: ' || text AS generated_text FROM conversations",
)
def q_attach_all_outputs(spark, d):
    """B3, join form: outputs of all turns, generated apart and joined back."""
    prompts = _prompts(spark, d)
    outputs = generate(prompts, ECHO, batch_col=None).select("prompt_id", "generated_text")
    return attach_outputs(prompts.select("prompt_id", "prompt"), outputs)


def _weighted_lengths():
    """A stand-in model: token ids (here lengths) times their places, masked; the width above 2^32."""
    import numpy as np

    return lambda ids, mask: (ids * mask * np.arange(1, ids.shape[1] + 1)).sum(1) + (ids.shape[1] << 32)


@register(
    "q_tensor_batches",
    f"WITH o AS (SELECT {_ID} AS prompt_id, {_ORD} // 16 AS batch_id, coalesce({O.tokens_raw('text')}, []) AS tok FROM conversations) "
    "SELECT prompt_id, batch_id::BIGINT AS batch_id, (max(len(tok)) OVER (PARTITION BY batch_id) * 4294967296 + "
    "coalesce(list_sum(list_transform(tok, lambda x, i: len(x) * i)), 0))::BIGINT AS prediction FROM o",
)
def q_tensor_batches(spark, d):
    """B1 -> T1 -> T3 -> U1 on matrices: token lengths as ids, a whole batch a call."""
    ids = F.transform(F.coalesce(tokenize(F.col("prompt")), F.array().cast("array<string>")), lambda t: F.char_length(t))
    prompts = _prompts(spark, d).select("prompt_id", ids.alias("ids"))
    padded = pad_batch(B.assign_batches(prompts, 16, ["prompt_id"], unique_keys=True), "ids", 0)
    return predict_batches(padded.drop("ids"), _weighted_lengths).select("prompt_id", "batch_id", "prediction")


@register(
    "q_generate_one",
    f"SELECT text AS prompt, 'Answer: ' || text AS generated_text FROM conversations "
    f"WHERE text IS NOT NULL ORDER BY len(text) DESC, {_ID} LIMIT 3",
)
def q_generate_one(spark, d):
    """The three longest prompts of the table, each generated by itself."""
    longest = _prompts(spark, d).where("prompt IS NOT NULL").orderBy(F.char_length("prompt").desc(), "prompt_id").limit(3)
    given = [r.prompt for r in longest.select("prompt").collect()]  # the caller's own list
    answers = prompts_from_list(spark, [generate_one(spark, p, ECHO) for p in given])
    return prompts_from_list(spark, given).join(answers.withColumnRenamed("prompt", "generated_text"), "prompt_id").drop("prompt_id")


_SEED = f"('0x' || substr(md5('42:' || ({_ID})::VARCHAR), 1, 15))::BIGINT"


@register(
    "q_row_seeds",
    f"SELECT {_ID} AS prompt_id, {_SEED} AS seed, 'seed ' || ({_SEED})::VARCHAR AS generated_text FROM conversations",
)
def q_row_seeds(spark, d):
    """The seed of every row, as the backend gets it."""
    seeded = B.with_row_seed(_prompts(spark, d), 42, "prompt_id")
    return generate(seeded, echo("seed {seed}"), batch_col=None, seed_col="seed").select(
        "prompt_id", "seed", "generated_text")


class TickClock:
    """A clock that moves half a second with each reading."""

    def __init__(self):
        self.now = 0.0

    def __call__(self) -> float:
        self.now += 0.5
        return self.now


_TICK_SQL = (
    f"WITH o AS (SELECT {_ORD} // 16 AS batch_id, len({O.tokens_raw(chr(39) + 'Answer: ' + chr(39) + ' || text')}) AS n "
    "FROM conversations) "
)


@register(
    "q_batch_seconds",
    _TICK_SQL + "SELECT batch_id::BIGINT AS batch_id, 0.5::DOUBLE AS seconds, sum(n)::BIGINT AS num_tokens, "
    "count(*)::BIGINT AS num_samples FROM o GROUP BY batch_id",
)
def q_batch_seconds(spark, d):
    """A call a batch, half a second each by the injected clock."""
    batched = B.assign_batches(_prompts(spark, d), 16, ["prompt_id"])
    out = timing_table(generate(batched, ECHO, GEN, clock=TickClock()))
    return out.select("batch_id", r6("seconds").alias("seconds"), "num_tokens", "num_samples")


@register(
    "q_timed_totals",
    _TICK_SQL + "SELECT sum(n)::BIGINT AS total_tokens, count(*)::BIGINT AS total_samples, "
    "0.5 * count(DISTINCT batch_id)::DOUBLE AS total_time, "
    "round(sum(n) / (0.5 * count(DISTINCT batch_id)), 6) AS tokens_per_second FROM o",
)
def q_timed_totals(spark, d):
    """U5 + M3/M4: totals and throughput of the same run."""
    batched = B.assign_batches(_prompts(spark, d), 16, ["prompt_id"])
    t = run_totals(timing_table(generate(batched, ECHO, GEN, clock=TickClock())))
    return t.select("total_tokens", "total_samples", r6("total_time").alias("total_time"),
                    r6("tokens_per_second").alias("tokens_per_second"))


# --------------------------------------------------------------------------
# Streaming: conversations as a file stream, drained with availableNow
# --------------------------------------------------------------------------
_CONV_SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
])


def _prompt_feed(spark, d):
    """The table as a stream, a file or a folder of part files (braces, as a stream takes a
    single file by a glob only)."""
    return read_prompts_stream(spark, f"{d.rstrip('/')}/{{conversations.parquet}}", "parquet", _CONV_SCHEMA)


def _stream(spark, d, build, callback=None):
    prompts = _prompt_feed(spark, d)
    out = scratch_path(spark, "stream")
    q = start_stream(build(prompts), out, f"{out}/_checkpoint", "stream", callback=callback)
    q.awaitTermination()
    return out


def _run_stream(spark, d, build):
    return spark.read.parquet(f"{_stream(spark, d, build)}/records/run_id=stream")


@register(
    "q_stream_prompts",
    "SELECT text AS prompt, unnest(range(2))::BIGINT AS seq_index, text || ' #' || unnest(range(2))::VARCHAR AS text, "
    "true AS finished FROM conversations WHERE text IS NOT NULL",
)
def q_stream_prompts(spark, d):
    """S10 -> ST3 (a backend without streaming: a finished chunk for each text)."""
    gen = Generation(num_return_sequences=2)
    res = _run_stream(spark, d, lambda p: generate_stream(p, batch_only_echo("{prompt} #{index}"), gen))
    return res.select("prompt", "seq_index", "text", "finished")


def _stream_finalize_oracle():
    src = "(SELECT text AS prompt, 'Answer: ' || text AS text FROM conversations WHERE text IS NOT NULL)"
    ctes, last = O.post_process_ctes(src, "prompt", 2048, True, True)
    return f"WITH {ctes}\nSELECT prompt, t AS text FROM {last}"


@register("q_stream_finalize", _stream_finalize_oracle())
def q_stream_finalize(spark, d):
    """S10 -> ST1 (word-by-word chunks, the unfinished dropped at once) -> ST2 -> F4 -> sink."""
    res = _run_stream(
        spark, d, lambda p: finished_only(finalize_responses(generate_stream(p, ECHO, only_finished=True), FULL)))
    return res.select("prompt", "text")


@register(
    "q_stream_chunks",
    "SELECT text AS prompt, 1::BIGINT AS n_finished, true AS growing, true AS prefixes FROM conversations "
    "WHERE text IS NOT NULL",
)
def q_stream_chunks(spark, d):
    """ST1 + ST2: every chunk is written; of each request one is finished, the
    others are ever longer raw prefixes of the whole answer."""
    res = _run_stream(spark, d, lambda p: finalize_responses(generate_stream(p, ECHO), FULL))
    whole = F.concat(F.lit("Answer: "), F.col("prompt"))
    early = F.when(~F.col("finished"), F.col("text"))
    parts = F.array_sort(F.collect_list(F.when(~F.col("finished"), F.struct("seq", F.length("text").alias("n")))))
    return res.groupBy("request_id", "prompt").agg(
        F.count_if("finished").alias("n_finished"),
        F.coalesce(F.bool_and(whole.startswith(early)), F.lit(True)).alias("prefixes"), parts.alias("parts"),
    ).select("prompt", "n_finished", F.forall(
        F.sequence(F.lit(1), F.greatest(F.size("parts"), F.lit(1))),
        lambda i: (i < 2) | (F.get("parts", i - 1)["n"] > F.get("parts", i - 2)["n"])).alias("growing"), "prefixes")


@register(
    "q_stream_callback",
    "SELECT text AS prompt, 'Answer: ' || text AS text FROM conversations WHERE text IS NOT NULL",
)
def q_stream_callback(spark, d):
    """ST4: what the callback of each micro-batch is handed."""
    seen = scratch_path(spark, "seen")

    def callback(batch, epoch):
        batch.select("prompt", "text").write.mode("overwrite").parquet(f"{seen}/epoch={epoch}")

    _stream(spark, d, lambda p: generate_stream(p, ECHO, only_finished=True), callback)
    return spark.read.parquet(seen).select("prompt", "text")


@register(
    "q_stream_chunk_callback",
    "SELECT text AS prompt, 1::BIGINT AS n_finished, true AS in_order, 'Answer: ' || text AS text FROM conversations "
    "WHERE text IS NOT NULL",
)
def q_stream_chunk_callback(spark, d):
    """ST4 for each chunk: what consumers on the executors were handed, in the order of the calls."""
    prompts = _prompt_feed(spark, d)
    out = scratch_path(spark, "chunks")
    columns = ["request_id", "seq_index", "seq", "prompt", "text", "finished"]
    # every chunk repeats the prompt and what came before it, which packs well
    consume_stream(generate_stream(prompts, ECHO), lambda part, epoch: JsonLines(f"{out}/seen", columns, part, epoch, "gzip"),
                   f"{out}/marks", f"{out}/checkpoint").awaitTermination()
    seen = spark.read.schema("n bigint, request_id bigint, seq_index bigint, seq bigint, prompt string, text string, "
                             "finished boolean").json(f"{out}/seen")
    calls = F.array_sort(F.collect_list(F.struct("epoch", "partition", "n", "seq")))
    one = seen.groupBy("request_id", "seq_index", "prompt").agg(
        F.count_if("finished").alias("n_finished"), F.transform(calls, lambda c: c["seq"]).alias("seqs"),
        F.max(F.when(F.col("finished"), F.col("text"))).alias("text"))
    # each chunk once, in the order of its request
    return one.select("prompt", "n_finished", (F.col("seqs") == F.sequence(
        F.lit(0).cast("bigint"), F.size("seqs").cast("bigint") - 1)).alias("in_order"), "text")


@register(
    "q_stream_metrics",
    "WITH t AS (SELECT count(*) AS n, sum(len(" + O.tokens_raw("'Answer: ' || text") + ")) AS k FROM conversations "
    "WHERE text IS NOT NULL) SELECT k::DOUBLE AS num_tokens, n::DOUBLE AS num_samples, k::DOUBLE AS total_tokens, "
    "n::DOUBLE AS total_samples, round(k / n, 6) AS tokens_per_sample FROM t",
)
def q_stream_metrics(spark, d):
    """ST5 + M5: events of the micro-batches of a streaming backend (sums of the
    epochs' own values, last totals)."""
    out = _stream(spark, d, lambda p: generate_stream(p, ECHO))
    ev = spark.read.parquet(f"{out}/metric_events/run_id=stream")
    names = ["num_tokens", "num_samples"]
    last = ["total_tokens", "total_samples", "throughput/tokens_per_sample"]
    own = ev.groupBy().pivot("name", names).sum("value")
    end = ev.groupBy().pivot("name", last).agg(F.max_by("value", "epoch"))
    return own.crossJoin(end).select(  # one row each
        *names, "total_tokens", "total_samples", r6(F.col("`throughput/tokens_per_sample`")).alias("tokens_per_sample"))


_PIECE = 64
_FIRST = "TIMESTAMP '2024-01-01 00:00:00'"


@register(
    "q_stream_state",
    f"SELECT {_ID} AS request_id, 0::BIGINT AS seq_index, text, greatest(1, (len(text) + {_PIECE - 1}) // {_PIECE})::BIGINT "
    "AS n_pieces, turn % 5 <> 4 AS complete FROM conversations WHERE text IS NOT NULL",
)
def q_stream_state(spark, d):
    """ST2 with state: every turn as pieces of 64 characters, dealt over three epochs in no
    order; every fifth turn never says that it is finished and leaves after the
    watermark, which a last epoch of one finished piece a conversation moves on."""
    conv = table(spark, d, "conversations").where("text IS NOT NULL").select(F.expr(_ID).alias("request_id"), "turn", "text")
    last = F.greatest(F.lit(0), F.ceil(F.char_length("text") / _PIECE).cast("int") - 1)
    pieces = conv.select("request_id", "turn", "text", last.alias("last"), F.explode(F.sequence(F.lit(0), last)).alias("seq")).select(
        "request_id", F.lit(0).cast("bigint").alias("seq_index"), F.col("seq").cast("bigint").alias("seq"),
        F.substring(F.col("text"), F.col("seq") * _PIECE + 1, F.lit(_PIECE)).alias("text"),
        ((F.col("seq") == F.col("last")) & (F.col("turn") % 5 != 4)).alias("finished"),
        F.timestamp_add("SECOND", F.pmod(F.xxhash64("seq", "request_id"), F.lit(300)).cast("int"), F.expr(_FIRST)).alias("event_time"))
    after = table(spark, d, "conversations").select(
        (-1 - F.col("conv_id")).alias("request_id"), F.lit(0).cast("bigint").alias("seq_index"), F.lit(0).cast("bigint").alias("seq"),
        F.lit("").alias("text"), F.lit(True).alias("finished"), F.expr(_FIRST + " + INTERVAL 1 DAY").alias("event_time")).distinct()
    path = scratch_path(spark, "pieces")
    files = max(1, int(pieces._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) >> 26)
    for epoch in range(3):
        part = pieces.where(F.pmod(F.xxhash64("request_id", "seq"), F.lit(3)) == epoch)
        part.repartition(files).write.mode("append").parquet(f"{path}/in")
    after.repartition(files).write.mode("append").parquet(f"{path}/in")
    feed = spark.readStream.schema(pieces.schema).option("maxFilesPerTrigger", files).parquet(f"{path}/in")
    q = assemble_responses(feed).writeStream.format("parquet").option("path", f"{path}/out").option(
        "checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(RESPONSE).parquet(f"{path}/out").where("request_id >= 0")


@register(
    "q_stream_attach",
    f"SELECT {_ID} AS prompt_id, text AS prompt, CASE WHEN turn % 2 = 0 THEN 'Answer: ' || text END AS generated_text "
    "FROM conversations",
)
def q_stream_attach(spark, d):
    """B3 on streams: prompts in two epochs, the outputs of a backend without answers for odd
    turns in two others; a last row on either side moves the watermarks on."""
    first = F.expr(_FIRST)
    at = lambda s: F.timestamp_add("SECOND", F.pmod(F.xxhash64("prompt_id"), F.lit(300)).cast("int") + s, first)
    prompts = _prompts(spark, d)
    answers = generate(prompts, even_seed_echo("Answer: {prompt}"), batch_col=None, seed_col="turn").where("generated_text IS NOT NULL")
    end = table(spark, d, "conversations").agg(F.lit(-1).cast("bigint").alias("prompt_id")).select(
        "prompt_id", F.lit("").alias("text"), (first + F.expr("INTERVAL 1 DAY")).alias("event_time"))
    path = scratch_path(spark, "attach")
    files = max(1, int(prompts._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) >> 26)
    feeds = []
    for name, rows, text, later in (("prompt", prompts, "prompt", 0), ("generated_text", answers, "generated_text", 60)):
        rows = rows.select("prompt_id", F.col(text).alias("text"), at(later).alias("event_time"))
        for part in (*(rows.where(F.pmod(F.xxhash64("prompt_id", F.lit(later)), F.lit(2)) == k) for k in (0, 1)), end):
            part.repartition(files).write.mode("append").parquet(f"{path}/{name}")
        feeds.append(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{path}/{name}")
                     .withColumnRenamed("text", name))
    joined = attach_outputs_stream(*feeds).select("prompt_id", "prompt", "generated_text")
    joined.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").trigger(
        availableNow=True).start().awaitTermination()
    return spark.read.schema(joined.schema).parquet(f"{path}/out").where("prompt_id >= 0")


# --------------------------------------------------------------------------
# The batch job end to end
# --------------------------------------------------------------------------
def _job(spark, d, fmt="parquet", pp=FULL, gen=GEN, backend=ECHO):
    prompts = apply_template(_prompts(spark, d).select("prompt_id", "prompt"), gen.prompt_template)
    cfg = RunConfig(model_name="echo", generation=gen, post_processing=pp,
                    output=Output(dir=scratch_path(spark, "job"), format=fmt))
    return run_batch_job(spark, prompts, cfg, backend, run_id="q")


def _job_oracle_ctes():
    src = (
        f"(SELECT {_ID} AS prompt_id, {_ORD} AS ordinal, "
        "'Q: ' || text AS prompt, 'Answer: Q: ' || text AS text FROM conversations)"
    )
    return O.post_process_ctes(src, "prompt_id, ordinal, prompt", 2048, True, True)


def _job_records_oracle():
    ctes, last = _job_oracle_ctes()
    return (
        f"WITH {ctes}\nSELECT prompt_id, (ordinal // 16)::BIGINT AS batch_id, prompt, t AS generated_text, "
        f"len({O.tokens_clean('t')})::BIGINT AS num_tokens, 'echo' AS model FROM {last}"
    )


@register("q_batch_job", _job_records_oracle())
def q_batch_job(spark, d):
    """P1 -> B1 -> B4 -> U1 -> F5/X6 -> T4 -> P3 -> K3 (K4: any case), read back from the written table."""
    paths = _job(spark, d, "Parquet")
    rec = spark.read.parquet(paths.records)
    return rec.select("prompt_id", "batch_id", "prompt", "generated_text", "num_tokens", "model")


@register(
    "q_job_multi_sequence",
    f"SELECT {_ID} AS prompt_id, unnest(range(3))::INTEGER AS seq_index, 'Q: ' || text AS prompt, "
    "'Q: ' || text || ' #' || unnest(range(3))::VARCHAR AS generated_text FROM conversations",
)
def q_job_multi_sequence(spark, d):
    """U3 in the job: a record for each of three texts a prompt, over CSV (K2)."""
    gen = Generation(prompt_template="Q: {prompt}", batch_size=16, num_return_sequences=3)
    paths = _job(spark, d, "CSV", PostProcessing(enabled=False), gen, echo("{prompt} #{index}"))
    from synthtext.sinks.records import read_records

    schema = T._parse_datatype_string("prompt_id bigint, seq_index int, prompt string, generated_text string")
    return read_records(spark, paths.records, "csv", schema)


@register(
    "q_job_totals",
    "WITH " + _job_oracle_ctes()[0] + f"\nSELECT sum(len({O.tokens_clean('t')}))::BIGINT AS total_tokens, "
    f"count(*)::BIGINT AS total_samples, round(sum(len({O.tokens_clean('t')})) / count(*), 6) AS tokens_per_sample "
    f"FROM {_job_oracle_ctes()[1]}",
)
def q_job_totals(spark, d):
    """K5: the run's metrics snapshot (its deterministic fields, one under its name space)."""
    paths = _job(spark, d)
    return spark.read.json(paths.metrics).select(
        F.col("total_tokens").cast("long"), F.col("total_samples").cast("long"),
        r6(F.col("`throughput/tokens_per_sample`")).alias("tokens_per_sample"))


def _events_oracle():
    ctes, last = _job_oracle_ctes()
    names = ("unique_tokens", "total_tokens", "unique_ratio", "entropy")
    per = " UNION ALL ".join(f"SELECT batch_id, 'diversity/{n}' AS name, {n}::DOUBLE AS value FROM x" for n in names)
    return (
        f"WITH {ctes},\nb AS (SELECT ordinal // 16 AS batch_id, {O.tokens_clean('t')} AS tok FROM {last}), "
        "c AS (SELECT batch_id, sum(sum(len(tok))) OVER w AS k, sum(count(*)) OVER w AS n FROM b GROUP BY batch_id "
        "WINDOW w AS (ORDER BY batch_id)), "
        "h AS (SELECT batch_id, tok, count(*) AS c FROM (SELECT batch_id, unnest(tok) AS tok FROM b) GROUP BY ALL), "
        f"x AS ({O.diversity_select('h', 'batch_id')}), "
        "e AS (SELECT batch_id, 'total_tokens' AS name, k::DOUBLE AS value FROM c UNION ALL "
        "SELECT batch_id, 'total_samples', n::DOUBLE FROM c UNION ALL "
        f"SELECT batch_id, 'throughput/tokens_per_sample', k / n FROM c UNION ALL {per}) "
        "SELECT batch_id::BIGINT AS batch_id, name, round(value, 6) AS value FROM e"
    )


@register("q_job_events", _events_oracle())
def q_job_events(spark, d):
    """K6: the metric events of every batch - running totals (M5) and diversity
    (M6) - but for those that hold clock times."""
    ev = spark.read.parquet(_job(spark, d).events)
    timed = ["total_time", "throughput/tokens_per_second", "throughput/samples_per_second", "throughput/seconds_per_sample"]
    return ev.where(~F.col("name").isin(timed)).select("batch_id", "name", r6("value").alias("value"))


@register(
    "q_job_samples",
    "WITH " + _job_oracle_ctes()[0] + f"\nSELECT (ordinal // 16)::BIGINT AS batch_id, (ordinal % 16)::BIGINT "
    f"AS position, prompt, t AS generated_text FROM {_job_oracle_ctes()[1]} "
    "WHERE (ordinal // 16) % 100 = 0 AND ordinal // 16 < 10 AND ordinal % 16 < 10",
)
def q_job_samples(spark, d):
    """K7 + W1 + F3: the logged sample table of the run (default cadence)."""
    paths = _job(spark, d)
    return spark.read.parquet(paths.samples).select("batch_id", "position", "prompt", "generated_text")


@register(
    "q_job_config",
    "SELECT 16::BIGINT AS batch_size, 'Q: {prompt}' AS prompt_template, count(*)::BIGINT AS records FROM conversations",
)
def q_job_config(spark, d):
    """K8: the configuration kept with a run, beside the number of its records."""
    paths = _job(spark, d)
    conf, n = spark.read.parquet(paths.config), spark.read.parquet(paths.records).select(F.count(F.lit(1))).scalar()
    return conf.select(
        F.get_json_object("config_json", "$.generation.batch_size").cast("bigint").alias("batch_size"),
        F.get_json_object("config_json", "$.generation.prompt_template").alias("prompt_template"), n.alias("records"))


def _job_raw_oracle():
    return (
        f"SELECT {_ID} AS prompt_id, ({_ORD} // 16)::BIGINT AS batch_id, 'Answer: Q: ' || text AS generated_text, "
        f"len({O.tokens_raw(chr(39) + 'Answer: Q: ' + chr(39) + ' || text')})::BIGINT AS num_tokens FROM conversations"
    )


@register("q_batch_job_raw", _job_raw_oracle())
def q_batch_job_raw(spark, d):
    """F5 off: the job writes raw generations; tokens are counted on raw text."""
    paths = _job(spark, d, "JSONL", PostProcessing(enabled=False))
    rec = spark.read.schema("prompt_id long, batch_id long, generated_text string, num_tokens long").json(paths.records)
    return rec.select("prompt_id", "batch_id", "generated_text", "num_tokens")


@register(
    "q_generator_run",
    "SELECT 'Q: ' || text AS prompt, 'Answer: Q: ' || text AS generated_text, true AS templated FROM conversations "
    "UNION ALL SELECT text, 'Answer: ' || text, false FROM conversations",
)
def q_generator_run(spark, d):
    """The generator surface with a registered backend (U4): prompts loaded from a
    file are templated once, given prompts not at all."""
    register_backend("echo-answer", EchoBackend)
    from synthtext.operators.backends import BackendSpec

    cfg = RunConfig(model_name="echo", post_processing=PostProcessing(enabled=False), generation=Generation(
        prompt_template="Q: {prompt}", prompt_file=f"{d.rstrip('/')}/conversations.parquet"),
        output=Output(dir=scratch_path(spark, "job"), format="parquet"))
    g = TextGenerator(spark, cfg, BackendSpec.of("echo-answer", template="Answer: {prompt}"))
    loaded, given = g.generate(run_id="loaded"), g.generate(_prompts(spark, d).select("prompt_id", "prompt"), "given")
    one = lambda p, t: spark.read.parquet(p.records).select("prompt", "generated_text", F.lit(t).alias("templated"))
    return one(loaded, True).union(one(given, False))


def _shared_runs_oracle():
    runs = (("first", "'A: ' || text"), ("second", "'C: ' || text"))
    return " UNION ALL ".join(
        f"SELECT '{name}' AS run_id, {_ID} AS prompt_id, {text} AS generated_text, len({O.tokens_raw(text)})::BIGINT AS num_tokens, "
        f"sum(len({O.tokens_raw(text)})) OVER ()::DOUBLE AS run_tokens FROM conversations" for name, text in runs)


@register("q_shared_runs", _shared_runs_oracle())
def q_shared_runs(spark, d):
    """K6, K8 and K9 in tables shared by all runs: a finished run, a run tried twice (the
    second counts), and a run that was killed before its manifest row; every record of the
    finished ones beside its run's last running total of tokens."""
    out = scratch_path(spark, "runs")
    prompts = _prompts(spark, d).select("prompt_id", "prompt")
    cfg = RunConfig(model_name="echo", generation=Generation(batch_size=16), post_processing=PostProcessing(enabled=False),
                    output=Output(dir=out, format="parquet"))
    run_shared_job(spark, prompts, cfg, echo("A: {prompt}"), "first", "1")
    run_shared_job(spark, prompts, cfg, echo("B: {prompt}"), "second", "1")
    run_shared_job(spark, prompts, cfg, echo("C: {prompt}"), "second", "2")
    R.write_attempt(generated_records(prompts, cfg, echo("D: {prompt}")), out, R.RECORDS, "killed", "1")
    R.write_attempt(generated_records(prompts, cfg, echo("E: {prompt}")), out, R.RECORDS, "first", "2")
    events = R.read_finished(spark, out, R.EVENTS)
    total = events.where("name = 'total_tokens'").groupBy("run_id").agg(F.max("value").alias("run_tokens"))
    rec = R.read_finished(spark, out, R.RECORDS)
    return rec.join(total, "run_id").select("run_id", "prompt_id", "generated_text", "num_tokens", "run_tokens")
