"""Prompt sources and shaping, samples, token arrays, request parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from synthtext.functions import text as X
from synthtext.functions.tokens import tokenize, truncate_tokens
from synthtext.operators import batching as B
from synthtext.operators import samples as W
from synthtext.operators.prompts import apply_template, prepend_bos, sampling_params
from synthtext.operators.tokens import pad_batch, token_stream
from synthtext.plans import oracle as O
from synthtext.plans.registry import r6, register, table
from synthtext.sources.prompts import read_prompts_parquet, synthesize_prompts_for

# --------------------------------------------------------------------------
# User turns as prompts, templated, BOS added when missing
# --------------------------------------------------------------------------
TEMPLATE = "{prompt} [END] {{done}}"
BOS = "In"


@register(
    "q_prompt_template",
    "WITH p AS (SELECT conv_id, turn, regexp_replace(text, '^" + O.WS[:-1] + "+|" + O.WS
    + "$', '', 'g') AS prompt FROM conversations), "
    "t AS (SELECT conv_id, turn, prompt || ' [END] {done}' AS prompt FROM p WHERE length(prompt) > 0) "
    f"SELECT conv_id, turn, CASE WHEN starts_with(prompt, '{BOS}') THEN prompt "
    f"ELSE '{BOS}' || prompt END AS prompt FROM t",
)
def q_prompt_template(spark, d):
    conv = table(spark, d, "conversations")
    p = conv.select("conv_id", "turn", X.ustrip("text").alias("prompt")).where(F.length("prompt") > 0)
    return prepend_bos(apply_template(p, TEMPLATE), BOS)


# --------------------------------------------------------------------------
# Prompt column choice and synthetic prompts
# --------------------------------------------------------------------------
@register(
    "q_prompt_column",
    "SELECT text AS prompt, length(text)::BIGINT AS n_chars FROM documents WHERE text IS NOT NULL",
)
def q_prompt_column(spark, d):
    p = read_prompts_parquet(spark, f"{d.rstrip('/')}/documents.parquet")
    return p.select("prompt", F.length("prompt").cast("long").alias("n_chars"))


@register(
    "q_synth_prompts",
    "SELECT doc_id AS prompt_id, 'Write a short story about ' || "
    "(['space travel','time travel','dragons','robots','magic'])"
    "[(('0x' || substr(md5('42:' || doc_id::VARCHAR), 1, 8))::BIGINT % 5) + 1] AS prompt "
    "FROM documents",
)
def q_synth_prompts(spark, d):
    return synthesize_prompts_for(table(spark, d, "documents"), "doc_id", seed=42)


# --------------------------------------------------------------------------
# Logged samples of batched documents
# --------------------------------------------------------------------------
BS, LOG_SAMPLES, LOG_INTERVAL = 16, 10, 3


def _batched_docs(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return B.assign_batches(docs, BS, ["doc_id"], total_col="total", unique_keys=True)


_ORD = "(row_number() OVER (ORDER BY doc_id) - 1)"


@register(
    "q_samples",
    f"WITH o AS (SELECT doc_id, {_ORD} AS ord FROM documents) "
    f"SELECT (ord // {BS})::BIGINT AS batch_id, (ord % {BS})::BIGINT AS position, doc_id FROM o "
    f"WHERE (ord // {BS}) % {LOG_INTERVAL} = 0 AND ord // {BS} < {LOG_SAMPLES} AND ord % {BS} < {LOG_SAMPLES}",
)
def q_samples(spark, d):
    return W.sample_table(_batched_docs(spark, d), BS, LOG_SAMPLES, LOG_INTERVAL, cols=("doc_id",))


@register(
    "q_sample_pick",
    f"WITH o AS (SELECT doc_id, text, {_ORD} AS ord, count(*) OVER () AS n FROM documents) "
    f"SELECT (ord // {BS})::BIGINT AS batch_id, substr(text, 1, 100) || '...' AS prompt_preview, "
    f"substr({O.clean('text')}, 1, 200) || '...' AS text_preview FROM o "
    f"WHERE (ord // {BS}) % {LOG_INTERVAL} = 0 AND ord // {BS} < {LOG_SAMPLES} "
    f"AND ord % {BS} = least({LOG_SAMPLES} - 1, least({BS}, n - (ord // {BS}) * {BS}) - 1)",
)
def q_sample_pick(spark, d):
    b = _batched_docs(spark, d).withColumn("clean", X.clean_whitespace("text"))
    return W.sample_pick(b, BS, LOG_SAMPLES, LOG_INTERVAL, prompt_col="text", text_col="clean")


# --------------------------------------------------------------------------
# Token arrays of conversation turns
# --------------------------------------------------------------------------
PAD_BATCH, MAX_TOKENS = 8, 64


@register(
    "q_pad_batch",
    "WITH o AS (SELECT conv_id, turn, (row_number() OVER (ORDER BY conv_id, turn) - 1) // "
    f"{PAD_BATCH} AS batch_id, ({O.tokens_raw('text')})[1:{MAX_TOKENS}] AS tok FROM conversations), "
    "w AS (SELECT *, max(len(tok)) OVER (PARTITION BY batch_id) AS width FROM o) "
    "SELECT conv_id, turn, batch_id::BIGINT AS batch_id, width::BIGINT AS width, "
    "array_to_string(list_concat(tok, list_transform(range(width - len(tok)), lambda x: '<pad>')), ' ') AS ids, "
    "repeat('1', len(tok)::BIGINT) || repeat('0', (width - len(tok))::BIGINT) AS mask FROM w",
)
def q_pad_batch(spark, d):
    conv = table(spark, d, "conversations").select("conv_id", "turn", "text")
    # (conv_id, turn) is unique and the padding window re-partitions by
    # batch_id anyway, so rank a key-only projection and join it back.
    b = B.assign_batches(conv, PAD_BATCH, ["conv_id", "turn"], unique_keys=True)
    b = b.withColumn("tok", truncate_tokens(tokenize("text"), MAX_TOKENS, "right"))
    p = pad_batch(b, "tok", "<pad>", side="right")
    return p.select(
        "conv_id", "turn", "batch_id",
        F.size("input_ids").cast("long").alias("width"),
        F.array_join("input_ids", " ").alias("ids"),
        F.array_join(F.col("attention_mask").cast("array<string>"), "").alias("mask"),
    )


@register(
    "q_pad_batch_left",
    "WITH o AS (SELECT conv_id, turn, (row_number() OVER (ORDER BY conv_id, turn) - 1) // "
    f"{PAD_BATCH} AS batch_id, ({O.tokens_raw('text')})[-{MAX_TOKENS}:] AS tok FROM conversations), "
    "w AS (SELECT *, max(len(tok)) OVER (PARTITION BY batch_id) AS width FROM o) "
    "SELECT conv_id, turn, "
    "array_to_string(list_concat(list_transform(range(width - len(tok)), lambda x: '<pad>'), tok), ' ') AS ids, "
    "repeat('0', (width - len(tok))::BIGINT) || repeat('1', len(tok)::BIGINT) AS mask FROM w",
)
def q_pad_batch_left(spark, d):
    """T2 and T3 on the left side."""
    conv = table(spark, d, "conversations").select("conv_id", "turn", "text")
    b = B.assign_batches(conv, PAD_BATCH, ["conv_id", "turn"], unique_keys=True)
    b = b.withColumn("tok", truncate_tokens(tokenize("text"), MAX_TOKENS, "left"))
    p = pad_batch(b, "tok", "<pad>", side="left")
    return p.select("conv_id", "turn", F.array_join("input_ids", " ").alias("ids"),
                    F.array_join(F.col("attention_mask").cast("array<string>"), "").alias("mask"))


@register(
    "q_token_stream",
    "WITH t AS (SELECT conv_id, turn, " + O.tokens_raw("text") + " AS tok FROM conversations) "
    "SELECT conv_id, turn, (generate_subscripts(tok, 1) - 1)::BIGINT AS position, "
    "unnest(tok) AS token FROM t",
)
def q_token_stream(spark, d):
    conv = table(spark, d, "conversations")
    t = conv.select("conv_id", "turn", tokenize("text").alias("tok"))
    return token_stream(t, "tok", keep=("conv_id", "turn")).withColumn(
        "position", F.col("position").cast("long")
    )


# --------------------------------------------------------------------------
# Per-request sampling parameters derived from events
# --------------------------------------------------------------------------
def _requests(spark, d):
    ev = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    return ev.select(
        "event_id",
        F.when(F.col("event_type") != "view", F.col("value") / 100).alias("temperature"),
        F.when(F.col("event_type") != "signup", (k % 10) / 10.0).alias("top_p"),
        k.cast("int").alias("top_k"),
        (F.lit(1.0) + F.pmod(k, F.lit(3)) / 10.0).alias("repetition_penalty"),
        F.when(F.col("event_type") != "click", (k * 8).cast("int")).alias("max_length"),
        (F.col("event_type") != "error").alias("do_sample"),
        (F.lit(1) + F.pmod(k, F.lit(4))).cast("int").alias("num_return_sequences"),
    )


_REQ_SQL = (
    "SELECT event_id, CASE WHEN event_type <> 'view' THEN value / 100 END AS temperature, "
    "CASE WHEN event_type <> 'signup' THEN (json_extract(props, '$.k')::BIGINT % 10) / 10.0 END AS top_p, "
    "json_extract(props, '$.k')::INTEGER AS top_k, "
    "1.0 + (json_extract(props, '$.k')::BIGINT % 3) / 10.0 AS repetition_penalty, "
    "CASE WHEN event_type <> 'click' THEN (json_extract(props, '$.k')::BIGINT * 8)::INTEGER END AS max_length, "
    "event_type <> 'error' AS do_sample, "
    "(1 + json_extract(props, '$.k')::BIGINT % 4)::INTEGER AS num_return_sequences FROM events"
)


@register(
    "q_sampling_params",
    f"WITH r AS ({_REQ_SQL}), f AS (SELECT event_id, coalesce(temperature, 0.8) AS temperature, "
    "coalesce(top_p, 0.92) AS top_p, coalesce(top_k, 50) AS top_k, coalesce(repetition_penalty, 1.0) AS rp, "
    "coalesce(max_length, 1024) AS max_length, coalesce(do_sample, true) AS do_sample, "
    "coalesce(num_return_sequences, 1) AS nrs FROM r) "
    "SELECT event_id, round(temperature, 6) AS temperature, round(top_p, 6) AS top_p, top_k, "
    "max_length AS max_tokens, round(CASE WHEN rp = 1.0 THEN 0.0 ELSE rp - 1.0 END, 6) AS presence_penalty, "
    "0.0::DOUBLE AS frequency_penalty, nrs AS n, NOT do_sample AS use_beam_search, "
    "CASE WHEN NOT do_sample THEN nrs END AS best_of FROM f",
)
def q_sampling_params(spark, d):
    sp = sampling_params(_requests(spark, d))
    return sp.select(
        "event_id", r6("temperature").alias("temperature"), r6("top_p").alias("top_p"), "top_k",
        "max_tokens", r6("presence_penalty").alias("presence_penalty"), "frequency_penalty", "n",
        "use_beam_search", "best_of",
    )
