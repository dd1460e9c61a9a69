"""Text clean-up, tokens, diversity, batches and shards over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from synthtext.config import PostProcessing
from synthtext.functions import text as X
from synthtext.functions.tokens import tokenize, tokenize_clean
from synthtext.operators import batching as B
from synthtext.operators import metrics as M
from synthtext.operators.postprocess import apply_post_processing, min_length_filter
from synthtext.plans import oracle as O
from synthtext.plans.registry import r6, register, table
from synthtext.session import spread

# Post-processing defaults of the reference configuration (X6 inputs).
FULL = PostProcessing(max_length=2048, complete_sentences=True, deduplicate=True)
# The same over whole texts: metrics count every token.
WHOLE = PostProcessing(max_length=None, complete_sentences=True, deduplicate=True)


# --------------------------------------------------------------------------
# Text clean-up over whole documents
# --------------------------------------------------------------------------
@register("q_clean_whitespace", f"SELECT doc_id, {O.clean('text')} AS text_out FROM documents")
def q_clean_whitespace(spark, d):
    return spread(table(spark, d, "documents").select("doc_id", "text")).select(
        "doc_id", X.clean_whitespace("text").alias("text_out")
    )


@register(
    "q_simple_post_process",
    f"SELECT doc_id, substr({O.clean('text')}, 1, 500) AS text_out FROM documents",
)
def q_simple_post_process(spark, d):
    return spread(table(spark, d, "documents").select("doc_id", "text")).select(
        "doc_id", X.simple_post_process("text", 500).alias("text_out")
    )


def _pp_oracle(n, complete, dedup, extra_cols="", src="documents", keep="doc_id"):
    ctes, last = O.post_process_ctes(src, keep, n, complete, dedup)
    return f"WITH {ctes}\nSELECT {keep}, t AS text_out{extra_cols} FROM {last}"


@register("q_truncate_200", _pp_oracle(200, False, False))
def q_truncate_200(spark, d):
    df = spread(table(spark, d, "documents").select("doc_id", "text"))
    out = apply_post_processing(df, "text", PostProcessing(max_length=200, complete_sentences=False, deduplicate=False))
    return out.select("doc_id", F.col("text").alias("text_out"))


@register("q_complete_sentences", _pp_oracle(None, True, False))
def q_complete_sentences(spark, d):
    df = spread(table(spark, d, "documents").select("doc_id", "text"))
    cfg = PostProcessing(max_length=None, complete_sentences=True, deduplicate=False)
    return apply_post_processing(df, "text", cfg).select("doc_id", F.col("text").alias("text_out"))


@register("q_dedup_sentences", _pp_oracle(None, False, True))
def q_dedup_sentences(spark, d):
    df = spread(table(spark, d, "documents").select("doc_id", "text"))
    cfg = PostProcessing(max_length=None, complete_sentences=False, deduplicate=True)
    return apply_post_processing(df, "text", cfg).select("doc_id", F.col("text").alias("text_out"))


@register("q_post_process_full", _pp_oracle(2048, True, True, ", length(t)::BIGINT AS n_chars_out"))
def q_post_process_full(spark, d):
    df = spread(table(spark, d, "documents").select("doc_id", "text"))
    out = apply_post_processing(df, "text", FULL)
    return out.select(
        "doc_id", F.col("text").alias("text_out"), F.length("text").cast("long").alias("n_chars_out")
    )


@register(
    "q_min_length",
    "SELECT doc_id, n_chars FROM documents WHERE length(text) >= 1000",
)
def q_min_length(spark, d):
    df = table(spark, d, "documents").select("doc_id", "text", "n_chars")
    return min_length_filter(df, "text", 1000).select("doc_id", "n_chars")


# --------------------------------------------------------------------------
# Tokens and diversity
# --------------------------------------------------------------------------
@register(
    "q_token_histogram",
    f"SELECT tok AS token, count(*)::BIGINT AS count FROM "
    f"(SELECT unnest({O.tokens_raw('text')}) AS tok FROM documents) GROUP BY tok",
)
def q_token_histogram(spark, d):
    df = spread(table(spark, d, "documents").select("text"))
    return M.token_histogram(df, tokenize("text")).select("token", F.col("count").cast("long"))


def _diversity_by_lang_oracle():
    ctes, last = O.post_process_ctes("documents", "doc_id, lang", None, True, True)
    return (
        f"WITH {ctes},\n"
        f"h AS (SELECT lang, tok, count(*) AS c FROM "
        f"(SELECT lang, unnest({O.tokens_clean('t')}) AS tok FROM {last}) GROUP BY lang, tok)\n"
        + O.diversity_select("h", "lang")
    )


@register("q_token_diversity_by_lang", _diversity_by_lang_oracle())
def q_token_diversity_by_lang(spark, d):
    """Flagship: X6 over whole documents, then M2 per language."""
    df = spread(table(spark, d, "documents").select("doc_id", "lang", "text"))
    processed = apply_post_processing(df, "text", WHOLE)
    div = M.token_diversity(processed, text_col="text", group_cols=["lang"], tokenizer=tokenize_clean)
    return div.select(
        "lang", "unique_tokens", "total_tokens", r6("unique_ratio").alias("unique_ratio"),
        r6("entropy").alias("entropy"),
    )


@register(
    "q_token_diversity",
    "WITH h AS (SELECT tok, count(*) AS c FROM (SELECT unnest("
    + O.tokens_raw("text")
    + ") AS tok FROM documents) GROUP BY tok) "
    + O.diversity_select("h", ""),
)
def q_token_diversity(spark, d):
    df = spread(table(spark, d, "documents").select("text"))
    div = M.token_diversity(df, text_col="text")
    return div.select(
        "unique_tokens", "total_tokens", r6("unique_ratio").alias("unique_ratio"),
        r6("entropy").alias("entropy"),
    )


# --------------------------------------------------------------------------
# Batches and shards over documents ordered by doc_id
# --------------------------------------------------------------------------
BATCH = 16
SHARDS = 7


@register(
    "q_batches",
    f"SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS ordinal, "
    f"((row_number() OVER (ORDER BY doc_id) - 1) // {BATCH})::BIGINT AS batch_id FROM documents",
)
def q_batches(spark, d):
    df = table(spark, d, "documents").select("doc_id")
    return B.assign_batches(df, BATCH, ["doc_id"]).select("doc_id", "ordinal", "batch_id")


@register(
    "q_shards",
    f"WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS ord, "
    f"count(*) OVER () AS n FROM documents) "
    f"SELECT doc_id, (CASE WHEN n // {SHARDS} = 0 THEN {SHARDS - 1} "
    f"ELSE least(ord // (n // {SHARDS}), {SHARDS - 1}) END)::BIGINT AS shard_id FROM o",
)
def q_shards(spark, d):
    df = table(spark, d, "documents").select("doc_id")
    return B.assign_shards(df, SHARDS, ["doc_id"]).select("doc_id", "shard_id")


def _batch_diversity_oracle():
    ctes, last = O.post_process_ctes(
        "(SELECT doc_id, text, (row_number() OVER (ORDER BY doc_id) - 1) // 16 AS batch_id FROM documents)",
        "doc_id, batch_id", None, True, True,
    )
    return (
        f"WITH {ctes},\n"
        f"h AS (SELECT batch_id, tok, count(*) AS c FROM "
        f"(SELECT batch_id, unnest({O.tokens_clean('t')}) AS tok FROM {last}) GROUP BY batch_id, tok)\n"
        "SELECT b.batch_id::BIGINT AS batch_id, coalesce(unique_tokens, 0)::BIGINT AS unique_tokens, "
        "coalesce(total_tokens, 0)::BIGINT AS total_tokens, coalesce(unique_ratio, 0) AS unique_ratio, "
        "coalesce(entropy, 0) AS entropy FROM (SELECT DISTINCT batch_id FROM "
        f"{last}) b LEFT JOIN ({O.diversity_select('h', 'batch_id')}) x ON b.batch_id = x.batch_id"
    )


@register("q_token_diversity_by_batch", _batch_diversity_oracle())
def q_token_diversity_by_batch(spark, d):
    # X6 is row-local and batches depend on doc_id only: post-process first,
    # then join the key-only ordinals, so no raw text is shuffled or re-read.
    df = spread(table(spark, d, "documents").select("doc_id", "text"))
    processed = apply_post_processing(df, "text", WHOLE)
    batched = B.assign_batches(processed, BATCH, ["doc_id"], unique_keys=True)
    div = M.token_diversity(batched, text_col="text", group_cols=["batch_id"], tokenizer=tokenize_clean)
    return div.select(
        "batch_id", "unique_tokens", "total_tokens", r6("unique_ratio").alias("unique_ratio"),
        r6("entropy").alias("entropy"),
    )


def _running_diversity_oracle():
    return (
        f"WITH o AS (SELECT (row_number() OVER (ORDER BY doc_id) - 1) // {BATCH} AS batch_id, {O.tokens_raw('text')} AS tok "
        "FROM documents), t AS (SELECT batch_id, unnest(tok) AS tok FROM o), "
        "f AS (SELECT b AS batch_id, count(*) AS n FROM (SELECT tok, min(batch_id) AS b FROM t GROUP BY tok) GROUP BY b), "
        "c AS (SELECT batch_id, sum(len(tok)) AS k FROM o GROUP BY batch_id) "
        "SELECT batch_id::BIGINT AS batch_id, coalesce(sum(n) OVER w, 0)::BIGINT AS unique_tokens, "
        "coalesce(sum(k) OVER w, 0)::BIGINT AS total_tokens, true AS sketch_near "
        "FROM c LEFT JOIN f USING (batch_id) WINDOW w AS (ORDER BY batch_id)"
    )


@register("q_running_diversity", _running_diversity_oracle())
def q_running_diversity(spark, d):
    """M2, mergeable: the unique tokens so far after every batch, exact (from each
    token's first batch) and whether the union of the batches' written sketches is
    within the tolerance; totals come from the sketches' table."""
    from synthtext.operators import sketches as S
    from synthtext.session import scratch_path

    df = spread(table(spark, d, "documents").select("doc_id", "text"))
    tokens = df.select("doc_id", tokenize(F.col("text")).alias("tokens"))
    batched = B.assign_batches(tokens, BATCH, ["doc_id"], unique_keys=True).select("batch_id", "tokens")
    path = scratch_path(spark, "sketches")
    S.token_sketches(batched, "tokens", ["batch_id"]).write.parquet(path)
    per_batch = spark.read.parquet(path)
    first = batched.select("batch_id", F.explode("tokens").alias("token")).groupBy("token").agg(F.min("batch_id").alias("batch_id"))
    new = first.groupBy("batch_id").agg(F.count(F.lit(1)).alias("unique_tokens"))
    new = per_batch.select("batch_id").join(new, "batch_id", "left").fillna(0, ["unique_tokens"])
    exact = M.running_totals(new, "batch_id", ["unique_tokens"]).select("batch_id", "cum_unique_tokens")
    so_far = S.running_sketches(per_batch, "batch_id").join(exact, "batch_id")
    n = F.col("cum_unique_tokens")
    return so_far.select(
        "batch_id", n.cast("bigint").alias("unique_tokens"), "total_tokens",
        (F.abs(S.unique_tokens("sketch") - n) <= S.TOLERANCE * n).alias("sketch_near"))


def _sketch_oracle():
    return (
        f"WITH o AS (SELECT lang, {O.tokens_raw('text')} AS tok FROM documents), "
        "t AS (SELECT lang, unnest(tok) AS tok FROM o), "
        "u AS (SELECT lang, count(DISTINCT tok) AS n FROM t GROUP BY lang), "
        "k AS (SELECT lang, coalesce(sum(len(tok)), 0) AS k FROM o GROUP BY lang) "
        "SELECT k.lang, coalesce(n, 0)::BIGINT AS unique_tokens, k::BIGINT AS total_tokens, true AS sketch_near "
        "FROM k LEFT JOIN u ON k.lang IS NOT DISTINCT FROM u.lang"
    )


@register("q_token_diversity_sketch", _sketch_oracle())
def q_token_diversity_sketch(spark, d):
    """M2, approximate: exact distinct tokens of each language beside sketches of
    (language, source), merged to languages."""
    from synthtext.operators import sketches as S

    df = spread(table(spark, d, "documents").select("lang", "source", "text"))
    tokens = df.select("lang", "source", tokenize(F.col("text")).alias("tokens"))
    merged = S.approx_diversity(S.merge_sketches(S.token_sketches(tokens, "tokens", ["lang", "source"]), ["lang"]), ["lang"])
    exact = M.diversity_from_histogram(M.token_histogram(tokens, "tokens", ["lang"], keep_empty_groups=True), ["lang"])
    exact = exact.select(F.col("lang").alias("__lang"), F.col("unique_tokens").alias("n"))
    n = F.col("n")
    return merged.join(exact, F.col("lang").eqNullSafe(F.col("__lang"))).select(
        "lang", n.alias("unique_tokens"), "total_tokens",
        (F.abs(F.col("unique_tokens") - n) <= S.TOLERANCE * n).alias("sketch_near"))


@register(
    "q_progress",
    f"WITH o AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS ord FROM documents) "
    f"SELECT (ord // {BATCH})::BIGINT AS batch_id, count(*)::BIGINT AS batch_samples, "
    f"(max(ord) + 1)::BIGINT AS done, (SELECT count(*) FROM documents)::BIGINT AS total "
    f"FROM o GROUP BY ord // {BATCH}",
)
def q_progress(spark, d):
    df = table(spark, d, "documents").select("doc_id")
    return M.progress(B.assign_batches(df, BATCH, ["doc_id"], total_col="total"))


