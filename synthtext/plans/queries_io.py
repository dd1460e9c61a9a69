"""Sinks and sources round trips (K1-K4, K9, S1-S7): conversation turns are
written with the record writers into a fresh folder below the checkpoint
root, then read back with the record and prompt readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from synthtext.config import Generation
from synthtext.operators.prompts import parameters_struct
from synthtext.plans import oracle as O
from synthtext.plans.registry import register, table
from synthtext.session import scratch_path
from synthtext.sinks import records as K
from synthtext.sources import prompts as S


def _records(spark, d):
    """Output records with the turn text as prompt, nested parameters, and texts
    that a format may spoil: null, empty, white space, quotes, line ends."""
    t = F.col("text")
    odd = (F.when(F.col("turn") == 0, F.lit("")).when(F.col("turn") == 1, F.lit(None))
           .when(F.col("turn") == 2, F.concat(F.lit('  "lead" \\, '), t, F.lit(" \t")))
           .when(F.col("turn") == 3, F.concat(t, F.lit("\r\nnext\rlast\n"))).otherwise(t))
    return table(spark, d, "conversations").select(
        "conv_id", "turn", t.alias("prompt"), odd.alias("generated_text"),
        F.lit("echo").alias("model"), parameters_struct(Generation()).alias("parameters"))


_FIELDS_SQL = (
    "SELECT conv_id, turn, text AS prompt, CASE turn WHEN 0 THEN '' WHEN 1 THEN NULL "
    "WHEN 2 THEN '  \"lead\" \\, ' || text || ' ' || chr(9) "
    "WHEN 3 THEN text || chr(13) || chr(10) || 'next' || chr(13) || 'last' || chr(10) ELSE text END AS generated_text, "
    "'echo' AS model, 0.8::DOUBLE AS temperature, 0.92::DOUBLE AS top_p, 50::INTEGER AS top_k, "
    "1024::INTEGER AS max_length FROM conversations"
)
_PROMPTS_SQL = "SELECT text AS prompt FROM conversations WHERE text IS NOT NULL"


def _written(spark, d, fmt):
    path = K.records_path(scratch_path(spark, "roundtrip"), "rt") + "/"
    K.write_records(_records(spark, d), path, fmt)
    return path


def _fields(spark, d, fmt):
    back = K.read_records(spark, _written(spark, d, fmt), fmt, _records(spark, d).schema)
    return back.select("conv_id", "turn", "prompt", "generated_text", "model", "parameters.*")


@register("q_roundtrip_jsonl", _FIELDS_SQL)
def q_roundtrip_jsonl(spark, d):
    """K1 (JSON lines, nulls kept): every field."""
    return _fields(spark, d, "JSONL")


@register("q_roundtrip_csv", _FIELDS_SQL)
def q_roundtrip_csv(spark, d):
    """K2 (CSV with header, parameters as JSON): every field."""
    return _fields(spark, d, "Csv")


@register("q_roundtrip_parquet", _FIELDS_SQL)
def q_roundtrip_parquet(spark, d):
    """K3 (Parquet): every field."""
    return _fields(spark, d, "PARQUET")


def _prompts(spark, d, fmt):
    # The folder holds part files: the reader is chosen by ``format``.
    return S.read_prompts(spark, _written(spark, d, fmt), format=fmt).select("prompt")


@register("q_prompts_jsonl", _PROMPTS_SQL)
def q_prompts_jsonl(spark, d):
    """K1 -> S3 (object -> prompt)."""
    return _prompts(spark, d, "jsonl")


@register("q_prompts_csv", _PROMPTS_SQL)
def q_prompts_csv(spark, d):
    """K2 -> S4/S6 (column ``prompt`` chosen)."""
    return _prompts(spark, d, "csv")


@register("q_prompts_parquet", _PROMPTS_SQL)
def q_prompts_parquet(spark, d):
    """K3 -> S5/S6 (column ``prompt`` chosen)."""
    return _prompts(spark, d, "parquet")


@register(
    "q_prompt_rejects",
    "SELECT CASE turn % 4 WHEN 1 THEN '{\"other\":' || turn || '}' ELSE '{\"prompt\": ' || turn END AS item, "
    "CASE turn % 4 WHEN 1 THEN 'no prompt' ELSE 'invalid JSON' END AS reason, count(*)::BIGINT AS n, "
    "(SELECT count(*) FROM conversations WHERE turn % 4 NOT IN (1, 2))::BIGINT AS prompts "
    "FROM conversations WHERE turn % 4 IN (1, 2) GROUP BY ALL",
)
def q_prompt_rejects(spark, d):
    """S3 + S7 with rejects: a line of every turn, half of them without a prompt
    or cut off."""
    conv = table(spark, d, "conversations")
    turn = F.col("turn").cast("string")
    line = (F.when(F.col("turn") % 4 == 1, F.concat(F.lit('{"other":'), turn, F.lit("}")))
            .when(F.col("turn") % 4 == 2, F.concat(F.lit('{"prompt": '), turn))
            .otherwise(F.to_json(F.struct(F.col("text").alias("prompt")))))
    path = scratch_path(spark, "rejects") + "/lines/"
    conv.select(line.alias("value")).write.text(path)
    prompts, rejects = S.read_prompts_checked(spark, path, format="jsonl")
    n = prompts.select(F.count(F.lit(1))).scalar()
    return rejects.groupBy("item", "reason").agg(F.count(F.lit(1)).alias("n")).withColumn("prompts", n)


@register(
    "q_roundtrip_text",
    "SELECT p AS prompt FROM (SELECT regexp_replace(unnest(regexp_split_to_array(text, '\r\n|\r|\n')), "
    f"'^{O.WS}|{O.WS}$', '', 'g') AS p FROM conversations) WHERE length(p) > 0",
)
def q_roundtrip_text(spark, d):
    """Text lines -> S1 + F1: every non-blank line of every turn, stripped."""
    path = scratch_path(spark, "roundtrip") + "/prompts/"
    table(spark, d, "conversations").select(F.col("text").alias("value")).write.text(path)
    return S.read_prompts(spark, path, format="txt").select("prompt")


_PER_DOCUMENT = 20


@register(
    "q_roundtrip_json_document",
    "SELECT text AS prompt FROM conversations UNION ALL "
    f"SELECT arg_min(text, (conv_id, turn)) FROM conversations GROUP BY conv_id // {_PER_DOCUMENT}",
)
def q_roundtrip_json_document(spark, d):
    """One JSON document per file in all three shapes, a file for the turns of
    20 conversations: an array of strings and objects or
    ``{"prompts": [...]}`` of them all, and ``{"prompt": ...}`` of the first."""
    conv = table(spark, d, "conversations").select("conv_id", "turn", "text")
    # the text as a JSON string literal
    t = F.regexp_extract(F.to_json(F.struct(F.col("text").alias("p"))), r'(?s)^\{"p":(.*)\}$', 1)
    item = F.when(F.col("turn") % 2 == 0, t).otherwise(F.concat(F.lit('{"prompt": '), t, F.lit(', "x": 1}')))
    docs = conv.groupBy(F.floor(F.col("conv_id") / _PER_DOCUMENT).alias("doc")).agg(
        F.concat(F.lit("["), F.concat_ws(", ", F.collect_list(item)), F.lit("]")).alias("items"),
        F.min_by(t, F.struct("conv_id", "turn")).alias("first"))
    many = F.when(F.col("doc") % 2 == 0, F.col("items")).otherwise(
        F.concat(F.lit('{"prompts": '), F.col("items"), F.lit("}")))
    value = F.explode(F.array(
        F.struct(F.lit("many").alias("kind"), many.alias("value")),
        F.struct(F.lit("first").alias("kind"), F.concat(F.lit('{"prompt": '), F.col("first"), F.lit("}")).alias("value"))))
    path = scratch_path(spark, "roundtrip") + "/docs"
    docs.select("doc", value.alias("v")).select("doc", "v.*").write.partitionBy("kind", "doc").text(path)
    return S.read_prompts_json(spark, path + "/*/*/").select("prompt")


_ODD_SQL = "CASE turn % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE text END"


@register(
    "q_csv_null_prompts",
    f"SELECT {_ODD_SQL} AS prompt, {_ODD_SQL} IS NULL AS rejected, count(*)::BIGINT AS n FROM conversations GROUP BY ALL",
)
def q_csv_null_prompts(spark, d):
    """K2 -> S4 with rejects: records whose prompts are empty, null or a text, by turn;
    the empty ones come back as prompts, the null ones as rejects."""
    turn = F.col("turn") % 3
    odd = F.when(turn == 0, F.lit("")).when(turn == 2, F.col("prompt"))
    path = K.records_path(scratch_path(spark, "roundtrip"), "rt") + "/"
    K.write_records(_records(spark, d).withColumn("prompt", odd), path, "csv")
    prompts, rejects = S.read_prompts_checked(spark, path, format="csv")
    both = prompts.select("prompt", F.lit(False).alias("rejected")).union(
        rejects.select(F.lit(None).cast("string"), F.lit(True)))
    return both.groupBy("prompt", "rejected").agg(F.count(F.lit(1)).alias("n"))


@register(
    "q_stream_rejects",
    "SELECT CASE turn % 4 WHEN 1 THEN '{\"other\":' || turn || '}' WHEN 2 THEN '{\"prompt\": ' || turn END AS item, "
    "CASE WHEN turn % 4 NOT IN (1, 2) THEN text END AS prompt, "
    "CASE turn % 4 WHEN 1 THEN 'no prompt' WHEN 2 THEN 'invalid JSON' END AS reason, "
    "count(*)::BIGINT AS n, true AS own_ids FROM conversations WHERE turn % 4 IN (1, 2) OR text IS NOT NULL GROUP BY ALL",
)
def q_stream_rejects(spark, d):
    """S10 with rejects: a JSON line of every turn, half of them without a prompt or cut
    off, fed as a stream by byte ranges; every line has an id of its own."""
    conv = table(spark, d, "conversations").where("turn % 4 IN (1, 2) OR text IS NOT NULL")
    turn = F.col("turn").cast("string")
    line = (F.when(F.col("turn") % 4 == 1, F.concat(F.lit('{"other":'), turn, F.lit("}")))
            .when(F.col("turn") % 4 == 2, F.concat(F.lit('{"prompt": '), turn))
            .otherwise(F.to_json(F.struct(F.col("text").alias("prompt")))))
    path = scratch_path(spark, "rejects")
    conv.select(line.alias("value")).write.text(f"{path}/lines")
    feed = S.read_prompt_items_stream(spark, f"{path}/lines", "jsonl", glob="part-*")
    feed.writeStream.format("parquet").option("path", f"{path}/items").option(
        "checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    items = spark.read.schema(feed.schema).parquet(f"{path}/items")
    ids = items.agg((F.count_distinct("prompt_id") == F.count(F.lit(1))).alias("own_ids"))
    item = F.when(F.col("prompt").isNull(), F.col("item"))
    rows = items.groupBy(item.alias("item"), "prompt", "reason").agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn("own_ids", ids.scalar())
