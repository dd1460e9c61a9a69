"""Prompt sources (S1-S10) returning ``(prompt_id BIGINT, prompt STRING)``.

``prompt_id`` replaces the list position of the reference. It comes from
``monotonically_increasing_id`` right after the scan, so it is unique, stable
when a task is re-run over the same split, and increasing in line order within
a file. Null prompts (empty CSV cells, JSON objects without ``prompt``) never
become the text "nan".

Items that give no prompt are rejects: ``failfast`` mode raises on the first,
``permissive`` mode leaves them out of the prompts, and ``read_prompts_checked``
returns them too, as ``(file, position, item, reason)``. A JSON value above the
size that a VARIANT holds raises in either mode rather than counting as invalid.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from synthtext.functions.text import ustrip
from synthtext.session import ship_package
from synthtext.sinks.records import CSV_READ
from synthtext.sources.lines import FILE_SCHEMA, lines_of, reachable

PROMPT_SCHEMA = T.StructType(
    [T.StructField("prompt_id", T.LongType(), False), T.StructField("prompt", T.StringType(), True)]
)

# Preferred prompt columns, in order; and the synthetic topics.
PROMPT_COLUMNS = ["prompt", "text", "input", "query"]
TOPICS = ["space travel", "time travel", "dragons", "robots", "magic"]
STORY_PREFIX = "Write a short story about "


#: bytes above which a JSON value does not fit a VARIANT
VARIANT_BYTES = 128 << 20
NO_PROMPT, NOT_JSON = "no prompt", "invalid JSON"


def _raw(scan: DataFrame, **cols: Column) -> DataFrame:
    """``file, position`` (the row's place in the scan) and ``cols`` of a file scan."""
    return scan.select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("position"),
                       *[c.alias(n) for n, c in cols.items()])


def _json(raw: DataFrame, col: str) -> DataFrame:
    """``raw`` with the parsed VARIANT ``v`` of ``col`` (null where it is not JSON)."""
    v = F.try_parse_json(F.col(col))
    large = F.octet_length(col) > F.lit(VARIANT_BYTES)
    return raw.withColumn("v", F.when(v.isNull() & large, F.raise_error(F.concat(
        F.lit("a JSON value of more than 128 MiB does not fit a VARIANT: "), F.col("file"),
        F.lit("; use JSON lines")))).otherwise(v))


def _split(items: DataFrame, mode: str) -> tuple[DataFrame, DataFrame]:
    """Prompts and rejects of ``items(file, position, item, prompt, reason)``."""
    if mode not in ("permissive", "failfast"):
        raise ValueError("mode must be 'permissive' or 'failfast'")
    prompt = F.col("prompt")
    if mode == "failfast":
        prompt = F.when(F.col("prompt").isNull(), F.raise_error(F.concat(
            F.col("reason"), F.lit(": "), F.coalesce("file", F.lit("table")), F.lit(", position "),
            F.col("position").cast("string")))).otherwise(prompt)
    prompts = items.select(F.monotonically_increasing_id().alias("prompt_id"), prompt.alias("prompt"))
    rejects = items.where(F.col("prompt").isNull()).select("file", "position", "item", "reason")
    return prompts.where(F.col("prompt").isNotNull()), rejects


def read_prompts_text(spark: SparkSession, path: str) -> DataFrame:
    """S1 + F1: one prompt per line, stripped; blank lines dropped."""
    lines = spark.read.text(path)
    stripped = lines.select(ustrip("value").alias("p")).where(F.length("p") > 0)
    return stripped.select(F.monotonically_increasing_id().alias("prompt_id"), F.col("p").alias("prompt"))


def _item_prompt(item: Column) -> Column:
    """An object item gives its ``prompt`` member, any other item itself."""
    is_obj = F.schema_of_variant(item).startswith("OBJECT")
    return F.when(is_obj, F.try_variant_get(item, "$.prompt", "string")).otherwise(
        F.try_variant_get(item, "$", "string")
    )


def _json_items(spark: SparkSession, path: str) -> DataFrame:
    docs = _json(_raw(spark.read.text(path, wholetext=True), value=F.col("value")), "value")
    v = F.col("v")
    kind = F.schema_of_variant(v)
    inner = F.try_variant_get(v, "$.prompts", "variant")
    items = (F.when(kind.startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>"))
             .when(kind.startswith("OBJECT") & inner.isNotNull(), F.try_variant_get(v, "$.prompts", "array<variant>"))
             .when(kind.startswith("OBJECT"), F.array(v)))
    rows = docs.select("file", "v", F.posexplode_outer(items).alias("position", "one"))
    bad = F.when(v.isNull(), NOT_JSON).otherwise(NO_PROMPT)
    return rows.select("file", F.coalesce(F.col("position").cast("bigint"), F.lit(0)).alias("position"),
                       F.to_json(F.coalesce("one", "v")).alias("item"),
                       F.when(F.col("one").isNotNull(), _item_prompt(F.col("one"))).alias("prompt"), bad.alias("reason"))


def read_prompts_json(spark: SparkSession, path: str, mode: str = "permissive") -> DataFrame:
    """One JSON document per file.

    An array gives its items (object -> ``prompt``, else the item); an object
    with ``prompts`` gives that array; any other object gives its ``prompt``.
    A whole JSON document is not splittable; use JSONL for large inputs.
    """
    return _split(_json_items(spark, path), mode)[0]


def _jsonl_items(spark: SparkSession, path: str) -> DataFrame:
    lines = _raw(spark.read.text(path), item=F.col("value")).where(F.length(ustrip("item")) > 0)
    parsed = _json(lines, "item")
    return parsed.select("file", "position", "item", _item_prompt(F.col("v")).alias("prompt"),
                         F.when(F.col("v").isNull(), NOT_JSON).otherwise(NO_PROMPT).alias("reason"))


def read_prompts_jsonl(spark: SparkSession, path: str, mode: str = "permissive") -> DataFrame:
    """S3: one JSON value per non-blank line; object -> ``prompt``, scalar -> itself."""
    return _split(_jsonl_items(spark, path), mode)[0]


def resolve_prompt_column(columns: Sequence[str]) -> str:
    """``prompt``, else the first of prompt/text/input/query, else the first column."""
    for c in PROMPT_COLUMNS:
        if c in columns:
            return c
    if not columns:
        raise ValueError("prompt table has no columns")
    return columns[0]


def _table_items(df: DataFrame, column: str | None = None, file: Column | None = None) -> DataFrame:
    col = F.col(f"`{column or resolve_prompt_column(df.columns)}`").cast("string")
    return df.select((F.lit(None).cast("string") if file is None else file).alias("file"),
                     F.monotonically_increasing_id().alias("position"), F.lit(None).cast("string").alias("item"),
                     col.alias("prompt"), F.lit(NO_PROMPT).alias("reason"))


def select_prompts(df: DataFrame, mode: str = "permissive", column: str | None = None) -> DataFrame:
    """S6 applied to any DataFrame: pick the prompt column, cast to string."""
    return _split(_table_items(df, column), mode)[0]


def _csv(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    return spark.read.options(**{**CSV_READ, "multiLine": multi_line}).csv(path, inferSchema=False)


def read_prompts_csv(spark: SparkSession, path: str, mode: str = "permissive",
                     multi_line: bool = True) -> DataFrame:
    """Header row; quoted newlines allowed (``multi_line=False`` keeps large
    clean files splittable). Every column is read as STRING: only one is used."""
    return select_prompts(_csv(spark, path, multi_line), mode)


def read_prompts_parquet(spark: SparkSession, path: str, mode: str = "permissive") -> DataFrame:
    """The chosen column only (the scan reads just that column)."""
    return select_prompts(spark.read.parquet(path), mode)


def _text_items(spark: SparkSession, path: str) -> DataFrame:
    lines = _raw(spark.read.text(path), item=F.col("value"), prompt=ustrip("value")).where(F.length("prompt") > 0)
    return lines.withColumn("reason", F.lit(NO_PROMPT))


_ITEMS = {
    ".txt": _text_items,
    ".json": _json_items,
    ".jsonl": _jsonl_items,
    ".csv": lambda s, p: _table_items(_csv(s, p, True), file=F.col("_metadata.file_path")),
    ".parquet": lambda s, p: _table_items(s.read.parquet(p), file=F.col("_metadata.file_path")),
}


def _reader(path: str, format: str | None):
    suffix = ("." + format.lower().lstrip(".")) if format else os.path.splitext(path.rstrip("/"))[1]
    reader = _ITEMS.get(suffix)
    if reader is None:
        raise ValueError(f"Unsupported prompt file format: {suffix}")
    return reader


def read_prompts(spark: SparkSession, path: str, format: str | None = None,
                 mode: str = "permissive") -> DataFrame:
    """Dispatch on the file suffix, or on ``format`` for folders and globs."""
    return _split(_reader(path, format)(spark, path), mode)[0]


def read_prompts_checked(spark: SparkSession, path: str, format: str | None = None) -> tuple[DataFrame, DataFrame]:
    """S7 with what was left out: the prompts and the rejects ``(file, position,
    item, reason)``; ``position`` is the item's place in its JSON document, or the
    row's place in the scan."""
    return _split(_reader(path, format)(spark, path), "permissive")


def topic_for(seed: int, key: Column) -> Column:
    """Deterministic topic choice from (seed, key): the first 32 bits of an MD5
    digest, mod the number of topics. Identical under any partitioning."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 8), 16, 10)
    idx = F.pmod(h.cast("long"), F.lit(len(TOPICS))) + 1
    return F.element_at(F.array(*[F.lit(t) for t in TOPICS]), idx.cast("int"))


def synthesize_prompts_for(df: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """S8 keyed by an existing id column: one story prompt per row."""
    return df.select(
        F.col(id_col).cast("long").alias("prompt_id"),
        F.concat(F.lit(STORY_PREFIX), topic_for(seed, F.col(id_col))).alias("prompt"),
    )


def synthesize_prompts(spark: SparkSession, n: int = 1000, seed: int = 42) -> DataFrame:
    """``n`` prompts "Write a short story about <topic>" (default n = 1000)."""
    return synthesize_prompts_for(spark.range(n).withColumnRenamed("id", "prompt_id"), "prompt_id", seed)


def prompts_from_list(spark: SparkSession, prompts: Sequence[str]) -> DataFrame:
    """Caller-supplied prompts (no template is applied here)."""
    rows = [(i, p) for i, p in enumerate(prompts)]
    return spark.createDataFrame(rows, PROMPT_SCHEMA)


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows(file, prompt)`` with ``position``, the row's number in its file. For files that
    are not cut: a task then has all rows of a file, one after another."""
    ship_package(rows.sparkSession)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        file, n = None, 0
        for batch in batches:
            files = batch.column("file").to_pylist()
            at = np.empty(len(files), np.int64)
            for i, f in enumerate(files):
                file, n = (f, n + 1) if f == file else (f, 0)
                at[i] = n
            yield batch.append_column("position", pa.array(at))

    return rows.mapInArrow(run, "file string, prompt string, position bigint")


def read_prompt_items_stream(spark: SparkSession, path: str, format: str = "text", schema: T.StructType | None = None,
                             max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """S10 with what gives no prompt: a stream of ``(prompt_id, file, position, item, prompt,
    reason)``, ``prompt`` null for rejects, which carry their ``item`` and ``reason``.

    ``position`` is the row's place in its file: the byte offset of a line (text, JSONL,
    JSON; files are read by byte range, whatever their size, where ``lines.reachable``, else
    whole, with the line's number), the row index of Parquet, the row's number in a CSV
    file (with quoted line ends, so a file is one task). ``prompt_id`` is a hash of file and
    place: the same after a replay, and equal lines have ids of their own. Blank
    lines are no items. A JSON value too large for a VARIANT raises.
    """
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        r = r.option("pathGlobFilter", glob)
    fmt = format.lower()
    meta = F.col("_metadata.file_path")
    if fmt in ("jsonl", "json", "text"):
        if fmt == "json" and schema is None:
            raise ValueError("a streaming json source needs an explicit schema")
        if reachable(path):
            files = r.format("binaryFile").schema(FILE_SCHEMA).load(path).select("path", "length")
            lines = lines_of(files).select("file", F.col("offset").alias("position"), F.col("value").alias("item"))
        else:
            lines = r.text(path, wholetext=True).select(
                meta.alias("file"), F.posexplode(F.split("value", "\r\n|\r|\n")).alias("position", "item"))
        lines = lines.where(F.length(ustrip("item")) > 0)
        if fmt == "text":
            items = lines.select("file", "position", "item", ustrip("item").alias("prompt"), F.lit(NO_PROMPT).alias("reason"))
        else:
            parsed = _json(lines, "item")
            if fmt == "json":  # one object a line, its fields by the schema
                prompt = F.from_json("item", schema).getField(resolve_prompt_column(schema.fieldNames())).cast("string")
            else:  # S3 rules per line: object -> its prompt, scalar -> itself
                prompt = _item_prompt(F.col("v"))
            items = parsed.select("file", "position", "item", prompt.alias("prompt"),
                                  F.when(F.col("v").isNull(), NOT_JSON).otherwise(NO_PROMPT).alias("reason"))
    else:
        if schema is None:
            raise ValueError(f"a streaming {fmt} source needs an explicit schema")
        r = r.schema(schema).format(fmt)
        df = (r.options(**CSV_READ) if fmt == "csv" else r).load(path)
        prompt = F.col(f"`{resolve_prompt_column(df.columns)}`").cast("string").alias("prompt")
        if fmt == "csv":
            rows = _numbered(df.select(meta.alias("file"), prompt))
        else:
            place = F.col("_metadata.row_index") if fmt == "parquet" else F.xxhash64(*df.columns)
            rows = df.select(meta.alias("file"), prompt, place.alias("position"))
        items = rows.select("file", "position", F.lit(None).cast("string").alias("item"), "prompt", F.lit(NO_PROMPT).alias("reason"))
    return items.select(F.xxhash64("file", "position").alias("prompt_id"), "file", F.col("position").cast("bigint").alias("position"),
                        "item", "prompt", F.when(F.col("prompt").isNull(), F.col("reason")).alias("reason"))


def read_prompts_stream(spark: SparkSession, path: str, format: str = "text",
                        schema: T.StructType | None = None, max_files_per_trigger: int | None = None,
                        glob: str | None = None) -> DataFrame:
    """A streaming prompt feed from a folder of text / JSONL / JSON / CSV / Parquet files:
    ``(prompt_id, prompt)`` of ``read_prompt_items_stream``, without the rejects."""
    items = read_prompt_items_stream(spark, path, format, schema, max_files_per_trigger, glob)
    return items.where(F.col("prompt").isNotNull()).select("prompt_id", "prompt")


def load_prompts(spark: SparkSession, gen, mode: str = "permissive") -> DataFrame:
    """S7 + S8 + P1 as one step: prompts from ``gen.prompt_file`` (by suffix)
    or ``gen.num_prompts`` synthetic ones, then the prompt template.
    ``gen`` is a ``synthtext.config.Generation``."""
    from synthtext.operators.prompts import apply_template

    if gen.prompt_file:
        prompts = read_prompts(spark, gen.prompt_file, mode=mode)
    else:
        prompts = synthesize_prompts(spark, gen.num_prompts, gen.seed)
    return apply_template(prompts, gen.prompt_template)
