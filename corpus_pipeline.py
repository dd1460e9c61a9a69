"""The corpus pipeline: five stages over ``documents``, each written and reread.

A stage is ``(name, function(spark, docs, sf_dir) -> DataFrame)``. All but the
last return the columns of ``documents``; each works on all that its predecessor
kept. Rows, nulls and repeated rows are treated as each operator's module states.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.window import Window  # noqa: E402

from synthtext.llm import decontaminate, language, lines, near_dup, pieces  # noqa: E402
from synthtext.llm.tables import written  # noqa: E402

#: least share of a text's n-grams that the predicted language knows
MIN_LANGUAGE_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of no language: without text or letters, or with less than
    ``MIN_LANGUAGE_SCORE`` of their n-grams known in the likeliest language."""
    model = language.fit(docs.filter(~language.held_out()).select("doc_id", "text", "lang"))
    p = _prefix(docs)
    out = language.predict(docs, model, names=(f"{p}lang", f"{p}score"))
    return out.filter((F.col(f"{p}lang") != language.UNKNOWN) & (F.col(f"{p}score") >= MIN_LANGUAGE_SCORE)).select(
        *docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one occurrence of each group of similar lines; a document of which
    no letter or digit is left goes, ``n_chars`` follows the text."""
    out, p = lines.dedup_lines(docs)
    left = (F.size(f"{p}removed") == 0) | F.col("text").rlike(r"[0-9A-Za-z\x{80}-\x{10ffff}]")
    out = out.filter(F.coalesce(left, F.lit(True)))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.size(f"{p}removed") == 0, F.col("n_chars")).otherwise(
            F.char_length("text").cast(kind)))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest doc_id of each near-duplicate group."""
    kept = written(near_dup.near_duplicates(docs).filter("key = component_id").select("key").distinct(), "kept")
    p = _prefix(docs)
    rows = docs.withColumn(f"{p}key", near_dup.row_key()).join(kept.withColumnRenamed("key", f"{p}key"), f"{p}key", "left_semi")
    one = Window.partitionBy(f"{p}key").orderBy(F.xxhash64("text"), "text")  # rows of one doc_id are one document
    return rows.withColumn(f"{p}row", F.row_number().over(one)).filter(f"{p}row = 1").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which at least a twentieth of the words lie in benchmark windows."""
    bench = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    out, p = decontaminate.find_benchmark(docs, bench)
    hit = decontaminate.covered(f"{p}spans")
    return out.filter(~((hit > 0) & (20 * hit >= F.col(f"{p}n_words")))).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_ids`` and whether the ids decode to the text."""
    table = pieces.load_pieces()
    # written between the two, so that no task has the Python workers of both
    ids = written(pieces.encode(docs.select("doc_id", "text"), table), "encoded")
    out = pieces.decode(ids, table)
    return out.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_ids"), pieces.same_text().alias("round_trip"))


def _prefix(df: DataFrame) -> str:
    p = "__"
    while any(c.startswith(p) for c in df.columns):
        p += "_"
    return p


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: SimHash, trained n-grams and piece merges have no SQL form; tests/llm holds
#: every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``; each stage's rows are written
    to the shared folder and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
