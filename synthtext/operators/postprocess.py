"""Post-processing as DataFrame transforms.

Each stage gets its own projection holding that stage's sentence list, so a
text is split once per stage; Catalyst keeps the projections apart because the
split is referenced more than once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synthtext.config import PostProcessing
from synthtext.functions import text as X

_TMP = "__pp_text"
_SEN = "__pp_sentences"


def apply_post_processing(
    df: DataFrame, col: str, cfg: PostProcessing | None = None, out: str | None = None
) -> DataFrame:
    """Whitespace clean-up, then truncation (when ``max_length`` is set),
    incomplete-sentence removal and adjacent-duplicate removal (when enabled).

    The clean-up always runs; ``cfg=None`` means clean-up only.
    """
    out = out or col
    d = df.withColumn(_TMP, X.clean_whitespace(F.col(col)))
    # From here on the text is clean, so the cheaper clean-text forms apply.
    if cfg is not None and cfg.max_length is not None:
        n = int(cfg.max_length)
        d = d.withColumn(_SEN, X.split_clean_sentences(F.substring(F.col(_TMP), 1, n + 100)))
        d = d.withColumn(_TMP, X.truncate_text(F.col(_TMP), n, window=F.col(_SEN)))
    if cfg is not None and cfg.complete_sentences:
        d = d.withColumn(_TMP, X.remove_incomplete_sentence_clean(F.col(_TMP)))
    if cfg is not None and cfg.deduplicate:
        d = d.withColumn(_SEN, X.split_clean_sentences(F.col(_TMP)))
        d = d.withColumn(_TMP, X.deduplicate_sentences(F.col(_TMP), F.col(_SEN)))
    d = d.withColumn(out, F.col(_TMP))
    return d.drop(_TMP, _SEN)


def batch_post_process(df: DataFrame, col: str, cfg: PostProcessing | None = None) -> DataFrame:
    """X6 over every row of the column (the same transform)."""
    return apply_post_processing(df, col, cfg)


def post_process_stage(df: DataFrame, col: str, cfg: PostProcessing) -> DataFrame:
    """the stage switch of the job: X6 only when ``cfg.enabled``."""
    return apply_post_processing(df, col, cfg) if cfg.enabled else df


def min_length_filter(df: DataFrame, col: str, min_length: int) -> DataFrame:
    """F2 (opt-in): keep rows whose text has at least ``min_length`` characters."""
    return df.where(F.length(F.col(col)) >= F.lit(int(min_length)))
