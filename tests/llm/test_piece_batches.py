"""Operator 1: small Python batches, and a name that is taken."""

import pytest

from synthtext.llm import pieces as P
from synthtext.llm.tables import small_batches

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_decode_refuses_a_taken_name(spark):
    table = P.load_pieces()
    df = spark.createDataFrame([(1, "a b", "x")], "doc_id bigint, text string, decoded string")
    ids = P.encode(df, table)
    with pytest.raises(ValueError, match="decoded"):
        P.decode(ids, table)
    row = P.decode(ids, table, out="back").first()
    assert (row.decoded, row.back) == ("x", "a b")


def test_batches_are_only_made_smaller(spark):
    before = spark.conf.get(ROWS)
    try:
        for given, want in (("10000", "1000"), ("500", "500"), ("0", "1000"), ("-1", "1000")):
            spark.conf.set(ROWS, given)
            small_batches(spark)
            assert spark.conf.get(ROWS) == want
    finally:
        spark.conf.set(ROWS, before)


def test_fold_mentions_its_masks_once_and_texts_are_not_translated(spark):
    from pyspark.sql import functions as F

    from synthtext.llm import pieces as P

    fold = str(P.bpe_fold(F.col("edges"), F.col("size")))
    short = fold[: fold.index("overlay")] if "overlay" in fold else fold
    assert short.count("bit_count") == 2 and "^" not in short
    assert "translate" not in str(P.same_text())
