"""Operator 6: the quantiles of strings are those of all rows, not of a sample."""

import math

from pyspark.sql import functions as F

from synthtext.llm.shards import bounds


def test_quantiles_of_all_rows(spark):
    n = 30_011
    df = spark.range(n).select("id", F.when(F.col("id") % 11 != 3, F.concat(F.lit("é"), F.md5(F.col("id").cast("string")))).alias("s"))
    values = sorted((r.s for r in df.collect() if r.s is not None), key=str.encode)
    want = [values[math.ceil(k / 16 * len(values)) - 1] for k in range(1, 16)]
    assert bounds(df, ["s"], 4, ["id"]) == [want]


def test_no_values(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id bigint, s string")
    assert bounds(df, ["s"], 2) == [[]] and bounds(df.limit(0), ["s"], 2) == [[]]
