"""The same result under 1, 3 and 8 input partitions."""

import pytest
from pyspark.sql import functions as F

from synthtext.operators import batching as B
from synthtext.operators import metrics as M
from synthtext.operators import samples as W


def frame(spark, n, parts):
    return spark.range(n).select((F.col("id") * 7 + 3).alias("key")).repartition(parts)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_dense_ordinals(spark, parts):
    d = B.with_ordinal(frame(spark, 1000, parts), ["key"]).collect()
    got = sorted((r.key, r.ordinal) for r in d)
    assert [o for _, o in got] == list(range(1000))


def test_ordinals_with_checkpoint(spark):
    d = B.with_ordinal(frame(spark, 300, 3), ["key"], checkpoint=True).collect()
    assert sorted(r.ordinal for r in d) == list(range(300))


def test_ordinals_with_hot_key(spark):
    # a third of the rows share one key: still dense and unique
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("key"))
    d = B.with_ordinal(df, ["key"], num_partitions=8).collect()
    assert sorted(r.ordinal for r in d) == list(range(900))


@pytest.mark.parametrize("n,bs,batches", [(10, 4, [4, 4, 2]), (2, 16, [2]), (0, 16, [])])
def test_batches(spark, n, bs, batches):
    d = B.assign_batches(frame(spark, n, 3), bs, ["key"])
    sizes = [r["count"] for r in d.groupBy("batch_id").count().orderBy("batch_id").collect()]
    assert sizes == batches


@pytest.mark.parametrize("n,k,sizes", [(10, 3, [3, 3, 4]), (2, 4, [0, 0, 0, 2]), (0, 2, [0, 0])])
def test_shards(spark, n, k, sizes):
    d = B.assign_shards(frame(spark, n, 3), k, ["key"])
    got = {r.shard_id: r["count"] for r in d.groupBy("shard_id").count().collect()}
    assert [got.get(i, 0) for i in range(k)] == sizes


@pytest.mark.parametrize("parts", [1, 8])
def test_seed_independent_of_partitioning(spark, parts):
    d = B.with_row_seed(frame(spark, 50, parts), 42, "key")
    assert sorted((r.key, r.seed) for r in d.collect()) == sorted(
        (r.key, r.seed) for r in B.with_row_seed(frame(spark, 50, 1), 42, "key").collect()
    )


def test_progress(spark):
    d = B.assign_batches(frame(spark, 10, 2), 4, ["key"])
    got = [(r.batch_id, r.done, r.total) for r in M.progress(d).orderBy("batch_id").collect()]
    assert got == [(0, 4, 10), (1, 8, 10), (2, 10, 10)]


def test_samples(spark):
    d = B.assign_batches(frame(spark, 10, 2), 4, ["key"])
    t = W.sample_table(d, 4, log_samples=2, log_interval=1, cols=("key",))
    assert sorted((r.batch_id, r.position) for r in t.collect()) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    d2 = d.withColumn("prompt", F.col("key").cast("string")).withColumn("generated_text", F.lit("x" * 300))
    p = W.sample_pick(d2, 4, log_samples=3, log_interval=1).orderBy("batch_id").collect()
    # batch 0 -> row 2 ("17"), batch 1 -> row 2 of batch ("45"); batch 2 is not sampled (2 >= log_samples? no: 2 < 3)
    assert [r.prompt_preview for r in p] == ["17...", "45...", "66..."]
    assert len(p[0].text_preview) == 203


@pytest.mark.parametrize("parts", [1, 5])
def test_dense_ordinals_key_only_join(spark, parts):
    df = frame(spark, 500, parts).withColumn("payload", F.repeat(F.lit("x"), 50))
    d = B.assign_batches(df, 16, ["key"], total_col="total", unique_keys=True).collect()
    got = sorted((r.key, r.ordinal) for r in d)
    assert [o for _, o in got] == list(range(500))
    assert {r.total for r in d} == {500} and {r.batch_id for r in d} == set(range(32))


def test_second_level_pieces_follow_the_rows(spark, monkeypatch):
    """Eight buckets at most, far more pieces: ordinals stay dense and in order, with a
    third of the rows on one key, and no window holds more than a few pieces' rows."""
    monkeypatch.setattr(B, "MAX_BUCKETS", 8)
    monkeypatch.setattr(B, "PIECE_ROWS", 256)
    n = 30_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(5_000)).otherwise(F.xxhash64("id") % 10_000).alias("k"),
                               F.col("id").alias("v")).repartition(5)
    one = B.with_ordinal(df, ["k"], total_col="n", levels=1)
    two = B.with_ordinal(df, ["k"], total_col="n", levels=2)
    rows = two.orderBy("ordinal").collect()
    assert [r.ordinal for r in rows] == list(range(n)) and {r.n for r in rows} == {n}
    assert [r.k for r in rows] == sorted(r.k for r in rows)
    assert one.exceptAll(two).isEmpty()  # the levels change the plan only
    key = F.struct("k", F.xxhash64("k", "v").alias("__row"))
    placed = df.withColumn("__key", key).withColumn("__b", B._bounds(df, key, 8)).withColumn(
        "__bucket", B._bucket(F.col("__b"), F.col("__key"))).drop("__b")
    sizes = [r["count"] for r in B._pieces(placed).groupBy("__bucket", "__piece").count().collect()]
    assert len(sizes) > 90 and max(sizes) <= 3 * 256


def test_second_level_on_small_and_empty_inputs(spark):
    for n in (0, 1, 5):
        got = B.with_ordinal(spark.range(n), ["id"], levels=2).collect()
        assert sorted((r.id, r.ordinal) for r in got) == [(i, i) for i in range(n)]
    wide = spark.range(100).selectExpr("id", "repeat('x', 50) AS text")
    got = B.assign_batches(wide, 16, ["id"], unique_keys=True)
    assert sorted((r.id, r.batch_id, len(r.text)) for r in got.collect()) == [(i, i // 16, 50) for i in range(100)]
