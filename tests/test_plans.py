"""Plan properties the scale design relies on (checked on the physical plan)."""


from pyspark.sql import functions as F

import __spark_entry__ as E
from synthtext.operators import batching as B
from synthtext.operators import metrics as M
from synthtext.session import spread


def plan(df):
    df.collect()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def jobs(spark, build):
    """Number of jobs that run while ``build()`` makes its plan."""
    sc = spark.sparkContext
    sc.setJobGroup("plan-time", "building")
    try:
        build()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup("plan-time"))


def test_ordinals_need_no_shared_exchange(spark):
    n = 200_000
    df = spark.range(n).select((F.col("id") % 1000).alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        out = B.with_ordinal(df.repartition(7), ["k"], num_partitions=24)
        stage = out.mapInArrow(lambda it: it, out.schema)  # a Python stage downstream
        got = stage.agg(F.countDistinct("ordinal"), F.max("ordinal"), F.min("ordinal")).first()
        assert tuple(got) == (n, n - 1, 0)
        late = B.with_ordinal(df.mapInArrow(lambda it: it, df.schema), ["k"], num_partitions=24)
        assert tuple(late.agg(F.countDistinct("ordinal"), F.max("ordinal")).first()) == (n, n - 1)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_ordinals_sort_in_pieces_and_broadcast_offsets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id")
    out = B.assign_batches(docs, 16, ["doc_id"], num_partitions=8)
    assert "BroadcastHashJoin" in plan(out)
    pieces = B.with_ordinal(docs, ["doc_id"], num_partitions=8)
    assert pieces.count() == docs.count()


def test_building_a_query_runs_no_job(spark):
    grouped = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    assert jobs(spark, lambda: B.assign_batches(grouped, 16, ["k"])) == 0
    assert jobs(spark, lambda: spread(grouped)) == 0


def test_flagship_prunes_scan_and_aggregates_partially(spark, sf_dir):
    df = E.entry(spark)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    fmt = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "ReadSchema: struct<text:string,lang:string>" in fmt
    assert "partial_count" in p  # map-side combine before the (lang, token) shuffle
    assert "BroadcastExchange" not in p


def test_token_histogram_partial_aggregation(spark, sf_dir):
    df = E.queries()["q_token_histogram"](spark, sf_dir)
    assert "partial_count" in plan(df)


def test_running_totals_window_partitions_include_block(spark):
    rows = [(1, b, 1) for b in range(200)]
    df = spark.createDataFrame(rows, "run_id int, batch_id long, v long")
    out = M.running_totals(df, "batch_id", ["v"], ["run_id"], block_size=16)
    p = plan(out)
    # every window is keyed by a block column, except the top level over blocks of blocks
    assert p.count("Window") >= 2 and "__blk2" in p and "__blk1" in p
    got = sorted((r.batch_id, r.cum_v) for r in out.collect())
    assert got == [(b, b + 1) for b in range(200)]


def test_spread_goes_by_bytes(spark):
    many = spark.range(1 << 30)  # 8 GB by estimate
    assert spread(many) is many
    few = spark.range(0, 1 << 20, numPartitions=1)  # 8 MB
    assert spread(few).rdd.getNumPartitions() == 8
