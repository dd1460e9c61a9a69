"""Written intermediate tables and connected components.

Intermediate results that several jobs read are written once as Parquet below
``spark.checkpoint.dir`` (every executor reaches it), which cuts lineage and
survives lost executors.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written to the shared folder and read back. The write's own shuffle files go
    when it is done, not when the driver happens to collect garbage."""
    spark = df.sparkSession
    path = scratch_path(spark, kind)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes the folders of tables of ``written`` (or of unions of them) that nothing reads any more."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(conf).delete(path, True)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Python stages after this get at most ``rows`` rows at a time: with whole texts and their
    ids in a row, the default of 10,000 makes batches of a hundred MB on either side."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def connected_components(edges: DataFrame, kind: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component
    is its smallest node.

    Each round gives every node its smallest smaller neighbour as parent (a
    partial aggregate), hooks its other smaller neighbours to that parent, and
    replaces the parent by the parent's parent, so trees get half as deep and a
    star is done in one round. A node with very many neighbours is combined
    map-side, and the joins have one row a node on the other side, so the skew
    join splits them. Edges are written after each round, with their count and
    digest; the loop ends when a round changes none.
    """
    e, mark = _kept(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), kind)
    while mark[0]:
        up = e.groupBy("u").agg(F.min("v").alias("p"))
        j = e.join(up, "u").join(up.select(F.col("u").alias("p"), F.col("p").alias("pp")), "p", "left")
        top = F.coalesce("pp", "p")
        step = j.select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), top.alias("v")),
            F.struct(F.greatest("v", "p").alias("u"), F.least("v", "p").alias("v")))).alias("e")).select("e.u", "e.v")
        e, now = _kept(step, kind)
        if now == mark:
            break
        mark = now
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _kept(edges: DataFrame, kind: str) -> tuple[DataFrame, tuple]:
    """Distinct edges ``u > v``, written; their number and an order-free digest."""
    seen = Observation()
    rows = edges.filter("u > v").distinct().observe(
        seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x"),
        F.coalesce(F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")), F.lit(0)).alias("s"))
    e = written(rows, kind)
    got = seen.get
    return e, (got["n"], got["x"], got["s"])


BITMAP_BITS = 24


def bitmap(keys: DataFrame, name: str, bits: int = BITMAP_BITS):
    """A fixed-size bitmap (``2^bits`` bits, 2 MB by default, whatever the
    number of keys) of hashed bigint keys, combined by Spark word by word."""
    at = F.pmod(F.col(name), F.lit(1 << bits))
    rows = keys.select((at / 64).cast("int").alias("w"), F.expr(f"shiftleft(1L, int(pmod({name}, 64)))").alias("m")) \
        .groupBy("w").agg(F.bit_or("m").alias("m"))
    out = np.zeros(1 << (bits - 6), np.int64)
    for r in rows.toLocalIterator():
        out[r.w] = r.m
    return out


def maybe_in(df: DataFrame, name: str, words, out: str = "maybe") -> DataFrame:
    """``df`` with a boolean column ``out``: False only for keys that are not in the
    bitmap. It spares the shuffle of rows that an exact join would not match;
    that join still has to follow."""
    shared = df.sparkSession.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def hit(keys: pd.Series) -> pd.Series:
        x = keys.to_numpy(np.int64, na_value=0)
        own = shared.value
        at = np.mod(x, len(own) * 64)
        return pd.Series((own[at >> 6] >> (at & 63)) & 1 == 1)

    return df.withColumn(out, hit(name))
