"""Batches, shards and per-row seeds.

The reference cuts a positional list into contiguous slices. On Spark the
position is a dense ordinal over a sort key, computed without a global
``row_number()`` (which would pull every row through one task):

1. bounds: the rows with the smallest hashes (a fixed number for each bucket)
   are a sample; every so-many-th of their sorted keys is a bound. The choice
   depends on the rows only, so every evaluation gives the same bounds;
2. a row's bucket is a column expression over the bounds (a scalar subquery),
   with a hash of the row as last part of the key, so one hot key value is still
   spread over several buckets;
3. rows are counted per bucket and the counts summed (at most ``MAX_BUCKETS``
   rows, so that table is broadcast); the ordinal is the count before the bucket
   plus the rank inside it.

Large inputs take a second level, so that the pieces follow the rows: every bucket has
bounds of its own, one for about ``PIECE_ROWS`` of its rows (each ``SAMPLE``-th of the keys
that a hash picks), and a bucket's counts are summed piece by piece. The bounds and counts of
all pieces are never in one place: they are joined to the rows, bounds by bucket
and a salt, counts by bucket and piece, where the rank's window has put the rows anyway.
A piece is the gap between ``SAMPLE`` picked keys, so hardly ever more than twice
``PIECE_ROWS`` rows, whatever the input.

No step runs a job while the plan is built, and nothing relies on two parts of
the plan sharing an exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from synthtext.session import SPREAD_BYTES, checkpoint_root

#: rows of a piece of the second level, and parts that a bucket is dealt over to find them
PIECE_ROWS = 1 << 20
_SALTS = 64
#: sampled rows for each bucket, and the most buckets (bounds are searched in two steps)
SAMPLE = 32
MAX_BUCKETS = 2048
_STEP = 32


def default_buckets(df: DataFrame) -> int:
    """Buckets of an ordinal pass: four for each shuffle partition, so sorted
    pieces stay well below a task's memory; up to ``MAX_BUCKETS``."""
    return min(MAX_BUCKETS, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _bounds(df: DataFrame, key: Column, buckets: int) -> Column:
    """One struct: the sorted bounds ``b`` and every ``_STEP``-th of them, ``c``."""
    pick = F.xxhash64(F.lit(7), key)
    sample = df.select(pick.alias("p"), key.alias("k")).orderBy("p", "k").limit(SAMPLE * buckets)
    every = sample.agg(F.array_sort(F.collect_list("k")).alias("s"))
    n = F.size("s")
    b = F.when(n < 2, F.slice("s", 1, 0)).otherwise(F.transform(
        F.sequence(F.lit(1), F.least(F.lit(buckets), n) - 1),
        lambda i: F.element_at("s", (i * n / F.least(F.lit(buckets), n)).cast("int") + 1)))
    b = F.when(F.lit(buckets) < 2, F.slice("s", 1, 0)).otherwise(b)
    every = every.select(b.alias("b"))
    c = F.filter("b", lambda x, i: i % _STEP == 0)
    return every.select(F.struct(F.col("b"), c.alias("c"))).scalar()


def _bucket(bounds: Column, key: Column) -> Column:
    """Number of bounds not above the key: first among every ``_STEP``-th, then
    in the step they lead to."""
    coarse = F.size(F.filter(bounds["c"], lambda x: x <= key))
    fine = F.size(F.filter(F.slice(bounds["b"], F.greatest(coarse - 1, F.lit(0)) * _STEP + 1, _STEP), lambda x: x <= key))
    return F.greatest(coarse - 1, F.lit(0)) * _STEP + fine


def default_levels(df: DataFrame) -> int:
    """Two levels above ``SPREAD_BYTES`` of the plan's own estimate. It changes the plan
    and never the ordinals."""
    return 2 if int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) > SPREAD_BYTES else 1


def _pieces(placed: DataFrame) -> DataFrame:
    """Second level: ``placed(.., __key, __bucket)`` with ``__piece``, its place among the
    bounds of its bucket."""
    picked = placed.where(F.pmod(F.xxhash64(F.lit(11), "__key"), F.lit(PIECE_ROWS)) < SAMPLE)
    every = picked.groupBy("__bucket").agg(F.array_sort(F.collect_list("__key")).alias("s"))
    b = F.filter("s", lambda x, i: i % SAMPLE == SAMPLE - 1)
    every = every.select("__bucket", b.alias("b")).select(
        "__bucket", F.struct(F.col("b"), F.filter("b", lambda x, i: i % _STEP == 0).alias("c")).alias("__bounds"),
        F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("__salt"))
    salted = placed.withColumn("__salt", F.pmod(F.xxhash64(F.lit(13), "__key"), F.lit(_SALTS)).cast("int"))
    return salted.join(every, ["__bucket", "__salt"], "left").withColumn(
        "__piece", F.coalesce(_bucket(F.col("__bounds"), F.col("__key")), F.lit(0))).drop("__bounds", "__salt")


def with_ordinal(
    df: DataFrame,
    order_by: Sequence[str],
    name: str = "ordinal",
    num_partitions: int | None = None,
    total_col: str | None = None,
    checkpoint: bool = False,
    unique_keys: bool = False,
    levels: int | None = None,
) -> DataFrame:
    """B1 building block: dense 0-based ``name`` in ``order_by`` order (nulls first).

    With ``unique_keys=True`` (the ``order_by`` columns identify a row) the
    ordinals are computed on a key-only projection - a column-pruned scan - and
    joined back on the keys, so wide rows are read and shuffled once.

    ``order_by`` should be unique for a reproducible order; ties get distinct,
    dense ordinals ordered by a hash of the row. ``num_partitions`` is the number
    of buckets (``default_buckets``). ``total_col`` also attaches the row count.
    ``checkpoint=True`` writes the rows to the shared checkpoint folder first,
    for inputs that read differently each time. ``levels`` (``default_levels``): 2 cuts
    the buckets into pieces of about ``PIECE_ROWS`` rows.
    """
    if unique_keys and len(df.columns) > len(order_by):
        keys = list(order_by)
        narrow = with_ordinal(df.select(*keys), keys, name, num_partitions, total_col, checkpoint, levels=levels)
        return df.join(narrow, keys)
    if checkpoint:
        checkpoint_root(df.sparkSession)
        df = df.checkpoint(eager=True)
    buckets = max(1, min(MAX_BUCKETS, int(num_partitions or default_buckets(df))))
    key = F.struct(*order_by, F.xxhash64(*[F.col(c) for c in df.columns]).alias("__row"))
    placed = df.withColumn("__key", key).withColumn("__bounds", _bounds(df, key, buckets)).withColumn(
        "__bucket", _bucket(F.col("__bounds"), F.col("__key"))).drop("__bounds")
    parts = ["__bucket"]
    if (levels or default_levels(df)) > 1:
        placed, parts = _pieces(placed), ["__bucket", "__piece"]
    counts = placed.groupBy(*parts).agg(F.count(F.lit(1)).alias("__cnt"))
    buckets_of = counts if len(parts) == 1 else counts.groupBy("__bucket").agg(F.sum("__cnt").alias("__cnt"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets_of.select(
        "__bucket",
        F.coalesce(F.sum("__cnt").over(before), F.lit(0)).cast("long").alias("__off"),
        F.sum("__cnt").over(Window.partitionBy()).cast("long").alias("__total"),
    )
    if len(parts) > 1:  # the pieces before it in its bucket
        inside = Window.partitionBy("__bucket").orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.withColumn("__in", F.coalesce(F.sum("__cnt").over(inside), F.lit(0))).join(
            F.broadcast(offsets), "__bucket").select(*parts, (F.col("__off") + F.col("__in")).alias("__off"), "__total")
    else:
        offsets = F.broadcast(offsets)
    rank = F.row_number().over(Window.partitionBy(*parts).orderBy("__key"))
    out = placed.withColumn("__rank", rank).join(offsets, parts).withColumn(
        name, F.col("__off") + F.col("__rank") - 1)
    if total_col:
        out = out.withColumnRenamed("__total", total_col)
    return out.drop("__key", "__bucket", "__piece", "__rank", "__off", "__total")


def assign_batches(
    df: DataFrame, batch_size: int, order_by: Sequence[str],
    num_partitions: int | None = None, total_col: str | None = None, unique_keys: bool = False,
) -> DataFrame:
    """B1: contiguous batches of ``batch_size`` rows in ``order_by`` order.

    Adds ``ordinal`` and ``batch_id = ordinal DIV batch_size``; the number of
    batches is ``ceil(n / batch_size)`` and only the last one can be short.
    ``total_col`` also attaches the row count, which the ordinal pass knows
    anyway (M10 and W2 need it).
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    d = with_ordinal(df, order_by, "ordinal", num_partitions, total_col=total_col, unique_keys=unique_keys)
    return d.withColumn("batch_id", (F.col("ordinal") / F.lit(batch_size)).cast("long"))


def assign_shards(
    df: DataFrame, num_shards: int, order_by: Sequence[str],
    num_partitions: int | None = None,
) -> DataFrame:
    """B2: ``per = n DIV k``; shard = ``least(ordinal DIV per, k-1)``; with
    ``n < k`` every row goes to the last shard (which takes the remainder)."""
    if num_shards <= 0:
        raise ValueError("num_shards must be positive")
    k = F.lit(num_shards).cast("long")
    d = with_ordinal(df, order_by, "ordinal", num_partitions, total_col="__n")
    per = (F.col("__n") / k).cast("long")
    shard = F.when(per == 0, k - 1).otherwise(
        F.least((F.col("ordinal") / F.greatest(per, F.lit(1))).cast("long"), k - 1)
    )
    return d.withColumn("shard_id", shard).drop("__n")


def partition_by_shard(df: DataFrame, num_shards: int) -> DataFrame:
    """Lay rows out one shard per partition (before writing or generating)."""
    return df.repartitionByRange(num_shards, "shard_id")


def with_row_seed(df: DataFrame, seed: int, id_col: str, name: str = "seed") -> DataFrame:
    """Per-row seed (60 bits of an MD5 digest) from (run seed, row id):
    independent of partitioning and identical when a task is retried."""
    digest = F.md5(F.concat(F.lit(f"{int(seed)}:"), F.col(id_col).cast("string")))
    return df.withColumn(name, F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"))
