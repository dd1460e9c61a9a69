"""Operator 6 [native]: sharding along a Hilbert curve.

Every dimension is quantised into ``2^bits`` bins at its own quantiles (numbers:
approximate percentiles of all rows; strings: whole values, at the exact quantiles of all
rows, compared as strings); the Hilbert index of the
bins orders the cells, and the rows, cell by cell, are cut into ``shards`` runs
of equal row count. Neighbours on the curve are close in all dimensions, so each
shard's files cover a small box and min/max statistics prune on any of them.

A row's place is exact without a global sort: the cells (at most
``2^(bits * dimensions)``, whatever the input) are counted and their counts
summed along the curve; a cell with more than ``group_rows`` rows is dealt by a
hash into parts, counted too, so no window holds more than about that many rows
(a source with a third of all rows is many parts). Only columns that are asked
for are shuffled, once. DataFrame functions only.

Defined results: null dimensions come first; ties in a cell are ordered by the
part's hash, then ``order``; rows equal in ``order`` are neighbours, in one
window whatever ``group_rows`` says, so ``order`` should tell most rows apart; an empty table gives an empty one. Names of added columns
start with a prefix that no input column has, ``shard`` and ``slot`` replace
columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .tables import written

BITS = 4
GROUP_ROWS = 50_000


def as_number(df: DataFrame, name: str) -> Column:
    """The column as a double."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.DateType)):
        return F.unix_timestamp(F.col(name)).cast("double")
    return F.col(name).cast("double")


def bounds(df: DataFrame, dims: list[str], bits: int, order: list[str] = ()) -> list[list]:
    """Ascending distinct quantiles of each dimension over all rows: doubles, or whole
    strings. ``order`` plays no part."""
    shares = [x / (1 << bits) for x in range(1, 1 << bits)]
    texts = [d for d in dims if isinstance(df.schema[d].dataType, T.StringType)]
    out = {}
    numbers = [d for d in dims if d not in texts]
    if numbers:
        row = df.select(*[as_number(df, d).alias(f"d{k}") for k, d in enumerate(numbers)]).agg(*[
            F.percentile_approx(f"d{k}", shares, 10_000) for k in range(len(numbers))]).first()
        out = {d: sorted(set(row[k] or [])) for k, d in enumerate(numbers)}
    for d in texts:
        out[d] = string_quantiles(df.select(F.col(d).alias("v")), shares)
    return [out[d] for d in dims]


def string_quantiles(values: DataFrame, shares: list[float]) -> list[str]:
    """Ascending distinct values of the column ``v`` at ``shares`` of its rows that are not
    null, exact: the counted values are dealt by ranges and summed range by range; only the sums
    of the ranges and the quantiles reach the driver."""
    counted = written(values.where("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("n")).repartitionByRange("v")
                      .withColumn("part", F.spark_partition_id()), "quantiles")
    start, starts = 0, []
    for r in counted.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        starts.append((r.part, start))
        start += r.n
    if not start:
        return []
    ranks = F.array(*[F.lit(x) for x in sorted({max(0, math.ceil(x * start) - 1) for x in shares})])
    inside = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = counted.sparkSession.createDataFrame(starts, "part int, start bigint")
    ends = counted.join(F.broadcast(before), "part").withColumn("end", F.col("start") + F.sum("n").over(inside))
    hit = F.exists(ranks, lambda k: (k < F.col("end")) & (k >= F.col("end") - F.col("n")))
    return sorted((r.v for r in ends.where(hit).select("v").collect()), key=lambda x: x.encode())


def hilbert_index(bins: Column, dims: int, bits: int) -> Column:
    """Index on the Hilbert curve of an array of ``dims`` bins of ``bits`` bits
    (the transpose form: undo the rotations from the top bit down, Gray code,
    interleave), folded with higher-order functions."""
    def put(x, at, value):
        return F.transform(x, lambda v, j: F.when(j == at, value).otherwise(v))

    def turn(x, s):
        q, i = s["q"], s["i"]
        first, own = x[0], F.element_at(x, i + 1)
        t = first.bitwiseXOR(own).bitwiseAND(q - 1)
        hit = own.bitwiseAND(q) != 0
        new0 = F.when(hit, first.bitwiseXOR(q - 1)).otherwise(first.bitwiseXOR(t))
        return F.transform(x, lambda v, j: F.when(j == 0, new0).when((j == i) & ~hit, own.bitwiseXOR(t)).otherwise(v))

    def let(value, then):
        """``then(value)``, the value computed once."""
        return F.get(F.transform(F.array(value), then), F.lit(0))

    pair = lambda q, i: F.struct(F.lit(q).alias("q"), F.lit(i).alias("i"))
    high = [1 << b for b in range(bits - 1, 0, -1)]
    if high:
        bins = F.aggregate(F.array(*[pair(q, i) for q in high for i in range(dims)]), bins, turn)
    if dims > 1:
        bins = F.aggregate(F.array(*[F.lit(i) for i in range(1, dims)]), bins, lambda x, i: put(
            x, i, F.element_at(x, i + 1).bitwiseXOR(F.element_at(x, i))))

    def gray(x):
        flip = F.aggregate(F.array(*[F.lit(q) for q in high]), F.lit(0), lambda t, q: F.when(
            F.element_at(x, dims).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))
        return let(flip, lambda t: F.transform(x, lambda v: v.bitwiseXOR(t)))

    order = F.array(*[pair(1 << b, i) for b in range(bits - 1, -1, -1) for i in range(dims)])
    braid = lambda x: F.aggregate(order, F.lit(0).cast("bigint"), lambda h, s: h * 2 + F.when(
        F.element_at(x, s["i"] + 1).bitwiseAND(s["q"]) != 0, 1).otherwise(0))
    return let(let(bins, gray) if high else bins, braid)


def hilbert_shards(df: DataFrame, dims: list[str], shards: int, order: list[str], bits: int = BITS,
                   group_rows: int = GROUP_ROWS) -> DataFrame:
    """``df`` with ``shard`` (0 to shards - 1, counts at most one apart) and
    ``slot`` (gapless from 0 within the shard, along the curve)."""
    if bits * len(dims) > 20:
        raise ValueError("bits * dimensions must not exceed 20: the cells are counted one by one")
    p = "__"
    while any(c.startswith(p) for c in df.columns):
        p += "_"
    edges = bounds(df, dims, bits, order)

    def bin_of(k, d):
        cuts = edges[k]
        if not cuts:
            return F.lit(0)
        if isinstance(cuts[0], str):
            return F.coalesce(sum(((F.lit(x) < F.col(d)).cast("int") for x in cuts), F.lit(0)), F.lit(0))
        value = as_number(df, d)
        return F.coalesce(F.size(F.filter(F.array(*[F.lit(x) for x in cuts]), lambda e: e < value)), F.lit(0))

    rows = df.drop("shard", "slot").withColumns({
        f"{p}cell": F.array(*[bin_of(k, d) for k, d in enumerate(dims)]),
        f"{p}hash": F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(1 << 30))})
    cells = rows.groupBy(f"{p}cell").agg(F.count("*").alias(f"{p}n"))
    along = Window.orderBy(f"{p}h").rowsBetween(Window.unboundedPreceding, -1)
    cells = (cells.withColumn(f"{p}h", hilbert_index(F.col(f"{p}cell"), len(dims), bits))
             .withColumn(f"{p}before", F.coalesce(F.sum(f"{p}n").over(along), F.lit(0)))
             .withColumn(f"{p}parts", F.ceil(F.col(f"{p}n") / group_rows))
             .select(f"{p}cell", f"{p}h", f"{p}before", f"{p}parts"))
    rows = (rows.join(cells, f"{p}cell")
            .withColumn(f"{p}part", F.floor(F.col(f"{p}hash") * F.col(f"{p}parts") / (1 << 30)))
            .drop(f"{p}cell", f"{p}parts"))
    inside = Window.partitionBy(f"{p}h").orderBy(f"{p}part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (rows.groupBy(f"{p}h", f"{p}part").agg(F.count("*").alias(f"{p}n"), F.first(f"{p}before").alias(f"{p}b"))
             .select(f"{p}h", f"{p}part", (F.col(f"{p}b") + F.coalesce(F.sum(f"{p}n").over(inside), F.lit(0))).alias(f"{p}start")))
    total = df.count()
    own = Window.partitionBy(f"{p}h", f"{p}part").orderBy(F.col(f"{p}hash"), *order)
    place = F.col(f"{p}start") + F.col(f"{p}rank") - 1
    return (rows.withColumn(f"{p}rank", F.row_number().over(own))
            .join(parts, [f"{p}h", f"{p}part"])
            .withColumn(f"{p}place", place)
            .withColumn("shard", F.expr(f"{p}place * {shards} div {max(total, 1)}").cast("int"))
            .withColumn("slot", F.col(f"{p}place") - F.expr(f"(shard * {total}L + {shards - 1}) div {shards}"))
            .drop(*[f"{p}{c}" for c in ("h", "part", "hash", "before", "start", "rank", "place")]))


def write_shards(df: DataFrame, path: str) -> None:
    """Files in ``shard=<n>`` folders, rows in curve order."""
    df.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
