"""Operator 6: strings are quantised by their whole values."""

from pyspark.sql import functions as F

from synthtext.llm.shards import BITS, bounds, hilbert_shards


def test_strings_that_share_their_first_bytes(spark):
    rows = [(k, f"commoncrawl-202{k % 8}" if k % 8 else f"commoncrawl-2019-é{k % 3}") for k in range(800)]
    df = spark.createDataFrame(rows, "id bigint, src string")
    by = {}
    for r in hilbert_shards(df, ["src"], 8, ["id"]).collect():
        by.setdefault(r.shard, set()).add(r.src[:16])
    assert len(by) == 8 and all(len(x) == 1 for x in by.values())
    cuts = bounds(df, ["src", "id"], 3)
    assert cuts[0] == sorted(cuts[0]) and len(cuts[0]) == 7 and len(cuts[1]) == 7
    odd = spark.createDataFrame([(1, None), (2, "")], "id bigint, src string")
    assert sorted(r.shard for r in hilbert_shards(odd, ["src"], 2, ["id"]).collect()) == [0, 1]


def test_repeated_values_are_sampled_row_by_row(spark):
    from synthtext.llm.shards import bounds

    share = F.when(F.col("id") % 10 < 4, "a").when(F.col("id") % 10 < 7, "b").when(F.col("id") % 10 < 9, "c").otherwise("d")
    df = spark.range(60_000).select("id", share.alias("src"), F.lit("x").alias("lang"))
    assert bounds(df, ["src", "lang"], 4, ["id"]) == [["a", "b", "c", "d"], ["x"]]


def curve(bins, bits):
    """Place of a cell on the Hilbert curve, by walking down the quadrants."""
    x, n = list(bins), len(bins)
    for b in range(bits - 1, 0, -1):
        for i in range(n):
            if x[i] >> b & 1:
                x[0] ^= (1 << b) - 1
            else:
                t = (x[0] ^ x[i]) & ((1 << b) - 1)
                x[0], x[i] = x[0] ^ t, x[i] ^ t
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = 0
    for b in range(bits - 1, 0, -1):
        if x[-1] >> b & 1:
            t ^= (1 << b) - 1
    return int("".join(str((v ^ t) >> b & 1) for b in range(bits - 1, -1, -1) for v in x), 2)


def test_places_by_brute_force(spark):
    rows = [(k, None if k % 17 == 0 else f"s{k * k % 7}", None if k % 13 == 0 else k * 37 % 101) for k in range(700)]
    df = spark.createDataFrame(rows, "id bigint, src string, size bigint")
    dims, order, shards = ["src", "size", "id"], ["id", "size"], 9
    edges = bounds(df, dims, BITS, order)
    hashes = {r.id: r.h for r in df.select("id", F.expr("pmod(xxhash64(id, size), 1 << 30)").alias("h")).collect()}

    def key(r):
        own = dict(zip(("id", "src", "size"), r))
        bins = [0 if own[d] is None else sum(e < own[d] for e in cuts) for d, cuts in zip(dims, edges)]
        return curve(bins, BITS), hashes[r[0]], r[0]

    want = {}
    for place, r in enumerate(sorted(rows, key=key)):
        shard = place * shards // len(rows)
        want[r[0]] = (shard, place - -(-shard * len(rows) // shards))
    for group in (50_000, 20):  # one part a cell, or many
        got = {r.id: (r.shard, r.slot) for r in hilbert_shards(df, dims, shards, order, group_rows=group).collect()}
        assert got == want
    cells = sorted(((a, b) for a in range(16) for b in range(16)), key=lambda c: curve(c, 4))
    assert all(abs(a - c) + abs(b - d) == 1 for (a, b), (c, d) in zip(cells, cells[1:]))
