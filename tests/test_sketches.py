"""Mergeable diversity sketches (M2) against exact counts."""

import random

from pyspark.sql import functions as F

from synthtext.operators import sketches as S


def frame(spark, rows):
    return spark.createDataFrame(rows, "run string, batch_id long, tokens array<string>")


def made(batches, per, vocabulary, seed=1):
    rng = random.Random(seed)
    return [("a" if b % 2 else "b", b, [f"t{int(rng.paretovariate(0.3)) % vocabulary}" for _ in range(per)]) for b in range(batches)]


def test_estimates_and_merges(spark):
    rows = made(40, 3000, 50_000)
    per = S.token_sketches(frame(spark, rows), "tokens", ["run", "batch_id"])
    for r in S.approx_diversity(per, ["run", "batch_id"]).collect():
        exact = len(set(rows[r.batch_id][2]))
        assert abs(r.unique_tokens - exact) <= S.TOLERANCE * exact and r.total_tokens == 3000
        assert abs(r.unique_ratio - r.unique_tokens / 3000) < 1e-12
    merged = {r.run: r for r in S.approx_diversity(S.merge_sketches(per, ["run"]), ["run"]).collect()}
    direct = {r.run: r for r in S.approx_diversity(S.token_sketches(frame(spark, rows), "tokens", ["run"]), ["run"]).collect()}
    for run in ("a", "b"):
        exact = len({t for r, _, ts in rows if r == run for t in ts})
        for got in (merged[run], direct[run]):
            assert abs(got.unique_tokens - exact) <= S.TOLERANCE * exact and got.total_tokens == 60_000


def test_running_unions_in_blocks(spark):
    rows = made(50, 400, 20_000, seed=2)
    per = S.token_sketches(frame(spark, rows), "tokens", ["run", "batch_id"])
    for levels, block in ((0, 4), (1, 4), (2, 3)):
        got = S.running_sketches(per, "batch_id", ["run"], block_size=block, levels=levels)
        got = {(r.run, r.batch_id): r for r in got.select("run", "batch_id", S.unique_tokens("sketch").alias("n"), "total_tokens").collect()}
        assert len(got) == 50
        for run in ("a", "b"):
            seen, total = set(), 0
            for r, b, ts in rows:
                if r == run:
                    seen.update(ts)
                    total += len(ts)
                    assert got[run, b].total_tokens == total and abs(got[run, b].n - len(seen)) <= S.TOLERANCE * len(seen)


def test_batches_without_tokens(spark):
    rows = [("a", 0, None), ("a", 1, []), ("a", 2, ["x", "y", "x"]), ("a", 3, []), ("a", 4, ["x"]), ("b", 0, [])]
    per = S.token_sketches(frame(spark, rows), "tokens", ["run", "batch_id"])
    assert {(r.run, r.batch_id): (r.sketch is None, r.total_tokens) for r in per.collect()}["a", 1] == (True, 0)
    got = S.running_sketches(per, "batch_id", ["run"], block_size=2).select(
        "run", "batch_id", S.unique_tokens("sketch").alias("n"), "total_tokens").collect()
    assert sorted(tuple(r) for r in got) == [
        ("a", 0, 0, 0), ("a", 1, 0, 0), ("a", 2, 2, 3), ("a", 3, 2, 3), ("a", 4, 2, 4), ("b", 0, 0, 0)]
    merged = S.approx_diversity(S.merge_sketches(per.where("batch_id < 2"), ["run"]), ["run"]).collect()
    assert sorted((r.run, r.unique_tokens, r.total_tokens, r.unique_ratio) for r in merged) == [("a", 0, 0, 0.0), ("b", 0, 0, 0.0)]
    assert S.token_sketches(frame(spark, []), "tokens", ["run"]).collect() == []
    whole = S.token_sketches(frame(spark, []), "tokens").select(S.unique_tokens(F.col("sketch"))).first()
    assert whole[0] == 0
