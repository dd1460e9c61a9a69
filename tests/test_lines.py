"""Lines by byte range and the streaming feed's rejects, ids and CSV rows."""

import io
import os
import random

import pytest
from pyspark.sql import types as T

from synthtext.sinks import records as K
from synthtext.sources import lines as L
from synthtext.sources import prompts as S


def plain(raw):
    out, at = [], 0
    parts = raw.split(b"\n")
    for k, line in enumerate(parts):
        if k == len(parts) - 1 and not line:
            break
        own = line[:-1] if line.endswith(b"\r") else line
        place = at
        for one in own.split(b"\r"):
            out.append((place, one))
            place += len(one) + 1
        at += len(line) + 1
    return out


def test_ranges_give_every_line_once(monkeypatch):
    rng = random.Random(3)
    for _ in range(200):
        raw = b"".join(rng.choice([b"a", b"bc", b"\n", b"\r\n", b"\r", b"long line ", "é".encode()]) for _ in range(rng.randint(0, 60)))
        size, split = len(raw), rng.randint(1, 40)
        monkeypatch.setattr(L, "_READ", rng.randint(1, 30))
        got = [x for s in range(0, max(size, 1), split) for x in L.range_lines(io.BytesIO(raw), s, min(s + split, size))]
        assert got == plain(raw), raw


def drain(spark, df, path):
    df.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/ck").trigger(
        availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/out").collect()


def test_feed_with_rejects_in_small_ranges(spark, scratch, monkeypatch):
    monkeypatch.setattr(L, "SPLIT", 16)
    os.makedirs(f"{scratch}/in")
    good = [f'{{"prompt": "p {k % 3}"}}' for k in range(40)]
    with open(f"{scratch}/in/a b.jsonl", "w") as f:
        f.write("\n".join([*good, '{"prompt": ', '{"other": 1}', "", '"scalar"', "null"]))
    with open(f"{scratch}/in/empty.jsonl", "w"):
        pass
    feed = S.read_prompt_items_stream(spark, f"{scratch}/in", "jsonl")
    one, two = drain(spark, feed, f"{scratch}/1"), drain(spark, feed, f"{scratch}/2")
    assert len(one) == 44 and len({r.prompt_id for r in one}) == 44
    assert {tuple(r) for r in one} == {tuple(r) for r in two}  # the same after a replay
    assert sorted(r.prompt for r in one if r.reason is None) == sorted(["scalar", *(f"p {k % 3}" for k in range(40))])
    assert {(r.item, r.reason) for r in one if r.prompt is None} == {
        ('{"prompt": ', "invalid JSON"), ('{"other": 1}', "no prompt"), ("null", "no prompt")}


def test_csv_feed_has_an_id_a_row(spark, scratch):
    os.makedirs(f"{scratch}/in")
    for name in "ab":
        with open(f"{scratch}/in/{name}.csv", "w") as f:
            f.write('id,prompt\n1,same\n2,same\n3,\n4,""\n5,"two\nlines"\n')
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("prompt", T.StringType())])
    rows = drain(spark, S.read_prompt_items_stream(spark, f"{scratch}/in", "csv", schema), scratch)
    assert len({r.prompt_id for r in rows}) == 10
    assert {r.reason for r in rows if r.prompt is None} == {"no prompt"} and all(r.reason is None for r in rows if r.prompt is not None)
    assert sorted(str(r.prompt) for r in rows) == sorted(["same", "same", "None", "", "two\nlines"] * 2)


def test_csv_null_and_empty_prompts_come_back(spark, scratch):
    df = spark.createDataFrame([("a",), (None,), ("",), (" x\n",)], "prompt string")
    K.write_records(df, f"{scratch}/r", "csv")
    prompts, rejects = S.read_prompts_checked(spark, f"{scratch}/r", "csv")
    assert sorted(r.prompt for r in prompts.collect()) == ["", " x\n", "a"] and rejects.count() == 1
    with pytest.raises(Exception, match="no prompt"):
        S.read_prompts(spark, f"{scratch}/r", "csv", mode="failfast").collect()


def test_other_stores_are_left_to_spark():
    assert L.reachable("/a/b") and L.reachable("file:/a") and L.reachable("s3a://b/c") and not L.reachable("viewfs://x/y")
