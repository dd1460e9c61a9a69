"""Small operators not covered elsewhere: left truncation/padding, shard
layout, prompt rejects, JSON streaming source."""

import json
import os

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from synthtext.functions.tokens import tokenize, truncate_tokens
from synthtext.operators import batching as B
from synthtext.plans.doubles import echo
from synthtext.operators.tokens import pad_batch
from synthtext.sources import prompts as S
from synthtext.streaming.generate import generate_stream, start_stream


def test_truncate_and_pad_left(spark):
    df = spark.createDataFrame([(0, "a b c d"), (0, "x")], "batch_id int, t string")
    d = df.withColumn("tok", truncate_tokens(tokenize("t"), 3, side="left"))
    rows = sorted(pad_batch(d, "tok", "<p>", side="left").collect(), key=lambda r: r.t)
    assert rows[0].input_ids == ["b", "c", "d"] and rows[0].attention_mask == [1, 1, 1]
    assert rows[1].input_ids == ["<p>", "<p>", "x"] and rows[1].attention_mask == [0, 0, 1]


def test_partition_by_shard(spark):
    d = B.assign_shards(spark.range(30).withColumnRenamed("id", "k"), 3, ["k"])
    laid = B.partition_by_shard(d, 3)
    per_part = laid.groupBy(F.spark_partition_id().alias("p")).agg(F.countDistinct("shard_id").alias("n")).collect()
    assert all(r.n == 1 for r in per_part) and len(per_part) == 3


def test_prompt_rejects(spark, scratch):
    os.makedirs(scratch, exist_ok=True)
    with open(f"{scratch}/p.csv", "w") as f:
        f.write("prompt,x\nok,1\n,2\n")
    _, rejects = S.read_prompts_checked(spark, f"{scratch}/p.csv")
    assert [(r.file.endswith("p.csv"), r.reason) for r in rejects.collect()] == [(True, "no prompt")]
    assert [r.prompt for r in S.read_prompts(spark, f"{scratch}/p.csv").collect()] == ["ok"]


def test_json_stream_source(spark, scratch):
    src = f"{scratch}/js"
    os.makedirs(src)
    with open(f"{src}/a.json", "w") as f:
        f.write(json.dumps({"query": "q1", "other": 1}) + "\n" + json.dumps({"query": "q2"}) + "\n")
    schema = T.StructType([T.StructField("other", T.LongType()), T.StructField("query", T.StringType())])
    prompts = S.read_prompts_stream(spark, src, "json", schema)
    q = start_stream(generate_stream(prompts, echo("{prompt}")), f"{scratch}/jo",
                     f"{scratch}/jc", "js")
    q.awaitTermination()
    got = sorted(r.text for r in spark.read.parquet(f"{scratch}/jo/records/run_id=js").collect())
    assert got == ["q1", "q2"]  # column chosen by the prompt/text/input/query rule


def test_json_rejects_and_positions(spark, scratch):
    os.makedirs(scratch, exist_ok=True)
    docs = {"a.json": '["p", {"other": 1}, {"prompt": "q"}, null]', "b.json": '{"prompts": ', "c.json": '{"x": 1}', "d.json": "[]"}
    for name, text in docs.items():
        with open(f"{scratch}/{name}", "w") as f:
            f.write(text)
    prompts, rejects = S.read_prompts_checked(spark, f"{scratch}/*.json")
    assert sorted(r.prompt for r in prompts.collect()) == ["p", "q"]
    got = {(os.path.basename(r.file), r.position, r.reason) for r in rejects.collect()}
    assert got == {("a.json", 1, "no prompt"), ("a.json", 3, "no prompt"), ("b.json", 0, "invalid JSON"),
                   ("c.json", 0, "no prompt"), ("d.json", 0, "no prompt")}


def test_over_limit_documents_raise(spark, scratch, monkeypatch):
    os.makedirs(scratch, exist_ok=True)
    with open(f"{scratch}/big.json", "w") as f:
        f.write('["x"' + " " * 2000)  # cut off, and above the limit set here
    assert S.read_prompts(spark, f"{scratch}/big.json").count() == 0
    monkeypatch.setattr(S, "VARIANT_BYTES", 1000)
    with pytest.raises(Exception, match="does not fit a VARIANT"):
        S.read_prompts(spark, f"{scratch}/big.json").collect()


def test_checks_tell_loading_from_syntax(spark):
    from synthtext.operators import checks as V

    df = spark.createDataFrame([(1, "{"), (2, "[1]"), (3, '"x"'), (4, "{}")], "id int, config_json string")
    got = {r.id: sorted(r.errors) for r in V.check_records(df).collect()}
    assert got[1] == ["syntax"] and got[2] == got[3] == ["loading"] and "model" in got[4]
    assert not V.check_config_files(spark, "/nowhere/at/all")
