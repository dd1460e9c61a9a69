"""S1-S9 readers and P1-P5 prompt shaping."""

import json
import os

import pytest
from pyspark.sql import functions as F

from synthtext.operators import prompts as P
from synthtext.sources import prompts as S


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def prompts_of(df):
    return [r.prompt for r in df.orderBy("prompt_id").collect()]


def test_text_prompts(spark, scratch):
    p = write(f"{scratch}/p.txt", "  first \n\n\t\nsecond\n third  \n")
    assert prompts_of(S.read_prompts(spark, p)) == ["first", "second", "third"]


@pytest.mark.parametrize("doc,want", [
    (["p1", {"prompt": "p2", "x": 1}], ["p1", "p2"]),
    ({"prompts": ["q1", "q2"]}, ["q1", "q2"]),
    ({"prompt": "z"}, ["z"]),
])
def test_json_document_shapes(spark, scratch, doc, want):
    p = write(f"{scratch}/p.json", json.dumps(doc))
    assert prompts_of(S.read_prompts(spark, p)) == want


def test_json_missing_prompt(spark, scratch):
    p = write(f"{scratch}/p.json", json.dumps({"other": 1}))
    assert S.read_prompts(spark, p).count() == 0
    with pytest.raises(Exception):
        S.read_prompts(spark, p, mode="failfast").collect()


def test_jsonl(spark, scratch):
    p = write(f"{scratch}/p.jsonl", '{"prompt": "a"}\n\n"b"\n{"prompt": "c", "k": 2}\n')
    assert prompts_of(S.read_prompts(spark, p)) == ["a", "b", "c"]


def test_csv_multiline_and_column_choice(spark, scratch):
    p = write(f"{scratch}/p.csv", 'id,text,query\n1,"hello, ""you""\nthere",q\n2,,q2\n')
    got = prompts_of(S.read_prompts(spark, p))
    assert got == ['hello, "you"\nthere']  # empty cell dropped, never "nan"


def test_parquet_and_first_column(spark, scratch):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "zz string, n int")
    df.coalesce(1).write.parquet(f"{scratch}/p.parquet")
    assert sorted(prompts_of(S.read_prompts(spark, f"{scratch}/p.parquet"))) == ["a", "b"]


def test_resolve_prompt_column():
    assert S.resolve_prompt_column(["x", "query", "text"]) == "text"
    assert S.resolve_prompt_column(["x", "y"]) == "x"
    assert S.resolve_prompt_column(["input", "prompt"]) == "prompt"


def test_unsupported_format(spark):
    with pytest.raises(ValueError, match="Unsupported prompt file format: .xml"):
        S.read_prompts(spark, "/nowhere/p.xml")


def test_synthetic_prompts_partition_independent(spark):
    a = {(r.prompt_id, r.prompt) for r in S.synthesize_prompts(spark, 200, seed=42).collect()}
    b = {(r.prompt_id, r.prompt) for r in S.synthesize_prompts(spark, 200, seed=42).repartition(7).collect()}
    assert a == b and len(a) == 200
    topics = {p.removeprefix(S.STORY_PREFIX) for _, p in a}
    assert topics <= set(S.TOPICS) and len(topics) == 5


def test_template(spark):
    df = S.prompts_from_list(spark, ["x", "y"])
    out = [r.prompt for r in P.apply_template(df, "Q: {prompt} {{literal}}").orderBy("prompt_id").collect()]
    assert out == ["Q: x {literal}", "Q: y {literal}"]
    assert P.apply_template(df, "{prompt}") is df
    with pytest.raises(KeyError):
        P.template_column("{other}", F.col("prompt"))
    with pytest.raises(ValueError):
        P.template_column("{prompt!r}", F.col("prompt"))


def test_bos(spark):
    df = S.prompts_from_list(spark, ["<s>a", "b"])
    out = [r.prompt for r in P.prepend_bos(df, "<s>").orderBy("prompt_id").collect()]
    assert out == ["<s>a", "<s>b"]
    assert P.prepend_bos(df, "<s>", enabled=False) is df


def test_sampling_params(spark):
    df = spark.createDataFrame([(1, 1.0, False, 3), (2, 1.3, True, None)], "id int, repetition_penalty double, do_sample boolean, num_return_sequences int")
    rows = {r.id: r for r in P.sampling_params(df).collect()}
    assert rows[1].presence_penalty == 0.0 and rows[1].use_beam_search and rows[1].best_of == 3 and rows[1].n == 3
    assert abs(rows[2].presence_penalty - 0.3) < 1e-12 and rows[2].best_of is None and rows[2].n == 1
    assert rows[2].max_tokens == 1024 and rows[2].temperature == 0.8 and rows[2].top_k == 50
