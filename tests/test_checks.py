"""V1-V9 messages on the reference's fixtures (as JSON)."""

import json
import os

from pyspark.sql import functions as F

from synthtext.operators import checks as V


def errs(spark, section, doc):
    df = spark.createDataFrame([(json.dumps(doc),)], "j string").withColumn("v", F.try_parse_json("j"))
    return V.with_section_errors(df, "v", section, "e", path="$").first().e


def test_model_rules(spark):
    e = errs(spark, "model", {"name": "m", "model_type": "causal_lm"})
    assert "Missing required field: pretrained_model_name_or_path" in e
    e = errs(spark, "model", {"name": "m", "pretrained_model_name_or_path": "p", "model_type": "c",
                              "quantization": {"enabled": True}, "model_loading": {"use_cache": "no"}})
    assert e == ["Missing required field: quantization.bits", "model_loading.use_cache must be a boolean"]
    e = errs(spark, "model", {"name": "m", "pretrained_model_name_or_path": "p", "model_type": "c",
                              "quantization": {"enabled": True, "bits": 3}})
    assert e == ["quantization.bits must be 4 or 8"]


def test_generation_rules(spark):
    e = errs(spark, "generation", {"temperature": -1.0, "top_p": 2.0, "top_k": -10, "repetition_penalty": 0.0,
                                   "min_length": 100, "max_length": 50})
    for m in ["temperature must be positive", "top_p must be between 0 and 1", "top_k must be non-negative",
              "repetition_penalty must be positive", "min_length must be less than or equal to max_length"]:
        assert m in e
    e = errs(spark, "generation", {"temperature": "hot", "top_k": 1.5, "batch_size": 0,
                                   "vllm": {"enabled": "x", "tensor_parallel_size": 0, "gpu_memory_utilization": 2.0}})
    assert e == ["temperature must be a number", "top_k must be an integer", "batch_size must be positive",
                 "vllm.enabled must be a boolean", "vllm.tensor_parallel_size must be positive",
                 "vllm.gpu_memory_utilization must be between 0 and 1"]
    assert errs(spark, "generation", {"top_k": True}) == ["top_k must be an integer"]  # JSON true is no number


def test_logging_rules(spark):
    e = errs(spark, "logging", {"enabled": "not_a_boolean", "log_interval": -1, "metrics": {"throughput": "x"}})
    assert e == ["enabled must be a boolean", "log_interval must be positive", "metrics.throughput must be a boolean"]
    e = errs(spark, "logging", {"project": 123, "tags": [123, "a", 456]})
    assert e == ["project must be a string", "tags[0] must be a string", "tags[2] must be a string"]
    assert errs(spark, "logging", {"tags": "x"}) == ["tags must be a list"]


def test_post_processing_rules(spark):
    e = errs(spark, "post_processing", {"enabled": "not_a_boolean", "max_length": -1, "complete_sentences": "x"})
    assert e == ["enabled must be a boolean", "max_length must be positive", "complete_sentences must be a boolean"]


def test_full_record_and_report(spark):
    recs = [
        (1, json.dumps({"model": {"name": "m", "pretrained_model_name_or_path": "p", "model_type": "c"}})),
        (2, "{not json"),
    ]
    df = spark.createDataFrame(recs, "id int, config_json string")
    checked = V.check_records(df)
    rows = {r.id: r.errors for r in checked.collect()}
    assert set(rows[1]) == {"generation", "logging", "post_processing"}
    assert rows[1]["post_processing"] == ["Missing post-processing configuration"]
    assert rows[2] == {"syntax": ["invalid JSON"]}
    rep = V.error_report(checked, ("id",)).collect()
    assert len(rep) == 4
    ok, bad = V.split_valid(checked)
    assert ok.count() == 0 and bad.count() == 2
    assert not V.all_valid(checked)


def test_required_structure(spark):
    df = spark.createDataFrame([(json.dumps({"a": {"b": 1}, "c": 2}),)], "j string").withColumn("v", F.try_parse_json("j"))
    e = df.select(V.required_errors(F.col("v"), {"a": {"b": None, "x": None}, "d": None}).alias("e")).first().e
    assert e == ["a.Missing required field: x", "Missing required field: d"]


def test_config_files(spark, scratch):
    def w(rel, doc):
        p = f"{scratch}/cfg/{rel}"
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as f:
            f.write(doc if isinstance(doc, str) else json.dumps(doc))

    w("model/invalid.json", {"name": "m", "model_type": "c", "quantization": {"enabled": True}})
    w("post_processing/invalid.json", {"enabled": "x"})
    w("post_processing/valid.json", {"enabled": True, "max_length": 200})
    w("other/whatever.json", {"anything": 1})
    w("root.json", {"x": 1})
    w("logging/broken.json", "invalid: [json: syntax")
    checked = V.check_files(spark, f"{scratch}/cfg")
    bad = {r.file_path.rsplit("cfg/", 1)[1]: (r.kind, r.errors) for r in checked.collect() if r.errors}
    assert set(bad) == {"model/invalid.json", "post_processing/invalid.json", "logging/broken.json"}
    assert bad["logging/broken.json"] == ("syntax", ["invalid JSON"])
    assert not V.check_config_files(spark, f"{scratch}/cfg")
    assert not V.check_config_files(spark, f"{scratch}/does_not_exist")
    os.remove(f"{scratch}/cfg/model/invalid.json")
    os.remove(f"{scratch}/cfg/post_processing/invalid.json")
    os.remove(f"{scratch}/cfg/logging/broken.json")
    assert V.check_config_files(spark, f"{scratch}/cfg")


def test_config_files_hive_style_folders(spark, scratch):
    p = f"{scratch}/cfg2/section=post_processing/a.json"
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as f:
        f.write(json.dumps({"enabled": "x"}))
    rows = V.check_files(spark, f"{scratch}/cfg2").collect()
    assert [(r.section, r.errors) for r in rows] == [("post_processing", ["enabled must be a boolean"])]
