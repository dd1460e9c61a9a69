"""Rule checks run once a row; numbers are read of numbers and truth values only."""

from synthtext.operators import checks as V


def test_rules_run_once_below_the_report(spark, scratch):
    spark.createDataFrame([('{"id": 1, "doc": {"temperature": "hot", "top_k": 1.5}}',)], "value string").write.text(f"{scratch}/generation")
    checked = V.check_files(spark, scratch, suffix=".txt", lines=True, doc_path="$.doc")
    rep = V.error_report(checked, ("section",))
    assert sorted(r.message for r in rep.collect()) == ["temperature must be a number", "top_k must be an integer"]
    plan = rep._jdf.queryExecution().optimizedPlan().toString()
    assert not any("must be" in line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Filter"))


def test_values_of_all_kinds(spark):
    docs = ['{"model": {"quantization": {"enabled": "yes"}}}', '{"model": {"quantization": {"enabled": true, "bits": "4"}}}',
            '{"model": {"quantization": {"enabled": 0}}}', '{"model": {"quantization": {"enabled": [0], "bits": 3}}}',
            '{"model": null, "logging": [], "generation": {"vllm": {"gpu_memory_utilization": true}}}', "[1]", "{", None]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(docs)], "k long, doc string")
    got = {r.k: {s: list(e) for s, e in r.errors.items()} for r in V.check_records(df, "doc").collect()}
    assert [got[k]["model"][-1] for k in range(4)] == [
        V.MSG_MISSING.format("quantization.bits"), V.MSG_NUMBER.format("quantization.bits"), V.MSG_MISSING.format("model_type"),
        V.MSG_BITS]
    assert got[4]["model"] == [V.MSG_MISSING.format(f) for f in V.MODEL_REQUIRED] and "logging" not in got[4]
    assert got[4]["generation"] == [V.MSG_NUMBER.format("vllm.gpu_memory_utilization")]
    assert got[5] == {"loading": [V.NOT_A_RECORD]} and got[6] == got[7] == {"syntax": [V.INVALID_JSON]}
