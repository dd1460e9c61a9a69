"""U1-U4 with the echo test double, K1-K9 sinks and the batch job."""

import pytest
from pyspark.sql import functions as F

from synthtext.config import Generation, Output, PostProcessing, RunConfig
from synthtext.operators import batching as B
from synthtext.operators.backends import BackendSpec, register_backend
from synthtext.plans.doubles import echo
from synthtext.operators.generate import explode_sequences, generate, generate_one, timing_table
from synthtext.plans.job import run_batch_job
from synthtext.sinks import records as K
from synthtext.sources.prompts import prompts_from_list

ECHO = echo("Echo: {prompt}")


def test_generate_keeps_order_and_batches(spark):
    df = B.assign_batches(prompts_from_list(spark, [f"p{i}" for i in range(37)]), 8, ["prompt_id"])
    out = generate(df, ECHO, Generation(batch_size=8)).orderBy("prompt_id").collect()
    assert [r.generated_text for r in out] == [f"Echo: p{i}" for i in range(37)]
    t = timing_table(spark.createDataFrame(out)).orderBy("batch_id").collect()
    assert [r.num_samples for r in t] == [8, 8, 8, 8, 5]


def test_generate_one(spark):
    assert generate_one(spark, "hi", ECHO) == "Echo: hi"


def test_multi_sequence(spark):
    df = prompts_from_list(spark, ["a", "b"])
    out = explode_sequences(generate(df, echo("{prompt}{index}"), Generation(num_return_sequences=3)))
    assert sorted((r.prompt, r.seq_index, r.generated_text) for r in out.collect()) == [
        ("a", 0, "a0"), ("a", 1, "a1"), ("a", 2, "a2"), ("b", 0, "b0"), ("b", 1, "b1"), ("b", 2, "b2")
    ]


def test_unknown_backend(spark):
    with pytest.raises(Exception):
        generate(prompts_from_list(spark, ["a"]), BackendSpec.of("nope")).collect()


def test_registered_backend(spark):
    # registered in the driver only: the spec carries the factory to the workers
    class Upper:
        def generate(self, prompts, params, seeds=None):
            return [[p.upper()] for p in prompts]

    register_backend("upper_test", Upper)
    out = generate(prompts_from_list(spark, ["ab", "cd"]), BackendSpec.of("upper_test"), batch_col=None)
    assert sorted(r.generated_text for r in out.collect()) == ["AB", "CD"]


def test_format_check():
    assert K.check_format("JSONL") == "jsonl"
    with pytest.raises(ValueError, match="Unsupported output format: xml"):
        K.check_format("xml")


@pytest.mark.parametrize("fmt", ["jsonl", "csv", "parquet"])
def test_record_roundtrip(spark, scratch, fmt):
    df = spark.createDataFrame(
        [("a, \"quoted\"\nline", None, 1.5), ("é", "x", 2.0), ("  lead and trail \t", "", 0.0), ("\r\n", "\\N", -1.0)], "prompt string, generated_text string, timestamp double"
    ).withColumn("parameters", F.struct(F.lit(0.8).alias("temperature"), F.lit(50).alias("top_k")))
    path = f"{scratch}/rec_{fmt}"
    K.write_records(df, path, fmt)
    K.write_records(df, path, fmt)  # append
    back = K.read_records(spark, path, fmt, df.schema)
    key = lambda r: str(r)
    assert sorted(back.collect(), key=key) == sorted(df.collect() * 2, key=key)
    if fmt == "jsonl":
        assert spark.read.text(path).where("value like '%\"generated_text\":null%'").count() == 2


def test_batch_job(spark, scratch):
    prompts = prompts_from_list(spark, [f"Tell me about {i}. " * 3 for i in range(40)])
    cfg = RunConfig(
        generation=Generation(batch_size=8, prompt_template="Q: {prompt}"),
        post_processing=PostProcessing(max_length=60),
        output=Output(dir=scratch, format="jsonl"),
    )
    for _ in range(2):  # a second try of a run replaces the first
        paths = run_batch_job(spark, prompts, cfg, echo("{prompt} {prompt}"), run_id="t1")
    recs = spark.read.json(paths.records)
    assert recs.count() == 40
    assert recs.where(F.length("generated_text") > 60).count() == 0
    m = spark.read.json(paths.metrics).first()
    assert m.total_samples == 40 and m.total_tokens > 0
    assert '"batch_size": 8' in spark.read.parquet(paths.config).first().config_json
    assert spark.read.parquet(f"{scratch}/runs").first().run_id == "t1"
    assert recs.where("prompt like 'Q: %'").count() == 0  # prompts are taken as they are
    assert spark.read.parquet(paths.samples).count() == 8  # min(log_samples=10, batch of 8)
    ev = spark.read.parquet(paths.events)
    assert {r.batch_id for r in ev.collect()} == set(range(5))  # every batch
    assert {"throughput/tokens_per_second", "diversity/entropy"} <= {r.name for r in ev.collect()}
    assert "throughput/tokens_per_second" in m.asDict()


def test_job_with_several_texts(spark, scratch):
    cfg = RunConfig(generation=Generation(batch_size=4, num_return_sequences=2), output=Output(dir=scratch, format="parquet"),
                    post_processing=PostProcessing(max_length=60))
    prompts = prompts_from_list(spark, [f"p{i}." for i in range(10)])
    paths = run_batch_job(spark, prompts, cfg, echo("{prompt} {index}."), run_id="k")
    recs = spark.read.parquet(paths.records).collect()
    assert {(r.prompt, r.seq_index, r.generated_text) for r in recs} == {
        (f"p{i}.", k, f"p{i}. {k}.") for i in range(10) for k in range(2)}
    assert spark.read.json(paths.metrics).first().total_samples == 20


@pytest.mark.parametrize("batch_size,batched", [(5000, True), (300, True), (5000, False)])
def test_calls_hold_whole_batches(spark, batch_size, batched):
    class Sizes:
        def generate(self, prompts, params, seeds=None):
            return [[str(len(prompts))] for _ in prompts]

    n = 10_000
    df = spark.range(n).select(F.col("id").alias("prompt_id"), F.col("id").cast("string").alias("prompt"))
    df = B.assign_batches(df, batch_size, ["prompt_id"]) if batched else df.coalesce(1)
    out = generate(df, BackendSpec.from_factory("sizes", Sizes), Generation(batch_size=batch_size))
    got = {r.s: r["count"] for r in out.groupBy(F.col("generated_text").cast("int").alias("s")).count().collect()}
    want = {batch_size: n // batch_size * batch_size}
    if n % batch_size:
        want[n % batch_size] = n % batch_size
    assert got == want


def test_re_registered_backends_are_new(spark):
    for answer in ("A", "B"):
        def factory(answer=answer):
            class Fixed:
                def generate(self, prompts, params, seeds=None):
                    return [[answer] for _ in prompts]
            return Fixed()

        register_backend("fixed_test", factory)
        df = spark.range(64).repartition(16).select(F.col("id").alias("prompt_id"), F.lit("x").alias("prompt"))
        out = generate(df, BackendSpec.of("fixed_test"), batch_col=None)
        assert {r.generated_text for r in out.collect()} == {answer}


def test_attach_outputs(spark):
    from synthtext.operators.generate import attach_outputs

    prompts = prompts_from_list(spark, ["a", "b", "c"])
    outs = spark.createDataFrame([(0, "A"), (2, "C")], "prompt_id long, generated_text string")
    left = sorted((r.prompt, r.generated_text) for r in attach_outputs(prompts, outs).collect())
    assert left == [("a", "A"), ("b", None), ("c", "C")]
    inner = attach_outputs(prompts, outs, how="inner").count()
    assert inner == 2  # like a positional zip, prompts without output drop


def test_user_tokenizer(spark):
    from synthtext.functions.tokens import udf_tokenizer
    from synthtext.operators import metrics as M

    def factory():
        vocab = {}
        return lambda text: [vocab.setdefault(w.lower(), len(vocab)) for w in text.split()]

    tok = udf_tokenizer(factory)
    df = spark.createDataFrame([("A b a",), ("B c",)], "text string")
    ids = [r.ids for r in df.select(tok("text").alias("ids")).collect()]
    assert all(isinstance(i, int) for row in ids for i in row) and sum(len(r) for r in ids) == 5
    r = M.token_diversity(df, text_col="text", tokenizer=tok).first()
    assert r.total_tokens == 5 and r.unique_tokens <= 5


def test_matrices_of_whole_batches(spark):
    """U1 on T3's matrices: shapes, masks, both padding sides, rows back in order."""
    from synthtext.operators.batching import assign_batches
    from synthtext.operators.generate import predict_batches
    from synthtext.operators.tokens import pad_batch

    rows = [(i, list(range(1, i % 5 + 1))) for i in range(23)]
    df = assign_batches(spark.createDataFrame(rows, "id long, ids array<int>"), 8, ["id"], unique_keys=True)

    def make():
        return lambda ids, mask: [f"{ids.shape}:{int(m.sum())}:{list(map(int, i))}" for i, m in zip(ids, mask)]

    for side in ("right", "left"):
        got = predict_batches(pad_batch(df, "ids", 0, side).drop("ids"), make, out_type="string").collect()
        assert len(got) == 23
        for r in got:
            own = rows[r.id][1]
            width = max(len(x) for i, x in rows if i // 8 == r.id // 8)
            fill = [0] * (width - len(own))
            n = len([i for i, _ in rows if i // 8 == r.id // 8])
            assert r.prediction == f"({n}, {width}):{len(own)}:{own + fill if side == 'right' else fill + own}"
    with pytest.raises(Exception, match="values for a batch"):
        predict_batches(pad_batch(df, "ids", 0).drop("ids"), lambda: lambda ids, mask: [1]).collect()
