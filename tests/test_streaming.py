"""ST1-ST5, S10, F4 with availableNow triggers."""

import os


from synthtext.config import Generation, PostProcessing
from synthtext.operators.batching import with_row_seed
from synthtext.plans.doubles import batch_only_echo, echo
from synthtext.sources.prompts import prompts_from_list, read_prompts_stream
from synthtext.streaming.generate import _stream_fn, finalize_responses, finished_only, generate_stream, start_stream

PP = PostProcessing(max_length=2048, complete_sentences=True, deduplicate=True)


def test_chunks_and_finalize(spark):
    df = prompts_from_list(spark, ["Hi. Hi. x"])
    chunks = generate_stream(df, echo("{prompt}"))
    rows = finalize_responses(chunks, PP).orderBy("seq").collect()
    assert [r.text for r in rows] == ["Hi.", "Hi. Hi.", "Hi."]  # intermediate raw, final processed
    assert [r.finished for r in rows] == [False, False, True]
    assert [r.text for r in finished_only(finalize_responses(chunks, PP)).collect()] == ["Hi."]


def test_fallback_without_streaming(spark):
    df = prompts_from_list(spark, ["a b", "c"])
    rows = generate_stream(df, batch_only_echo("<{prompt}>{index}"), Generation(num_return_sequences=2)).collect()
    assert sorted((r.request_id, r.seq_index, r.text, r.finished) for r in rows) == [
        (0, 0, "<a b>0", True), (0, 1, "<a b>1", True), (1, 0, "<c>0", True), (1, 1, "<c>1", True)]


def test_stream_seeds_are_those_of_the_rows(spark):
    df = prompts_from_list(spark, ["a", "b"])
    got = {r.request_id: r.text for r in generate_stream(df, echo("{seed}"), Generation(seed=5)).collect()}
    want = {r.prompt_id: str(r.seed) for r in with_row_seed(df, 5, "prompt_id").collect()}
    assert got == want


def test_long_prompts_stream_in_small_frames():
    """20,000 words: cumulative chunks of about 1 GB, never held together."""
    import tracemalloc

    import pandas as pd

    text = " ".join(["abcd"] * 20_000)
    spec = echo("{prompt}")
    pdf = pd.DataFrame({"prompt_id": [1], "prompt": [text], "__seed": [0]})
    for only in (False, True):
        run = _stream_fn(spec, {}, 4, "prompt_id", "prompt", "__seed", [], only)
        tracemalloc.start()
        rows = sum(len(f) for f in run(iter([pdf])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows == (1 if only else 20_000) and peak < 64 << 20


def test_metrics_count_finished_texts(spark, scratch):
    src = f"{scratch}/in"
    os.makedirs(src)
    for k, lines in enumerate(["one two three\nfour\n", "four\n"]):
        with open(f"{src}/{k}.txt", "w") as f:
            f.write(lines)
    prompts = read_prompts_stream(spark, src, "text", max_files_per_trigger=1)
    q = start_stream(generate_stream(prompts, echo()), f"{scratch}/out", f"{scratch}/ckpt", "m")
    q.awaitTermination()
    out = spark.read.parquet(f"{scratch}/out/records/run_id=m").where("finished")
    assert out.count() == 3 and out.select("request_id").distinct().count() == 3  # equal lines, own ids
    ev = {}
    for r in spark.read.parquet(f"{scratch}/out/metric_events/run_id=m").collect():
        ev.setdefault(r.epoch, {})[r.name] = r.value
    assert sum(e["num_samples"] for e in ev.values()) == 3 and sum(e["num_tokens"] for e in ev.values()) == 5
    last = ev[max(ev)]
    assert (last["total_samples"], last["total_tokens"]) == (3, 5) and "throughput/tokens_per_second" in last


def test_a_replayed_epoch_replaces_its_events(spark, scratch):
    src, out = f"{scratch}/in", f"{scratch}/out"
    os.makedirs(src)
    with open(f"{src}/a.txt", "w") as f:
        f.write("one two\n")
    for checkpoint in ("c1", "c2"):  # a lost checkpoint replays epoch 0
        prompts = read_prompts_stream(spark, src, "text")
        start_stream(generate_stream(prompts, echo()), out, f"{scratch}/{checkpoint}", "r").awaitTermination()
    ev = spark.read.parquet(f"{out}/metric_events/run_id=r").where("name = 'num_samples'").collect()
    assert [(r.epoch, r.value) for r in ev] == [(0, 1.0)]


def test_text_stream_end_to_end(spark, scratch):
    src = f"{scratch}/in"
    os.makedirs(src)
    with open(f"{src}/a.txt", "w") as f:
        f.write("one two\n\nthree.  three. four\n")
    seen = []
    prompts = read_prompts_stream(spark, src, "text")
    q = start_stream(
        finished_only(finalize_responses(generate_stream(prompts, echo("{prompt}")), PP)),
        f"{scratch}/out", f"{scratch}/ckpt", "r1", callback=lambda df, epoch: seen.append((epoch, df.count())),
    )
    q.awaitTermination()
    out = spark.read.parquet(f"{scratch}/out/records/run_id=r1")
    assert sorted(r.text for r in out.collect()) == ["one two"[:0], "three."] or sorted(r.text for r in out.collect()) == ["", "three."]
    assert seen and seen[0][1] == 2
    ev = spark.read.parquet(f"{scratch}/out/metric_events/run_id=r1")
    assert {"seconds", "num_tokens", "num_samples", "total_tokens"} <= {r.name for r in ev.collect()}


def test_jsonl_stream(spark, scratch):
    src = f"{scratch}/jin"
    os.makedirs(src)
    with open(f"{src}/a.jsonl", "w") as f:
        f.write('{"prompt": "p1"}\n\n"p2"\n{"other": 1}\n')
    prompts = read_prompts_stream(spark, src, "jsonl")
    q = start_stream(generate_stream(prompts, echo("{prompt}!")), f"{scratch}/jout",
                     f"{scratch}/jckpt", "j")
    q.awaitTermination()
    out = spark.read.parquet(f"{scratch}/jout/records/run_id=j").where("finished")
    assert sorted(r.text for r in out.collect()) == ["p1!", "p2!"]
