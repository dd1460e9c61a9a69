"""K6, K8 and K9 in tables of all runs; ST4 for every chunk."""

import json
import os

import pytest

from synthtext.config import Generation, Output, PostProcessing, RunConfig
from synthtext.plans.doubles import echo
from synthtext.plans.job import generated_records, run_shared_job
from synthtext.sinks import runs as R
from synthtext.sources.prompts import prompts_from_list, read_prompts_stream
from synthtext.streaming.callbacks import JsonLines, _Writer, consume_stream
from synthtext.streaming.generate import generate_stream


def _texts(spark, out):
    return sorted((r.run_id, r.generated_text) for r in R.read_finished(spark, out, R.RECORDS).collect())


def test_readers_see_finished_tries_only(spark, scratch):
    cfg = RunConfig(model_name="m", generation=Generation(batch_size=2), post_processing=PostProcessing(enabled=False),
                    output=Output(dir=scratch, format="parquet"))
    prompts = prompts_from_list(spark, ["x", "y", "z"])
    assert R.finished_runs(spark, scratch).count() == 0
    R.write_attempt(generated_records(prompts, cfg, echo("lost {prompt}")), scratch, R.RECORDS, "007", "1")
    assert _texts(spark, scratch) == []  # killed before its manifest row
    run_shared_job(spark, prompts, cfg, echo("a {prompt}"), "007", "2")
    run_shared_job(spark, prompts, cfg, echo("b {prompt}"), "8")
    want = [("007", "a x"), ("007", "a y"), ("007", "a z"), ("8", "b x"), ("8", "b y"), ("8", "b z")]
    assert _texts(spark, scratch) == want
    # a later try that is killed leaves the finished one as it was
    R.write_attempt(generated_records(prompts, cfg, echo("c {prompt}")), scratch, R.RECORDS, "007", "3")
    assert _texts(spark, scratch) == want
    # the same try again replaces itself, and leaves the other run alone
    run_shared_job(spark, prompts.limit(1), cfg, echo("d {prompt}"), "007", "2")
    assert _texts(spark, scratch) == [("007", "d x"), *want[3:]]
    kept = {r.run_id: (r.attempt, json.loads(r.config_json)) for r in R.finished_runs(spark, scratch).collect()}
    assert kept["007"] == ("2", json.loads(json.dumps(cfg.to_dict()))) and set(kept) == {"007", "8"}
    events = R.read_finished(spark, scratch, R.EVENTS).where("name = 'total_tokens'").collect()
    assert max(e.value for e in events if e.run_id == "007") == 2 and max(e.value for e in events if e.run_id == "8") == 6


def _seen(folder):
    out = []
    for root, _, files in os.walk(folder):
        for f in files:
            if f.endswith(".json"):
                with open(f"{root}/{f}") as h:
                    out.append([json.loads(line) for line in h])
    return out


def test_every_chunk_is_handed_over_once_in_order(spark, scratch):
    os.makedirs(f"{scratch}/in")
    for k, lines in enumerate(["one two three\nfour\n", "five six\n"]):
        with open(f"{scratch}/in/{k}.txt", "w") as f:
            f.write(lines)
    columns = ["request_id", "seq", "text", "finished"]

    def run(checkpoint):
        feed = read_prompts_stream(spark, f"{scratch}/in", "text", max_files_per_trigger=1)
        make = lambda part, epoch: JsonLines(f"{scratch}/seen", columns, part, epoch)
        consume_stream(generate_stream(feed, echo("{prompt}")), make, f"{scratch}/marks", checkpoint).awaitTermination()

    run(f"{scratch}/c1")
    first = sorted(map(json.dumps, _seen(f"{scratch}/seen")))
    by_request = {}
    for part in map(json.loads, first):
        assert [c["n"] for c in part] == list(range(len(part)))
        for c in part:
            by_request.setdefault(c["request_id"], []).append((c["seq"], c["text"], c["finished"]))
    assert sorted(by_request.values()) == [
        [(0, "five", False), (1, "five six", True)], [(0, "four", True)],
        [(0, "one", False), (1, "one two", False), (2, "one two three", True)]]
    times = {f: os.stat(os.path.join(r, f)).st_mtime_ns for r, _, fs in os.walk(f"{scratch}/seen") for f in fs}
    run(f"{scratch}/c2")  # the checkpoint is lost, all epochs come again: each partition is marked
    assert sorted(map(json.dumps, _seen(f"{scratch}/seen"))) == first
    assert times == {f: os.stat(os.path.join(r, f)).st_mtime_ns for r, _, fs in os.walk(f"{scratch}/seen") for f in fs}


def test_a_failed_partition_is_not_marked(scratch):
    made = []

    class Failing:
        def __init__(self, part, epoch):
            made.append((part, epoch))

        def chunk(self, row):
            raise ValueError(row)

        def close(self, error):
            assert error is not None

    w = _Writer(Failing, f"{scratch}/marks")
    for _ in range(2):
        assert w.open(3, 5)
        with pytest.raises(ValueError):
            w.process("row")
        w.close(ValueError("row"))
    assert made == [(3, 5), (3, 5)]
    w = _Writer(lambda p, e: JsonLines(f"{scratch}/none", [], p, e), f"{scratch}/marks")
    assert w.open(3, 5)
    w.close(None)
    assert not w.open(3, 5) and w.open(3, 6)
