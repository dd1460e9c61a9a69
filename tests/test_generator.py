"""The generator surface: load_prompts, generate_batch, generate, generate_streaming."""

import os

from pyspark.sql import functions as F

from synthtext.config import Generation, Output, PostProcessing, RunConfig
from synthtext.plans.doubles import echo
from synthtext.plans.generator import TextGenerator
from synthtext.sources.prompts import STORY_PREFIX, prompts_from_list, read_prompts_stream


def cfg(scratch, **gen):
    return RunConfig(generation=Generation(batch_size=4, **gen), post_processing=PostProcessing(max_length=100),
                     output=Output(dir=scratch, format="jsonl"))


def test_load_prompts_synthetic_and_file(spark, scratch):
    g = TextGenerator(spark, cfg(scratch, num_prompts=7, prompt_template="<{prompt}>"))
    rows = g.load_prompts().collect()
    assert len(rows) == 7 and all(r.prompt.startswith("<" + STORY_PREFIX) for r in rows)
    os.makedirs(scratch, exist_ok=True)
    with open(f"{scratch}/p.txt", "w") as f:
        f.write("a\n\nb\n")
    g = TextGenerator(spark, cfg(scratch, prompt_file=f"{scratch}/p.txt"))
    assert sorted(r.prompt for r in g.load_prompts().collect()) == ["a", "b"]


def test_generate_batch_and_run(spark, scratch):
    g = TextGenerator(spark, cfg(scratch, num_prompts=9), echo("{prompt}. {prompt}."))
    out = g.generate_batch(prompts_from_list(spark, ["x", "y"])).orderBy("prompt_id").collect()
    assert [r.generated_text for r in out] == ["x.", "y."]  # adjacent duplicate removed
    paths = g.generate(run_id="g1")
    assert spark.read.json(paths.records).count() == 9
    assert spark.read.json(paths.metrics).first().total_samples == 9


def test_generate_streaming(spark, scratch):
    src = f"{scratch}/in"
    os.makedirs(src)
    with open(f"{src}/a.txt", "w") as f:
        f.write("one. two\n")
    g = TextGenerator(spark, cfg(scratch), echo("{prompt}"))
    seen = []
    q = g.generate_streaming(read_prompts_stream(spark, src, "text"), f"{scratch}/ck", "s",
                             callback=lambda df, e: seen.append(df.where(F.col("finished")).first().text))
    q.awaitTermination()
    assert seen == ["one."]
