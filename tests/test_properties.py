"""Property tests: X6 on arbitrary texts equals the plain-Python statement;
M2 is the same under any partitioning (SURVEY section 5 (c), (e))."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from synthtext.config import PostProcessing
from synthtext.operators import metrics as M
from synthtext.operators.postprocess import apply_post_processing
from tests import pyref

# words, terminators and every kind of whitespace the rules care about
ALPHABET = st.sampled_from(list("ab. !?x") + ["\n", "\t", "\x1c", "\x1f", "\x85", "\xa0", " ", "　", "é", "\U0001F600"])
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=80), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=TEXTS, n=st.sampled_from([None, 5, 20, 60]), complete=st.booleans(), dedup=st.booleans())
def test_post_processing_property(spark, texts, n, complete, dedup):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    cfg = PostProcessing(max_length=n, complete_sentences=complete, deduplicate=dedup)
    got = [r.t for r in apply_post_processing(df, "t", cfg).orderBy("i").collect()]
    assert got == [pyref.post_process(t, n, complete, dedup) for t in texts]


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_diversity_partition_independent(spark, sf_dir, parts):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text").repartition(parts)
    got = {r.lang: (r.unique_tokens, r.total_tokens, round(r.entropy, 9))
           for r in M.token_diversity(docs, text_col="text", group_cols=["lang"]).collect()}
    base = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text").coalesce(1)
    want = {r.lang: (r.unique_tokens, r.total_tokens, round(r.entropy, 9))
            for r in M.token_diversity(base, text_col="text", group_cols=["lang"]).collect()}
    assert got == want


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.integers(min_value=-5, max_value=50), max_size=120),
       parts=st.integers(min_value=1, max_value=9), ranges=st.integers(min_value=1, max_value=7))
def test_ordinals_property(spark, keys, parts, ranges):
    from synthtext.operators import batching as B

    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k int").repartition(parts)
    rows = B.with_ordinal(df, ["k"], num_partitions=ranges).collect()
    assert sorted(r.ordinal for r in rows) == list(range(len(keys)))  # dense and unique
    by_ord = sorted(rows, key=lambda r: r.ordinal)
    assert [r.k for r in by_ord] == sorted(keys)  # consistent with the key order
