"""Cases, edge cases and randomised texts."""

import random

import pytest
from pyspark.sql import functions as F

from synthtext.config import PostProcessing
from synthtext.functions import text as X
from synthtext.operators.postprocess import apply_post_processing, batch_post_process
from tests import pyref


def one(spark, col_fn, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", col_fn(F.col("t")).alias("o")).orderBy("i").collect()
    return [r.o for r in rows]


def test_clean_whitespace_cases(spark):
    got = one(spark, X.clean_whitespace, ["two  gaps   here", "\t\t tabbed \r\n", "row\none\vtwo\fthree", " ", "as is"])
    assert got == ["two gaps here", "tabbed", "row one two three", "", "as is"]


def test_clean_whitespace_unicode(spark):
    texts = ["a\x1cb\x1dc\x1ed\x1fe", "x\x85y\xa0z　w", "  lead", "tail  ", "", "\U0001F600  \U0001F600"]
    assert one(spark, X.clean_whitespace, texts) == [pyref.clean(t) for t in texts]


def test_truncate_cases(spark):
    cut = lambda n, t: one(spark, lambda c: X.truncate_text(c, n), [t])[0]
    assert cut(12, "Fits in full") == "Fits in full"
    assert cut(9, "No end mark anywhere in here") == ""
    assert cut(14, "Aa bb! Cc dd? Ee ff.") == "Aa bb! Cc dd?"
    assert cut(8, "Aa bb! Cc dd? Ee ff.") == "Aa bb!"


@pytest.mark.parametrize("n", [15, 16, 17])
def test_truncate_first_sentence_boundary(spark, n):
    # a first sentence of 15 characters needs 16
    t = " ".join(["Count to 15 ok!"] * 3)
    assert one(spark, lambda c: X.truncate_text(c, n), [t]) == [pyref.truncate(t, n)]


def test_complete_sentence_cases(spark):
    got = one(spark, X.remove_incomplete_sentence, ["Rain? Snow!", "Rain? Snow and", "hail", "", "One. two. three"])
    assert got == ["Rain? Snow!", "Rain?", "", "", "One. two."]


def test_dedup_cases(spark):
    got = one(spark, X.deduplicate_sentences, ["A! B! C!", "A! A! A! B? B?", "A! B? A!", "A! a! A."])
    assert got == ["A! B! C!", "A! B?", "A! B? A!", "A! a! A."]


def test_null_passes_through(spark):
    df = spark.createDataFrame([(None,)], "t string")
    out = apply_post_processing(df, "t", PostProcessing(max_length=50)).first()
    assert out.t is None


def test_apply_post_processing_stages(spark):
    text = " Go  now!\nGo now!  Or\tlater? And if"
    for cfg, want in [
        (PostProcessing(max_length=None, complete_sentences=False, deduplicate=False), "Go now! Go now! Or later? And if"),
        (PostProcessing(max_length=None, complete_sentences=True, deduplicate=False), "Go now! Go now! Or later?"),
        (PostProcessing(max_length=None, complete_sentences=True, deduplicate=True), "Go now! Or later?"),
        (PostProcessing(max_length=17, complete_sentences=True, deduplicate=True), "Go now!"),
    ]:
        df = spark.createDataFrame([(0, text), (1, "x")], "i int, t string")
        got = [r.t for r in batch_post_process(df, "t", cfg).orderBy("i").collect()]
        assert got == [want, "" if cfg.complete_sentences else "x"]


def test_simple_post_process(spark):
    got = one(spark, lambda c: X.simple_post_process(c, 10), ["  hello \n\n world  again "])
    assert got == ["hello worl"]


def _random_texts(n, seed):
    rnd = random.Random(seed)
    words = ["alpha", "beta", "Gamma", "d", "x.", "why?", "no!", "ok.", "é", "\U0001F600", "end."]
    seps = [" ", "  ", "\n", "\t", "\x1c", "　", "\xa0", " \n ", ""]
    out = []
    for _ in range(n):
        k = rnd.randint(0, 40)
        out.append("".join(rnd.choice(words) + rnd.choice(seps) for _ in range(k)))
    return out


@pytest.mark.parametrize("n,complete,dedup", [(20, False, False), (60, True, True), (None, True, False), (None, False, True), (200, True, True)])
def test_post_processing_matches_python(spark, n, complete, dedup):
    texts = _random_texts(400, seed=hash((n, complete, dedup)) & 0xFFFF)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    cfg = PostProcessing(max_length=n, complete_sentences=complete, deduplicate=dedup)
    got = [r.t for r in apply_post_processing(df, "t", cfg).orderBy("i").collect()]
    want = [pyref.post_process(t, n, complete, dedup) for t in texts]
    assert got == want


def test_standalone_functions_match_python(spark):
    texts = _random_texts(300, seed=7)
    assert one(spark, lambda c: X.truncate_text(c, 40), texts) == [pyref.truncate(t, 40) for t in texts]
    assert one(spark, X.remove_incomplete_sentence, texts) == [pyref.complete(t) for t in texts]
    assert one(spark, X.deduplicate_sentences, texts) == [pyref.dedup(t) for t in texts]
