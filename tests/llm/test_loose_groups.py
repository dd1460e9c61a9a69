"""Operator 7 in buckets whose members are not linked to their most frequent class."""

import random

from synthtext.llm import near_dup as N

from . import plain


def loose_texts(rng, n, vocab, core, edits):
    """Copies of one text with words of their own at some places."""
    out = []
    for _ in range(n):
        ws = list(core)
        for k in rng.sample(range(len(core)), edits):
            ws[k] = rng.choice(vocab)
        out.append(" ".join(ws))
    return out


def rare_pairs(spark, texts):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "key bigint, text string")
    loose = rows.selectExpr("key a", "key c", "true apart")
    return [tuple(r) for r in N._rare_pairs(loose, rows, 75).collect()]


def jaccard_pairs(texts):
    sets = [set(zip(*[t.split(" ")[k:] for k in range(5)])) for t in texts]
    return {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}


def test_rare_shingles_lose_no_pair(spark):
    rng = random.Random(3)
    vocab = [f"w{k}" for k in range(400)]
    core = [rng.choice(vocab) for _ in range(120)]
    texts = [t for e in (0, 1, 2, 3, 5) for t in loose_texts(rng, 12, vocab, core, e)]
    texts += [" ".join(core[: rng.randint(90, 119)]) for _ in range(10)] + ["a b c d e"] * 2
    want, got = jaccard_pairs(texts), rare_pairs(spark, texts)
    assert len(got) == len(set(got)) and want <= set(got) and len(want) > 100


def test_a_loose_group_does_not_emit_all_its_pairs(spark):
    rng = random.Random(5)
    vocab = [f"w{k}" for k in range(5000)]
    core = [rng.choice(vocab) for _ in range(150)]
    texts = loose_texts(rng, 240, vocab, core, 8)
    assert not jaccard_pairs(texts)
    half, whole = len(rare_pairs(spark, texts[:120])), len(rare_pairs(spark, texts))
    assert whole <= 2 * half + 240 and whole < 240 * 239 / 2 / 20


def test_pairs_of_one_component_or_of_rows_in_place_do_not_meet(spark):
    same = "a b c d e f g h"
    rows = spark.createDataFrame([(k, same) for k in range(4)], "key bigint, text string")
    loose = spark.createDataFrame([(0, 9, True), (1, 9, True), (2, 2, False), (3, 3, False)], "a bigint, c bigint, apart boolean")
    got = {tuple(r) for r in N._rare_pairs(loose, rows, 75).collect()}
    assert got == {(0, 2), (0, 3), (1, 2), (1, 3)}
    assert N._rare_pairs(loose.limit(0), rows, 75).collect() == []


def test_loose_group_by_brute_force(spark):
    rng = random.Random(7)
    vocab = [f"w{k}" for k in range(3000)]
    core = [rng.choice(vocab) for _ in range(150)]
    texts = [t for e in (1, 3, 5, 8) for t in loose_texts(rng, 25, vocab, core, e)]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(None, texts[0]), (3, texts[9]), (500, None), (501, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.key: r.component_id for r in N.near_duplicates(df).collect() if r.key is not None}
    part = plain.near_duplicates([(d, t) for d, t in rows if d is not None])
    assert len(set(got.values())) > 3
    for d in {d for d, _ in rows if d is not None}:
        for e in {d for d, _ in rows if d is not None}:
            if (d in part) and (e in part):
                assert (got[d] == got[e]) == (part[d] == part[e])
