"""Operator 12 against all pairs of a small vocabulary."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from synthtext.llm.queries import QUERIES
from synthtext.llm.variants import rotations, spelling_variants, word_counts

from .plain import LOW


def counted(rows, drop):
    out = Counter()
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(LOW)
            h = zlib.crc32(f"{'null' if d is None else d}:{w}".encode())
            if drop and h % drop == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            out[w] += 1
    return out


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(counts):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 2 * counts[w]:
            form[w] = best
    out = {}
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, counts[w], len(near[w]), counts[form[w]] if w in form else None)
    return out


def result(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_counts(spark, monkeypatch):
    rows = [(1, None), (2, ""), (3, "Été ÉTÉ été × ÷ Straße STRASSE o'clock x1y"), (None, "null Null"), (4, "a" * 70),
            (5, "Word " * 5000), (5, "Word " * 5000)]
    df = spark.createDataFrame([(d, t, "z") for d, t in rows], "doc_id bigint, text string, word string")
    for piece in (1 << 20, 100):
        monkeypatch.setattr("synthtext.llm.variants._PIECE", piece)
        for drop in (0, 1, 3):
            got = {r.word: r.n for r in word_counts(df, drop=drop).collect()}
            assert got == dict(counted(rows, drop))
    assert {r.word for r in word_counts(df, min_chars=4, min_count=2).collect()} == {"null", "word"}
    assert word_counts(df.limit(0)).collect() == []


def test_near_words_by_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    counts = {}
    for _ in range(700):  # few letters: many near words, runs of equal letters
        counts["".join(rng.choices("aabé÷", k=rng.randint(1, 7)))] = rng.choice([1, 2, 3, 5, 8, 16, 32, 64, 200])
    counts |= {"book": 9, "bok": 3, "boook": 20, "z" * 3000: 4, "z" * 2999: 8, "z" * 3001: 8}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    want = grouped(counts)
    for long in (64, 4):
        monkeypatch.setattr("synthtext.llm.variants.LONG", long)
        assert result(spelling_variants(df)) == want


def test_very_long_words(spark):
    w = "".join(random.Random(1).choices("abc", k=50_000))
    counts = {w: 3, w[1:]: 9, w[:-1] + "d": 9, w + "d": 2, w[:30_000] + w[30_001:]: 40, "other": 5}
    got = result(spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n bigint")))
    assert got[w] == (w[:30_000] + w[30_001:],) * 2 + (3, 4, 40)
    assert got["other"] == (None, "other", 5, 0, None)


def test_long_chain_and_empty(spark):
    counts = {"a" * k: 2**k for k in range(5, 40)}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    got = result(spelling_variants(df))
    assert got == grouped(counts)
    assert {r[1] for r in got.values()} == {"a" * 39}
    assert spelling_variants(df.limit(0)).collect() == []


def test_groups_are_bounded_by_the_alphabet(spark):
    """20,000 words that end alike and differ in one place each: no prefix holds more rows
    than letters, and the second place's edits meet elsewhere."""
    letters = "abcdefghijklmnopqrst"
    words = [(a + b + c + "ending", 3) for a in letters for b in letters for c in letters]
    df = spark.createDataFrame(words, "word string, n bigint")
    assert rotations(df).groupBy("prefix").count().agg(F.max("count")).first()[0] <= len(letters) + 1


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    counts = {w: n for w, n in counted(rows, 97).items() if len(w) >= 5 and n >= 3}
    got = result(QUERIES["op12_spelling_variants"](spark, sf_dir))
    assert got == grouped(counts)
