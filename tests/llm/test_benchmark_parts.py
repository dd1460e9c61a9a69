"""Operator 8: the benchmark's parts by the operator's own words."""

import random

import pytest

from synthtext.llm import decontaminate as D

from . import plain


@pytest.mark.parametrize("space", ["\n", "\t", ",", " "])
def test_parts_hold_few_words_whatever_separates_them(spark, monkeypatch, space):
    rng = random.Random(3)
    text = lambda n: space.join(rng.choice(["the", "of", "Été", "x1", "b", "c"]) for _ in range(n))
    items = [(k, text(rng.randint(13, 40))) for k in range(30)] + [(7, "the of b")] * 40
    rows = [(k, f"{text(20)}{space}{rng.choice(items)[1]}{space}{text(9)}") for k in range(20)]
    built, windows = [], D.item_windows
    monkeypatch.setattr(D, "item_windows", lambda x: built.append([len(plain.words8(t)) for _, t in x]) or windows(x))
    out, p = D.find_benchmark(spark.createDataFrame(rows, "doc_id bigint, text string"),
                              spark.createDataFrame(items, "item_id bigint, text string"), part_words=200)
    got = {r.doc_id: (r[p + "n_words"], sum(b - a for a, b in r[p + "spans"]), len(r[p + "items"])) for r in out.collect()}
    assert got == {d: plain.benchmark_hits(t, items)[:3] for d, t in rows}
    assert len(built) > 2 and max(map(sum, built)) <= 200


def test_part_starts():
    assert D.part_starts([], 5) == [0]
    assert D.part_starts([(9, 9), (3, 2), (4, 3), (7, 1)], 5) == [0, 7, 9]
