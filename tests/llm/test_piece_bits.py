"""The BPE fold on both sides of the length at which ends stop to fit one number."""

import random

from synthtext.llm import pieces as P


def test_fold_around_the_width_of_a_number(spark):
    table = P.load_pieces()
    rnd = random.Random(7)
    long = sorted((p for p in table.scores if len(p) > 3 and p.isalpha()))
    chunks = set()
    for n in (2, 3, 30, 60, 61, 62, 63, 64, 65, 130):
        for _ in range(6):
            text = ""
            while len(text) < n:
                text += rnd.choice(long) if rnd.random() < 0.8 else rnd.choice("aeznqé")
            chunks.add(P.SPACE + text[: n - 1])
            chunks.add("a" * n)
    rows = spark.createDataFrame([(0, c) for c in sorted(chunks)], "bucket bigint, chunk string")
    got = {r.chunk: [b - 48 for b in r.cut.encode()] for r in P.segmentations(rows, table, ["bucket"]).collect()}
    want = {c: [len(p) for p in P.merge(c, table.scores, table.longest)] for c in chunks}
    for c, cut in want.items():  # chunks without a piece of two characters are left out
        assert got.get(c, [1] * len(c)) == cut, c
    assert len(got) > 50 and {len(c) for c in got} >= {61, 62, 63, 64, 65, 130}
