"""What a Python worker holds: n-grams of one length, the words of one block."""

import re
import tracemalloc

import numpy as np
import pyarrow as pa

from synthtext.llm import language as G
from synthtext.llm import pieces as P
from synthtext.llm import words as W


def _texts(n, seed):
    rng = np.random.default_rng(seed)
    words = ["".join(map(chr, rng.integers(97, 123, k))) for k in rng.integers(2, 9, 20_000)]
    return [" ".join(words[i] for i in rng.integers(0, len(words), 400)) for _ in range(n)]


def _peak(run):
    tracemalloc.start()
    run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak


def test_counting_holds_one_length():
    texts = _texts(300, 1)
    batch = pa.record_batch([pa.array([k % 3 for k in range(300)]), pa.array(texts)], names=["l", "t"])
    rows = {}

    def run():
        for out in G._gram_counter([batch]):
            for x in out.to_pylist():
                rows[x["l"], x["g"]] = rows.get((x["l"], x["g"]), 0) + x["n"]

    assert _peak(lambda: [len(x) for x in G._gram_counter([batch])]) < 140 * W.CHUNK
    run()
    want = {}
    for k, t in enumerate(texts):
        data, offs = W.text_buffers(pa.array([t]))
        for g in {int(x) for _, h in G._grams(data, offs) for x in W.signed(h)}:
            want[k % 3, g] = want.get((k % 3, g), 0) + 1
    assert rows == want


def test_a_block_is_spelled_without_a_string_a_word():
    table = P.load_pieces()
    pattern = re.compile(table.chunk_pattern())
    col = pa.array([*_texts(600, 2), None, "", "x  y", " ", "漢 \x00"])
    cuts = {0: "", 1: "", 2: ""}
    chunks = P._chunks(P._words(col, "bpe")[0], "bpe", pattern)[0]
    order, own, ends = P._dealt(chunks, 3)
    asked = chunks.take(pa.array(order)).to_pylist()
    cuts = {int(b): " ".join("".join(chr(48 + len(x)) for x in P.merge(c, table.scores, table.longest))
                             for c in asked[i:j]) for b, i, j in zip(own, ends, ends[1:])}
    got = []
    assert _peak(lambda: got.append(P._spelled(col, table, pattern, 3, cuts))) < 24 * sum(len(t or "") for t in col.to_pylist())
    flat, stops = got[0]
    own = [b"".join(table.raw[i] for i in flat[a:b]).decode() for a, b in zip(stops, stops[1:])]
    assert own == [f" {t}" if t else "" for t in col.to_pylist()]
