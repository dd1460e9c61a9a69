"""Operator 4: all spans against a plain statement, and long runs in linear time."""

import random
import time
from collections import Counter
from math import log2

import numpy as np
import pyarrow as pa

from synthtext.llm import secrets as S
from synthtext.llm import words as W

from . import plain

TOKEN = S.CLASSES["token"][0]


def maximal(text, chars, least):
    out, start = [], None
    for i, c in enumerate(text + "\n"):
        if c in chars:
            start = i if start is None else start
        elif start is not None:
            if i - start >= least:
                out.append((start, i))
            start = None
    return out


def entropy(window):
    return -sum(n / len(window) * log2(n / len(window)) for n in Counter(window).values())


def open_parts(run):
    """Pieces of a run: its parts that touch an allow-list hit cut it."""
    hits = [m.span() for p in S.ALLOW for m in p.finditer(run)]
    alnum = frozenset(c for c in TOKEN if c.isalnum())
    bad = [p for p in maximal(run, alnum, 1) if any(u < p[1] and p[0] < v for u, v in hits)]
    edges = [0, *[x for p in bad for x in p], len(run)]
    for k in range(0, len(edges), 2):
        a, b = edges[k : k + 2]
        while k and a < b and run[a] not in alnum:
            a += 1
        while k + 2 < len(edges) and a < b and run[b - 1] not in alnum:
            b -= 1
        if b - a >= S.MIN_RUN:
            yield a, b


def brute(text):
    """Entropy spans of a text."""
    base = [(m.start(), m.end()) for m in S.ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    base += [m.span() for m in S.ACCESS.finditer(text) if len(m.group()) >= 20]
    base += maximal(text, frozenset("0123456789abcdef"), 24)
    found = []
    for x, y in maximal(text, TOKEN, S.MIN_RUN):
        for a, b in open_parts(text[x:y]):
            piece, covered = text[x + a : x + b], set()
            for chars, width, least, needs in S.CLASSES.values():
                for u, v in maximal(piece, chars, width):
                    for i in range(u, v - width + 1):
                        w = piece[i : i + width]
                        if all(any(c in need for c in w) for need in needs) and entropy(w) >= least - 1e-12:
                            covered.update((j, j + 1) for j in range(i, i + width))
            joined = []
            for p, q in sorted(covered):
                if joined and joined[-1][1] == p:
                    joined[-1][1] = q
                else:
                    joined.append([p, q])
            found += [(x + a + p, x + a + q) for p, q in joined]
    return [(p, q) for p, q in found if not any(u <= p and q <= v for u, v in base)]


def scan(texts):
    data, offs = W.text_buffers(pa.array(texts, pa.string()))
    out = [[] for _ in texts]
    for r, a, kind, b in S._base_and_entropy(data, offs):
        if kind == 3:
            out[r].append((a, b))
    return out


def random_text(rng):
    alphabets = ["".join(sorted(chars)) for chars, *_ in S.CLASSES.values()]
    fixed = ["example", "sample-", "your_", "token=", "secret: ", "api_key=", "AKIA", "0123456789abcdef", "1234567890",
             "123e4567-e89b-12d3-a456-426614174000", " ", "-", "/", "é", "\n", "_", "=", ", "]
    return "".join(rng.choice(fixed) if rng.random() < 0.45 else
                   "".join(rng.choice(alphabet) for _ in range(rng.choice((5, 19, 20, 24, 30, 48, 60))))
                   for alphabet in rng.choices(alphabets, k=rng.randint(1, 12)))


def test_spans_of_every_class_by_brute_force():
    rng = random.Random(11)
    texts = [random_text(rng) for _ in range(250)] + ["", None, "a"]
    want = [brute(t or "") for t in texts]
    assert sum(map(len, want)) > 150
    assert [sorted(x) for x in scan(texts)] == [sorted(x) for x in want]


def test_query_rows_by_brute_force(spark):
    rng = random.Random(12)
    rows = [(k, random_text(rng)) for k in range(40)] + [(40, None), (41, "")]
    got = {r.doc_id: r.spans for r in S.find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for d, t in rows:
        mine = [x for x in got[d].split(",") if x.startswith("entropy")]
        assert mine == [f"entropy:{p}:{q}" for p, q in sorted(brute(t or ""))]
    assert plain.base_secrets(None)[:3] == (0, 0, 0)


def test_long_runs_cost_what_they_hold():
    key = "AbC1sk9Qz7Lm2Xc4Vb8Nw1Ty6Rf3"
    for unit in ("example-", f"token={key} ", f"sample/{key}/"):
        small, large = unit * (100_000 // len(unit)), unit * (800_000 // len(unit))
        seconds = []
        for text in (small, large):
            start = time.process_time()
            scan([text])
            seconds.append(time.process_time() - start)
        assert seconds[1] < 24 * max(seconds[0], 0.02), (unit, seconds)


def test_pieces_follow_overlapping_hits():
    assert S.open_pieces("example-" * 4) == []
    assert np.array_equal(S._reaches([(5, 9), (0, 20), (7, 8)]), ([0, 5, 7], [20, 20, 20]))
