"""Packed bands, the filters before the edit distance, and the distance itself, against plain versions."""

import random

import numpy as np
import pyarrow as pa

import corpus_pipeline as C
from synthtext.llm import lines as L

from .test_line_grams import brute, edited
from .test_lines import frame, levenshtein


def pairs(rng, n):
    x, y = [], []
    for _ in range(n):
        a = "".join(rng.choice("ab cé漢") for _ in range(rng.choice([1, 5, 30, 63, 64, 65, 129])))
        b = list(a)
        for _ in range(rng.choice([0, 1, 3, 9])):
            if b and rng.random() < 0.6:
                i = rng.randrange(len(b))
                b[i : i + 1] = rng.choice(["", "x", "ab"])
            else:
                b.insert(rng.randint(0, len(b)), "c")
        x.append(a)
        y.append("".join(b if rng.random() < 0.9 else b[: len(b) // 2]))
    return x, y


def test_edits_and_bounds():
    rng = random.Random(5)
    x, y = pairs(rng, 200)
    limit = np.array([rng.choice([0, 2, 5, 12]) for _ in x])
    want = [levenshtein(a, b) for a, b in zip(x, y)]
    seen = set()
    for at, got in L._edits(x, y, limit):
        seen.update(at.tolist())
        for i, v in zip(at, got):
            assert v == want[i] if want[i] <= limit[i] else v > limit[i]
    assert seen == {i for i in range(200) if x[i] and y[i]}
    assert all(L._long_edits(a, b) == d for a, b, d in zip(x, y, want))
    close = np.array(want) <= limit
    assert L._pairs_agree(x, y, limit)[close].all()
    share, most = 0.1, pa.array([max(len(a), len(b)) for a, b in zip(x, y)], pa.int32())
    one, two = (next(L._profiled([pa.record_batch([pa.array(range(200)), pa.array(t)], names=["hash", "t"])])) for t in (x, y))
    out = next(L._letters_agree(share)([pa.record_batch(
        [one.column("hash"), two.column("hash"), one.column("letters"), two.column("letters"), most],
        names=["a", "b", "letters_a", "letters_b", "most"])]))
    assert {i for i in range(200) if want[i] <= share * most[i].as_py() + 1e-9} <= set(out.column("a").to_pylist())


def test_packed_bands_meet_again():
    rng = np.random.default_rng(3)
    h = rng.integers(1, 1 << 63, 400).astype(np.uint64)
    h[300:] = h[:100]  # repeated lines
    chars = np.where(np.arange(400) % 7 == 0, 50, 100)
    chars[300:] = chars[:100]
    band = rng.integers(-60, 60, (400, 5)).astype(np.int32)
    band[300:] = band[:100]
    held = [(h[i:j], chars[i:j], np.full(j - i, 5), band[i:j].ravel()) for i, j in ((0, 250), (250, 400))]
    got, sizes = set(), 0
    blobs = [L._packed(held[:1], 3), L._packed(held[1:], 3)]
    for part in range(3):
        own = [x.as_py() for b in blobs for p, x in zip(b.column("part").to_pylist(), b.column("packed")) if p == part]
        sizes += sum(map(len, own))
        if own:
            bucket, a, _, size = L._buckets_of(own, 3)
            got |= set(zip(bucket.to_pylist(), a.to_pylist()))
    assert sizes <= 10 * 5 * 400
    want, mask = set(), (1 << L.NAME_BITS) - 1
    for v in np.unique(band):
        own = {(int(h[i]) & mask, int(chars[i])) for i in np.flatnonzero((band == v).any(1))}
        want |= {(int(v) & 0xFFFFFFFF, a) for a, c in own if sum(c == d for _, d in own) > 1}
    assert got == want


def test_pairs_in_slices(spark, monkeypatch):
    rng = random.Random(9)
    vocab = ["".join(rng.choice("abcdefghi") for _ in range(rng.randint(3, 9))) for _ in range(200)]
    rows = []
    for _ in range(25):
        x = " ".join(rng.choice(vocab) for _ in range(rng.choice([6, 12, 30])))
        rows += [(len(rows), x), (len(rows) + 1, edited(rng, x))]
    tried, plain = [], L.written
    monkeypatch.setattr(L, "_at_once", lambda docs: 900)
    monkeypatch.setattr(L, "written", lambda df, kind: tried.append(kind) or plain(df, kind))
    out, p = L.dedup_lines(frame(spark, rows + rows[:5]), links="grams")
    assert {r.doc_id: r[p + "removed"] for r in out.collect()} == brute(rows)[0]
    assert tried.count("line_links") > 2


def test_encoding_is_written_before_decoding(spark, sf_dir, capsys):
    out = C.encoding(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
    out.explain()
    assert "CoGroups" not in capsys.readouterr().out
