"""Operator 11 against the tokenizers' own ids and sets of common ends."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from synthtext.llm.align import align, align_documents, byte_letters, load_tokenizers
from synthtext.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, `__text` string, block string, pair int"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", "y", 1) for d, t in rows], SCHEMA)


def plain(rows):
    """doc -> the contract's columns; A by the tokenizers library, not by the operator's table."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    letters = byte_letters()
    groups, holds = [], Counter()
    for d, t in rows:
        cut = []
        if t:
            ia, ib = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
            ra = [bytes(letters[c] for c in a.id_to_token(i)) for i in ia]
            rb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
                  for i in ib]
            if b"".join(ra) == b"".join(rb) == (" " + t).encode():
                ea, eb = np.cumsum([*map(len, ra)]).tolist(), np.cumsum([*map(len, rb)]).tolist()
                at_a = at_b = 0
                for e in sorted(set(ea) & set(eb)):
                    i, j = ea.index(e, at_a) + 1, eb.index(e, at_b) + 1
                    cut.append((ia[at_a:i], ib[at_b:j]))
                    at_a, at_b = i, j
        groups.append(cut)
        holds.update({(x, y) for ga, gb in cut for x in ga for y in gb})
    top = defaultdict(int)
    for (x, _), n in holds.items():
        top[x] = max(top[x], n)
    out = []
    for (d, _), cut in zip(rows, groups):
        pairs = [(x, y) for ga, gb in cut for x in ga for y in gb]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in cut)
        out.append((d, sum(len(g[0]) for g in cut), sum(len(g[1]) for g in cut), len(cut), len(pairs),
                    sum(holds[p] == top[p[0]] for p in pairs), sum(holds[p] for p in pairs), text))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r))


def test_intervals_by_sets():
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randint(1, 4)  # texts of a run
        ends_a, ends_b, first_a, first_b, at = [], [], [0], [0], 0
        for _ in range(n):
            size = rng.randint(1, 60)
            for ends, first, p in ((ends_a, first_a, rng.random()), (ends_b, first_b, rng.random())):
                ends += [at + k for k in range(1, size) if rng.random() < p] + [at + size]
                first.append(len(ends))
            at += size
        a, b = align(*(np.array(x, np.int64) for x in (ends_a, ends_b, first_a, first_b)))
        common = sorted(set(ends_a) & set(ends_b))
        assert a.tolist() == [0, *(ends_a.index(e) + 1 for e in common[:-1])]
        assert b.tolist() == [0, *(ends_b.index(e) + 1 for e in common[:-1])]
    none = np.zeros(0, np.int64)
    assert all(len(x) == 0 for x in align(none, none, np.zeros(1, np.int64), np.zeros(1, np.int64)))
    size = 40_000  # no cut inside: one group
    a, b = align(np.arange(2, 2 * size + 1, 2), np.append(np.arange(1, 2 * size, 2), 2 * size), np.array([0, size]),
                 np.array([0, size + 1]))
    assert a.tolist() == b.tolist() == [0]


def test_documents_by_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    words = ["the", "Ünder", "naïve", "x" * 40, "  ", "\n\n", "日本語のテキスト", "🙂🙃", "don't", "1234567", "<|endoftext|>", "</s>",
             "<unk>", "<0x41>", " ", "é", "=====", "\x00", "internationalisation", "Größe"]
    rows = [(0, None), (1, ""), (2, " "), (3, "a▁b"), (4, "▁"), (5, "日本語" * 3000), (6, " " * 5000),
            (None, "the the"), (None, "the the"), (7, "x"), (7, "x"), (8, "".join(rng.choices("abcdef", k=20_000)))]
    rows += [(10 + k, rng.choice(["", " "]).join(rng.choices(words, k=rng.randint(1, 60)))) for k in range(120)]
    want = plain(rows)
    for block in (6 << 20, 300):
        monkeypatch.setattr("synthtext.llm.align.BLOCK", block)
        monkeypatch.setattr("synthtext.llm.align.RUN", block // 3)
        got = align_documents(frame(spark, rows).repartition(3), load_tokenizers(), ["doc_id"])
        assert order(tuple(r) for r in got.collect()) == order(want)
    short = align_documents(frame(spark, rows), load_tokenizers(), ["doc_id", "pair"], groups="sha256").filter("n_a > 0").collect()
    assert {r.groups for r in short} == {hashlib.sha256(w[-1].encode()).hexdigest() for w in want if w[1]}
    assert {r.pair for r in short} == {1}


def test_wide_groups(spark, monkeypatch):
    monkeypatch.setattr("synthtext.llm.align.WIDE", 1)  # every group of several links by its distinct ids
    rows = [(k, "ab" * k + " naïvement" * k + "日本") for k in range(1, 30)]
    got = align_documents(frame(spark, rows), load_tokenizers(), ["doc_id"])
    assert order(tuple(r) for r in got.collect()) == order(plain(rows))


def test_empty_and_clashes(spark):
    assert align_documents(frame(spark, []), load_tokenizers(), ["doc_id"]).collect() == []
    nothing = align_documents(frame(spark, [(1, None), (2, "")]), load_tokenizers(), ["doc_id"]).collect()
    assert [tuple(r)[1:] for r in nothing] == [(0, 0, 0, 0, 0, 0, "")] * 2
    with pytest.raises(ValueError, match="n_a"):
        align_documents(frame(spark, []).withColumn("n_a", F.lit(1)), load_tokenizers(), ["doc_id", "n_a"])


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = [(*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest() if w[1] else "") for w in plain(rows)]
    assert sorted(tuple(r) for r in QUERIES["op11_token_alignment"](spark, sf_dir).collect()) == sorted(want)
