"""The corpus pipeline against a plain version, stage by stage."""

import re
import zlib

import pytest
import sentencepiece

import __spark_entry__ as E
import corpus_pipeline as C
from synthtext.llm import language as L

from . import plain
from .test_lines import brute as line_brute

public_tokenizers = pytest.importorskip("public_tokenizers")


def grams(text):
    """n-grams of a text's bytes as the language model reads them."""
    raw = b" " + bytes(b if b > 127 or chr(b).isalpha() else 32 for b in text.lower().encode()) + b" "
    return [raw[i : i + n] for n in L.GRAMS for i in range(len(raw) - n + 1) if b"  " not in raw[i : i + n]]


def plain_language(rows):
    """Rows with a letter whose best language, by plain sets of n-grams, knows
    enough of them; with the share of the best."""
    train = [r for r in rows if r.lang is not None and r.text is not None
             and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    langs = {r.lang for r in train}
    known = {}
    for x in langs:
        own = [set(grams(r.text)) for r in train if r.lang == x]
        count = {}
        for g in (g for s in own for g in s):
            count[g] = count.get(g, 0) + 1
        known[x] = {g for g, n in count.items() if n >= max(2, -(-len(own) * L.LEAST_SHARE // 1))}
    out = {}
    for r in rows:
        g = grams(r.text or "")
        best = max((sum(x in s for x in g) for s in known.values()), default=0) / max(len(g), 1)
        out[r.doc_id] = any(c.isalpha() for c in r.text or "") and best
    return out


def test_stages_by_brute_force(spark, sf_dir, scratch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = [(9001, None, "en", "s", 0), (9002, "", None, "s", 0), (9003, "12 34 !?", "en", "s", 8),
           (9004, "漢字かな 漢字", None, "s", 7), (9005, "the and of in to with", None, None, None)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema))
    stages = dict(C.STAGES)
    rows = docs.collect()
    share = plain_language(rows)
    got = C.written(stages["language_id"](spark, docs, sf_dir), "t")
    kept = {r.doc_id for r in got.collect()}
    assert got.columns == docs.columns
    for d, x in share.items():  # the filter's false positives move a share by less than this
        assert (d in kept) == (x is not False and x >= C.MIN_LANGUAGE_SCORE) or abs(x - C.MIN_LANGUAGE_SCORE) < 0.02
    assert {9001, 9002, 9003, 9004}.isdisjoint(kept) and 9005 in kept

    rows = got.collect()
    gone, _ = line_brute([(r.doc_id, r.text) for r in rows])
    want = {}
    for r in rows:
        cut = gone[r.doc_id, r.text]
        text = "\n".join(x for i, x in enumerate(r.text.split("\n")) if i not in cut)
        if not cut or re.search(r"[0-9A-Za-z\x80-\U0010ffff]", text):
            want[r.doc_id] = (text, r.lang, r.source, len(text) if cut else r.n_chars)
    got = C.written(stages["line_dedup"](spark, got, sf_dir), "t")
    assert {r.doc_id: (r.text, r.lang, r.source, r.n_chars) for r in got.collect()} == want
    assert len(want) < len(rows)

    rows = got.collect()
    parts = plain.near_duplicates([(r.doc_id, r.text) for r in rows])
    got = C.written(stages["near_dedup"](spark, got, sf_dir), "t")
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(d for d, (_, c) in parts.items() if d == c)

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = got.collect()
    got = C.written(stages["decontamination"](spark, got, sf_dir), "t")
    assert sorted(got.collect(), key=str) == sorted((r for r in rows if not plain.benchmark_hits(r.text, items)[4]), key=str)

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    text = {r.doc_id: r.text for r in got.collect()}
    out = stages["encoding"](spark, got, sf_dir).collect()
    assert {r.doc_id: r.ids for r in out} == {d: sp.encode(t) for d, t in text.items()}
    assert all(r.round_trip and r.n_ids == len(r.ids) for r in out)


def test_run_is_the_stages_in_order(spark, sf_dir):
    assert [n for n, _ in C.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "encoding"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in C.STAGES:
        docs = C.written(stage(spark, docs, sf_dir), "t")
    got = E.queries()["pipeline"](spark, sf_dir)
    assert sorted(got.collect(), key=str) == sorted(docs.collect(), key=str) and got.count() > 100


def test_stages_on_clashing_names_repeats_and_empty_tables(spark, sf_dir):
    rows = [(1, "one two three four five six seven", "en", 1, "m", 1, 2)] * 2 + [(None, "x y z", None, 2, "n", 3, 4)]
    schema = "doc_id bigint, text string, lang string, maybe int, `__key` string, component_id int, ids2 int"
    df = spark.createDataFrame(rows, schema)
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, df, sf_dir)
        assert out.columns == df.columns, name
        n = out.count()
        assert n == (2 if name == "near_dedup" else 3) or name == "language_id", name
        assert stage(spark, df.limit(0), sf_dir).collect() == [], name
    assert C.STAGES[-1][1](spark, df, sf_dir).count() == 3
