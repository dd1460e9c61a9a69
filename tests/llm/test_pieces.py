"""Operator 1 against the SentencePiece library."""

import random

import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from synthtext.llm import pieces as P

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, "  a  b", "\n", "a▁b", " x", "ends ", "漢字かな混じり文", "🙂🙃 emoji", "tab\tx\r\ny", "    indented      code", "▁▁▁",
       "é̂ñ", "a" * 3000, " " * 15, " " * 16, "x" + " " * 33 + "y", " " * 29 + "漢", "a  漢  b", " \n  \n   z", "   ", "\x00\x7f", "<s> </s> <0x0A>"]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, chunk string, cut int")


def test_same_ids_as_the_library(spark, sf_dir):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice(" abtheing.,漢é\n▁0123") for _ in range(rng.randint(1, 80))) for _ in range(300)]
    texts += [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts += texts[-3:]
    table = P.load_pieces()
    df = frame(spark, texts)
    out = P.decode(P.encode(df, table), table).withColumn("same", P.same_text()).collect()
    assert len(out) == len(texts)
    for r in out:
        assert r.ids == sp.encode(texts[r.doc_id] or ""), texts[r.doc_id]
        assert r.same and (r.chunk, r.cut) == ("x", 1)
        assert r.decoded == (texts[r.doc_id] or "").replace("▁", " ")


def test_small_blocks_and_empty_tables(spark, monkeypatch):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    monkeypatch.setattr(P, "BLOCK", 200)
    texts = ["the other day " * (k % 7) + str(k) for k in range(60)] * 2
    table = P.load_pieces()
    got = {r.doc_id: r.ids for r in P.encode(frame(spark, texts).repartition(3), table).collect()}
    assert got == {i: sp.encode(t) for i, t in enumerate(texts)}
    assert P.encode(frame(spark, []), table).collect() == []
    assert P.decode(spark.createDataFrame([(None,)], "ids array<int>"), table).first().decoded is None


def test_unigram_tables_use_viterbi(spark, tmp_path):
    m = proto.ModelProto()
    with open(PATH, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    for p in m.pieces:
        if p.type == 1:
            p.score = -1.0 if len(p.piece) > 4 else -0.5 - 0.1 * (hash_of(p.piece) % 23)
    path = tmp_path / "unigram.model"
    path.write_bytes(m.SerializeToString())
    sp = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    table = P.load_pieces(str(path))
    assert table.kind == "unigram"
    texts = ["the other thing", "reading and writing", "nothing at all", "x y", "Éléphant", "", "inthe thering"]
    out = P.decode(P.encode(frame(spark, texts), table), table).collect()
    for r in out:
        best = sp.encode(r.text)
        score = lambda ids: round(sum(sp.get_score(i) for i in ids if not sp.is_byte(i)), 4)
        assert score(r.ids) == score(best) and r.decoded == r.text  # ties may be cut otherwise


def hash_of(s):
    return sum(ord(c) * 31 ** k for k, c in enumerate(s))


def test_tables_that_would_go_wrong_are_refused(tmp_path):
    m = proto.ModelProto()
    with open(PATH, "rb") as f:
        m.ParseFromString(f.read())
    for change in ("space", "order", "spaces"):
        x = proto.ModelProto()
        x.CopyFrom(m)
        p = next(p for p in x.pieces if p.piece == "▁the")
        if change == "space":
            p.piece = "the▁the"
        elif change == "order":
            p.piece = "qzxqzx"
        else:
            x.normalizer_spec.remove_extra_whitespaces = True
        path = tmp_path / f"{change}.model"
        path.write_bytes(x.SerializeToString())
        with pytest.raises(ValueError):
            P.load_pieces(str(path))
