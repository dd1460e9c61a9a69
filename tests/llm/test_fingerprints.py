"""Operator 13 against a plain statement with another library's hash."""

import hashlib
import random
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from synthtext.llm.fingerprints import BINS, BITS, WIDTH, fingerprint, fingerprints, likeness
from synthtext.llm.queries import QUERIES

SEED = 42


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def of_longs(*xs):
    h = SEED
    for x in xs:
        h = xxhash.xxh64_intdigest(struct.pack("<Q", x % (1 << 64)), h)
    return h


def of_ints(*xs):
    """Spark hashes an int as four bytes, a long as eight."""
    h = SEED
    for x, size in xs:
        h = xxhash.xxh64_intdigest(struct.pack("<q" if size == 8 else "<i", x), h)
    return h


def words(text):
    out, word = [], ""
    for c in (text or "").lower():
        if c in " \t\n\x0b\x0c\r":
            out.append(word)
            word = ""
        else:
            word += c
    return [w for w in [*out, word] if w]


def plain_fingerprint(text):
    h = [xxhash.xxh64_intdigest(w.encode(), SEED) for w in words(text)]
    if not h:
        return ""
    hashes = [of_longs(*h[i : i + WIDTH]) for i in range(max(len(h) - WIDTH + 1, 1))]
    bins = {}
    for x in hashes:
        b = x >> (64 - (BINS - 1).bit_length())
        bins[b] = min(bins.get(b, x), x)
    digits = []
    for i in range(BINS):
        source = i
        if i not in bins:  # order: pair hash without its top 8 bits, as a signed number, then the bin
            source = min(bins, key=lambda j: signed((of_ints((i, 4), (j, 4)) << 8) % (1 << 64) | j))
        digits.append(of_ints((signed(bins[source]), 8), (i, 4)) >> (64 - BITS))
    return "".join(f"{d:x}" for d in digits)


def plain_likeness(a, b):
    if not a or not b:
        return float(a == b)
    same = sum(x == y for x, y in zip(a, b)) / BINS
    return max(0.0, (same - 2.0**-BITS) / (1 - 2.0**-BITS))


def plain_rows(rows):
    docs = sorted({(d, t or "") for d, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(
        f"{'-' if r[0] is None else r[0]}:{r[1]}".encode()).hexdigest()))
    out = []
    for k, (d, t) in enumerate(docs):
        nxt = docs[(k + 1) % len(docs)][1]
        q = len(t) // 4
        edited = t[: len(t) - q] + nxt[:q]
        f, e, n = plain_fingerprint(t), plain_fingerprint(edited), plain_fingerprint(nxt)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), f, e, plain_likeness(f, e), plain_likeness(f, n)))
    return out


def check(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:])


def test_by_plain_statement(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)] + ["Été", "\x00", "日本", "🙂"]
    text = lambda n: rng.choice([" ", "\n", "\t \r"]).join(rng.choices(vocab, k=n))
    rows = [(1, None), (2, ""), (2, ""), (3, " \n\t"), (4, "one"), (5, "a b c d"), (6, "a b c d e"), (7, " a b  c\x0bd\x0ce "),
            (None, "x y"), (None, "x y"), (None, "z"), (9, "same id"), (9, "other text"), (10, "long " * 30_000)]
    rows += [(20 + k, text(rng.randint(1, 500))) for k in range(60)]
    df = spark.createDataFrame([(d, t, "k", "f") for d, t in rows], "doc_id bigint, text string, key string, fingerprint string")
    check(fingerprints(df.repartition(3)).collect(), plain_rows(rows))


def test_few_documents(spark):
    schema = "doc_id bigint, text string"
    assert fingerprints(spark.createDataFrame([], schema)).collect() == []
    one = fingerprints(spark.createDataFrame([(5, "a b c d e f g h")], schema)).collect()
    check(one, plain_rows([(5, "a b c d e f g h")]))
    assert one[0].near_next == 1.0


def test_estimate(spark):
    """The estimate is unbiased: pairs of known similarity, long and short."""
    rng = random.Random(11)
    rows = []
    for j in (0.0, 0.25, 0.5, 0.75, 1.0):
        for size in (8, 40, 1500):
            for _ in range(30):
                both = round(size * j)
                sets = [[f"b{rng.random()}" for _ in range(both)]]
                sets += [[f"o{rng.random()}" for _ in range((size - both) // 2)] for _ in range(2)]
                # shingles as words of one shingle each would need a width of one: compare hashes directly
                rows.append((j, size, sets[0] + sets[1], sets[0] + sets[2]))
    from synthtext.llm.fingerprints import _digits, _least

    def packed(name):
        return F.lower(_digits(_least(F.sort_array(F.transform(name, lambda x: F.xxhash64(x))))))

    df = spark.createDataFrame(rows, "j double, size int, a array<string>, b array<string>")
    got = df.select("j", "size", packed("a").alias("a"), packed("b").alias("b")).groupBy("j", "size").agg(
        F.avg(likeness(F.col("a"), F.col("b"))).alias("mean")).collect()
    for r in got:
        n = round(r["size"] * r.j)
        true = n / (n + 2 * ((r["size"] - n) // 2))
        assert abs(r["mean"] - true) < (0.09 if r["size"] == 8 else 0.04), r


def test_equal_texts(spark):
    df = spark.createDataFrame([("A b C d e f",), ("a  B\tc D e\nF ",), ("",), (None,)], "t string")
    a, b, c, d = [r[0] for r in df.select(fingerprint(F.col("t"))).collect()]
    assert a == b and len(a) == BINS * BITS // 4 and c == d == ""


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(QUERIES["op13_fingerprints"](spark, sf_dir).collect(), plain_rows(rows))
