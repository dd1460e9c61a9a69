"""Operator 7: near duplicates by circulant MinHash.

A document is the set of its distinct five-word shingles (64-bit hashes).
Two permutations make the whole signature: ``sigma`` scatters a shingle over
the 32-bit ring once, and coordinate ``k`` is the minimum of ``pi`` at the
place shifted circularly by ``k``. Bands of the signature give buckets; pairs
of a bucket are confirmed by the exact Jaccard index of the full sets.

Rows: any number, any skew. Equal sets are one class before anything is
compared. In a bucket classes are compared with the class of most copies (a star,
not all pairs): each class first with one such pivot, then, by the components of
the links so far, with those pivots that are in other components, and last, what
is not in its pivot's component with those members of such buckets that share one
of its rarest shingles (prefix filtering, which loses no pair). So no link between
candidates is lost and no group emits all its pairs. Before texts
are fetched for the exact check, the last bits of 192 coordinates are compared: a
pair at 0.75 agrees in 168 of them on average (deviation 4.6) and is let through
from 136, seven deviations below, so it costs no link (2e-11) and documents that
merely share a passage (0.3 agrees in 125) are not fetched.

Defined results: a null or wordless text has an empty set (0 shingles) and is
linked with nothing; fewer than five words are one shingle; a row without
doc_id takes a hash of its text as its id; rows that share a doc_id are one
document. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from . import words as W
from .tables import connected_components, written

WIDTH = 5
BANDS = 40
ROWS = 5
#: 192 one-bit coordinates; at the threshold 168 agree on average, 4.6 the deviation
SKETCH = 192
AGREE = 136
#: white space: U+0020 and U+0009 to U+000D
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_COEF = W.constants(WIDTH, 11)
_SHORT = W.constants(WIDTH, 12)


_TABLE = W.byte_table(SPACE)


def shingle_sets(col):
    """Per text of an Arrow column: sorted distinct shingle hashes (uint64)."""
    data, offs = W.text_buffers(col)
    for i, j in W.runs(offs):
        w = W.find_words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], _TABLE)
        h = w.hash
        s = W.sequence_hash(h, WIDTH, _COEF)
        b = w.bounds
        for r in range(j - i):
            lo, hi = b[r], b[r + 1]
            if hi - lo >= WIDTH:
                yield np.unique(s[lo : hi - WIDTH + 1])
            elif hi > lo:
                with np.errstate(over="ignore"):
                    x = (h[lo:hi] * _SHORT[: hi - lo]).sum(dtype=np.uint64) + np.uint64(hi - lo)
                yield W.mix64(np.array([x], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def _pi(x: np.ndarray) -> np.ndarray:
    """The second permutation, of 32-bit numbers (bijective mixer)."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """Circulant MinHash of non-empty sets: ``len(sets) x size`` uint32."""
    cut = np.concatenate([[0], np.cumsum([len(s) for s in sets])])[:-1]
    place = (W.mix64(np.concatenate(sets)) >> np.uint64(32)).astype(np.uint32)  # sigma
    out = np.empty((len(sets), size), np.uint32)
    for k in range(size):
        out[:, k] = np.minimum.reduceat(_pi(place - np.uint32(k)), cut)
    return out


def _signer(bands: int, rows: int):
    coef = W.constants(rows, 13)
    tag = W.constants(bands, 14)
    schema = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("fp", pa.int64()),
                        ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])

    def flush(part):
        sets = [s for _, s in part]
        full = [k for k, s in enumerate(sets) if len(s)]
        keys = np.zeros((len(sets), bands), np.int64)
        fp = np.zeros(len(sets), np.uint64)
        sketch = np.zeros((len(sets), SKETCH // 64), np.int64)
        if full:
            sig = signatures([sets[k] for k in full], max(bands * rows, SKETCH)).astype(np.uint64)
            sketch[full] = np.packbits((sig[:, :SKETCH] & np.uint64(1)).astype(np.uint8), axis=1).view(np.int64)
            with np.errstate(over="ignore"):
                for b in range(bands):
                    s = tag[b] + (sig[:, b * rows : (b + 1) * rows] * coef).sum(1, dtype=np.uint64)
                    keys[full, b] = W.signed(W.mix64(s))
                for k in full:  # one number for the whole set
                    fp[k] = W.mix64(sets[k] + tag[0]).sum(dtype=np.uint64)
        n = np.array([len(s) for s in sets], np.int64)
        lists = [pa.ListArray.from_arrays(
            np.concatenate([[0], np.cumsum(np.where(n > 0, x.shape[1], 0))]).astype(np.int32),
            x[n > 0].ravel()) for x in (keys, sketch)]
        return pa.record_batch([pa.array([k for k, _ in part], pa.int64()), pa.array(n),
                                pa.array(W.signed(fp)), *lists], schema=schema)

    def run(batches):
        for batch in batches:
            part, held = [], 0
            for key, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1)), strict=True):
                part.append((key, s))
                held += len(s)
                if held > 40_000 or len(part) >= 4096:
                    yield flush(part)
                    part, held = [], 0
            if part:
                yield flush(part)

    return run


def _confirm(num: int, den: int):
    def run(batches):
        for batch in batches:
            keep = []
            for r, (a, b) in enumerate(zip(shingle_sets(batch.column("text_a")),
                                           shingle_sets(batch.column("text_b")), strict=True)):
                both = len(np.intersect1d(a, b, assume_unique=True))
                if len(a) and den * both >= num * (len(a) + len(b) - both):
                    keep.append(r)
            yield pa.record_batch([batch.column("a").take(pa.array(keep, pa.int64())),
                                   batch.column("b").take(pa.array(keep, pa.int64()))],
                                  names=["a", "b"])

    return run


def row_key() -> Column:
    """doc_id, or a hash of the text where it is null."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64("text"))


def near_duplicates(docs: DataFrame, percent: int = 75, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """``key, n_shingles, component_id`` for each row of ``docs(doc_id, text)``:
    the components of all pairs with ``100 * |A & B| >= percent * |A | B|``.

    With 40 bands of 5 rows a pair at exactly 0.75 is missed as a candidate
    with probability 2e-5, one at 0.8 with 1e-7.
    """
    ship_package(docs.sparkSession)
    texts = docs.select(row_key().alias("key"), "text")
    signed = written(texts.mapInArrow(_signer(bands, rows),
                                      "key bigint, n bigint, fp bigint, bands array<bigint>, "
                                      "sketch array<bigint>"),
                     "near_dup_signatures")
    full = signed.filter("n > 0")
    classes = written(full.groupBy("fp", "n").agg(F.min("key").alias("node"), F.min("sketch").alias("sketch"),
                                                    F.count("*").alias("copies")),
                      "near_dup_classes")
    # one row of each class carries the bands
    ends = (full.drop("sketch").join(classes.select("fp", "n", "copies", F.col("node").alias("key")),
                                      ["fp", "n", "key"])
            .select(F.col("key").alias("node"), "n", "copies", F.explode(F.array_distinct("bands")).alias("bucket")))
    # the bucket's class with most copies; map-side combined, buckets of one class end here
    pivots = (ends.groupBy("bucket").agg(F.max(F.struct("copies", "node", "n")).alias("p"), F.count("*").alias("size"))
              .filter("size > 1").select("bucket", F.col("p.node").alias("b"), F.col("p.n").alias("nb"), "size"))
    near = written(ends.join(pivots, "bucket").filter("node <> b")
                   .select("bucket", F.col("node").alias("a"), F.col("n").alias("na"), "b", "nb", "size"),
                   "near_dup_buckets")
    fits = f"100 * least(na, nb) >= {percent} * greatest(na, nb)"
    sketches = classes.select("node", "sketch")
    alike = sum((F.bit_count(F.col("sa")[k].bitwiseXOR(F.col("sb")[k])) for k in range(SKETCH // 64)),
                F.lit(0)) <= SKETCH - AGREE

    def linked(pairs):
        known = (pairs.join(sketches.toDF("a", "sa"), "a").join(sketches.toDF("b", "sb"), "b").filter(alike)
                 .select("a", "b"))
        return written(_linked(known, texts, percent), "near_dup_links")

    def component(x, y):
        return comps.select(F.col("node").alias(x), F.col("component").alias(y))

    # 1. each class with one pivot, that of its largest bucket
    stars = near.filter(fits).select("a", "b", "size")
    links = linked(stars.groupBy("a").agg(F.max_by("b", F.struct("size", "b")).alias("b")))
    comps = connected_components(links, "near_dup_components")
    # 2. with the pivots of its other buckets, where they are in other components
    apart = (stars.select("a", "b").distinct().join(component("a", "ca"), "a", "left")
             .join(component("b", "cb"), "b", "left").filter("coalesce(ca, a) <> coalesce(cb, b)").select("a", "b"))
    links = links.union(linked(apart))
    comps = connected_components(links, "near_dup_components")
    # 3. in buckets of three and more, what is not in the pivot's component with the rest
    members = (near.filter("size > 2").join(component("a", "c"), "a", "left").join(component("b", "cb"), "b", "left")
               .select("bucket", "a", F.coalesce("c", "a").alias("c"), F.coalesce("cb", "b").alias("cb")))
    open_buckets = members.filter("c <> cb").select("bucket").distinct()
    loose = written(members.join(open_buckets, "bucket").groupBy("a").agg(
        F.min("c").alias("c"), F.bool_or(F.expr("c <> cb")).alias("apart")), "near_dup_loose")
    cross = (_rare_pairs(loose, texts, percent).join(sketches.toDF("a", "sa"), "a").join(sketches.toDF("b", "sb"), "b")
             .filter(alike).select("a", "b"))
    comps = connected_components(links.union(written(_linked(cross, texts, percent), "near_dup_links")),
                                 "near_dup_components")

    label = (classes.join(comps, "node", "left")
             .select("fp", "n", F.coalesce("component", "node").alias("component")))
    return (signed.select("key", "n", "fp").join(label, ["fp", "n"], "left")
            .select("key", F.col("n").alias("n_shingles"),
                    F.coalesce("component", "key").alias("component_id")))


def _tokens(batches):
    """Every text's shingles, with their number and one number for the whole set."""
    for batch in batches:
        for node, c, apart, s in zip(batch.column("a").to_pylist(), batch.column("c").to_pylist(),
                                     batch.column("apart").to_pylist(), shingle_sets(batch.column("text")), strict=True):
            own = pa.scalar([node, c, len(s), int(W.signed(W.mix64(s)).sum())], pa.list_(pa.int64()))
            yield pa.record_batch([*[pa.repeat(x, 1) for x in own], pa.array([apart]),
                                   pa.ListArray.from_arrays(pa.array([0, len(s)], pa.int32()), pa.array(W.signed(s)))],
                                  names=["a", "c", "n", "own", "apart", "tokens"])


def _rare_pairs(loose: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of ``loose(a, c, apart)`` that can reach the threshold: of
    different components, one of them apart. Prefix filtering: with shingles
    in one order, the rarest first, two sets with ``o`` shingles in common share one
    among the first ``n - o + 1`` of each, so members that agree only in what the
    whole group holds do not meet. A shingle of one set alone needs no row: it
    only moves the others back."""
    sets = (loose.join(texts.withColumnRenamed("key", "a"), "a").select("a", "c", "apart", "text")
            .mapInArrow(_tokens, "a bigint, c bigint, n bigint, own bigint, apart boolean, tokens array<bigint>"))
    each = written(sets.select("a", "c", "apart", "n", "own", F.explode("tokens").alias("token")), "near_dup_tokens")
    often = each.groupBy("token").agg(F.count("*").alias("often")).filter("often > 1")
    shared = (each.join(often, "token").groupBy("a", "c", "apart", "n", "own")
              .agg(F.sort_array(F.collect_list(F.struct("often", "token"))).alias("ts")))
    first = f"n - ({percent} * n + 99) div 100 + 1 - (n - size(ts))"
    heads = written(shared.select("a", "c", "apart", "n", F.expr("n - size(ts)").alias("alone"),
                                  F.posexplode(F.expr(f"slice(ts, 1, cast(greatest({first}, 0) as int))")).alias("at", "t"))
                    .select("a", "c", "apart", "n", (F.col("alone") + F.col("at")).alias("at"), F.col("t.token").alias("token")),
                    "near_dup_heads")
    other = heads.toDF("b", "c2", "apart2", "nb", "bt", "token")
    common = f"({percent} * (n + nb) + {99 + percent}) div {100 + percent}"
    return (heads.filter("apart").join(other, "token").filter("c <> c2 and (not apart2 or a < b)")
            .filter(f"100 * least(n, nb) >= {percent} * greatest(n, nb)")
            .filter(f"at <= n - {common} and bt <= nb - {common}")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _linked(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    a = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_confirm(percent, 100), "a bigint, b bigint")
