"""Operator 8: benchmark decontamination by Wu-Manber multi-pattern search.

The patterns are the 13-word windows of the benchmark items (an item of fewer
words is one window of its own length). Texts are scanned as word hashes, a
block being ``BLOCK`` consecutive words: the shift table, indexed by a hash of
the block, says how far the scan may jump (11 words past a block that no
window holds); where it says 0, the bucket of the block's hash selects the
windows ending in it, and comparing the words' bytes confirms an occurrence.
All windows of one scan have the same length, so short items do not shorten
the jumps of the others.

The search is one row-local Arrow stage without a shuffle. The windows go to
the tasks in parts of at most ``PART_WORDS`` benchmark words (more for a single
longer item), so what the driver builds and broadcasts at once has a bound; a larger
benchmark takes more passes, written to the shared folder in between. Parts are ranges
of ``BUCKETS`` hash buckets of the items, filled by the counts of their words.

Defined results: a null or wordless text has no words and no hits; a wordless
item has no window; a null item_id counts as the string "null"; rows of one
item_id are one item. Repeated rows are judged alike; other columns pass
through untouched under any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from . import words as W
from .tables import written

WIDTH = 13
BLOCK = 3
PART_WORDS = 500_000
BUCKETS = 1 << 16
_BITS = 20
#: word bytes: 0-9, a-z (A-Z folded) and all bytes of non-ASCII characters
SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
_TABLE = W.byte_table(SEPARATORS)
_COEF = W.constants(BLOCK, 21)


def _blocks(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of the block that ends at each word (0 where none does)."""
    out = np.zeros(len(h), np.uint64)
    if len(h) >= size:
        out[size - 1 :] = W.sequence_hash(h, size, _COEF)
    return out


def _scan(data, offsets):
    """Folded bytes and words of texts."""
    low = data + np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)
    return low.tobytes(), W.find_words(data, offsets, _TABLE)


class Matcher:
    """Shift table and suffix buckets of the windows of one length."""

    def __init__(self, length: int, windows: dict[tuple[bytes, ...], list[str]]):
        self.length, self.size = length, min(BLOCK, length)
        self.shift = np.full(1 << _BITS, length - self.size + 1, np.int64)
        self.buckets: dict[int, list] = {}
        for words, items in windows.items():
            raw = b" ".join(words)
            h = _blocks(W.find_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), _TABLE).hash,
                        self.size)
            for end in range(self.size - 1, length):
                slot = int(h[end]) >> (64 - _BITS)
                self.shift[slot] = min(self.shift[slot], length - 1 - end)
            self.buckets.setdefault(int(h[-1]), []).append((words, items))
        self.shift = self.shift.astype(np.uint8) if length < 256 else self.shift

    def find(self, low: bytes, w: W.Words, blocks: np.ndarray):
        """Yield (row, first word, items) of every occurrence."""
        jump = self.shift[(blocks >> np.uint64(64 - _BITS)).astype(np.int64)].tolist()
        start, end, last = w.start, w.end, self.length - 1
        for row in range(len(w.bounds) - 1):
            at, stop = int(w.bounds[row]) + last, int(w.bounds[row + 1])
            while at < stop:
                if jump[at]:
                    at += jump[at]
                    continue
                for words, items in self.buckets.get(int(blocks[at]), ()):
                    first = at - last
                    if all(low[start[first + k] : end[first + k]] == x for k, x in enumerate(words)):
                        yield row, first, items
                at += 1


def item_windows(items: list[tuple[str, str]]) -> list[Matcher]:
    """The matchers of (item_id, text) pairs, one for each window length."""
    by: dict[int, dict[tuple[bytes, ...], list[str]]] = {}
    for item, text in items:
        low, w = _scan(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
        ws = [low[a:b] for a, b in zip(w.start, w.end)]
        length = min(WIDTH, len(ws))
        for i in range(len(ws) - length + 1 if ws else 0):
            ids = by.setdefault(length, {}).setdefault(tuple(ws[i : i + length]), [])
            if item not in ids:
                ids.append(item)
    return [Matcher(n, x) for n, x in sorted(by.items())]


def _searcher(shared, text: str, keep: list[str], spans: str, items: str, words: str, first: bool,
              schema: pa.Schema):
    def run(batches):
        matchers = shared.value
        for batch in batches:
            data, offs = W.text_buffers(batch.column(text))
            rows = batch.num_rows
            n_words = np.zeros(rows, np.int64)
            old_s = [[]] * rows if first else batch.column(spans).to_pylist()
            old_i = [[]] * rows if first else batch.column(items).to_pylist()
            found_s, found_i = [list(map(tuple, x)) for x in old_s], [set(x) for x in old_i]
            for i, j in W.runs(offs):
                low, w = _scan(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                n_words[i:j] = np.diff(w.bounds)
                blocks = {m.size: None for m in matchers}
                for m in matchers:
                    if blocks[m.size] is None:
                        blocks[m.size] = _blocks(w.hash, m.size)
                    for r, a, ids in m.find(low, w, blocks[m.size]):
                        a -= int(w.bounds[r])
                        found_s[i + r].append((a, a + m.length))
                        found_i[i + r].update(ids)
            cols = [batch.column(c) for c in keep]
            cols += [pa.array(n_words),
                     pa.array([[list(x) for x in merged(s)] for s in found_s], pa.list_(pa.list_(pa.int64()))),
                     pa.array([sorted(x) for x in found_i], pa.list_(pa.string()))]
            yield pa.record_batch(cols, names=[*keep, words, spans, items])

    return run


def merged(spans):
    """Sorted, disjoint spans covering the same words."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def part_starts(counts, part_words: int) -> list[int]:
    """First buckets of the parts: each of at most ``part_words`` words or one bucket."""
    starts, held = [0], 0
    for bucket, n in sorted(counts):
        if held and held + n > part_words:
            starts.append(bucket)
            held = 0
        held += n
    return starts


def find_benchmark(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                   keep: list[str] | None = None, part_words: int = PART_WORDS) -> tuple[DataFrame, str]:
    """``docs`` (columns ``keep``, all by default) with, under a prefix that no
    column has: ``n_words``, ``spans`` (merged [first, end) word ranges of the
    occurrences) and ``items`` (sorted ids of the items found). Returns the
    frame and the prefix.
    """
    spark = docs.sparkSession
    ship_package(spark)
    keep = docs.columns if keep is None else keep
    prefix = "__"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    names = {k: prefix + k for k in ("n_words", "spans", "items")}
    bench = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                             F.coalesce("text", F.lit("")).alias("text"))
    bench = bench.distinct().withColumn("bucket", F.pmod(F.xxhash64("item", "text"), F.lit(BUCKETS)))
    n = F.regexp_count("text", F.lit(r"[0-9A-Za-z\x{80}-\x{10ffff}]+"))
    starts = part_starts(bench.groupBy("bucket").agg(F.sum(n).alias("n")).collect(), part_words)
    parts = len(starts)
    out = docs
    for part, (low, high) in enumerate(zip(starts, [*starts[1:], BUCKETS])):
        rows = bench.filter((F.col("bucket") >= low) & (F.col("bucket") < high)).collect()
        shared = spark.sparkContext.broadcast(item_windows([(r.item, r.text) for r in rows]))
        end = part == parts - 1
        held = keep if end else docs.columns
        schema = T.StructType([docs.schema[c] for c in held]
                              + [T.StructField(names["n_words"], T.LongType()),
                                 T.StructField(names["spans"], T.ArrayType(T.ArrayType(T.LongType()))),
                                 T.StructField(names["items"], T.ArrayType(T.StringType()))])
        if not part:
            out = out.select(*{*held, text})
        out = out.mapInArrow(_searcher(shared, text, held, names["spans"], names["items"],
                                       names["n_words"], part == 0, None), schema)
        out = out if end else written(out, "benchmark_pass")
    return out, prefix


def covered(spans: str):
    """Number of words in merged spans."""
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda s, x: s + x[1] - x[0])
