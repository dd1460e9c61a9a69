"""Operator 11: tokens of two tokenizers aligned by divide and conquer at shared cuts.

A text, with a space before it, is encoded by a byte-level BPE (side A) and a SentencePiece
model (side B, which adds that space itself). Each side's tokens end at byte
offsets; where both end, the text can be cut. ``align`` starts with whole texts:
it takes the middle A token of an interval and looks by bisection whether a B token
ends there too; if not, at ends farther and farther from the middle, in rounds of
doubling width. The interval is divided at the first common end, and both
halves go on; an interval without one is a leaf, a group. All intervals of a level are
worked on at once with numpy.

All pairs of an A and a B token of a group are links. How many documents hold an id
pair linked needs all documents, so texts are worked on in blocks of about
``BLOCK`` bytes: a block keeps its documents' rows, packed, and lists its distinct pairs
with their number of documents. Pairs are summed over all blocks, the highest count
of each A id (at most as many rows as A has ids, so broadcast) is set beside them,
and counts return to the blocks that asked, one row a block and pair. A pair that every
block holds is one row in each of them; no group follows the corpus.

Defined results: null and empty texts, and texts that either side does not give back byte
for byte, have no tokens: zeros and the groups ''. Special tokens' strings are
plain text. Repeated rows count each time. Columns to keep are asked for and must not be
named like an added one. A very long text is a block of its own, read whole; links of a
group without a cut are counted by its distinct ids, so memory follows a document's
distinct pairs.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from . import words as W
from .tables import written

BLOCK = 6 << 20
RUN = 1 << 18
#: groups of more pairs are counted by their distinct ids
WIDE = 1 << 12
#: fixed value: the split of the byte-level pre-tokenizer
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ADDED = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def byte_letters() -> dict[str, int]:
    """The printable character of each byte in byte-level vocabularies: the byte's own
    if Latin-1 prints it, else the next one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


@dataclass
class Tokenizers:
    """Both vocabularies as read from their files; the encoders are built in the workers."""

    ranks: dict[bytes, int]
    model: bytes

    @cached_property
    def a(self):
        import tiktoken

        return tiktoken.Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks=self.ranks, special_tokens={})

    @cached_property
    def b(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.model)

    @cached_property
    def bytes_a(self) -> list[bytes]:
        out = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for raw, i in self.ranks.items():
            out[i] = raw
        return out

    @cached_property
    def bytes_b(self) -> list[bytes]:
        b = self.b
        return [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b"" if b.is_control(i)
                else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())]

    def __getstate__(self):
        return {"ranks": self.ranks, "model": self.model}


def load_tokenizers(a: str | None = None, b: str | None = None) -> Tokenizers:
    """Read a byte-level BPE file (tokenizers' JSON) and a SentencePiece model; defaults are the
    public ones installed here. Only tables whose ids follow the order of their
    merges are taken: there a merge's rank is its result's id."""
    if a is None or b is None:
        import public_tokenizers

        a = a or public_tokenizers.path("byte_bpe_50k.json")
        b = b or public_tokenizers.path("piece_bpe_32k.model")
    with open(a, encoding="utf-8") as f:
        j = json.load(f)
    pre, vocab = j["pre_tokenizer"], j["model"]["vocab"]
    if pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre.get("use_regex", True) or j["normalizer"]:
        raise ValueError("only a byte-level table without normalisation is supported")
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in j["model"]["merges"]]
    if merged != sorted(merged):
        raise ValueError("ids do not follow the order of merges")
    letters = byte_letters()
    with open(b, "rb") as f:
        return Tokenizers({bytes(letters[c] for c in piece): i for piece, i in vocab.items()}, f.read())


def align(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First A and B token of each group, in order. ``ends_*``: byte offsets where tokens
    end, rising; ``first_*``: first tokens of the texts (none empty), then the
    number of tokens."""
    lo_a, hi_a, lo_b, hi_b = first_a[:-1], first_a[1:], first_b[:-1], first_b[1:]
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(lo_a):
        # ends of the tokens lo .. hi - 2 are inside, the last one's end closes the interval
        mid = (lo_a + hi_a - 2) // 2
        cut_a = np.full(len(lo_a), -1, np.int64)
        cut_b = np.full(len(lo_a), -1, np.int64)
        seek = np.flatnonzero((hi_a - lo_a > 1) & (hi_b - lo_b > 1))
        found = np.searchsorted(ends_b, ends_a[mid[seek]])
        same = ends_b[found] == ends_a[mid[seek]]
        cut_a[seek[same]], cut_b[seek[same]] = mid[seek[same]], found[same]
        seek = seek[~same]
        near, far = 1, 2  # distances from the middle looked at in this round: near .. far - 1
        seek = seek[(mid[seek] - near >= lo_a[seek]) | (mid[seek] + near <= hi_a[seek] - 2)]
        while len(seek):
            d = np.arange(near, far)
            at = mid[seek, None] + np.stack([-d, d], 1).reshape(-1)[None, :]
            inside = (at >= lo_a[seek, None]) & (at <= hi_a[seek, None] - 2)
            row, col = np.nonzero(inside)
            own = at[row, col]
            found = np.searchsorted(ends_b, ends_a[own])
            same = ends_b[found] == ends_a[own]
            row, own, found = row[same], own[same], found[same]
            hit, first = np.unique(row, return_index=True)  # rows come by distance: the nearest
            cut_a[seek[hit]], cut_b[seek[hit]] = own[first], found[first]
            left = np.ones(len(seek), bool)
            left[hit] = False
            seek = seek[left]
            near, far = far, 2 * far
            seek = seek[(mid[seek] - near >= lo_a[seek]) | (mid[seek] + near <= hi_a[seek] - 2)]
        leaf = cut_a < 0
        done.append((lo_a[leaf], lo_b[leaf]))
        lo_a, hi_a, lo_b, hi_b, cut_a, cut_b = (x[~leaf] for x in (lo_a, hi_a, lo_b, hi_b, cut_a, cut_b))
        lo_a, hi_a = np.concatenate([lo_a, cut_a + 1]), np.concatenate([cut_a + 1, hi_a])
        lo_b, hi_b = np.concatenate([lo_b, cut_b + 1]), np.concatenate([cut_b + 1, hi_b])
    if not done:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(a)
    return a[order], b[order]


def _spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions first[i] .. first[i] + size[i] - 1 of all i, one after another."""
    end = np.cumsum(size)
    return np.repeat(first - (end - size), size) + np.arange(int(end[-1]) if len(end) else 0)


def links(a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(group, pair, times) of all links; a pair is ``a << 32 | b``. ``at_*``: first tokens
    of the groups, then the number of tokens."""
    n_a, n_b = np.diff(at_a), np.diff(at_b)
    wide = n_a * n_b > WIDE
    small = np.flatnonzero(~wide)
    size = n_a[small] * n_b[small]
    group = np.repeat(small, size)
    off = _spans(np.zeros(len(small), np.int64), size)
    i, j = np.divmod(off, n_b[group])
    yield group, a[at_a[group] + i].astype(np.int64) << 32 | b[at_b[group] + j], np.ones(len(group), np.int64)
    for g in np.flatnonzero(wide):
        ua, ca = np.unique(a[at_a[g] : at_a[g + 1]], return_counts=True)
        ub, cb = np.unique(b[at_b[g] : at_b[g + 1]], return_counts=True)
        pair = (ua.astype(np.int64)[:, None] << 32 | ub.astype(np.int64)[None, :]).reshape(-1)
        yield np.full(len(pair), g), pair, (ca[:, None] * cb[None, :]).reshape(-1)


class _Gather:
    """Strings of ids put one after another."""

    def __init__(self, parts: list[bytes]):
        self.size = np.array([len(x) for x in parts], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.letters = np.frombuffer(b"".join(parts), np.uint8)

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        return self.letters[_spans(self.first[ids], self.size[ids])]


class Aligner:
    """Encodes and aligns runs of texts."""

    def __init__(self, both: Tokenizers):
        self.both = both
        self.a, self.b = _Gather(both.bytes_a), _Gather(both.bytes_b)
        top = max(len(both.bytes_a), len(both.bytes_b))
        # an id's digits with what follows it: the next token, the other side, the next group, the end
        self.digits = _Gather([str(i).encode() + end for end in (b",", b"|", b";", b"") for i in range(top)])
        self.top = top

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """Ids and tokens a text, of A and B; none for texts that do not come back."""
        ids_a = [self.both.a.encode_ordinary(" " + t) if t else [] for t in texts]
        n_a = np.array([len(x) for x in ids_a], np.int64)
        a = np.fromiter(chain.from_iterable(ids_a), np.int64, int(n_a.sum()))
        ids_b = self.both.b.encode(texts, num_threads=1)
        n_b = np.array([len(x) for x in ids_b], np.int64)
        b = np.fromiter(chain.from_iterable(ids_b), np.int64, int(n_b.sum()))
        row_a, row_b = np.repeat(np.arange(len(texts)), n_a), np.repeat(np.arange(len(texts)), n_b)
        raw = [b" " + t.encode() if t else b"" for t in texts]
        want = np.array([len(x) for x in raw], np.int64)
        good = want > 0
        for side, ids, row in ((self.a, a, row_a), (self.b, b, row_b)):
            size = np.zeros(len(texts), np.int64)
            np.add.at(size, row, side.size[ids])
            good &= size == want
        keep_a, keep_b = good[row_a], good[row_b]
        a, b, n_a, n_b = a[keep_a], b[keep_b], np.where(good, n_a, 0), np.where(good, n_b, 0)
        text = np.frombuffer(b"".join(x for x, g in zip(raw, good) if g), np.uint8)
        off = [self.a(a) != text, self.b(b) != text]
        if off[0].any() or off[1].any():  # right length, other bytes
            row = np.repeat(np.flatnonzero(good), want[good])
            bad = np.zeros(len(texts), bool)
            bad[row[off[0] | off[1]]] = True
            a, b = a[~np.repeat(bad, n_a)], b[~np.repeat(bad, n_b)]
            n_a, n_b = np.where(bad, 0, n_a), np.where(bad, 0, n_b)
        return a, b, n_a, n_b

    def run(self, texts: list[str], as_text: bool):
        """Per text: n_a, n_b, n_groups, n_links, groups; and (text, pair, times) of the
        links, each pair once a text."""
        a, b, n_a, n_b = self.encoded(texts)
        full = np.flatnonzero(n_a)
        first_a, first_b = (np.concatenate([[0], np.cumsum(n[full])]) for n in (n_a, n_b))
        at_a, at_b = align(np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b]), first_a, first_b)
        n_groups = np.zeros(len(texts), np.int64)
        bound = np.searchsorted(at_a, first_a)
        n_groups[full] = np.diff(bound)
        row = np.repeat(np.arange(len(texts)), n_groups)
        all_a, all_b = np.append(at_a, len(a)), np.append(at_b, len(b))
        per = np.diff(all_a) * np.diff(all_b)
        n_links = np.zeros(len(texts), np.int64)
        np.add.at(n_links, row, per)
        parts = [(row[g], pair, times) for g, pair, times in links(a, b, all_a, all_b)]
        doc, pair, times = (np.concatenate(x) for x in zip(*parts))
        uniq, code = np.unique(pair, return_inverse=True)
        key, inv = np.unique(doc * max(len(uniq), 1) + code, return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, inv, times)
        doc, code = np.divmod(key, max(len(uniq), 1))
        groups = self.rendered(a, b, all_a, all_b, bound, full, len(texts), as_text)
        return n_a, n_b, n_groups, n_links, groups, doc, uniq[code], total

    def rendered(self, a, b, at_a, at_b, bound, full, rows: int, as_text: bool) -> list[str]:
        """``a1,a2|b1;..`` of each text, or its SHA-256."""
        n_a, n_b = np.diff(at_a), np.diff(at_b)
        kind_a, kind_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        kind_a[at_a[1:] - 1] = 1
        kind_b[at_b[1:] - 1] = 2
        kind_b[at_b[bound[1:]] - 1] = 3
        start = at_a[:-1] + at_b[:-1]  # tokens before a group, of both sides
        ids = np.empty(len(a) + len(b), np.int64)
        ids[_spans(start, n_a)] = a + kind_a * self.top
        ids[_spans(start + n_a, n_b)] = b + kind_b * self.top
        out = [""] * rows
        cut = (at_a + at_b)[bound]
        for r, i, j in zip(full.tolist(), cut, cut[1:]):
            raw = self.digits(ids[i:j]).tobytes()
            out[r] = raw.decode() if as_text else hashlib.sha256(raw).hexdigest()
        return out


_BUILT: dict[int, tuple] = {}  # the worker's aligner, one for each broadcast


def _aligner(shared) -> Aligner:
    both = shared.value
    if _BUILT.get(0, (None,))[0] is not both:
        _BUILT[0] = (both, Aligner(both))
    return _BUILT[0][1]


def _blocks(shared, text_at: int, keep: list[str], as_text: bool):
    """Rows ``block, docs, pairs, held`` of each block of about BLOCK bytes."""

    def run(batches):
        work = _aligner(shared)
        where = TaskContext.get().partitionId() << 32
        parts, pairs, held, size = [], [], [], 0

        def block():
            nonlocal where, size
            uniq, code = np.unique(np.concatenate(pairs), return_inverse=True)
            count = np.bincount(code, minlength=len(uniq)).astype(np.int64)
            docs = pa.concat_tables(parts).combine_chunks()
            docs = docs.append_column("codes", pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.concatenate(held))]).astype(np.int32)), pa.array(code.astype(np.int32))))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 1))) as w:
                w.write_table(docs)
            out = pa.record_batch([
                pa.array([where]), pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                pa.array([uniq], pa.list_(pa.int64())), pa.array([count], pa.list_(pa.int64()))],
                names=["block", "docs", "pairs", "held"])
            where += 1
            size = 0
            for x in (parts, pairs, held):
                x.clear()
            return out

        for batch in batches:
            col = batch.column(text_at)
            _, ends = W.text_buffers(col)
            for i, j in W.runs(ends, RUN):
                texts = [x or "" for x in col.slice(i, j - i).to_pylist()]
                n_a, n_b, n_groups, n_links, groups, doc, pair, times = work.run(texts, as_text)
                own = np.bincount(doc, minlength=j - i).astype(np.int64)
                cols = {name: batch.column(k) for k, name in enumerate(keep)}
                bounds = pa.array(np.concatenate([[0], np.cumsum(own)]).astype(np.int32))
                parts.append(pa.table({
                    **{name: c.slice(i, j - i) for name, c in cols.items()},
                    "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups": pa.array(groups, pa.string()),
                    "times": pa.ListArray.from_arrays(bounds, pa.array(times))}))
                pairs.append(pair)
                held.append(own)
                size += int(ends[j] - ends[i])
                if size >= BLOCK:
                    yield block()
        if parts:
            yield block()

    return run


def _finish(keep: list[str]):
    """The documents of a block with their counts."""

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for raw in blocks["docs"]:
            docs = pa.ipc.open_stream(raw.as_py()).read_all().combine_chunks()
            code = docs["codes"].combine_chunks()
            ends = np.concatenate([[0], np.cumsum(code.value_lengths().to_numpy())])
            at = code.flatten().to_numpy()
            times = docs["times"].combine_chunks().flatten().to_numpy()
            n, best = np.zeros(answers.num_rows, np.int64), np.zeros(answers.num_rows, np.int64)
            n[answers["at"].to_numpy()] = answers["n"].to_numpy()
            best[answers["at"].to_numpy()] = answers["best"].to_numpy()
            sums = []
            for x in (best, n):
                run_sum = np.concatenate([[0], np.cumsum(times * x[at])])
                sums.append(pa.array(run_sum[ends[1:]] - run_sum[ends[:-1]]))
            out.append(pa.table([*[docs[c] for c in keep], docs["n_a"], docs["n_b"], docs["n_groups"], docs["n_links"],
                                 *sums, docs["groups"]], names=[*keep, *ADDED]))
        return pa.concat_tables(out)

    return run


def align_documents(docs: DataFrame, both: Tokenizers, keep: list[str], text_col: str = "text",
                    groups: str = "text") -> DataFrame:
    """``keep`` columns with ``ADDED``: tokens of each side, groups, links, links whose pair
    is its A id's most frequent, the sum of the pairs' document counts, and the
    groups as ``a1,a2|b1;..`` (``groups="sha256"``: their digest)."""
    if set(keep) & set(ADDED):
        raise ValueError(f"columns named like an added one: {sorted(set(keep) & set(ADDED))}")
    if groups not in ("text", "sha256"):
        raise ValueError(f"groups: text or sha256, not {groups!r}")
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(both)
    rows = docs.select(*keep, F.col(text_col).alias("__text"))
    blocks = written(rows.mapInArrow(_blocks(shared, len(keep), keep, groups == "text"),
                                     "block bigint, docs binary, pairs array<bigint>, held array<bigint>"), "align_blocks")
    asked = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "held")).alias("at", "p")).select(
        "block", "at", F.col("p.pairs").alias("pair"), F.col("p.held").alias("held"))
    counts = written(asked.groupBy("pair").agg(F.sum("held").alias("n")), "align_pairs")
    a_id = F.shiftright("pair", 32)
    top = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("top"))  # one row an id of A
    scored = counts.withColumn("a", a_id).join(F.broadcast(top), "a").select(
        "pair", "n", (F.col("n") == F.col("top")).cast("bigint").alias("best"))
    answers = asked.select(F.col("block").alias("own"), "at", "pair").join(scored, "pair").select("own", "at", "n", "best")
    schema = T.StructType([*docs.select(*keep).schema.fields,
                           *[T.StructField(c, T.StringType() if c == "groups" else T.LongType()) for c in ADDED]])
    return blocks.select("block", "docs").groupBy("block").cogroup(answers.groupBy("own")).applyInArrow(
        _finish(keep), schema)
