"""Operator 1: SentencePiece encoding and decoding over a relational lattice.

Encoding. Spaces become U+2581, one is put before the text, and the text is cut
into chunks (U+2581 with the word after it; ASCII characters that occur in no
longer piece stand alone): no piece crosses a cut, so chunks are encoded
independently and each distinct chunk once. Its lattice is relational: all
substrings of 2 to the longest piece's characters are exploded, joined by
equality to the piece table (as large as the model's vocabulary, broadcast),
grouped by chunk, and folded with Spark's ``aggregate``:

* ``unigram`` tables: the Viterbi recursion, best sum of scores at each position;
* ``bpe`` tables: scores are merge ranks, whose sum means nothing (Viterbi on it
  gives other ids than the model's), so the fold takes the lattice's edges best
  score first, then leftmost (each edge one number, the ends of
  a chunk the bits of another, or a text in chunks of more than 61 characters); an edge is used if both its ends are still piece
  ends and exactly one other lies between them. As every piece of such a table
  is built from pieces of better score, one pass gives the model's merges. Runs
  of U+2581, whose pieces share one score, are spelled by their length.

Getting the segmentations back to the texts without moving a row a word: texts are packed in
blocks of about ``BLOCK`` bytes (compressed Arrow); a block asks for its distinct
chunks, one row a block and bucket of chunks; the answers, piece lengths in the
order asked, return to the block, where ids are looked up and written out. A
block is bounded whatever the input. A bucket's distinct chunks are too, but each
block that has one of them sends it an ask, so the asks of a bucket with a chunk
that every block holds grow with the number of blocks.

Defined results: a null or empty text has no ids; characters outside the table
become the bytes of their UTF-8 form (or ``unk`` where the model has no
bytes); U+2581 in a text decodes to a space, all else exactly; null ids decode to null.
A chunk of very many characters without a space costs (edges x characters).
Other columns pass through; the added one's name must be free.
"""

from __future__ import annotations

import hashlib
import re
import string
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from . import words as W
from .tables import small_batches

SPACE = "▁"
BLOCK = 4 << 20


@dataclass
class Pieces:
    """A piece table: normal pieces with id and score, byte ids, the unknown id."""

    kind: str
    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int] | None
    unknown: int
    raw: list[bytes]  # what each id decodes to

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.ids), default=1)

    def chunk_pattern(self) -> str:
        """Chunks of a word with U+2581 before it; ASCII characters of no longer
        piece stand alone."""
        inside = {c for p in self.ids if len(p) > 1 for c in p}
        lone = re.escape("".join(chr(c) for c in range(128) if chr(c) not in inside))
        return f"{SPACE}+[^{SPACE}{lone}]*|[^{SPACE}{lone}]+|[{lone}]"

    @cached_property
    def index(self) -> tuple[pa.Array, np.ndarray]:
        """The pieces, and their ids."""
        return pa.array(list(self.ids), pa.string()), np.fromiter(self.ids.values(), np.int32, len(self.ids))

    @cached_property
    def run_sizes(self) -> set[int]:
        return {len(p) for p in self.ids if not p.strip(SPACE)}

    def run_lengths(self, k: int) -> list[int]:
        """Pieces of a run of ``k`` U+2581 in a BPE table: their scores are equal,
        so the leftmost pair that makes a piece is merged again and again, and
        a piece of the greatest length is done."""
        sizes = self.run_sizes
        top = max(sizes, default=1)
        out = [1] * (k % top)
        while True:
            at = next((i for i in range(len(out) - 1) if out[i] + out[i + 1] in sizes), None)
            if at is None:
                return [top] * (k // top) + out
            out[at : at + 2] = [out[at] + out[at + 1]]

    def spell_run(self, k: int) -> list[int]:
        return [i for n in self.run_lengths(k) for i in self.spell(SPACE * n)]

    def spell(self, piece: str) -> list[int]:
        """Ids of a piece of a segmentation."""
        i = self.ids.get(piece)
        if i is not None:
            return [i]
        if self.byte_ids is None:
            return [self.unknown]
        return [self.byte_ids[b] for b in piece.encode()]


def load_pieces(path: str | None = None) -> Pieces:
    """Read a model's table (default: the public 32k BPE model installed here).

    Only tables that the operator treats exactly are taken: identity
    normalisation, a space in front, no piece with U+2581 after another
    character, and for BPE every piece reachable from better-scored ones.
    """
    from sentencepiece import sentencepiece_model_pb2 as proto

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    m = proto.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    n = m.normalizer_spec
    if n.precompiled_charsmap or n.remove_extra_whitespaces or not n.add_dummy_prefix:
        raise ValueError("only identity normalisation with a space in front is supported")
    normal = [(i, p) for i, p in enumerate(m.pieces) if p.type == 1]
    byte = {int(p.piece[3:5], 16): i for i, p in enumerate(m.pieces) if p.type == 6}
    out = Pieces(
        {1: "unigram", 2: "bpe"}[m.trainer_spec.model_type],
        {p.piece: i for i, p in normal}, {p.piece: p.score for _, p in normal},
        [byte[b] for b in range(256)] if len(byte) == 256 else None,
        next(i for i, p in enumerate(m.pieces) if p.type == 2),
        [p.piece.replace(SPACE, " ").encode() if p.type == 1 else bytes([int(p.piece[3:5], 16)]) if p.type == 6
         else " ⁇ ".encode() if p.type == 2 else b"" for p in m.pieces])
    if any(SPACE in p.lstrip(SPACE) for p in out.ids):
        raise ValueError("a piece crosses words")
    if out.longest > 64:
        raise ValueError("pieces of more than 64 characters are not supported")
    if not set(string.ascii_letters) <= {c for p in out.ids if len(p) > 1 for c in p}:
        raise ValueError("a letter is in no longer piece")
    if out.kind == "bpe":
        runs = {p: s for p, s in out.scores.items() if set(p) == {SPACE}}
        rest = {p: s for p, s in out.scores.items() if p not in runs}
        if len(set(runs.values())) > 1 or runs and max(runs.values()) >= min(rest.values()):
            raise ValueError("runs of U+2581 must score alike and below all other pieces")
        out.scores = rest  # runs are spelled apart
        odd = [p for p in rest if len(p) > 1 and merge(p, rest, out.longest) != [p]]
        if odd:
            raise ValueError(f"{len(odd)} pieces cannot be reached in score order, such as {odd[0]!r}")
    return out


def merge(chunk: str, scores: dict[str, float], longest: int) -> list[str]:
    """The fold in plain Python, one chunk (checks the table, tests the fold)."""
    n = len(chunk)
    edges = sorted((-scores[chunk[i:j]], i, j) for i in range(n) for j in range(i + 2, min(n, i + longest) + 1)
                   if chunk[i:j] in scores)
    ends = set(range(n + 1))
    for _, i, j in edges:
        if i in ends and j in ends:
            inner = [k for k in range(i + 1, j) if k in ends]
            if len(inner) == 1:
                ends.remove(inner[0])
    cut = sorted(ends)
    return [chunk[a:b] for a, b in zip(cut, cut[1:])]


def lattice(chunks: DataFrame, pieces: DataFrame, longest: int, keys: list[str], edge: Column | None = None) -> DataFrame:
    """``chunks(keys.., chunk)`` with ``edges``: (order, start, end, score) of every
    piece of two or more characters in the chunk, or ``edge`` over ``score``, ``start`` and
    ``len``. Chunks without one are left out."""
    sub = (chunks.withColumn("size", F.char_length("chunk")).filter("size > 1")
           .select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("start"))
           .select("*", F.explode(F.sequence(F.lit(2), F.least(F.lit(longest), F.col("size") - F.col("start") + 1)))
                   .alias("len"))
           # never null, which spares a test that would cut every substring twice
           .select(*keys, "chunk", "start", "len",
                   F.coalesce(F.substring(F.col("chunk"), F.col("start"), F.col("len")), F.lit("")).alias("piece")))
    if edge is None:
        edge = F.struct((-F.col("score")).alias("order"), F.col("start"), (F.col("start") + F.col("len")).alias("end"))
    return (sub.join(F.broadcast(pieces), "piece").groupBy(*keys, "chunk")
            .agg(F.collect_list(edge).alias("edges")))


#: chunks of up to this many characters have their ends in the bits of one number
BITS = 61


def packed_edge() -> Column:
    """An edge of a BPE lattice as one number, in the order of (rank, start, length);
    ``score`` is the rank of the piece's score here, the best being 0."""
    return F.shiftleft(F.col("score").cast("bigint"), 40) + F.shiftleft(F.col("start").cast("bigint"), 8) + F.col("len")


def bpe_fold(edges: Column, size: Column) -> Column:
    """Piece ends as a string of 0 and 1 (position k: k characters before it) of packed edges."""
    left = lambda a, n: F.call_function("shiftleft", a, n)
    number = lambda n: F.lit(n).cast("bigint")
    start = lambda e: F.shiftright(e, 8).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    length = lambda e: e.bitwiseAND(number(255)).cast("int")

    def bits(ends, e):
        at, n = start(e) - 1, length(e)  # a lambda evaluates each mention anew, so each mask is mentioned once
        own, outer = left(left(number(2), n) - 1, at), left(left(number(1), n) + 1, at)
        use = (F.bit_count(ends.bitwiseAND(own)) == 3) & (F.bit_count(ends.bitwiseAND(outer)) == 2)
        return F.when(use, ends.bitwiseAND(F.bitwise_not(left(left(number(1), n) - 2, at)))).otherwise(ends)

    def text(ends, e):
        n = length(e)
        own = F.substring(ends, start(e), n + 1)
        use = (F.length(F.replace(own, F.lit("0"), F.lit(""))) == 3) & own.startswith("1") & own.endswith("1")
        return F.when(use, F.overlay(ends, F.concat(F.lit("1"), F.repeat(F.lit("0"), n - 1), F.lit("1")), start(e))
                      ).otherwise(ends)

    best = F.sort_array(edges)
    short = F.aggregate(best, left(number(2), size) - 1, bits)
    return F.when(size <= BITS, F.reverse(F.bin(short))).otherwise(
        F.aggregate(best, F.repeat(F.lit("1"), size + 1), text))


def viterbi_fold(edges: Column, size: Column, chunk: Column, single: Column, unknown: float) -> Column:
    """The same string for the best sum of scores. ``single``: a map of the
    scores of single characters; others cost ``unknown``."""
    alone = F.transform(F.sequence(F.lit(1), size), lambda i: F.struct(
        (-F.coalesce(F.element_at(single, F.substring(chunk, i, F.lit(1))), F.lit(float(unknown)))).alias("order"),
        i.alias("start"), (i + 1).alias("end")))
    every = F.concat(F.coalesce(edges, F.slice(alone, 1, 0)), alone)
    start = F.array(F.struct(F.lit(0.0).alias("cost"), F.lit(0).alias("back")))

    def step(best, i):  # best[k]: least cost of the first k characters, and where its last piece starts
        here = F.filter(every, lambda e: e["end"] == i + 1)
        return F.concat(best, F.array(F.array_min(F.transform(here, lambda e: F.struct(
            (F.element_at(best, e["start"])["cost"] + e["order"]).alias("cost"), (e["start"] - 1).alias("back"))))))

    best = F.aggregate(F.sequence(F.lit(1), size), start, step)
    walk = F.aggregate(
        F.sequence(F.lit(1), size), F.struct(best.alias("best"), size.alias("at"), F.repeat(F.lit("0"), size + 1).alias("ends")),
        lambda s, _: F.struct(
            s["best"].alias("best"), F.when(s["at"] > 0, F.element_at(s["best"], s["at"] + 1)["back"]).otherwise(0).alias("at"),
            F.overlay(s["ends"], F.lit("1"), s["at"] + 1).alias("ends")))
    return F.overlay(walk["ends"], F.lit("1"), 1)


def lengths(ends: Column) -> Column:
    """Piece lengths of a string of ends, each as one character from '0' on
    (a run of zeros between ones): '1001' -> '3'."""
    runs = F.slice(F.split(ends, "1"), 2, 1 << 30)
    runs = F.slice(runs, 1, F.size(runs) - 1)
    return F.array_join(F.transform(runs, lambda r: F.char(F.length(r) + F.lit(49))), "")


def segmentations(chunks: DataFrame, table: Pieces, keys: list[str]) -> DataFrame:
    """``keys.., chunk, cut`` (piece lengths) of distinct ``chunks(keys.., chunk)``
    that hold a piece of two or more characters."""
    spark = chunks.sparkSession
    bpe = table.kind == "bpe"
    rank = {s: i for i, s in enumerate(sorted(set(table.scores.values()), reverse=True))}
    pieces = spark.createDataFrame(
        [(p, float(rank[s] if bpe else s)) for p, s in table.scores.items() if len(p) > 1] or [("", 0.0)],
        "piece string, score double")
    found = lattice(chunks, pieces, table.longest, keys, packed_edge() if bpe else None).withColumn(
        "size", F.char_length("chunk"))
    if bpe:
        ends = bpe_fold(F.col("edges"), F.col("size"))
    else:
        single = [x for p, s in table.scores.items() if len(p) == 1 for x in (F.lit(p), F.lit(float(s)))]
        ends = viterbi_fold(F.col("edges"), F.col("size"), F.col("chunk"),
                            F.create_map(*single) if single else F.create_map().cast("map<string,double>"),
                            min(table.scores.values()) - 10)
    return found.select(*keys, "chunk", lengths(ends).alias("cut"))


# -- texts -> blocks -> chunks -> blocks

def _spaced(text: str) -> list[str]:
    """The words of a text in a unigram table: spaces beyond one are part of the word after them."""
    out, run = [], ""
    for w in text.replace(SPACE, " ").split(" ") if text else []:
        if w:
            out.append(run + w)
            run = ""
        else:
            run += SPACE
    return [*out, run[1:]] if run else out


def _words(col, kind: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of some texts, the place among them of each text's words, and how
    many each text has. Words stand between spaces (U+2581 counts as one). In BPE
    tables spaces beyond the first are empty words, spelled as a run."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.string())
    col = pc.fill_null(col.cast(pa.string()), "")
    if kind == "bpe":
        lists = pc.split_pattern(pc.replace_substring(col, SPACE, " "), " ")
        size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        some = pc.binary_length(col).to_numpy(zero_copy_only=False) > 0
        flat = lists.flatten().filter(pa.array(np.repeat(some, size)))
        size = np.where(some, size, 0)
    else:
        lists = [_spaced(t) for t in col.to_pylist()]
        flat = pa.array(list(chain.from_iterable(lists)), pa.string())
        size = np.fromiter(map(len, lists), np.int64, len(lists))
    code = flat.dictionary_encode()
    return code.dictionary, code.indices.to_numpy(zero_copy_only=False).astype(np.int64), size


def _joined(strings: pa.Array, ends: np.ndarray, by: str) -> pa.Array:
    """One string for the strings between each two of ``ends``."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), strings), by)


def _chunks(words: pa.Array, kind: str, pattern: re.Pattern) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct chunks of distinct words, the place among them of each word's chunks, and
    how many each word has (an empty word of a BPE table has none)."""
    if kind == "bpe":  # no word holds U+2581, so all are cut at once
        own = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
        text = _joined(words.filter(pa.array(own)), np.array([0, own.sum()]), SPACE)[0].as_py()
        found = pattern.findall(SPACE + text) if text else []
        every = pa.array(found, pa.string())
        heads = np.flatnonzero(pc.starts_with(every, SPACE).to_numpy(zero_copy_only=False))
        size = np.zeros(len(own), np.int64)
        size[own] = np.diff(np.append(heads, len(found)))
    else:
        parts = [pattern.findall(SPACE + w) for w in words.to_pylist()]
        every = pa.array(list(chain.from_iterable(parts)), pa.string())
        size = np.fromiter(map(len, parts), np.int64, len(parts))
    code = every.dictionary_encode()
    return code.dictionary, code.indices.to_numpy(zero_copy_only=False).astype(np.int64), size


_POWER = W.constants(1, 61)[0]


def _dealt(chunks: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the chunks of two or more characters, by bucket and then by their first
    bytes; the buckets, and where each begins and the last ends. A chunk's bucket follows
    from the chunk, the order from the order of ``chunks``."""
    data, offs = W.text_buffers(chunks)
    long = np.flatnonzero(pc.utf8_length(chunks).to_numpy(zero_copy_only=False) > 1)
    if not len(long):
        return long, long, np.zeros(1, np.int64)
    size = np.diff(offs)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(int(size.max()), _POWER), dtype=np.uint64)
        at = np.arange(len(data)) - np.repeat(offs[:-1], size)
        h = W.mix64(np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * power[at], offs[:-1]))
    bucket = (h % np.uint64(buckets)).astype(np.int64)
    first = np.zeros(len(size), np.uint64)
    for j in range(8):
        byte = np.where(j < size, data[np.minimum(offs[:-1] + j, len(data) - 1)], 0).astype(np.uint64)
        first |= byte << np.uint64(56 - 8 * j)
    order = long[np.lexsort((first[long], bucket[long]))]
    own = bucket[order]
    heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    return order, own[heads], np.append(heads, len(order))


def _pack():
    """Rows of about BLOCK bytes as one compressed block, named by its content."""
    def block(part):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part[0].schema, options=pa.ipc.IpcWriteOptions(
                compression=pa.Codec("zstd", 3))) as w:
            w.write_table(pa.Table.from_batches(part).combine_chunks())
        raw = sink.getvalue().to_pybytes()
        name = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "big", signed=True)
        return pa.record_batch([pa.array([name]), pa.array([raw], pa.binary())], names=["block", "rows"])

    def run(batches):
        part, held = [], 0
        for batch in batches:
            i, ends = 0, W.text_buffers(batch.column("text"))[1][1:]
            while i < batch.num_rows:
                base = ends[i - 1] if i else 0
                j = max(i + 1, int(np.searchsorted(ends, base + BLOCK - held, "right")))
                part.append(batch.slice(i, j - i))
                held += int(ends[j - 1] - base)
                i = j
                if held >= BLOCK or i < batch.num_rows:
                    yield block(part)
                    part, held = [], 0
        if part:
            yield block(part)

    return run


def _rows(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(raw).read_all()


def _ask(kind: str, pattern: str, buckets: int):
    """(bucket, asks): the block's name, then its chunks of that bucket."""
    p = re.compile(pattern)

    def run(batches):
        for batch in batches:
            for name, raw in zip(batch.column("block").to_pylist(), batch.column("rows")):
                chunks = _chunks(_words(_rows(raw.as_py())["text"], kind)[0], kind, p)[0]
                order, own, ends = _dealt(chunks, buckets)
                asked = _joined(chunks.take(pa.array(order)), ends, " ")
                yield pa.record_batch([pa.array(own, pa.int64()), pc.binary_join_element_wise(str(name), asked, " ")],
                                      names=["bucket", "asks"])

    return run


def _answer(key, asks: pa.Table, known: pa.Table) -> pa.Table:
    """The cuts of each ask's chunks, in its order ('' where a chunk has no piece
    of two characters)."""
    cut = dict(zip(known["chunk"].to_pylist(), known["cut"].to_pylist()))
    blocks, cuts = [], []
    for ask in asks["asks"].to_pylist():
        name, *chunks = ask.split(" ")
        blocks.append(int(name))
        cuts.append(" ".join([cut.get(c, "") for c in chunks]))
    return pa.table([pa.array(blocks, pa.int64()), pa.array([key[0].as_py()] * len(blocks), pa.int64()),
                     pa.array(cuts, pa.string())], names=["block", "bucket", "cuts"])


def _expand(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, .. of size[0] places, then those of first[1], .."""
    end = np.cumsum(size)
    return np.repeat(first - (end - size), size) + np.arange(int(size.sum()))


def _stops(size: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])


def _cut(chunks: pa.Array, order: np.ndarray, cuts: str) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all chunks, and how many each has. ``cuts``: those of the chunks in
    ``order``; chunks without one are cut into characters."""
    raw = np.frombuffer(cuts.encode(), np.uint8)
    given = np.diff(np.concatenate([[-1], np.flatnonzero(raw == 32), [len(raw)]])) - 1 if len(order) else order
    if len(given) != len(order):
        raise ValueError(f"{len(given)} cuts for {len(order)} chunks")
    count = pc.utf8_length(chunks).to_numpy(zero_copy_only=False).astype(np.int64)
    some = given > 0
    count[order[some]] = given[some]
    size = np.ones(int(count.sum()), np.int64)
    size[_expand(_stops(count)[order[some]], given[some])] = raw[raw != 32].astype(np.int64) - 48
    data, _ = W.text_buffers(chunks)
    starts = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    offs = starts[_stops(size)].astype(np.int32)
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(data))), count


def _ids(pieces: pa.Array, table: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of pieces, and how many each has (more than one: bytes)."""
    known, own = table.index
    at = pc.index_in(pieces, value_set=known)
    size = np.ones(len(pieces), np.int64)
    if not at.null_count:
        return own[at.to_numpy(zero_copy_only=False)], size
    bare = at.is_null().to_numpy(zero_copy_only=False)
    code = pieces.filter(pa.array(bare)).dictionary_encode()
    spelled = [table.spell(p) for p in code.dictionary.to_pylist()]
    which = code.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n = np.fromiter(map(len, spelled), np.int64, len(spelled))
    size[bare] = n[which]
    out, first = np.empty(int(size.sum()), np.int32), _stops(size)[:-1]
    out[first[~bare]] = own[at.drop_null().to_numpy(zero_copy_only=False)]
    every = np.fromiter(chain.from_iterable(spelled), np.int32)
    out[_expand(first[bare], n[which])] = every[_expand((_stops(n)[:-1])[which], n[which])]
    return out, size


def _with_runs(words: list[str], own: list[list[int]], table: Pieces) -> list[int]:
    """Ids of a text in a BPE table: runs of spaces join the words beside them."""
    space = table.spell(SPACE)
    out, run = [], 0
    for w, ids in zip(words, own):
        if not w:
            run += 1
            continue
        if run:
            if ids[: len(space)] == space:  # the word left its own U+2581 to the run
                run, ids = run + 1, ids[len(space):]
            out += table.spell_run(run)
            run = 0
        out += ids
    return out + table.spell_run(run) if run else out


def _spelled(col, table: Pieces, pattern: re.Pattern, buckets: int, cuts: dict[int, str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a block, and where each text's end. Pieces, chunks and words are
    spelled once and put together with numpy."""
    words, at, n = _words(col, table.kind)
    chunks, of, n_chunks = _chunks(words, table.kind, pattern)
    order, own, _ = _dealt(chunks, buckets)
    pieces, n_pieces = _cut(chunks, order, " ".join([cuts[b] for b in own.tolist()]))
    flat, size = _ids(pieces, table)
    stop = _stops(size)[_stops(n_pieces)]  # of chunks
    size = np.diff(stop)[of]
    flat, stop = flat[_expand(stop[of], size)], _stops(size)[_stops(n_chunks)]  # of words
    first, size = stop[:-1], np.diff(stop)
    empty = pc.index(words, "").as_py() if table.kind == "bpe" else -1
    if empty >= 0:
        w, odd, parts = words.to_pylist(), [], []
        for a, b in zip(_stops(n), np.cumsum(n)):
            mine = at[a:b]
            if empty in mine:
                odd.append(_with_runs([w[i] for i in mine], [flat[stop[i] : stop[i + 1]].tolist() for i in mine], table))
                mine = np.array([len(first) + len(odd) - 1])
            parts.append(mine)
        more = np.fromiter(map(len, odd), np.int64, len(odd))
        first, size = np.concatenate([first, stop[-1] + _stops(more)[:-1]]), np.concatenate([size, more])
        flat = np.concatenate([flat, np.fromiter(chain.from_iterable(odd), np.int32)])
        at, n = np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
    return flat[_expand(first[at], size[at])], _stops(size[at])[_stops(n)]


def _spell(shared, buckets: int, keep: list[str], out: str):
    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        table: Pieces = shared.value
        p = re.compile(table.chunk_pattern())
        cuts = dict(zip(answers["bucket"].to_pylist(), answers["cuts"].to_pylist()))
        done = []
        for raw in blocks["rows"]:
            rows = _rows(raw.as_py())
            flat, ends = _spelled(rows["text"], table, p, buckets, cuts)
            done.append(rows.select(keep).append_column(
                out, pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))))
        return pa.concat_tables(done)

    return run


def encode(docs: DataFrame, table: Pieces, out: str = "ids") -> DataFrame:
    """``docs`` with the ids of its column ``text`` in a new column ``out``."""
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    keep = docs.columns
    if out in keep:
        raise ValueError(f"there is a column {out!r} already")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // BLOCK))
    shared = spark.sparkContext.broadcast(table)
    # rows of about BLOCK bytes; both exchanges are read twice, so both readers use
    # the same columns; their partition counts are fixed, as few bytes become many rows
    parts = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = docs.mapInArrow(_pack(), "block bigint, rows binary").repartition(parts, "block")
    asks = (blocks.mapInArrow(_ask(table.kind, table.chunk_pattern(), buckets), "bucket bigint, asks string")
            .repartition(parts, "bucket"))
    chunks = asks.select("bucket", F.explode(F.slice(F.split("asks", " "), 2, 1 << 30)).alias("chunk")).distinct()
    known = segmentations(chunks, table, ["bucket"]).withColumnRenamed("bucket", "own")
    answers = (asks.groupBy("bucket").cogroup(known.groupBy("own"))
               .applyInArrow(_answer, "block bigint, bucket bigint, cuts string"))
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _spell(shared, buckets, keep, out), schema)


def decode(rows: DataFrame, table: Pieces, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the text of its ids in ``out``."""
    ship_package(rows.sparkSession)
    small_batches(rows.sparkSession)
    if out in rows.columns:
        raise ValueError(f"there is a column {out!r} already")
    shared = rows.sparkSession.sparkContext.broadcast(table.raw)

    def run(batches):
        raw = shared.value
        size = np.array([len(x) for x in raw])
        first, letters = np.cumsum(size) - size, np.frombuffer(b"".join(raw), np.uint8)
        for batch in batches:
            col = batch.column(ids)
            count = np.nan_to_num(col.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            flat = col.flatten().to_numpy(zero_copy_only=False)
            ends, text = np.concatenate([[0], np.cumsum(count)]), []
            for i, j in W.runs(ends, 1 << 17):
                own = flat[ends[i] : ends[j]]
                n = size[own]
                at = np.cumsum(n) - n
                buf = letters[np.repeat(first[own] - at, n) + np.arange(int(n.sum()))].tobytes()
                cut = np.append(at, len(buf))[ends[i : j + 1] - ends[i]]
                for a, b in zip(cut, cut[1:]):
                    s = buf[a:b].decode("utf-8", "replace")
                    text.append(s[1:] if s.startswith(" ") else s)
            found = pa.array(text, pa.string())
            if col.null_count:
                found = pc.if_else(col.is_null(), pa.scalar(None, pa.string()), found)
            yield batch.append_column(out, found)

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(out, T.StringType())]))


def same_text(text: str = "text", decoded: str = "decoded") -> Column:
    """Whether a text came back (null as empty, U+2581 as a space)."""
    return F.replace(F.coalesce(F.col(text), F.lit("")), F.lit(SPACE), F.lit(" ")) == F.col(decoded)
