"""Operator 12: spelling variants grouped through permuterm rotations.

Two words are near if exactly one code point is inserted, deleted or replaced. Each word
is marked with a terminator and all its rotations are sorted. In the rotation that
ends in code point c, everything before c is the rest of the word around the edited
place: words that differ only there share that prefix, so a replacement is a
prefix range of rotations that skip their last code point, and an insertion or
deletion is the whole rotation that equals the prefix. A rotation therefore enters
the sorted table twice, whole and without its last code point.

A group of equal prefixes fixes the place of the edit, so it holds at most one whole
rotation and one shortened rotation a code point of the alphabet: groups are bounded by
the alphabet, whatever the corpus. The scan gives each member its number of near
words in the group and the best of them (the group's best, or its second for the best
itself), so no pairs are written. A pair that differs in place of a run of equal code points
(book, bok) would meet once a position; only the run's first position counts.

Forms and roots: a word's form is its most frequent near word, if that is at least
``RATIO`` times as frequent. Frequencies grow along forms, so chains have no cycle and
at most log2(highest frequency) steps; roots take them by pointer doubling.

Defined results: null text has no words, a null id counts as the text ``null``, repeated
rows count each time. Columns other than id and text are not read. Very long texts are
scanned in pieces cut between words. Words of more than ``LONG`` code points enter by digests
of their rotations' two parts and by their rank in code-point order, so their cost grows
with their length and not with its square.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.batching import with_ordinal
from ..session import ship_package
from .tables import written

WORD = "[A-Za-zÀ-ÿ]+"
MARK = "$"  # no letter, so no word holds it
RATIO = 2
LONG = 64
#: parts of long rotations are told apart by their value as a number of this base, modulo a prime
_PRIME, _BASE = (1 << 127) - 1, 0x5DEECE66D1F3C9A7B4E2D8061
#: characters scanned at once, and distinct words that a task holds before it hands them on
_PIECE = 1 << 20
_HELD = 200_000


def _pieces(text: str, letters: re.Pattern):
    """``text`` in pieces of about ``_PIECE`` characters, cut after a word."""
    at = 0
    while len(text) - at > 2 * _PIECE:
        end = at + _PIECE
        m = letters.match(text, end)
        end = m.end() if m else end
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop: int = 0,
                min_chars: int = 0, min_count: int = 1) -> DataFrame:
    """``word, n`` of all words of ``docs``, A-Z lower-cased. With ``drop`` a word of which
    it divides the crc32 of ``<id>:<word>`` loses one code point, the one at that
    number modulo its length: a misspelling planted by rule."""
    ship_package(docs.sparkSession)

    def run(batches):
        letters = re.compile(WORD)
        out: Counter[str] = Counter()

        def table():
            words = [w for w in out if len(w) >= min_chars]
            got = pa.record_batch([pa.array(words, pa.string()), pa.array([out[w] for w in words], pa.int64())],
                                  names=["word", "n"])
            out.clear()
            return got

        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = raw.as_py()
                if not text:
                    continue
                head = f"{'null' if doc is None else doc}:".encode()
                for piece in _pieces(text, letters):
                    own = Counter(letters.findall(piece.encode().lower().decode()))  # bytes: A-Z only
                    for w, n in own.items():
                        if drop:
                            h = zlib.crc32(head + w.encode())
                            if h % drop == 0:
                                k = h % len(w)
                                w = w[:k] + w[k + 1:]
                        out[w] += n
                if len(out) > _HELD:
                    yield table()
        if out:
            yield table()

    rows = docs.select(id_col, text_col).mapInArrow(run, "word string, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """``prefix, word, n, whole, counts`` of all rotations of ``words(word, n)``: each whole,
    and without its last code point unless that is the terminator, as far as they have
    at most ``LONG`` code points. ``counts`` is false for a shortened one at a repeated
    code point but the first."""
    size, i = F.char_length("word"), F.col("i")
    words = words.filter(size <= LONG)
    every = words.select("word", "n", F.explode(F.sequence(F.lit(0), size)).alias("i"))
    # rotation i starts after i code points: word[i:] + MARK + word[:i]
    turned = every.select("word", "n", "i", F.concat(F.substring(F.col("word"), i + 1, size), F.lit(MARK),
                                                     F.left("word", i)).alias("turn"))
    here, left = F.substring(F.col("word"), i, F.lit(1)), F.substring(F.col("word"), i - 1, F.lit(1))
    forms = F.array(
        F.when(size < LONG, F.struct(F.col("turn").alias("prefix"), F.lit(True).alias("whole"), F.lit(True).alias("counts"))),
        F.when(i > 0, F.struct(F.left("turn", F.char_length("turn") - 1).alias("prefix"), F.lit(False).alias("whole"),
                               ((i == 1) | (here != left)).alias("counts"))))
    return turned.select("word", "n", F.explode(F.array_compact(forms)).alias("f")).select(
        "f.prefix", "word", "n", "f.whole", "f.counts")


def _long_turns(limit: int):
    """The rows of ``rotations`` beyond ``limit`` code points; ``prefix`` is a digest."""
    names = ["prefix", "word", "n", "whole", "counts"]

    def table(rows):
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (
            pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.bool_()))], names=names)

    def run(batches):
        for batch in batches:
            for word, rank, n in zip(batch.column("word"), batch.column("rank").to_pylist(), batch.column("n").to_pylist()):
                w = word.as_py()
                size = len(w)
                before, power = [0], [1]
                for c in w:
                    before.append((before[-1] * _BASE + ord(c)) % _PRIME)
                    power.append(power[-1] * _BASE % _PRIME)
                after = [(before[-1] - before[i] * power[size - i]) % _PRIME for i in range(size + 1)]
                rows = []
                for i in range(size + 1):
                    rows.append((f"{size + 1}:{i}:{before[i]:x}:{after[i]:x}", rank, n, True, True))
                    if i and size > limit:
                        rows.append((f"{size}:{i - 1}:{before[i - 1]:x}:{after[i]:x}", rank, n, False,
                                     i == 1 or w[i - 1] != w[i - 2]))
                    if len(rows) > 20_000:
                        yield table(rows)
                        rows = []
                if rows:
                    yield table(rows)

    return run


def _scan_long(words: DataFrame) -> DataFrame:
    """``scan`` for the prefixes of more than ``LONG`` code points: a word is its rank
    in code-point order, written so that ranks sort as texts."""
    ranked = written(with_ordinal(words.filter(F.char_length("word") >= LONG), ["word"], "rank").select(
        "word", "n", F.lpad(F.col("rank").cast("string"), 19, "0").alias("rank")), "variant_long_words")
    found = scan(ranked.mapInArrow(
        _long_turns(LONG), "prefix string, word string, n bigint, whole boolean, counts boolean"))
    own, other = ranked.select(F.col("rank").alias("word"), F.col("word").alias("w")), ranked.select(
        F.col("rank").alias("b"), F.col("word").alias("bw"))
    return found.join(own, "word").withColumn("b", F.col("best.word")).join(other, "b").select(
        F.col("w").alias("word"), "n_near", F.struct(F.col("best.m").alias("m"), F.col("bw").alias("word")).alias("best"))


def scan(turns: DataFrame) -> DataFrame:
    """``word, n_near, best`` once for each group that a word has near words in; ``best``
    is (-n, word), least for the most frequent, then for the smallest word."""
    group = Window.partitionBy("prefix")
    me = F.struct((-F.col("n")).alias("m"), F.col("word").alias("word"))
    cut, first = ~F.col("whole"), F.col("counts")
    g = turns.select(
        "word", "n", "whole", "counts", "prefix", me.alias("me"),
        F.count(F.lit(1)).over(group).alias("size"), F.count_if(cut).over(group).alias("cuts"),
        F.count_if(cut & first).over(group).alias("firsts"),
        F.min(F.when(cut, me)).over(group).alias("top"), F.min(F.when(cut & first, me)).over(group).alias("first_top"),
        F.min(F.when(F.col("whole"), me)).over(group).alias("short")).filter("size > 1")
    g = g.withColumn("second", F.min(F.when(cut & (F.col("me") != F.col("top")), F.col("me"))).over(group))
    # a shortened rotation: the other shortened ones, and the whole one at a first position;
    # the whole one: the shortened ones at first positions
    replaced = F.when(F.col("me") == F.col("top"), F.col("second")).otherwise(F.col("top"))
    n_near = F.when(F.col("whole"), F.col("firsts")).otherwise(
        F.col("cuts") - 1 + (first & F.col("short").isNotNull()).cast("bigint"))
    best = F.when(F.col("whole"), F.col("first_top")).otherwise(
        F.least(replaced, F.when(first, F.col("short"))))
    return g.select("word", n_near.alias("n_near"), best.alias("best")).filter("n_near > 0")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, n, n_near, form, form_n`` of each of ``words(word, n)``, which must be distinct."""
    found = scan(rotations(words))
    if not words.filter(F.char_length("word") >= LONG).isEmpty():
        ship_package(words.sparkSession)
        found = found.unionByName(_scan_long(words))
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    form = (-F.col("best.m")) >= ratio * F.col("n")
    return words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(form, F.col("best.word")).alias("form"), F.when(form, -F.col("best.m")).alias("form_n"))


def roots(found: DataFrame) -> DataFrame:
    """``found(word, form, ..)`` with ``root``, the last word along the forms."""
    link = written(found.filter("form is not null").select("word", F.col("form").alias("root")), "variant_links")
    while True:
        up = link.select(F.col("word").alias("root"), F.col("root").alias("up"))
        link = written(link.join(up, "root", "left").select(
            "word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")), "variant_links")
        if link.filter("moved").isEmpty():
            break
        link = link.drop("moved")
    return found.join(link.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of distinct ``words(word, n)``."""
    return roots(written(variants(written(words, "variant_words"), ratio), "variant_forms"))
