"""Operator 13: document fingerprints by one-permutation MinHash, DataFrame functions only.

A text's words (lower-cased, cut at white space) give shingles of ``WIDTH`` words, each
hashed once. The top bits of the hash name one of ``BINS`` bins, and a bin keeps its
least hash: hashes are sorted, so that is the first of each bin's run. An empty
bin takes the value of a filled one by optimal densification: every empty bin has a
random order of its own over all bins (a hash of the pair) and takes the first
filled one of that order, so two texts that share their filled bins also share the
choice. Of each value, mixed with its bin's number, ``BITS`` bits are stored: one hex
digit a bin, 64 bytes a fingerprint. Unequal values agree in those bits once in
``2^BITS``; ``likeness`` corrects the share of equal digits for that.

``with_next`` pairs each document with its successor by ascending id without a window
over all rows: keys alone get dense ordinals; a document's head, only as long as its
predecessor asks, goes to the predecessor, which stays where its key put it.

Defined results: null text is empty; a text without words has the fingerprint ''. Two
such are alike by 1, one of them and another by 0. Texts of fewer than ``WIDTH`` words are
one shingle. Rows of equal id and text are one document and give one row; rows of one
id and several texts are ordered by a digest; null ids come first. One document
alone is its own successor. Only id and text are read; other columns, whatever
their names, are not carried on. Texts are never cut.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.batching import with_ordinal
from .tables import written

WIDTH = 5
BINS = 128
BITS = 4
_SPACES = " \t\n\x0b\x0c\r"
_TOP = 64 - (BINS - 1).bit_length()


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _bin(x: Column) -> Column:
    return F.shiftrightunsigned(x, _TOP).cast("int")


def shingle_hashes(text: Column) -> Column:
    """Hashes of all shingles of a text, sorted; empty for a text without words."""
    plain = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(_SPACES))
    words = F.transform(F.split(plain, r"[\x20\x09-\x0D]+"), lambda w: F.xxhash64(w))
    hashes = _let(words, lambda h: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(h) - (WIDTH - 1), F.lit(1))),
        lambda i: F.xxhash64(F.slice(h, i, F.lit(WIDTH)))))
    return F.when(plain == "", F.array().cast("array<bigint>")).otherwise(F.sort_array(hashes))


def _least(hashes: Column) -> Column:
    """The least hash of each filled bin, of sorted hashes."""
    return _let(hashes, lambda s: F.filter(
        s, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(s, i - 1)))))


def _digits(least: Column) -> Column:
    """One hex digit a bin; empty bins filled from the first filled one of their order."""
    def digit(values, bins, i):
        def order(j):  # the pair's hash above, the bin below: least is the first of the order
            return F.shiftleft(F.xxhash64(i, j), 8).bitwiseOR(j.cast("bigint"))

        source = F.when(F.array_contains(bins, i), i).otherwise(
            F.array_min(F.transform(bins, order)).bitwiseAND(F.lit(255).cast("bigint")).cast("int"))
        value = F.get(values, F.array_position(bins, source).cast("int") - 1)
        return F.hex(F.shiftrightunsigned(F.xxhash64(value, i), 64 - BITS))

    return _let(least, lambda values: _let(F.transform(values, _bin), lambda bins: F.array_join(
        F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: digit(values, bins, i)), "")))


def fingerprint(text: Column) -> Column:
    """The packed fingerprint of a text: ``BINS`` hex digits, or ''."""
    return _let(_least(shingle_hashes(text)), lambda m: F.when(F.size(m) == 0, F.lit("")).otherwise(
        F.lower(_digits(m))))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the texts of two fingerprints, 0 to 1."""
    ones = F.lit(0x1111111111111111)
    other = F.lit(0)
    for at in range(1, BINS, 16):
        x = F.conv(F.substring(a, at, 16), 16, -10).cast("bigint").bitwiseXOR(
            F.conv(F.substring(b, at, 16), 16, -10).cast("bigint"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        other = other + F.bit_count(x.bitwiseAND(ones))
    chance = 2.0 ** -BITS
    share = (F.lit(1.0) - other / F.lit(float(BINS)) - chance) / (1 - chance)
    return F.when((a == "") | (b == ""), (a == b).cast("double")).otherwise(F.greatest(F.lit(0.0), share))


def edited_text(text: Column, n_chars: Column, head: Column) -> Column:
    """The last quarter of a text replaced by ``head``."""
    return F.concat(F.left(text, n_chars - F.floor(n_chars / 4).cast("int")), head)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key, id, text, n_chars, head, next_key`` of each distinct (id, text); ``head`` is
    the start of the next document's text, a quarter of this one's length."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.lit(":"), text))
    rows = docs.select(key.alias("key"), F.col(id_col).alias("id"), text.alias("text"))
    keys = written(rows.select("key", "id", F.char_length("text").alias("n_chars")).distinct(), "fingerprint_keys")
    ranked = written(with_ordinal(keys, ["id", "key"], "at", total_col="total"), "fingerprint_order")
    before = ranked.select(((F.col("at") + 1) % F.col("total")).alias("at"), F.col("key").alias("prev_key"),
                           F.col("id").alias("prev_id"), F.floor(F.col("n_chars") / 4).cast("int").alias("quarter"))
    asked = ranked.select("at", "key").join(before, "at").select("key", "prev_key", "prev_id", "quarter")
    # the texts move once: both branches read the same columns of one exchange by key
    placed = rows.groupBy("key").agg(F.first("text").alias("text"))
    heads = placed.join(asked, "key").select(
        F.col("prev_key").alias("key"), F.col("prev_id").alias("id"), F.col("key").alias("next_key"),
        F.left("text", F.col("quarter")).alias("head"))
    return placed.join(heads, "key").select("key", "id", "text", F.char_length("text").alias("n_chars"), "head", "next_key")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``
    of each document: its text, its text with the last quarter replaced by the next
    document's start, and the likeness to that and to the next document."""
    d = with_next(docs, id_col, text_col).withColumn("edited", edited_text(F.col("text"), F.col("n_chars"), F.col("head")))
    d = written(d.select(
        "key", "next_key", F.col("id").alias(id_col), F.col("n_chars").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("text")).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint")), "fingerprints")
    nxt = d.select(F.col("key").alias("next_key"), F.col("fingerprint").alias("next_fingerprint"))
    return d.join(nxt, "next_key").select(
        id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
