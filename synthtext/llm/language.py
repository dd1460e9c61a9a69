"""Operator 2: language ID with a bit-sliced Bloom filter of n-grams.

One Bloom filter serves all languages: each slot holds a bit mask, bit ``l``
saying that some n-gram of language ``l`` falls there. An n-gram's languages
are the AND of its ``HASHES`` slots, so one lookup answers for every language
at once. A text's votes are the popcounts of those masks by language, with the
expected false positives (fill of the language's bits to the power of the
number of hashes) taken out; the highest corrected share of the n-grams wins.

Fitting reads at most about ``SAMPLE`` labelled texts a language, chosen by a
hash of the id: the one bounded sample of the method. An n-gram belongs to a
language if at least ``LEAST_SHARE`` of its sampled texts (and at least two)
have it. What is broadcast is the filter: 8 bytes a slot for each 64 languages,
whatever the corpus. Prediction is one row-local Arrow stage over whole texts.

Defined results: a null text or one without a letter is ``und`` with score 0;
so is everything when nothing was learned. Ties, also a text of which no n-gram
is known, go to the language with more labelled texts, then by name. Extra
columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from . import words as W

GRAMS = (2, 3, 4, 5)
HASHES = 2
SLOT_BITS = 20
SAMPLE = 2000
LEAST_SHARE = 0.01
UNKNOWN = "und"
_COEF = W.constants(max(GRAMS), 31)

#: ASCII other than letters reads as one space
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[:128][[not chr(b).isalpha() for b in range(128)]] = 32


@dataclass
class Model:
    """Learned languages, the filter's slots by slice, false-positive rates."""

    langs: list[str]
    slots: list[np.ndarray]
    rate: np.ndarray


def _grams(data: np.ndarray, offsets: np.ndarray):
    """Yield (row, hash) arrays of the n-grams of texts, length by length.

    Texts are lower-cased, framed by a space, and n-grams holding two
    spaces in a row are left out.
    """
    rows = len(offsets) - 1
    size = np.diff(offsets)
    o = offsets + 2 * np.arange(rows + 1)  # room for the frame
    buf = np.full(int(o[-1]), 32, np.uint8)
    buf[np.arange(len(data)) + np.repeat(2 * np.arange(rows) + 1, size)] = _BYTES[data]
    row = np.repeat(np.arange(rows), size + 2)
    space = buf == 32
    wide = np.concatenate([[0], np.cumsum(space[1:] & space[:-1])])  # pairs of spaces so far
    value = _VALUE[buf]
    for n in GRAMS:
        m = len(buf) - n + 1
        if m <= 0:
            continue
        with np.errstate(over="ignore"):
            s = value[:m] * _COEF[0]
            for j in range(1, n):
                s = s + value[j : j + m] * _COEF[j]
        ok = (row[:m] == row[n - 1 :]) & (wide[n - 1 :] == wide[:m])
        yield row[:m][ok], W.mix64(s[ok] + np.uint64(n))


_VALUE = W.constants(256, 32)


def _lowered(col):
    """Lower-cased text (null is empty) as bytes and offsets."""
    return W.text_buffers(pc.utf8_lower(pc.fill_null(col, "")))


def _gram_counter(batches):
    """(lang, gram, number of texts that have it), combined within a run and a length, so
    the arrays of one length are held at a time."""
    for batch in batches:
        lang = np.array(batch.column("l").to_pylist(), np.int64)
        data, offs = _lowered(batch.column("t"))
        for i, j in W.runs(offs):
            for r, h in _grams(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]):
                if not len(r):
                    continue
                order = np.lexsort((h, r))
                r, h = r[order], h[order]
                first = np.append(True, (r[1:] != r[:-1]) | (h[1:] != h[:-1]))  # once a text
                ls, h = lang[i:j][r[first]], h[first]
                order = np.lexsort((h, ls))
                ls, h = ls[order], h[order]
                head = np.flatnonzero(np.append(True, (ls[1:] != ls[:-1]) | (h[1:] != h[:-1])))
                n = np.diff(np.append(head, len(h)))
                yield pa.record_batch([pa.array(ls[head]), pa.array(W.signed(h[head])), pa.array(n)],
                                      names=["l", "g", "n"])


def _slots_of(g: np.ndarray, bits: int) -> list[np.ndarray]:
    """The slots of n-gram hashes, one array for each hash function."""
    g = g.astype(np.uint64, copy=False)
    return [((g >> np.uint64(k * (64 // HASHES))) & np.uint64((1 << bits) - 1)).astype(np.int64)
            for k in range(HASHES)]


def fit(labelled: DataFrame, sample: int = SAMPLE, least_share: float = LEAST_SHARE,
        bits: int = SLOT_BITS) -> Model:
    """Learn from ``labelled(doc_id, text, lang)``; rows without either are left out."""
    ship_package(labelled.sparkSession)
    has = labelled.filter("lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in has.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(counts, key=lambda x: (-counts[x], x))
    if not langs:
        return Model([], [], np.zeros(0))
    # a share of each language's rows by a hash of the id: about ``sample`` rows, no shuffle of text
    # (rows of one doc_id, null included, are taken all or none)
    place = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30))
    keep = F.lit(False)
    number = F.lit(None).cast("bigint")
    for k, x in enumerate(langs):
        mine = F.col("lang") == x
        keep = keep | (mine & (place < int(min(1.0, sample / counts[x]) * (1 << 30))))
        number = F.when(mine, k).otherwise(number)
    chosen = has.filter(keep).select(number.cast("bigint").alias("l"), F.col("text").alias("t"))
    grams = (chosen.mapInArrow(_gram_counter, "l bigint, g bigint, n bigint")
             .groupBy("l", "g").agg(F.sum("n").alias("n")))
    size = F.lit(0)
    for k, x in enumerate(langs):
        size = F.when(F.col("l") == k, min(sample, counts[x])).otherwise(size)
    known = grams.filter(F.col("n") >= F.greatest(F.lit(2), F.ceil(size * least_share)))
    slot = F.explode(F.array(*[
        F.shiftrightunsigned("g", k * (64 // HASHES)).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))
        for k in range(HASHES)])).alias("s")
    masks = (known.select((F.col("l") / 64).cast("int").alias("slice"), F.expr("shiftleft(1L, int(l % 64))").alias("m"), slot)
             .groupBy("slice", "s").agg(F.bit_or("m").alias("m")))
    slots = [np.zeros(1 << bits, np.uint64) for _ in range(-(-len(langs) // 64))]
    for r in masks.toLocalIterator():  # at most 2^bits rows a slice
        slots[r["slice"]][r["s"]] = np.uint64(r["m"] & 0xFFFFFFFFFFFFFFFF)
    fill = [float((slots[k // 64] >> np.uint64(k % 64) & np.uint64(1)).mean()) for k in range(len(langs))]
    return Model(langs, slots, np.array(fill) ** HASHES)


def _votes(model: Model, data, offsets) -> tuple[np.ndarray, np.ndarray]:
    """Corrected hits (rows x languages) and numbers of n-grams."""
    rows, size = len(offsets) - 1, len(model.langs)
    hits, total = np.zeros((rows, size)), np.zeros(rows)
    for row, g in _grams(data, offsets):
        if not len(row):
            continue
        at = _slots_of(g, int(np.log2(len(model.slots[0]))))
        total += np.bincount(row, minlength=rows)
        for k in range(size):
            if k % 64 == 0:
                mask = model.slots[k // 64][at[0]]
                for a in at[1:]:
                    mask &= model.slots[k // 64][a]
            bit = (mask >> np.uint64(k % 64)) & np.uint64(1)
            hits[:, k] += np.bincount(row[bit.astype(bool)], minlength=rows)
    return np.maximum(0, (hits - total[:, None] * model.rate) / (1 - np.minimum(model.rate, 0.999999))), total


def _predictor(shared, text: str, keep: list[str], names: tuple[str, str]):
    def run(batches):
        model = shared.value
        for batch in batches:
            col = batch.column(text)
            letter = pc.fill_null(pc.match_substring_regex(pc.fill_null(col, ""), r"\p{L}"), False)
            data, offs = _lowered(col)
            lang = np.full(batch.num_rows, UNKNOWN, object)
            score = np.zeros(batch.num_rows)
            if model.langs:
                for i, j in W.runs(offs):
                    hits, total = _votes(model, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                    best = hits.argmax(1)
                    lang[i:j] = np.array(model.langs, object)[best]
                    score[i:j] = np.minimum(1, hits[np.arange(j - i), best] / np.maximum(total, 1))
                bare = ~letter.to_numpy(zero_copy_only=False)
                lang[bare], score[bare] = UNKNOWN, 0.0
            yield pa.record_batch([batch.column(c) for c in keep]
                                  + [pa.array(lang, pa.string()), pa.array(score)], names=[*keep, *names])

    return run


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None,
            names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` (columns ``keep``, all by default) with predicted language and score,
    which replace columns of the same names."""
    ship_package(docs.sparkSession)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema[c] for c in keep]
                          + [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(
        _predictor(shared, text, keep, names), schema)


def held_out(doc_id: str = "doc_id"):
    """Rows that nothing is learned from: crc32(doc_id as text) mod 4 is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))
