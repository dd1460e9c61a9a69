"""Text clean-up as native Column expressions.

All operators are JVM-side: regular expressions, ``split`` and higher-order
array functions, so they stay inside Spark's expression evaluation and never
cross into Python.

Operators that look at the sentence list accept an optional, already
materialised ``sentences`` column. DataFrame-level transforms (see
``synthtext.operators.postprocess``) pass one so the split runs once per row
and stage; the stand-alone Column forms compute it themselves.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the behaviour being matched):
#   * whitespace = Python's str.isspace() set. Java's Unicode \s lacks the four
#     separators U+001C..U+001F, so they are added to the class.
#   * sentence boundary = whitespace run that follows one of . ! ?
#   * a sentence is complete when it ends in . ! or ?
# ---------------------------------------------------------------------------
WS_CLASS = r"[\s\x1c-\x1f]"
WS_RUN = r"(?U)" + WS_CLASS + "+"
SENTENCE_BREAK = r"(?U)(?<=[.!?])" + WS_CLASS + "+"
SENTENCE_END = r"[.!?]\z"
_EDGE_WS = r"(?U)^" + WS_CLASS + "+|" + WS_CLASS + r"+\z"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ustrip(col: Column | str) -> Column:
    """Remove Unicode whitespace at both ends (Python ``str.strip()``)."""
    return F.regexp_replace(_c(col), _EDGE_WS, "")


def clean_whitespace(col: Column | str) -> Column:
    """Every whitespace run becomes one space, then the ends are trimmed.

    After the collapse only U+0020 can sit at the ends, which is exactly what
    ``trim`` removes.
    """
    return F.trim(F.regexp_replace(_c(col), WS_RUN, " "))


def split_sentences(col: Column | str) -> Column:
    """Sentence list; a trailing terminator + whitespace yields a final ''."""
    return F.split(_c(col), SENTENCE_BREAK, -1)


def _kept_sentence_count(sentences: Column, max_length: int) -> Column:
    """Number of leading sentences a greedy fill keeps under ``max_length``.

    Fold over the sentences carrying (joined length, kept count, stopped).
    A sentence fits while ``len + len(s) + 1 <= n``; the first misfit stops
    the fill for good. The joining space is counted once the text is
    non-empty.
    """
    n = F.lit(max_length)

    def step(acc, x):
        fits = (~acc["stop"]) & (acc["l"] + F.length(x) + 1 <= n)
        grown = F.struct(
            (acc["l"] + F.length(x) + F.when(acc["l"] > 0, 1).otherwise(0)).alias("l"),
            (acc["n"] + 1).alias("n"),
            F.lit(False).alias("stop"),
        )
        stopped = F.struct(acc["l"].alias("l"), acc["n"].alias("n"), F.lit(True).alias("stop"))
        return F.when(fits, grown).otherwise(stopped)

    zero = F.struct(F.lit(0).alias("l"), F.lit(0).alias("n"), F.lit(False).alias("stop"))
    return F.aggregate(sentences, zero, step, lambda acc: acc["n"])


def truncate_text(col: Column | str, max_length: int, window: Column | None = None) -> Column:
    """Sentence-aware truncation to ``max_length`` characters.

    Unchanged when short enough. Otherwise the first ``max_length + 100``
    characters are split into sentences and filled greedily; the result is
    stripped and may be empty. ``window`` may pass the precomputed sentence
    list of that prefix.
    """
    text = _c(col)
    sentences = window if window is not None else split_sentences(
        F.substring(text, 1, max_length + 100)
    )
    kept = _kept_sentence_count(sentences, max_length)
    cut = ustrip(F.array_join(F.slice(sentences, 1, kept), " "))
    return F.when(F.length(text) <= max_length, text).otherwise(cut)


def truncation_window(col: Column | str, max_length: int) -> Column:
    """Sentence list of the prefix that X3 inspects."""
    return split_sentences(F.substring(_c(col), 1, max_length + 100))


def remove_incomplete_sentence(col: Column | str, sentences: Column | None = None) -> Column:
    """Drop a last sentence that does not end in . ! ?

    When the last sentence is complete the text comes back unchanged (inner
    spacing kept); otherwise the remaining sentences are joined by one space.
    """
    text = _c(col)
    s = sentences if sentences is not None else split_sentences(text)
    complete = F.element_at(s, -1).rlike(SENTENCE_END)
    return F.when(complete, text).otherwise(F.array_join(F.slice(s, 1, F.size(s) - 1), " "))


# Forms for text that X1 has already cleaned (single U+0020 between words,
# no whitespace at the ends): sentence boundaries are exactly "[.!?] ".
CLEAN_SENTENCE_BREAK = r"(?<=[.!?]) "


def split_clean_sentences(col: Column | str) -> Column:
    """X2 for cleaned text."""
    return F.split(_c(col), CLEAN_SENTENCE_BREAK, -1)


def remove_incomplete_sentence_clean(col: Column | str) -> Column:
    """X4 for cleaned text without building the sentence list.

    On cleaned text, joining all sentences but the last with one space is the
    prefix up to the last boundary, which one greedy regex finds; no boundary
    gives ''.
    """
    text = _c(col)
    return F.when(text.rlike(SENTENCE_END), text).otherwise(F.regexp_extract(text, r"(?s)^(.*[.!?]) ", 1))


def deduplicate_sentences(col: Column | str, sentences: Column | None = None) -> Column:
    """Drop a sentence equal to its immediate predecessor (case-sensitive).

    Pairs each sentence with the previous one (``zip_with`` against the list
    shifted by one) and nulls repeats; ``array_join`` skips the nulls.
    Non-adjacent repeats stay. Always re-joined with single spaces.
    """
    s = sentences if sentences is not None else split_sentences(_c(col))
    prev = F.concat(F.array(F.lit(None).cast("string")), s)
    marked = F.zip_with(
        s, prev, lambda x, p: F.when(p.isNull() | (x != p), x)
    )
    return F.array_join(marked, " ")


def simple_post_process(col: Column | str, max_length: int | None = None) -> Column:
    """Collapse whitespace, then a hard cut at ``max_length`` characters."""
    cleaned = clean_whitespace(col)
    if max_length is None:
        return cleaned
    return F.substring(cleaned, 1, max_length)


def preview(col: Column | str, n: int) -> Column:
    """The first ``n`` characters followed by '...'."""
    return F.concat(F.substring(_c(col), 1, n), F.lit("..."))
