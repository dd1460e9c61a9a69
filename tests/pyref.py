"""The text rules in plain Python, for randomised tests: stated over the list of
sentence ends rather than sentence by sentence."""

import re
from itertools import accumulate, groupby, takewhile

_GAP = re.compile(r"(?<=[.!?])\s+")


def clean(text):
    return " ".join(text.split())


def truncate(text, limit):
    """The sentences whose running length (a space after each) stays within the
    limit; the first one needs room for its space as well."""
    if len(text) <= limit:
        return text
    parts = _GAP.split(text[: limit + 100])
    totals = accumulate(len(p) + 1 for p in parts)
    fits = list(takewhile(lambda total: total - 1 <= limit, totals))
    count = len(fits) if len(parts[0]) < limit else 0
    return " ".join(parts[:count]).strip()


def complete(text):
    """The text up to its last sentence, unless that one ends as a sentence."""
    *before, last = _GAP.split(text)
    return text if re.search(r"[.!?]$", last) else " ".join(before)


def dedup(text):
    """Of equal neighbours one."""
    return " ".join(sentence for sentence, _ in groupby(_GAP.split(text)))


def post_process(text, limit=None, complete_sentences=False, deduplicate=False):
    """The stages that are switched on, in order."""
    stages = [clean, limit is not None and (lambda t: truncate(t, limit)), complete_sentences and complete,
              deduplicate and dedup]
    for stage in filter(None, stages):
        text = stage(text)
    return text
