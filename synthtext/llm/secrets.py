"""Operator 4: secret scans.

Base patterns (assignments, access keys, long hex runs) and, added to them,
high-entropy strings: candidates are maximal runs of token characters; for
each character class a window slides over the candidate's runs in that class,
its Shannon entropy kept by incremental counts (one character enters, one
leaves). Overlapping windows at or above the class's threshold form one span.
The parts of a candidate, between separators, that are on the allow-list
(documentation samples, UUIDs, alphabet and digit ladders) are left out and the
pieces between them searched on their own; base spans always stay.

One row-local Arrow stage over whole texts, no shuffle. Runs are found with
numpy on the batch's bytes; regular expressions only see texts that hold one
of their literal words. Defined results: a null text is empty; positions are
code points, end exclusive; repeated rows give the same result; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from itertools import accumulate
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import ship_package
from . import words as W

#: fixed values of the contract
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "entropy")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX, MIN_RUN = 6, 20, 24, 20

#: class: characters, window, least entropy in bits, sets of which each window holds some
_DIGIT, _LOWER, _UPPER = frozenset("0123456789"), frozenset(map(chr, range(97, 123))), frozenset(map(chr, range(65, 91)))
CLASSES = {
    "hex": (_DIGIT | frozenset("abcdefABCDEF"), 20, 3.0, (_DIGIT, frozenset("abcdefABCDEF"))),
    "alnum": (_DIGIT | _LOWER | _UPPER, 20, 3.6, (_DIGIT, _LOWER, _UPPER)),
    "token": (_DIGIT | _LOWER | _UPPER | frozenset("+/_=-"), 24, 3.9, (_DIGIT, _LOWER, _UPPER)),
    "lower": (_DIGIT | _LOWER, 20, 3.6, (_DIGIT, _LOWER)),
    "upper": (_DIGIT | _UPPER, 20, 3.6, (_DIGIT, _UPPER)),
    "letters": (_LOWER | _UPPER, 24, 4.05, (_LOWER, _UPPER)),
    # letters of one case: shorter windows of words run together have the entropy of random ones
    "lower_letters": (_LOWER, 48, 4.1, (_LOWER,)),
    "upper_letters": (_UPPER, 48, 4.1, (_UPPER,)),
}
_RUNS = {k: re.compile(f"[{re.escape(''.join(sorted(chars)))}]{{{width},}}") for k, (chars, width, _, _) in CLASSES.items()}
#: allow-list: strings that look random but are public by convention
ALLOW = (
    re.compile(r"example|sample|placeholder|changeme|your[_-]", re.I),
    re.compile(r"(?<![0-9A-Za-z])[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9A-Za-z])"),
    re.compile(r"0123456789abcdef|abcdefghijklmnop|1234567890", re.I),
)

_TOKEN = np.zeros(256, bool)
_TOKEN[[ord(c) for c in CLASSES["token"][0]]] = True
_HEX = np.zeros(256, bool)
_HEX[[ord(c) for c in "0123456789abcdef"]] = True
_IS_DIGIT, _IS_LOWER, _IS_UPPER = (np.isin(np.arange(256), [ord(c) for c in x]) for x in (_DIGIT, _LOWER, _UPPER))


def class_runs(data: np.ndarray, offsets: np.ndarray, chars: np.ndarray, least: int):
    """Maximal runs of at least ``least`` bytes of a class: (start, end)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = chars[data]
    edge = np.empty(n + 1, bool)
    edge[0], edge[n] = inside[0], inside[-1]
    edge[1:n] = inside[1:] != inside[:-1]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    cut = np.unique(cut)
    joined = cut[inside[cut] & inside[cut - 1]]  # a run must not pass a text's end
    at = np.sort(np.concatenate([np.flatnonzero(edge), joined, joined]))
    start, end = at[0::2], at[1::2]
    keep = end - start >= least
    return start[keep], end[keep]


def entropy_spans(s: str) -> list[tuple[int, int]]:
    """Spans of ``s`` covered by high-entropy windows of any class."""
    spans = []
    for kind, (_, width, least, needs) in CLASSES.items():
        for m in _RUNS[kind].finditer(s):
            spans += [(m.start() + a, m.start() + b) for a, b in window_spans(m.group(), width, least, needs)]
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def window_spans(s: str, width: int, least: float, needs) -> list[tuple[int, int]]:
    """Windows of ``width`` with entropy >= ``least`` that hold a character of
    every set in ``needs``. The sum of c * log2(c) and the sets' counts follow
    each character that enters or leaves."""
    part = [0.0] + [c * log2(c) for c in range(1, width + 2)]  # one more while a character enters
    count: dict[str, int] = {}
    total, has, out = 0.0, [0] * len(needs), []
    for i, c in enumerate(s):
        k = count.get(c, 0)
        total += part[k + 1] - part[k]
        count[c] = k + 1
        for x, group in enumerate(needs):
            has[x] += c in group
        if i >= width:
            o = s[i - width]
            k = count[o]
            total += part[k - 1] - part[k]
            count[o] = k - 1
            for x, group in enumerate(needs):
                has[x] -= o in group
        if i >= width - 1 and all(has) and log2(width) - total / width >= least:
            a, b = i - width + 1, i + 1
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
    return out


_PART = re.compile("[0-9A-Za-z]+")


def open_pieces(s: str) -> list[tuple[int, int]]:
    """The pieces of a run without its parts on the allow-list, and without the
    separators next to those; the whole run if it has none."""
    hits = sorted(m.span() for p in ALLOW for m in p.finditer(s))
    if not hits:
        return [(0, len(s))]
    # parts and hits in one walk: ``reach`` is the last end of the hits that start before the part's end
    out, last, at, reach = [], 0, 0, 0
    for m in _PART.finditer(s):
        a, b = m.span()
        while at < len(hits) and hits[at][0] < b:
            reach = max(reach, hits[at][1])
            at += 1
        if reach > a:
            out.append((last, a))
            last = b
    out.append((last, len(s)))
    ends = []
    for k, (a, b) in enumerate(out):
        while k and a < b and not s[a].isalnum():
            a += 1
        while k < len(out) - 1 and a < b and not s[b - 1].isalnum():
            b -= 1
        ends.append((a, b))
    return [(a, b) for a, b in ends if b - a >= MIN_RUN]


def _scanner(keep: list[str]):
    def run(batches):
        for batch in batches:
            data, offs = W.text_buffers(batch.column("text"))
            rows = batch.num_rows
            spans: list[list[tuple[int, int, int]]] = [[] for _ in range(rows)]
            for i, j in W.runs(offs):
                raw, o = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                for r, *span in _base_and_entropy(raw, o):
                    spans[i + r].append(tuple(span))
            cols: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            for own in spans:
                base = sorted(x for x in own if x[1] < 3)
                text = lambda xs: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in xs)
                for k, name in enumerate(("n_assign", "n_access", "n_hex")):
                    cols[name].append(sum(x[1] == k for x in base))
                cols["base_sha256"].append(hashlib.sha256(text(base).encode()).hexdigest())
                cols["spans"].append(text(sorted(own)))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.record_batch([batch.column(c) for c in keep]
                                  + [pa.array(v, t) for v, t in zip(cols.values(), kinds)],
                                  names=[*keep, *cols])

    return run


def _base_and_entropy(raw: np.ndarray, o: np.ndarray):
    """Yield (row, start, kind, end), positions in code points of the row."""
    head = (raw & 0xC0) != 0x80
    chars = np.concatenate([[0], np.cumsum(head)])
    own = lambda pos, row: int(chars[pos] - chars[o[row]])
    base: dict[int, list[tuple[int, int]]] = {}

    a, b = class_runs(raw, o, _HEX, MIN_HEX)
    for x, y, r in zip(a, b, np.searchsorted(o, a, "right") - 1):
        base.setdefault(int(r), []).append((x, y))
        yield int(r), own(x, r), 2, own(y, r)

    buf = raw.tobytes()
    low = buf.lower()
    if any(w in low for w in ASSIGN_WORDS) or b"AKIA" in buf:
        for r in range(len(o) - 1):
            part = low[o[r] : o[r + 1]]
            todo = [(k, p) for k, p, hit in (
                (0, ASSIGN, any(w in part for w in ASSIGN_WORDS)),
                (1, ACCESS, b"akia" in part)) if hit]
            if not todo:
                continue
            text = buf[o[r] : o[r + 1]].decode()
            at = None
            for kind, pattern in todo:
                for m in pattern.finditer(text):
                    size = m.end(2) - m.start(2) if kind == 0 else m.end() - m.start()
                    if size >= (MIN_ASSIGN, MIN_ACCESS)[kind]:
                        if at is None:  # byte position of every code point
                            at = np.append(np.flatnonzero(head[o[r] : o[r + 1]]), o[r + 1] - o[r]) + o[r]
                        base.setdefault(r, []).append((at[m.start()], at[m.end()]))
                        yield r, m.start(), kind, m.end()

    a, b = class_runs(raw, o, _TOKEN, MIN_RUN)
    def has(chars):
        n = np.concatenate([[0], np.cumsum(chars[raw])])
        return n[b] > n[a]

    # without a digit and both cases only the classes of one case's letters are left
    some = has(_IS_DIGIT) | (has(_IS_LOWER) & has(_IS_UPPER)) | (b - a >= CLASSES["lower_letters"][1])
    a, b = a[some], b[some]
    held: dict[int, tuple[list[int], list[int]]] = {}
    for x, y, r in zip(a, b, np.searchsorted(o, a, "right") - 1):
        s = buf[x:y].decode()
        for at, end in open_pieces(s):
            for p, q in entropy_spans(s[at:end]):
                p, q = x + at + p, x + at + q
                if int(r) not in held:
                    held[int(r)] = _reaches(base.get(int(r), []))
                starts, reach = held[int(r)]
                k = bisect_right(starts, p)
                if not k or reach[k - 1] < q:
                    yield int(r), own(p, r), 3, own(q, r)


def _reaches(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Sorted starts, and the last end of the spans up to each: one of them holds
    (p, q) if the end reached by the starts up to p is q at least."""
    spans = sorted(spans)
    return [int(u) for u, _ in spans], [int(v) for v in accumulate((v for _, v in spans), max)]


def find_secrets(docs: DataFrame, keep: str = "doc_id") -> DataFrame:
    """``keep``, counts of base spans, ``base_sha256`` and all ``spans`` of
    every row of ``docs(keep, text)``."""
    ship_package(docs.sparkSession)
    kind = docs.schema[keep].dataType.simpleString()
    return docs.select(keep, "text").mapInArrow(
        _scanner([keep]),
        f"{keep} {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
