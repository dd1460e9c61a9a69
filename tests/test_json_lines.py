"""The consumer that writes JSON lines: what it holds, and what a failure leaves."""

import gzip
import json
import os
import tracemalloc

from synthtext.streaming.callbacks import JsonLines


def _files(at):
    return sorted(os.path.join(r, f) for r, _, fs in os.walk(at) for f in fs)


def test_lines_are_not_held_until_the_end(tmp_path):
    text = "x" * 10_000
    one = JsonLines(str(tmp_path), ["text"], 0, 0, "gzip")
    tracemalloc.start()
    for _ in range(5000):
        one.chunk({"text": text})
    peak = tracemalloc.get_traced_memory()[1]
    one.close(None)
    tracemalloc.stop()
    assert peak < 16 << 20
    (path,) = _files(tmp_path)
    assert path.endswith("epoch=0/partition=0/part.json.gz")
    with gzip.open(path, "rt") as f:
        assert [json.loads(x) for x in f] == [{"n": n, "text": text} for n in range(5000)]


def test_a_failure_leaves_no_lines(tmp_path):
    for error in (ValueError("x"), None):
        one = JsonLines(str(tmp_path), ["text"], 0, 0)
        for k in range(3):
            one.chunk({"text": "y" * (1 << 20) if k else None})
        assert [os.path.basename(f) for f in _files(tmp_path)] == ["_part.json.open"]
        one.close(error)
        assert len(_files(tmp_path)) == (error is None)
    with open(_files(tmp_path)[0]) as f:
        assert [(r["n"], r["text"] is None) for r in map(json.loads, f)] == [(0, True), (1, False), (2, False)]


def test_nothing_is_left_of_no_lines(tmp_path):
    JsonLines(str(tmp_path), ["text"], 0, 0).close(None)
    assert not _files(tmp_path)
