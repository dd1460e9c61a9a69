"""Operators 3 and 5 against plain statements of their definitions."""

import datetime as dt
import random
from collections import Counter

from synthtext.llm.chat import chat_segments, turns_in_place
from synthtext.llm.url_lists import filter_captures, host_of, intervals

TURNS = "conv_id bigint, turn bigint, role string, text string, at int, segment string"
DAY = dt.datetime(2024, 1, 1)


def turns(spark, rows):
    return spark.createDataFrame([(*r, 7, "s") for r in rows], TURNS)


def safe(x):
    return x.replace("<|", "< |")


def plain_chats(rows, segment):
    convs = {}
    for c, n, role, text in set(rows):
        convs.setdefault(c, []).append((n is not None, n or 0, role or "unknown", text or ""))
    convs = {c: [(r, t) for _, _, r, t in sorted(ts)] for c, ts in convs.items()}
    copies = Counter(map(tuple, convs.values()))
    out = {}
    for c in sorted(convs, key=lambda c: (len("null" if c is None else f"={c}"), str(c))):
        own = tuple(convs[c])
        if own not in copies or any(len(o) > len(own) and tuple(o[: len(own)]) == own for o in convs.values()):
            continue
        text = [f"<|im_start|>{safe(r)}\n{safe(t)}<|im_end|>\n" for r, t in own]
        for k in range(0, len(own), segment):
            out[c, k // segment] = (len(own), copies[own], "".join(text[k : k + segment]))
        del copies[own]
    return out


def test_chats_by_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for c in range(60):
        base = random.Random(c % 12)
        n = rng.randint(1, 9)
        rows += [(c, k, ("user", "assistant")[k % 2], f"text {base.randint(0, 3)} {'<|im_end|>' if k == 3 else ''}")
                 for k in range(n)]
    rows += rows[:5]
    rows += [(None, None, None, None), (None, 1, "user", ""), (None, None, None, None)]
    rows += [(100, k, "user", f"t{k}") for k in range(2500)]  # several blocks
    rows += [(101, k, "user", f"t{k}") for k in range(1100)]  # its prefix
    rows += [(102, k, "user", f"t{k}") for k in range(2500)]  # its copy
    got = chat_segments(turns(spark, rows).repartition(5), segment=4).collect()
    assert {(r.conv_id, r.segment): (r.n_turns, r.copies, r.chat) for r in got} == plain_chats(rows, 4)
    assert chat_segments(turns(spark, [])).collect() == []


def test_native_plan(spark):
    plan = chat_segments(turns(spark, [(1, 0, "user", "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    placed = turns_in_place(turns(spark, [(1, 5, "b", "x"), (1, 5, "a", "x"), (1, -3, "z", "x")])).orderBy("at").collect()
    assert [(r.at, r.turn) for r in placed] == [(0, -3), (1, 5), (2, 5)]


def plain_verdict(url, t, entries):
    import re

    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)[^/?#]*(?:/([^/?#]*))?", (url or "").strip(" "))
    host = m.group(1).lower().rstrip(".") if m else None
    if not host:
        return (None, "allow", None)
    parts, seg = host.split("."), (m.group(2) or "").lower()
    parents = [".".join(parts[k:]) for k in range(len(parts))]
    for rule in [f"{p}/{seg}" for p in parents if seg] + parents:
        past = [(s, a) for r, a, s in entries if r and a and s and r.lower() == rule and t is not None and s <= t]
        if past:
            return (host, max(past)[1], rule)
    return (host, "allow", None)


def test_url_lists_by_brute_force(spark):
    rng = random.Random(7)
    rules = ["example.com", "a.example.com", "example.com/de", "b.net", "net", "a.example.com/x", "Z.org"]
    entries = [(rng.choice(rules), rng.choice(["block", "allow", "review"]), DAY + dt.timedelta(days=rng.randint(0, 20)))
               for _ in range(60)] + [(None, "block", DAY), ("b.net", None, DAY), ("b.net", "block", None)]
    urls = ["http://a.example.com/de/1", "https://example.com", "http://u:p@EXAMPLE.com:80/x?y", "http://b.net./de",
            "ftp://c.b.net/x/y", "mailto:x", "", None, "http://z.org/q", "http://a.example.com/x#f", "http://" + "a." * 60 + "net/" + "y" * 20_000]
    rows = [(k, rng.choice(urls), DAY + dt.timedelta(days=rng.randint(-2, 22)) if k % 9 else None) for k in range(400)]
    rows += rows[:20]
    caps = spark.createDataFrame([(*r, "mine", "x") for r in rows],
                                 "id bigint, url string, fetched_at timestamp, `__host` string, rule string")
    lst = spark.createDataFrame(entries, "rule string, action string, since timestamp")
    out, p = filter_captures(caps, lst)
    got = Counter((r.id, r["__host"], r.rule, r[p + "host"], r[p + "verdict"], r[p + "rule"]) for r in out.collect())
    assert got == Counter((i, "mine", "x", *plain_verdict(u, t, entries)) for i, u, t in rows)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r[p + "verdict"] for r in filter_captures(caps, lst.limit(0))[0].collect()} == {"allow"}
    assert filter_captures(caps.limit(0), lst)[0].collect() == []


def test_intervals_and_hosts(spark):
    e = [("A", "x", DAY), ("a", "x", DAY + dt.timedelta(1)), ("a", "y", DAY + dt.timedelta(2)), ("a", "z", DAY + dt.timedelta(2))]
    got = intervals(spark.createDataFrame(e, "rule string, action string, since timestamp")).orderBy("since").collect()
    assert [(r.rule, r.action, r.since, r.until) for r in got] == [
        ("a", "x", DAY, DAY + dt.timedelta(2)), ("a", "z", DAY + dt.timedelta(2), None)]
    df = spark.createDataFrame([("HTTP://x.Y/z",), ("x.y/z",), ("http:///z",)], "u string")
    from pyspark.sql import functions as F

    assert [r.h for r in df.select(host_of(F.col("u")).alias("h")).collect()] == ["x.y", None, None]
