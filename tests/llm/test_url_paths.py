"""Operator 5: rules of paths of any depth."""

import datetime as dt

from synthtext.llm.url_lists import filter_captures

DAY = dt.datetime(2024, 1, 1)


def test_path_prefixes_of_any_depth(spark):
    rules = ["site.com", "site.com/a/b", "www.site.com/a", "site.com/a/b/c/D/", "site.com/x/", "org"]
    urls = {"http://site.com/a": "site.com", "http://site.com/a/b": "site.com/a/b", "http://site.com/A/B/?q=/c/d": "site.com/a/b",
            "http://site.com/a/bc": "site.com", "http://www.site.com/a/z/b": "www.site.com/a",
            "http://www.site.com/a/b/z": "site.com/a/b", "http://site.com/a/b/c/d/e/f": "site.com/a/b/c/d",
            "http://site.com/a/b/c#d/d": "site.com/a/b", "http://site.com/x": "site.com/x", "http://site.com/x/y/": "site.com/x",
            "http://site.com//a/b": "site.com", "http://e.org/a/b": "org", "http://e.net/a/b": None, "http://site.com": "site.com"}
    caps = spark.createDataFrame([(u, DAY) for u in urls], "url string, fetched_at timestamp")
    lst = spark.createDataFrame([(r, f"by {r}", DAY) for r in rules], "rule string, action string, since timestamp")
    out, p = filter_captures(caps, lst)
    assert out.columns[:2] == caps.columns and len(out.columns) == 5
    assert {r.url: r[p + "rule"] for r in out.collect()} == urls
    assert all(r[p + "verdict"] != "allow" for r in out.collect() if r[p + "rule"])
