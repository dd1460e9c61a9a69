"""Operator 5 [native]: URL filters by temporal list join.

Dated list entries (``rule``: a domain, or a domain and path prefix; ``action``:
what holds from ``since`` on, until the rule's next entry) become validity
intervals with a window over each rule. A capture is judged by the entries that
were active when it was fetched: the most specific matching rule decides, a path
prefix before a domain, a longer path before a shorter, then a longer domain before
a shorter. A path prefix is of whole segments (``/a`` matches ``/a/b``, not ``/ab``).

Each distinct host and path, cut at the depth of the list's deepest rule, is expanded
once into the rules that could match it (the domain and its parents, with and without
each path prefix, whatever the number of captures), joined to the intervals by equality,
and the intervals of a page group are kept as one array, whose size the list
bounds. Captures then join their group's array and the as-of lookup is a filter
on it: captures are shuffled at most once, and a host with a third of them is
split by the skew join (the other side has one row a group). DataFrame
functions only.

Defined results: a URL that is null or has no host has a null host and the
verdict ``default``; so has a capture without a fetch time or without an active
matching rule. Of entries of one rule with equal ``since`` the greatest action
holds; null rules, actions or dates are no entries. Hosts compare in lower case
without port, user and final dot; slashes at a rule's end do not count. Repeated captures each get their verdict; the
captures' other columns pass through, added ones get a prefix that none has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def host_of(url: Column) -> Column:
    """Lower-case host of a URL, or null."""
    h = F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    h = F.regexp_replace(F.lower(h), r"\.$", "")
    return F.when(h != "", h)


def path_of(url: Column, depth: Column) -> Column:
    """The first ``depth`` path segments of a URL in lower case, or an empty string."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)", 1)
    return F.array_join(F.slice(F.split(F.lower(path), "/"), F.lit(1), depth), "/")


def rule_of(rule: Column) -> Column:
    """A rule as it is compared: lower case, without slashes at its end."""
    return F.regexp_replace(F.lower(rule), "/+$", "")


def intervals(entries: DataFrame) -> DataFrame:
    """``rule, action, since, until``: [since, until) of every entry; until is
    null for the last. Entries that change nothing are merged into the one
    before."""
    e = (entries.filter("rule is not null and action is not null and since is not null")
         .groupBy(rule_of(F.col("rule")).alias("rule"), "since").agg(F.max("action").alias("action")))
    w = Window.partitionBy("rule").orderBy("since")
    e = (e.withColumn("old", F.lag("action").over(w)).filter("old is null or old <> action").drop("old"))
    return e.withColumn("until", F.lead("since").over(w))


def rules_for(host: Column, path: Column) -> Column:
    """Rules that can match, most specific first: struct(rank, rule)."""
    labels, segments = F.split(host, r"\."), F.split(path, "/")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(F.sequence(F.size(segments), F.lit(1), F.lit(-1)), lambda i: F.array_join(
        F.slice(segments, F.lit(1), i), "/"))
    both = F.concat(F.when(path != "", F.flatten(F.transform(prefixes, lambda x: F.transform(
        parents, lambda d: F.concat(d, F.lit("/"), x))))).otherwise(F.array().cast("array<string>")), parents)
    return F.transform(both, lambda r, i: F.struct(i.alias("rank"), r.alias("rule")))


def filter_captures(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_at",
                    default: str = "allow") -> tuple[DataFrame, str]:
    """``captures`` with, under a prefix that no column has, ``host``, ``verdict``
    (the deciding entry's action, or ``default``) and ``rule`` (null where none
    decided). Returns frame and prefix."""
    p = "__"
    while any(c.startswith(p) for c in captures.columns):
        p += "_"
    deepest = entries.agg(F.coalesce(F.max(F.size(F.split(rule_of(F.col("rule")), "/")) - 1), F.lit(0)).alias(f"{p}depth"))
    c = captures.crossJoin(F.broadcast(deepest)).withColumns({
        f"{p}host": host_of(F.col(url)), f"{p}path": F.coalesce(path_of(F.col(url), F.col(f"{p}depth")), F.lit(""))})
    pages = c.select(F.col(f"{p}host").alias("h"), F.col(f"{p}path").alias("s")).filter("h is not null").distinct()
    rules = pages.select("h", "s", F.explode(rules_for(F.col("h"), F.col("s"))).alias("r")).select(
        "h", "s", "r.rank", "r.rule")
    lists = (rules.join(intervals(entries), "rule")
             .groupBy("h", "s").agg(F.sort_array(F.collect_list(F.struct("rank", "rule", "action", "since", "until")))
                                    .alias(f"{p}list"))
             .withColumnsRenamed({"h": f"{p}h", "s": f"{p}s"}))
    joined = c.join(lists, (F.col(f"{p}host") == F.col(f"{p}h")) & (F.col(f"{p}path") == F.col(f"{p}s")), "left")
    t = F.col(fetched)
    active = F.get(F.filter(f"{p}list", lambda x: (x["since"] <= t) & (x["until"].isNull() | (t < x["until"]))), F.lit(0))
    return joined.withColumn(f"{p}hit", active).select(
        *captures.columns, f"{p}host", F.coalesce(F.col(f"{p}hit")["action"], F.lit(default)).alias(f"{p}verdict"),
        F.col(f"{p}hit")["rule"].alias(f"{p}rule")), p
