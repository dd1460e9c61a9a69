"""Connected components and bitmaps."""

import random

from synthtext.llm.tables import bitmap, connected_components, maybe_in

from . import plain


def components(spark, links):
    df = spark.createDataFrame(links, "a bigint, b bigint")
    return {r.node: r.component for r in connected_components(df).collect()}


def test_components_of_random_graphs(spark):
    rng = random.Random(9)
    for n, m in ((40, 20), (60, 60), (200, 150)):
        links = [(rng.randrange(n) * 7 - 90, rng.randrange(n) * 7 - 90) for _ in range(m)]
        nodes = {x for a, b in links for x in (a, b) if a != b}
        want = plain.smallest_reachable(nodes, [x for x in links if x[0] != x[1]])
        assert components(spark, links + links[:5]) == want


def test_components_of_chains_and_stars(spark):
    order = list(range(300))
    random.Random(1).shuffle(order)
    chain = list(zip(order, order[1:]))
    assert set(components(spark, chain).values()) == {0}
    assert set(components(spark, [(k, k + 1) for k in range(130)]).values()) == {0}
    star = [(500, k) for k in range(499)] + [(500, k) for k in range(501, 900)]
    assert components(spark, star) == {k: 0 for k in range(900) if k != 499}
    assert components(spark, []) == {}


def test_bitmap_only_says_no_for_absent_keys(spark):
    keys = spark.createDataFrame([(k * 1_000_003 - 7,) for k in range(500)], "k bigint")
    other = spark.createDataFrame([(k * 999_983 + 11,) for k in range(500)], "k bigint")
    words = bitmap(keys, "k")
    assert maybe_in(keys, "k", words, "m").filter("not m").count() == 0
    assert maybe_in(other, "k", words, "m").filter("m").count() < 10
    assert maybe_in(other, "k", bitmap(keys.limit(0), "k"), "m").filter("m").count() == 0
