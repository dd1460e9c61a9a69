"""Operator 10: exact top-k by inner product with M-trees.

Vectors are dealt to trees by their nearest pivot (a bounded sample of the
vectors; the choice of pivots changes the work, never the result); a pivot with
more than ``TREE_ROWS`` vectors is dealt by a hash into several trees, so a very
common vector is many trees and no task holds an unbounded group. A tree is
paged: a node has a routing vector, a covering radius and its distance to the
parent's routing vector, a leaf entry its distance to the leaf's.

For a query q and anything within distance d of a vector p, the score is at
most q.p + |q| d. Search is best-first on that bound; a child is first judged by
the stored parent distance (and radius) alone, so most routing and leaf
vectors are never multiplied. Bounds are compared as (score, smallest id), so
ties are exact. Each query first searches the tree it lies in; its k-th score
there lets the other trees end early.

Queries are a stated set against all rows, in blocks: a block of at most
``BLOCK`` query vectors is sent to all trees. Scores are exact integers as long
as they fit 63 bits. Defined results: vectors that are null or hold a null or a
non-finite component take no part, nor do rows without an id; shorter
vectors count as padded with zeros; rows that share an id are one vector (the
smallest). Other columns are not read.
"""

from __future__ import annotations

import heapq
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .tables import written

#: vectors of a leaf page and children of a node: pages large enough that numpy
#: works on them as a whole
PAGE = 128
FAN = 16
TREE_ROWS = 2048
PIVOTS = 256
BLOCK = 4096
_SLACK = 1e-9


def quantised(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: float = 1024.0) -> DataFrame:
    """``id, v``: floor(scale * x) of each component; one row an id."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                  & (F.abs(x.cast("double")) < float("inf")))
    return (df.filter(F.col(vec_id).isNotNull() & F.col(vector).isNotNull()).filter(ok)
            .select(F.col(vec_id).cast("bigint").alias("id"),
                    F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias("v"))
            .groupBy("id").agg(F.min("v").alias("v")))


def _matrix(col, width: int) -> np.ndarray:
    """A list column as rows of ``width`` integers, padded with zeros."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    size = col.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(col), width), np.int64)
    if len(flat):
        row = np.repeat(np.arange(len(col)), size)
        out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _distance(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    d = (x - p).astype(np.float64)
    return np.sqrt((d * d).sum(-1))


class Tree:
    """A paged metric tree over some vectors, in flat arrays.

    Node ``k``: routing vector ``route[k]``, ``radius[k]``, distance to the
    parent's routing vector ``up[k]``, smallest id ``low[k]``, children
    ``kid[k]`` .. ``stop[k]`` (nodes, or entries in a leaf). Entry ``e``: vector
    ``x[e]``, ``ids[e]``, distance to its leaf's routing vector ``far[e]``.
    """

    def __init__(self, ids, x):
        self.ids, self.x = ids, x

    @classmethod
    def build(cls, ids: np.ndarray, x: np.ndarray) -> Tree:
        t = cls(ids, x)
        order: list[np.ndarray] = []
        far: list[np.ndarray] = []
        nodes: list[list] = []  # route, radius, up, low, leaf, kid, stop
        todo = [(np.argsort(ids, kind="stable"), None, -1)]  # rows, parent's routing vector, place
        placed, entries = 0, 0
        nodes.append([])
        while todo:
            nxt = []
            for rows, parent, place in todo:
                place = max(place, 0)
                centre = x[rows].mean(0)
                route = x[rows[_distance(x[rows], centre).argmin()]]
                d = _distance(x[rows], route)
                up = float(_distance(route, parent)) if parent is not None else 0.0
                leaf = len(rows) <= PAGE
                node = [route, float(d.max()), up, int(ids[rows].min()), leaf, 0, 0]
                if leaf:
                    node[5:] = [entries, entries + len(rows)]
                    order.append(rows)
                    far.append(d)
                    entries += len(rows)
                else:
                    groups = cls._split(rows, x)
                    node[5:] = [len(nodes), len(nodes) + len(groups)]
                    for g in groups:
                        nxt.append((g, route, len(nodes)))
                        nodes.append([])
                nodes[place] = node
            todo = nxt
        own = np.concatenate(order)
        t.ids, t.x, t.far = ids[own], x[own], np.concatenate(far)
        t.route = np.array([n[0] for n in nodes])
        for k, name in ((1, "radius"), (2, "up")):
            setattr(t, name, np.array([n[k] for n in nodes], np.float64))
        for k, name in ((3, "low"), (4, "leaf"), (5, "kid"), (6, "stop")):
            setattr(t, name, np.array([n[k] for n in nodes], np.int64))
        return t

    @staticmethod
    def _split(rows: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
        """Groups around far-apart seeds; even pieces where all are alike."""
        seeds, near = [rows[0]], None
        for _ in range(FAN - 1):
            d = _distance(x[rows], x[seeds[-1]])
            near = d if near is None else np.minimum(near, d)
            if near.max() == 0:
                break
            seeds.append(rows[near.argmax()])
        if len(seeds) == 1:
            return np.array_split(rows, min(FAN, -(-len(rows) // PAGE)))
        own = np.stack([_distance(x[rows], x[s]) for s in seeds]).argmin(0)
        return [rows[own == k] for k in range(len(seeds)) if (own == k).any()]

    FIELDS = ("ids", "x", "far", "route", "radius", "up", "low", "leaf", "kid", "stop")

    def pack(self) -> list[bytes]:
        return [np.ascontiguousarray(getattr(self, f)).tobytes() for f in self.FIELDS]

    @classmethod
    def unpack(cls, parts: list[bytes], width: int) -> Tree:
        t = cls(None, None)
        for f, raw in zip(cls.FIELDS, parts, strict=True):
            kind = np.float64 if f in ("far", "radius", "up") else np.int64
            a = np.frombuffer(raw, kind)
            setattr(t, f, a.reshape(-1, width) if f in ("x", "route") else a)
        return t

    def search(self, q: np.ndarray, own: int, k: int, floor=None) -> list[tuple[int, int]]:
        """The k best (score, -id) of the tree above ``floor``, best last;
        ``own`` is the query's id."""
        if k <= 0:
            return []
        top: list[tuple[int, int]] = []
        norm = sqrt(float((q.astype(np.float64) ** 2).sum())) * (1 + _SLACK)
        floor = floor or (-(1 << 63), -(1 << 63))
        best = lambda: max(floor, top[0]) if len(top) == k else floor
        dot = int(self.route[0] @ q)
        heap = [(-(dot + norm * self.radius[0] + 1), int(self.low[0]), 0, dot)]
        while heap:
            bound, low, node, dot = heapq.heappop(heap)
            score, _ = best()
            if -bound < score:
                break
            if self.radius[node] == 0 and (dot, -low) <= best():
                continue  # equal vectors: all score dot, and the smallest id comes too late
            a, b = int(self.kid[node]), int(self.stop[node])
            slack = 1 + _SLACK * abs(dot)
            if self.leaf[node]:
                near = dot + norm * self.far[a:b] + slack >= score
                page, ids = (self.x[a:b], self.ids[a:b]) if near.all() else (self.x[a:b][near], self.ids[a:b][near])
                s = page @ q
                good = s >= (top[0][0] if len(top) == k else score)
                for v, i in zip(s[good].tolist(), ids[good].tolist()):
                    if i != own and (v, -i) > best():
                        (heapq.heapreplace if len(top) == k else heapq.heappush)(top, (v, -i))
            else:
                ok = dot + norm * (self.up[a:b] + self.radius[a:b]) + slack >= score
                kids = a + np.flatnonzero(ok)
                dots = self.route[kids] @ q
                up = dots + norm * self.radius[kids] + 1
                for c, d, u in zip(kids[up >= score].tolist(), dots[up >= score].tolist(), up[up >= score].tolist()):
                    heapq.heappush(heap, (-u, int(self.low[c]), c, d))
        return sorted(top)


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_TREE = "tree bigint, hole int, slot int, ids binary, x binary, far binary, route binary, radius binary, " \
        "up binary, low binary, leaf binary, kid binary, stop binary"


def _assigner(shared, width: int):
    def run(batches):
        pivots = shared.value
        for batch in batches:
            x = _matrix(batch.column("v"), width).astype(np.float64)
            best = np.zeros(len(x), np.int64)
            for i in range(0, len(x), 4096):
                part = x[i : i + 4096]
                best[i : i + 4096] = ((pivots * pivots).sum(1) - 2 * part @ pivots.T).argmin(1)
            yield pa.record_batch([batch.column("id"), batch.column("v"), pa.array(best)], names=["id", "v", "pivot"])

    return run


def _builder(width: int):
    def run(table: pa.Table) -> pa.Table:
        t = Tree.build(table["id"].to_numpy(), _matrix(table["v"], width))
        kinds = [pa.binary()] * len(Tree.FIELDS)
        return pa.table([pa.array([v], k) for v, k in zip(t.pack(), kinds)], names=list(Tree.FIELDS))

    return run


def _found(rows) -> pa.RecordBatch:
    q, v, s = zip(*rows) if rows else ((), (), ())
    return pa.record_batch([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.int64())], schema=_FOUND)


def _trees(batch, width):
    cols = [batch.column(f) for f in Tree.FIELDS]
    for r in range(batch.num_rows):
        yield Tree.unpack([c[r].as_py() for c in cols], width)


def _own_tree(width: int, k: int, every: int):
    """The queries of each tree searched in that tree."""
    schema = pa.schema([("id", pa.int64()), ("v", pa.list_(pa.int64())), ("score", pa.int64()), ("other", pa.int64())])

    def run(batches):
        for batch in batches:
            rows = []
            for t in _trees(batch, width):
                for e in np.flatnonzero(t.ids % every == 0):
                    top = t.search(t.x[e], int(t.ids[e]), k)
                    floor = top[0] if len(top) == k else (None, None)
                    rows.append((int(t.ids[e]), t.x[e].tolist(), *floor))
            yield pa.record_batch([pa.array([r[c] for r in rows], schema[c].type) for c in range(4)], schema=schema)

    return run


def _all_trees(shared, width: int, k: int):
    def run(batches):
        queries = shared.value
        for batch in batches:
            rows = []
            for t in _trees(batch, width):
                for own, q, floor in queries:
                    # the own tree's k-th result itself must come again, so the floor is just below it
                    rows += [(own, -i, s) for s, i in t.search(q, own, k, floor)]
            yield _found(rows)

    return run


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, tree_rows: int = TREE_ROWS,
          block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vectors(id, v)``
    whose id is divisible by ``every``, against every other row."""
    spark = vectors.sparkSession
    ship_package(spark)
    vectors = written(vectors, "vectors")
    n, width = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    width = max(width or 0, 1)
    count = int(min(PIVOTS, max(1, -(-n // tree_rows))))
    chosen = vectors.orderBy(F.xxhash64("id", F.lit("pivot")), "id").limit(count).select("v").collect()
    pivots = np.zeros((max(1, len(chosen)), width))
    for r, row in enumerate(chosen):
        pivots[r, : len(row.v)] = row.v
    dealt = written(vectors.mapInArrow(_assigner(spark.sparkContext.broadcast(pivots), width),
                                       "id bigint, v array<bigint>, pivot bigint"), "vectors_dealt")
    # PIVOTS rows at most; a pivot with many vectors gets several trees
    sizes = dealt.groupBy("pivot").agg(F.ceil(F.count("*") / tree_rows).alias("trees"))
    trees = written(dealt.join(F.broadcast(sizes), "pivot")
                    .withColumn("salt", F.pmod(F.xxhash64("id", F.lit("tree")), "trees"))
                    .select("pivot", "salt", "id", "v")
                    .groupBy("pivot", "salt")
                    .applyInArrow(_builder(width), ", ".join(f"{f} binary" for f in Tree.FIELDS)), "trees")
    queries = written(trees.mapInArrow(_own_tree(width, k, every),
                                       "id bigint, v array<bigint>, score bigint, other bigint"), "queries")
    parts = max(1, -(-queries.count() // block))
    found = None
    for part in range(parts):
        rows = queries.filter(F.pmod(F.xxhash64("id"), F.lit(parts)) == part).collect()
        # one below the k-th of its own tree, as (score, -id), so that one is found again
        sent = [(r.id, np.array(r.v, np.int64), None if r.score is None else (r.score, r.other - 1)) for r in rows]
        one = trees.mapInArrow(_all_trees(spark.sparkContext.broadcast(sent), width, k),
                               "query_id bigint, vec_id bigint, score bigint")
        found = one if found is None else found.union(one)
    from pyspark.sql.window import Window

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
