"""Exact top-k by inner product with a paged M-tree.

Vectors become integers (floor of ``SCALE`` times each component). One more
coordinate, sqrt(M - |x|^2) with M the largest squared norm, puts all vectors on
one sphere, where the order by distance to (q, 0) is the order by inner product:
|q|^2 + M - 2 q.x is the squared distance. The tree is a metric index over it:

* the root holds routing objects chosen farthest-first from a bounded sample; every
  vector goes to its nearest one, its parent, and keeps its distance to it;
* a node's vectors are paged by that distance: rings of equal width, and a ring with more
  than ``PAGE`` vectors over several pages (copies of one vector can't be told
  apart by any routing object, so they are dealt by id); a page stores the least and largest
  distance to the parent, its covering ring;
* best-first search, a block of queries at a time: each query first reads the
  innermost page of the routing object nearest to it, which gives its k-th best score.
  Then it opens only pages whose ring may hold something as good, by the triangle
  inequality on stored distances, and inside a page passes over entries the same way,
  without computing their products.

Bounds have a slack far above rounding errors and scores are integer products, so
the result is exact, ties to the smaller id.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor do those whose
product with themselves does not fit 62 bits; a vector shorter than the longest one counts as if zeros followed, so the
products are over the components that both have; rows with a null id take no part; rows
that repeat an id are candidates each, but not for a query of that id, and a repeated query is
answered once; with fewer than ``k`` other rows a query has fewer results; an empty table
gives no rows; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexgrid.llm.common import written

SCALE = 1024
LIMIT = 2.0**62             # of squared norms: products of any two vectors fit 64 bits
PAGE = 512                  # entries of a page, on average at most
SAMPLE = 4096               # rows drawn to choose routing objects, in expectation
PIVOTS = 128                # routing objects at most
QUERY_BLOCK = 256           # queries that travel together, on average

RESULT = "query_id bigint, rank int, vec_id bigint, score bigint"
QUERIES = "ids binary, q binary, floor binary, floor_id binary"
NO_FLOOR = -(1 << 62)


def usable(vector: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    norm = F.aggregate(vector, F.lit(0.0), lambda a, x: a + F.pow(F.abs(x.cast("double")) * SCALE + 1, F.lit(2)))
    return vector.isNotNull() & ~F.exists(vector, bad) & (norm < LIMIT)


def whole(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))


def _stacked(rows: list, dims: int) -> np.ndarray:
    """Vectors under each other, zeros after the shorter ones."""
    out = np.zeros((len(rows), dims), np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _lift(x: np.ndarray, m: float) -> np.ndarray:
    """Vectors on the sphere of squared radius ``m``."""
    x = x.astype(np.float64)
    return np.c_[x, np.sqrt(np.maximum(m - (x * x).sum(1), 0))]


def _level(q: np.ndarray) -> np.ndarray:
    """Queries in the space of the lifted vectors."""
    return np.c_[q.astype(np.float64), np.zeros(len(q))]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T), 0))


def _routing(sample: np.ndarray, top: int) -> np.ndarray:
    """Farthest-first choice among distinct sampled vectors."""
    points = np.unique(sample, axis=0)
    chosen, gap = [0], np.full(len(points), np.inf)
    while len(chosen) < min(top, len(points)):
        gap = np.minimum(gap, np.linalg.norm(points - points[chosen[-1]], axis=1))
        if gap.max() <= 0:
            break
        chosen.append(int(gap.argmax()))
    return points[chosen]


def _reach(q: np.ndarray, floor: np.ndarray, m: float) -> np.ndarray:
    """No vector farther from the query than this scores ``floor`` or more; infinite without a floor."""
    norm = (q.astype(np.float64) ** 2).sum(1)
    known = floor > NO_FLOOR
    far = np.sqrt(np.maximum(norm + m - 2.0 * np.where(known, floor, 0), 0)) + 1e-6 * np.sqrt(norm + m) + 1e-3
    return np.where(known, far, np.inf)


class Tree:
    """The routing level; pages travel as rows."""

    def __init__(self, pivots: np.ndarray, m: float, dims: int, k: int):
        self.pivots, self.m, self.dims, self.k = pivots, m, dims, k

    def place(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                d = _distances(_lift(_stacked(f["v"].to_list(), self.dims), self.m), self.pivots)
                node = d.argmin(1)
                yield f.assign(node=node.astype(np.int32), up=d[np.arange(len(f)), node])

    def page(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Pack a page: entries by distance to the parent."""
        for f in frames:
            rows = []
            for node, ring, part, entries in zip(f["node"], f["ring"], f["part"], f["entries"]):
                up = np.array([e["up"] for e in entries])
                order = np.argsort(up, kind="stable")
                ids = np.array([e["vec_id"] for e in entries], np.int64)[order]
                x = _stacked([e["v"] for e in entries], self.dims)[order]
                rows.append((node, ring, part, len(up), up.min(), up.max(), up[order].tobytes(), ids.tobytes(), x.tobytes()))
            yield pd.DataFrame(rows, columns=["node", "ring", "part", "n", "inner", "radius", "up", "ids", "x"])

    def block(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for asked in f["asked"]:
                ids = np.array([a["vec_id"] for a in asked], np.int64)
                floor = [NO_FLOOR if a["floor"] is None else a["floor"] for a in asked]
                limit = [0 if a["floor_id"] is None else a["floor_id"] for a in asked]
                rows.append((ids.tobytes(), _stacked([a["v"] for a in asked], self.dims).tobytes(),
                             np.array(floor, np.int64).tobytes(), np.array(limit, np.int64).tobytes()))
            yield pd.DataFrame(rows, columns=["ids", "q", "floor", "floor_id"])

    def _unpack(self, row) -> tuple[np.ndarray, ...]:
        ids, q, floor, floor_id = (np.frombuffer(row[c], np.int64) for c in ("ids", "q", "floor", "floor_id"))
        return ids, q.reshape(len(ids), self.dims), floor, floor_id

    @staticmethod
    def _packed(pick: np.ndarray, *arrays: np.ndarray) -> tuple[bytes, ...]:
        return tuple(np.ascontiguousarray(a[pick]).tobytes() for a in arrays)

    def first_visits(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The queries of a block by the routing object nearest to them."""
        for f in frames:
            out = []
            for row in f.to_dict("records"):
                parts = self._unpack(row)
                node = _distances(_level(parts[1]), self.pivots).argmin(1)
                out += [(int(x), *self._packed(node == x, *parts)) for x in np.unique(node)]
            yield pd.DataFrame(out, columns=["node", "ids", "q", "floor", "floor_id"])

    def routed(self, rings: dict[int, tuple[float, float]]):
        """The queries of a block that may find something in a node, for every node."""
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                for row in f.to_dict("records"):
                    parts = self._unpack(row)
                    reach = _reach(parts[1], parts[2], self.m)
                    down = _distances(_level(parts[1]), self.pivots)
                    out = []
                    for node, (inner, radius) in rings.items():
                        pick = (down[:, node] - reach <= radius) & (down[:, node] + reach >= inner)
                        if pick.any():
                            out.append((node, float((down[pick, node] - reach[pick]).min()), float((down[pick, node] + reach[pick]).max()),
                                        *self._packed(pick, *parts)))
                    yield pd.DataFrame(out, columns=["node", "low", "high", "ids", "q", "floor", "floor_id"])
        return run

    def visit(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Search a page for the queries sent to it: ``k`` best entries each that reach the floor."""
        for f in frames:
            out: list[tuple[int, int, int]] = []
            for row in f.to_dict("records"):
                ids, q, floor, floor_id = self._unpack(row)
                up, own = np.frombuffer(row["up"]), np.frombuffer(row["entry_ids"], np.int64)
                x = np.frombuffer(row["x"], np.int64).reshape(len(own), self.dims)
                reach = _reach(q, floor, self.m)
                down = _distances(_level(q), self.pivots[row["node"]][None])[:, 0]
                lo, hi = np.searchsorted(up, down - reach), np.searchsorted(up, down + reach, "right")
                for i in np.flatnonzero(lo < hi):
                    at = own[lo[i]:hi[i]]
                    s = x[lo[i]:hi[i]] @ q[i]
                    good = (at != ids[i]) & ((s > floor[i]) | ((s == floor[i]) & (at <= floor_id[i])))
                    at, s = at[good], s[good]
                    best = np.lexsort((at, -s))[:self.k]
                    out += zip([int(ids[i])] * len(best), at[best].tolist(), s[best].tolist())
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, queries: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``queries`` holds, the ``k`` other
    rows with the highest integer inner product, ties to the smaller id."""
    spark = vectors.sparkSession
    src = vectors.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).alias("vector"),
                         F.coalesce(queries, F.lit(False)).alias("asked")).where("vec_id IS NOT NULL")
    rows = src.where(usable(F.col("vector"))).select("vec_id", whole(F.col("vector")).alias("v"), "asked")
    square = F.aggregate("v", F.lit(0).cast("bigint"), lambda a, x: a + x * x)
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("m"), F.count_if("asked").alias("asked"), F.max(F.size("v")).alias("dims")).first()
    if not facts["asked"]:
        return spark.createDataFrame([], RESULT)
    dims = int(facts["dims"])
    m = float(facts["m"])
    # a bounded sample: SAMPLE rows in expectation; any routing objects give the right result
    share = min(1.0, SAMPLE / facts["n"])
    drawn = rows.where(F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(1 << 31)) < F.lit(int(share * (1 << 31)))).select("v").collect()
    sample = _stacked([r["v"] for r in drawn], dims) if drawn else np.zeros((1, dims))
    tree = Tree(_routing(_lift(sample, m), PIVOTS), m, dims, k)

    placed = written(rows.mapInPandas(tree.place, "vec_id bigint, v array<bigint>, asked boolean, node int, up double"), "placed")
    nodes = placed.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("up").alias("lo"), F.max("up").alias("hi")).collect()
    rings = {r["node"]: (r["lo"], r["hi"]) for r in nodes}      # a line per routing object: PIVOTS at most
    spans = F.broadcast(spark.createDataFrame([(r["node"], r["lo"], r["hi"] - r["lo"], -(-r["n"] // PAGE)) for r in nodes],
                                              "node int, lo double, width double, rings int"))
    ringed = placed.join(spans, "node").withColumn("ring", F.when(F.col("width") > 0, F.least(F.col("rings") - 1, F.floor(
        (F.col("up") - F.col("lo")) / F.col("width") * F.col("rings")).cast("int"))).otherwise(0))
    room = ringed.groupBy("node", "ring").agg(F.ceil(F.count(F.lit(1)) / PAGE).cast("int").alias("parts")).checkpoint()
    entries = ringed.join(room, ["node", "ring"]).withColumn(
        "part", F.pmod(F.xxhash64("vec_id", F.lit(9)), F.col("parts")).cast("int"))
    pages = written(entries.groupBy("node", "ring", "part").agg(F.collect_list(F.struct("vec_id", "v", "up")).alias("entries")).mapInPandas(
        tree.page, "node int, ring int, part int, n int, inner double, radius double, up binary, ids binary, x binary"), "pages")
    found = pages.select("node", "inner", "radius", "up", F.col("ids").alias("entry_ids"), "x")

    asked = placed.where("asked").select("vec_id", "v", F.lit(None).cast("bigint").alias("floor"),
                                         F.lit(None).cast("bigint").alias("floor_id")).dropDuplicates(["vec_id"])
    blocks = max(1, -(-facts["asked"] // QUERY_BLOCK))
    dealt = lambda df: df.groupBy(F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(blocks)).alias("block")).agg(
        F.collect_list(F.struct("vec_id", "v", "floor", "floor_id")).alias("asked")).select("asked").mapInPandas(tree.block, QUERIES)
    hits = "query_id bigint, vec_id bigint, score bigint"
    # first visit: a node's innermost page that can fill a result
    inmost = pages.where(F.col("n") > k).groupBy("node").agg(F.min(F.struct("ring", "part")).alias("at")).select("node", "at.*")
    head = pages.join(inmost, ["node", "ring", "part"]).select("node", "up", F.col("ids").alias("entry_ids"), "x")
    early = dealt(asked).mapInPandas(tree.first_visits, f"node int, {QUERIES}").hint("merge").join(head, "node").mapInPandas(tree.visit, hits)
    floors = early.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min(
        F.struct("score", F.bitwise_not("vec_id").alias("back"))).alias("w")).where(F.col("n") >= k).select(
            F.col("query_id").alias("vec_id"), F.col("w.score").alias("floor"), F.bitwise_not("w.back").alias("floor_id"))
    bounded = written(asked.select("vec_id", "v").join(floors, "vec_id", "left"), "bounded")
    routed = dealt(bounded).mapInPandas(tree.routed(rings), f"node int, low double, high double, {QUERIES}")
    # a merge join by name: sizes of packed rows are guessed far too small for a broadcast to be safe
    visits = routed.hint("merge").join(found, "node").where("low <= radius AND high >= inner").drop("low", "high", "inner", "radius")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return visits.mapInPandas(tree.visit, hits).withColumn("rank", F.row_number().over(best).cast("int")).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
