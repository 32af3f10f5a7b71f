"""Connected components with the large-star / small-star iteration.

Kiveris et al., "Connected Components in MapReduce and Beyond" (SoCC 2014):
alternate *large-star* (every node's larger neighbours re-attach to the
smallest node of its neighbourhood) and *small-star* (every node and its
smaller neighbours re-attach to the smallest of them) until the edges form one
star per component around its smallest node (checked with one aggregation per
round). O(log^2 n) rounds.

Each round is a few aggregations and joins keyed by node. A hub node with a
huge degree is a skewed key on the edge side only (the per-node minimum is
one row per key), which AQE's skew join splits. The minima are checkpointed before they are
joined back, so each step is worked out once, and so are every step's edges, into
``spark.checkpoint.dir`` (reliable): lineage stays one step deep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgrid.session import ensure_checkpoint_dir

MAX_ROUNDS = 64


class NotConverged(RuntimeError):
    pass


def _orient(edges: DataFrame) -> DataFrame:
    return (edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
            .where(F.col("u") != F.col("v")).distinct())


def _large_star(e: DataFrame) -> DataFrame:
    sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    mins = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).checkpoint()
    return _orient(sym.where(F.col("v") > F.col("u")).join(mins, "u").select(F.col("m").alias("u"), F.col("v"))).checkpoint()


def _small_star(e: DataFrame) -> DataFrame:
    mins = e.groupBy("v").agg(F.min("u").alias("m")).checkpoint()
    # a node and its smaller neighbours all move to the smallest of them
    return _orient(e.join(mins, "v").select(F.explode(F.array(
        F.struct(F.col("m").alias("u"), F.col("u").alias("v")), F.struct(F.col("m").alias("u"), F.col("v")))).alias("p")).select("p.u", "p.v")).checkpoint()


def _is_star_forest(e: DataFrame) -> bool:
    """Converged when every node has at most one smaller neighbour and no such
    neighbour has one itself: each component is then a star around its minimum.
    One aggregation per round."""
    roles = e.select(F.col("v").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("root")) \
        .unionByName(e.select(F.col("u").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("root")))
    bad = roles.groupBy("n").agg(F.sum("up").alias("up"), F.max("root").alias("root")) \
        .where((F.col("up") > 1) | ((F.col("up") >= 1) & (F.col("root") == 1)))
    return bad.isEmpty()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst",
                         max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``node, component`` for every node on an edge; component = smallest node in it.

    Raises ``NotConverged`` rather than returning a partial answer.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    e = _orient(edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))).checkpoint(eager=True)
    for _ in range(max_rounds):
        if _is_star_forest(e):
            return e.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
                e.select("u").distinct().select(F.col("u").alias("node"), F.col("u").alias("component")))
        e = _small_star(_large_star(e))
    raise NotConverged(f"connected components did not converge in {max_rounds} rounds")


def with_singletons(nodes: DataFrame, node: str, components: DataFrame) -> DataFrame:
    """Give nodes that have no edge their own component."""
    return (nodes.select(F.col(node).alias("node")).distinct()
            .join(components, "node", "left")
            .select("node", F.coalesce("component", "node").alias("component")))
