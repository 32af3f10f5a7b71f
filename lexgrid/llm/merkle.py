"""Merkle manifest of a dataset, by checkpoint and recompute.

Rows are leaves; the leaves of one source, in key order, make a tree of fan-out
``FAN``, and the subroots of all sources, in source order, make the top tree.
Only every ``STEP``-th level is stored. A proof needs the levels between as well:
they are worked out again for each aligned subtree of ``FAN ** STEP`` stored nodes, their
siblings are emitted, and they are dropped.

* Leaf digests are DataFrame functions, so is the building of levels (one grouping per
  stored level; a group is a subtree, never a source).
* Leaves get their place in their source from ``ranking.running_sums``, so a source that holds a
  third of all rows is spread over tasks.
* Paths come from the top: the path of a node is its siblings in its own subtree, then the path
  of the subtree's top. Stored nodes above the leaves are a 1 / FAN ** STEP part of them. At
  the leaves one Arrow pass per subtree folds every leaf up to the root.

Defined cases: a null field is ``-``; the null source is a source of its own, before all others; null keys come
first; rows that repeat a key are leaves of their own, ordered by their digest; a source of one row has its leaf as
subroot; an empty table gives no rows and no root; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lexgrid.functions.sequences import let
from lexgrid.llm.common import map_batches, written
from lexgrid.operators.ranking import fixed_order, running_sums

FAN = 16
STEP = 2                    # levels from one stored level to the next
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BITS = 4 * STEP            # log2(FAN ** STEP)

_PATH = "array<struct<left:string,right:string>>"


def framed(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[framed(c) for c in columns]), 256)


def hash_text(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def climb(digests: list[str], levels: int) -> list[list[str]]:
    """The nodes themselves and ``levels`` levels above them."""
    out = [digests]
    for _ in range(levels):
        last = out[-1]
        out.append([hash_text("".join(last[i:i + FAN])) for i in range(0, len(last), FAN)])
    return out


def siblings(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    """For node ``i`` of the lowest level: the run's other digests, left and right of it, level by level."""
    out = []
    for level in levels[:-1]:
        first = i // FAN * FAN
        out.append(("".join(level[first:i]), "".join(level[i + 1:first + FAN])))
        i //= FAN
    return out


def fold(digest: str, path: Sequence[tuple[str, str]]) -> str:
    for left, right in path:
        digest = hash_text(left + digest + right)
    return digest


def _height(n: Column) -> Column:
    """Levels above ``n`` leaves until one node remains."""
    return sum(((n > F.lit(FAN ** k)).cast("int") for k in range(1, 15)), (n > 1).cast("int"))


def _climbed(digests: Column, height: Column) -> Column:
    """The digest ``STEP`` levels (or ``height``, if fewer) above a subtree's nodes."""
    for k in range(STEP):
        up = let(digests, lambda d: F.transform(F.sequence(F.lit(0), F.floor((F.size(d) - 1) / FAN).cast("int")),
                                                lambda i: F.sha2(F.array_join(F.slice(d, i * FAN + 1, F.lit(FAN)), ""), 256)))
        digests = F.when(height > k, up).otherwise(digests)
    return F.element_at(digests, 1)


def _hex(digest: str) -> Column:
    return F.lower(F.hex(digest))


@dataclass
class Forest:
    """Stored levels ``tree, idx, height, digest`` (``height``: levels left above), lowest first, and ``tree, digest`` of the tops."""

    levels: list[DataFrame]
    tops: DataFrame


def grow(leaves: DataFrame, name: str) -> Forest:
    """Trees over ``tree, idx, height, digest`` (binary, ``idx`` from 0), ``STEP`` levels at a time."""
    levels = [leaves]
    tallest = leaves.agg(F.max("height")).first()[0] or 0
    while tallest > 0:
        groups = levels[-1].where("height > 0").groupBy("tree", "height", F.shiftright("idx", _BITS).alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("nodes"))
        digests = F.transform("nodes", lambda n: F.lower(F.hex(n["digest"])))
        levels.append(written(groups.select(
            "tree", F.col("block").alias("idx"), F.greatest(F.col("height") - STEP, F.lit(0)).alias("height"),
            F.unhex(_climbed(digests, F.col("height"))).alias("digest")), f"{name}-level"))
        tallest -= STEP
    tops = levels[0].where("height = 0").select("tree", "digest")
    for level in levels[1:]:
        tops = tops.unionByName(level.where("height = 0").select("tree", "digest"))
    return Forest(levels, written(tops, f"{name}-tops"))


def _subtrees(level: DataFrame, above: DataFrame | None, top_paths: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per aligned subtree of a stored level: its nodes in order and the path of its top.

    ``above``: ``tree, idx, path`` of the next stored level; ``top_paths``: ``tree, path``.
    """
    groups = level.groupBy("tree", "height", F.shiftright("idx", _BITS).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("idx", "digest", *keep))).alias("nodes"))
    low = groups.where(F.col("height") <= STEP).join(top_paths, "tree")
    if above is None:
        return low
    return low.unionByName(groups.where(F.col("height") > STEP).join(above.withColumnRenamed("idx", "block"), ["tree", "block"])
                           .select(*low.columns))


_PATHS = f"tree string, idx bigint, path {_PATH}"


def _emit_paths(batches: Iterator[pa.RecordBatch], kind: pa.Schema) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(b.num_rows):
            tree, height, nodes, path = (b.column(c)[k].as_py() for c in ("tree", "height", "nodes", "path"))
            levels = climb([n["digest"].hex() for n in nodes], min(height, STEP))
            paths = [[{"left": x, "right": y} for x, y in siblings(levels, i)] + path for i in range(len(nodes))]
            yield pa.RecordBatch.from_arrays([pa.array([tree] * len(nodes), kind.types[0]), pa.array([n["idx"] for n in nodes], kind.types[1]),
                                              pa.array(paths, kind.types[2])], schema=kind)


def paths_down(forest: Forest, top_paths: DataFrame, lowest: int, name: str) -> DataFrame | None:
    """``tree, idx, path`` of all nodes of the stored level ``lowest``; None where there is no such level."""
    above = None
    for level in reversed(forest.levels[max(lowest, 1):-1]):
        above = written(map_batches(_subtrees(level.where("height > 0"), above, top_paths, ()), _emit_paths, _PATHS), f"{name}-paths")
    if lowest == 0:
        above = written(map_batches(_subtrees(forest.levels[0], above, top_paths, ()), _emit_paths, _PATHS), f"{name}-paths")
    return above


def _proofs(root: str):
    """Per subtree of leaves: siblings up to the root, their hash, and each leaf folded with them."""
    def run(batches: Iterator[pa.RecordBatch], out: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                height, path, top = (b.column(c)[k].as_py() for c in ("height", "path", "subroot"))
                nodes = b.column("nodes")[k].values
                leaves = [d.hex() for d in nodes.field("digest").to_pylist()]
                levels = climb(leaves, min(height, STEP))
                path = [(p["left"], p["right"]) for p in path]
                shared = "".join(x + y for x, y in path)
                proofs, folded = [], []
                for i, other in enumerate(nodes.field("tampered").to_pylist()):
                    own = siblings(levels, i)
                    proofs.append(hash_text("".join(x + y for x, y in own) + shared))
                    folded.append(fold(other.hex() if other is not None else leaves[i], own + path))
                n = len(leaves)
                columns = [leaves, [top] * n, [root] * n, proofs, folded, [f == root for f in folded]]
                yield pa.RecordBatch.from_arrays([nodes.field("key"), *[pa.array(c, t) for c, t in zip(columns, out.types[1:])]], schema=out)
    return run


class Manifest:
    """The manifest of ``docs``: stored levels of every source's tree and of the top tree, and the root."""

    def __init__(self, docs: DataFrame, fields: Sequence[str] = FIELDS, tree: str = "source", key: str = "doc_id",
                 tampered: dict[str, Column] | None = None, which: Column | None = None):
        """``tampered`` replaces columns of the rows where ``which`` holds, for ``proofs`` to find."""
        leaf = leaf_digest([F.col(f) for f in fields])
        changed = leaf_digest([(tampered or {}).get(f, F.col(f)) for f in fields])
        source = F.col(tree).cast("string")
        rows = written(docs.select(
            F.when(source.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), source)).alias("tree"), F.col(key).alias("key"),
            F.unhex(leaf).alias("digest"), F.when(F.lit(False) if which is None else which, F.unhex(changed)).alias("tampered"),
            F.monotonically_increasing_id().alias("place"), F.lit(1).cast("bigint").alias("one")), "leaves")
        # equal rows are told apart by their place, so that they spread too
        placed = running_sums(fixed_order(rows, ["tree", "key", "digest", "place"]), "tree", {"rank": "one"})
        # one side has a row per source, so a hot source is split by the skew join
        sizes = rows.groupBy("tree").agg(_height(F.count(F.lit(1))).alias("height"))
        self.leaves = written(placed.join(sizes, "tree").select("tree", (F.col("rank") - 1).alias("idx"), "height", "digest", "key", "tampered"),
                              "ranked-leaves")
        self.forest = grow(self.leaves, "source")
        tops = self.forest.tops.withColumn("one", F.lit(1).cast("bigint")).withColumn("all", F.lit("").cast("string"))
        ranked = running_sums(fixed_order(tops, ["all", "tree"]), "all", {"rank": "one"}).select(
            F.col("all").alias("tree"), (F.col("rank") - 1).alias("idx"), "digest", F.col("tree").alias("source_tree")).checkpoint()
        height = ranked.agg(_height(F.count(F.lit(1)))).first()[0]
        self._sources = ranked.withColumn("height", F.lit(height))
        self.top = grow(self._sources.drop("source_tree").select("tree", "idx", "height", "digest"), "top")
        found = self.top.tops.select(_hex("digest")).first()
        self.root: str | None = found[0] if found else None

    def proofs(self) -> DataFrame:
        """Per row ``key, leaf, subroot, root, proof_sha256, folded_root, verified``.

        ``proof_sha256`` hashes the siblings on the way to the root; ``folded_root`` is worked out from them and
        the row's leaf, tampered where that was asked for.
        """
        kind = self.leaves.schema["key"]
        out = StructType([StructField("key", kind.dataType, True), *StructType.fromDDL(
            "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean").fields])
        if self.root is None:
            return self.leaves.sparkSession.createDataFrame([], out)
        top_path = self.leaves.sparkSession.createDataFrame([("", [])], f"tree string, path {_PATH}")
        paths = paths_down(self.top, top_path, 0, "top")
        subroots = written(self._sources.select("source_tree", "idx", _hex("digest").alias("subroot")).join(paths.drop("tree"), "idx").select(
            F.col("source_tree").alias("tree"), "path", "subroot"), "subroots")
        above = paths_down(self.forest, subroots.drop("subroot"), 1, "source")
        subtrees = _subtrees(self.leaves, above, subroots.drop("subroot"), ("key", "tampered"))
        return map_batches(subtrees.join(subroots.drop("path"), "tree").select("height", "path", "subroot", "nodes"), _proofs(self.root), out)
