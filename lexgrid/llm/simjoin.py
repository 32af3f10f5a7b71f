"""Set similarity joins over a token-group matrix.

Rows of the matrix are groups of similar sets, columns are cells (hashes of
some of a set's tokens). Sets that share cells fall into groups of bounded size; a
group stores its cells and, when opened, the union of its members' tokens.
The work on a pair of groups is:

* the pair is looked at only if the groups share as many cells as linked sets must;
* a query's tokens found in the other group's union bound its overlap with
  every member; only queries and members whose bound reaches the threshold
  stay (a group without any is never opened);
* what is left is compared exactly, on whole token sets.

A group is compared with itself where its sets meet. One that others are compared with is packed (its
tokens once, its sets as places among them), and the lighter group of a pair travels to the other.

Pairs of documents are never emitted: a pair of groups gives a spanning
forest of its links, and connected components join the forests. What a first pass, linear in
the groups, has connected is not compared again, so n near copies of one text cost
about n / GROUP_ROWS pairs of groups, not the square.

Cells that cannot lose a link (``pigeonhole_cells``): tokens are dealt by hash
into ``m`` boxes, a cell is the hash of the tokens in one box. Sets of sizes a
and b with Jaccard t or more differ in at most ``H = (1 - t) / (1 + t) * (a + b)``
tokens, so at least ``m - H`` boxes are equal; with ``m = H + 1 + S`` that is
``1 + S``. Empty boxes are equal but no evidence: a set with ``e <= S`` empty boxes
leaves them out and shares ``1 + S - e`` cells with any linked set; a set with too many
gives them as cells. As a set of n tokens has no linked partner above n / t, its own H
is smaller than that of the largest sets of its class, and it shares the more cells.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgrid.llm.common import map_batches, maybe_in, mix, remove, written
from lexgrid.llm.graph import components

SPARE, SPARE_SHARE = 2, 0.1  # S = SPARE + SPARE_SHARE * H
GROUP_ROWS = 48             # members of a group, on average at most
FAR = 10                    # as many times more in the second pass, where all groups of a home meet: fewer of them travel
GROUP_TOKENS = 60_000       # tokens of a group, on average at most (but for single larger sets)
PAIRS = 64                  # groups, or pairs of them, that a task hands to Python at a time
_STEP = 0xD6E8FEB86659FD93


def size_class(n: int) -> tuple[int, int]:
    """Class of a set size and the largest size in it; classes grow by a factor of 1.5."""
    c, top = 0, 2
    while n > top:
        c, top = c + 1, top + max(1, top // 2)
    return c, top


def pigeonhole_cells(tokens: np.ndarray, t: Fraction) -> tuple[np.ndarray, int]:
    """Cells of a set of distinct token hashes, and how many of them any linked set shares at least.

    A set whose size may have a linked partner in the next class gives the
    cells of both classes.
    """
    n = len(tokens)
    if n == 0:
        return np.empty(0, np.uint64), 1
    out, need = [], n + 1
    classes = [size_class(n)]
    while n >= t * (classes[-1][1] + 1):
        classes.append(size_class(classes[-1][1] + 1))
    spread = mix(tokens)
    for c, top in classes:
        # both sets of a pair that meets in this class have top tokens at most
        differ = int((1 - t) / (1 + t) * (2 * top))
        spare = SPARE + int(SPARE_SHARE * differ)
        boxes = differ + 1 + spare
        box = (spread % np.uint64(boxes)).astype(np.int64)
        total = np.zeros(boxes, np.uint64)
        np.add.at(total, box, mix(spread + np.uint64(c * _STEP % 2**64)))
        filled = np.bincount(box, minlength=boxes) > 0
        empty = int((~filled).sum())
        name = np.uint64(c << 40) + np.arange(boxes, dtype=np.uint64)
        cells = mix(mix(name) ^ total)
        # equal boxes that hold something, against the largest partner this set can have here
        common = boxes - int((1 - t) / (1 + t) * (n + min(top, int(n / t)))) - empty
        out.append(cells if common < 1 else cells[filled])
        need = min(need, max(common, 1))
    return np.unique(np.concatenate(out)), need


def _overlap(tokens: np.ndarray, union: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """How many tokens of each set (cut at ``cuts``) are in the sorted ``union``."""
    at = np.searchsorted(union, tokens)
    at[at == len(union)] = 0
    hit = np.r_[0, np.cumsum(union[at] == tokens)] if len(union) else np.zeros(len(tokens) + 1, np.int64)
    return hit[cuts[1:]] - hit[cuts[:-1]]


def _linked(a: np.ndarray, b: np.ndarray, t: Fraction) -> bool:
    if min(len(a), len(b)) < t * max(len(a), len(b)):
        return False
    common = int(_overlap(a, b, np.array([0, len(a)]))[0])
    return common * t.denominator >= t.numerator * (len(a) + len(b) - common)


def _links(a: list[np.ndarray], b: list[np.ndarray] | None, t: Fraction) -> tuple[list[tuple[int, int]], int]:
    """Links between the sets of two groups (or inside one): a spanning forest and the number of links."""
    inside = b is None
    b = a if inside else b
    num, den = t.numerator, t.denominator
    # most groups hold a set or two: they need no unions and bounds
    if inside and len(a) < 3:
        linked = len(a) == 2 and _linked(a[0], a[1], t)
        return ([(0, 1)], 1) if linked else ([], 0)
    if not inside and len(a) == len(b) == 1:
        return ([(0, 0)], 1) if _linked(a[0], b[0], t) else ([], 0)
    na, nb = np.array([len(x) for x in a]), np.array([len(x) for x in b])

    def survivors(own: list[np.ndarray], n: np.ndarray, other: list[np.ndarray], m: np.ndarray) -> np.ndarray:
        # a linked partner holds t * n tokens of a set at least, and has t * n to n / t tokens
        if inside:
            value, count = np.unique(np.concatenate(other), return_counts=True)
            union = value[count > 1]
        else:
            union = np.unique(np.concatenate(other))
        got = _overlap(np.concatenate(own), union, np.r_[0, np.cumsum(n)])
        return np.flatnonzero((got * den >= num * n) & (n * den >= num * m.min()) & (num * n <= den * m.max()))

    left = survivors(a, na, b, nb)
    right = left if inside else (survivors(b, nb, a, na) if len(left) else left)
    if not len(left) or not len(right):
        return [], 0
    tokens = np.concatenate([b[j] for j in right])
    place = np.repeat(np.arange(len(right)), nb[right])
    order = np.argsort(tokens, kind="stable")
    tokens, place = tokens[order], place[order]
    root = {("a", int(i)): ("a", int(i)) for i in left} | {("b", int(j)): ("b", int(j)) for j in right if not inside}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    forest, links = [], 0
    for i in left:
        lo, hi = np.searchsorted(tokens, a[i], "left"), np.searchsorted(tokens, a[i], "right")
        many = hi - lo
        at = np.repeat(lo - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
        common = np.bincount(place[at], minlength=len(right))
        whole = na[i] + nb[right] - common
        for k in np.flatnonzero(common * den >= num * whole):
            j = int(right[k])
            if inside and j <= i:
                continue
            links += 1
            x, y = find(("a", int(i))), find(("a" if inside else "b", j))
            if x != y:
                root[x] = y
                forest.append((int(i), j))
    return forest, links


def linked_forest(keys: DataFrame, tokens_of: Callable[[DataFrame], DataFrame], t: Fraction, spent: list[str] | None = None) -> DataFrame:
    """Forest of links ``src, dst`` between sets. ``spent``: tables that only ``keys`` reads; they are deleted, and
    so are this function's own, as soon as what is made from them is written.

    ``keys``: ``node, size, need, cell``, distinct by node and cell; a set shares ``need`` of its
    cells at least with any set linked to it. ``tokens_of`` takes ``node, grp`` (some of
    all nodes) and gives ``node, grp, tokens binary`` (sorted distinct 64-bit hashes).
    Node ids are unique and not null.
    """
    spark, cells, tables = keys.sparkSession, [], []
    company = written(keys.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "company", cells)
    shared = written(maybe_in(keys, "cell", company, "cell").join(company, "cell"), "shared-cells", tables)
    remove(spark, cells)
    remove(spark, spent or [])
    # the cell with most company brings the near copies of one text together
    homes = written(shared.groupBy("node").agg(
        F.count(F.lit(1)).alias("k"), F.first("size").alias("size"), F.first("need").alias("need"),
        F.max(F.struct("n", "cell")).alias("h")).where("k >= need").select("node", "size", "need", F.col("h.cell").alias("home")), "homes", tables)
    rooms = written(homes.groupBy("home").agg(_parts(), F.min("need").alias("need"), F.count(F.lit(1)).alias("rows")), "rooms", tables)
    # the matrix: which homes hold a cell; pairs of homes with as many common cells as their members need
    matrix = shared.select("node", "cell").join(homes.select("node", "home"), "node").select("cell", "home").distinct()
    matrix = written(matrix.join(rooms, "home").select("cell", "home", "parts", "need"), "matrix", tables)
    several = written(matrix.groupBy("cell").agg(F.count(F.lit(1)).alias("g")).where("g > 1").select("cell"), "several", tables)
    across = matrix.join(several, "cell")
    side = lambda x: F.struct(f"{x}.home", f"{x}.parts", f"{x}.need")
    met = written(across.alias("x").join(across.alias("y"), F.expr("x.cell = y.cell AND x.home < y.home")).groupBy(
        side("x").alias("x"), side("y").alias("y")).agg(F.count(F.lit(1)).alias("k")).where(
            "k >= greatest(x.need, y.need)").select("x.home", "x.parts", F.col("y.home").alias("home2"), F.col("y.parts").alias("parts2")),
        "home-pairs", tables)

    # first pass: every group with itself and with the first group of its home, and the first groups of
    # homes that meet: as many pairs as groups and pairs of homes
    grp = lambda home, part: F.xxhash64(home, part)
    inside = rooms.where("rows > 1").select("home", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("p"))
    first = inside.select(grp("home", "p").alias("g1"), F.explode(F.array_distinct(F.array(
        grp("home", "p"), grp("home", F.lit(0))))).alias("g2"))
    first = first.unionByName(met.select(grp("home", F.lit(0)).alias("g1"), grp("home2", F.lit(0)).alias("g2")))
    seats = homes.join(rooms.select("home", "parts"), "home").select("node", grp("home", _seat()).alias("grp"))
    near = _compared(seats, first, tokens_of, t, "first")

    # second pass, for what the first didn't look at: members of a home that are connected already need no
    # look at each other, so large classes get groups of their own; the rest of the home is one kind
    wide = met.where("parts > 1 OR parts2 > 1").select("home", "home2").unionByName(
        rooms.where("parts > 2").select("home", F.col("home").alias("home2")))
    wanted = wide.select(F.explode(F.array("home", "home2")).alias("home")).distinct()
    classes = homes.join(wanted, "home", "left_semi").join(components(near), "node", "left").withColumn(
        "class", F.when(F.col("component_id").isNotNull(), F.xxhash64("component_id", F.lit(13))))
    large = classes.where("class IS NOT NULL").groupBy("home", "class").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") > GROUP_ROWS).select(F.col("home").alias("its_home"), F.col("class").alias("kind"))
    sorted_out = written(classes.join(large, F.expr("home = its_home AND class = kind"), "left").select(
        "node", "size", "home", F.coalesce("kind", F.lit(0).cast("bigint")).alias("kind")), "kinds", tables)
    halls = written(sorted_out.groupBy("home", "kind").agg(_parts(FAR)), "halls", tables)
    grp2 = lambda home, kind, part: F.xxhash64(home, kind, part)
    seats = sorted_out.join(halls, ["home", "kind"]).select("node", grp2("home", "kind", _seat()).alias("grp"))
    rest = wide.join(halls.withColumnsRenamed({"kind": "kind1", "parts": "parts1"}), "home").join(
        halls.withColumnsRenamed({"home": "home2", "kind": "kind2", "parts": "parts2"}), "home2").where(
            "(kind1 <> kind2 OR kind1 = 0) AND (home <> home2 OR kind1 <= kind2)")
    rest = rest.withColumn("p1", F.explode(F.sequence(F.lit(0), F.col("parts1") - 1))).withColumn("p2", F.explode(F.sequence(F.when(
        (F.col("home") == F.col("home2")) & (F.col("kind1") == F.col("kind2")), F.col("p1")).otherwise(0), F.col("parts2") - 1)))
    rest = rest.select(grp2("home", "kind1", "p1").alias("g1"), grp2("home2", "kind2", "p2").alias("g2"))
    far = _compared(seats, rest, tokens_of, t, "second")
    remove(spark, tables)
    return near.unionByName(far)


def _parts(times: int = 1):
    """Number of groups for some members (``size``)."""
    return F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / (times * GROUP_ROWS)), F.ceil(F.sum("size") / GROUP_TOKENS)).cast("int").alias("parts")


def _seat():
    return F.pmod(F.xxhash64("node", F.lit(3)), F.col("parts")).cast("int")


def _compared(seats: DataFrame, pairs: DataFrame, tokens_of: Callable[[DataFrame], DataFrame], t: Fraction, name: str) -> DataFrame:
    """Links ``src, dst`` between the members (``node, grp``) of pairs of groups ``g1, g2``, as a written table."""
    tables: list[str] = []
    seats, pairs = written(seats, f"{name}-members", tables), written(pairs, f"{name}-pairs", tables)
    roles = written(pairs.select(F.explode(F.array("g1", "g2")).alias("grp"), (F.col("g1") == F.col("g2")).alias("own")).groupBy("grp").agg(
        F.max("own").alias("own"), F.max(~F.col("own")).alias("others")), f"{name}-roles", tables)
    tokens = tokens_of(seats.join(roles.select("grp"), "grp", "left_semi"))
    node = tokens.schema["node"].dataType.simpleString()
    # a group is compared with itself where its sets meet; only groups that others are compared with travel on, packed
    sets = tokens.groupBy("grp").agg(F.collect_list(F.struct("node", "tokens")).alias("sets")).join(roles, "grp")
    groups = written(map_batches(sets, _grouped(t), f"grp bigint, links array<struct<src:{node},dst:{node}>>, weight bigint, packed {_PACKED.format(node)}"),
                     f"{name}-groups", tables, PAIRS)
    packed = groups.where("packed IS NOT NULL")
    # the lighter group of a pair travels to the other: one that many light ones meet stays where it is
    weigh = lambda g, w: packed.select(F.col("grp").alias(g), F.col("weight").alias(w))
    weighed = pairs.where("g1 <> g2").join(weigh("g1", "w1"), "g1").join(weigh("g2", "w2"), "g2")
    towards = written(weighed.select(F.expr("IF(w1 <= w2, g1, g2)").alias("g1"), F.expr("IF(w1 <= w2, g2, g1)").alias("g2")), f"{name}-ways", tables)
    both = towards.join(packed.select(F.col("grp").alias("g1"), F.col("packed").alias("s1")), "g1").join(
        packed.select(F.col("grp").alias("g2"), F.col("packed").alias("s2")), "g2").select("g2", "s1", "s2")
    across = map_batches(both, _compare(t), f"src {node}, dst {node}")
    inside = groups.select(F.explode("links").alias("l")).select("l.src", "l.dst")
    links = written(across.unionByName(inside), f"{name}-links", batch=PAIRS)
    remove(pairs.sparkSession, tables)
    return links


# sets of a group: its tokens once, sorted, and the places of each set's tokens among them, set after set
_PACKED = "struct<nodes:array<{0}>,tokens:binary,sizes:binary,places:binary>"


def _pack(nodes: list, sets: list[np.ndarray]) -> dict:
    every, places = np.unique(np.concatenate(sets), return_inverse=True) if len(sets) > 1 else (sets[0], np.arange(len(sets[0])))
    return {"nodes": nodes, "tokens": every.tobytes(), "sizes": np.array([len(x) for x in sets], np.int32).tobytes(),
            "places": places.astype(_place(len(every))).tobytes()}


def _place(n: int) -> type:
    return np.uint16 if n <= 1 << 16 else np.uint32


def _unpack(packed: pa.StructScalar) -> tuple[list, list[np.ndarray]]:
    every = _numbers(packed["tokens"], np.uint64)
    tokens = every[_numbers(packed["places"], _place(len(every)))]
    sizes = _numbers(packed["sizes"], np.int32)
    return packed["nodes"].as_py(), np.split(tokens, np.cumsum(sizes)[:-1]) if len(sizes) > 1 else [tokens]


def _numbers(value: pa.Scalar, kind: type) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), kind)


def _grouped(t: Fraction):
    def run(batches: Iterator[pa.RecordBatch], out: pa.Schema) -> Iterator[pa.RecordBatch]:
        for rows in (b.slice(at, 16) for b in batches for at in range(0, b.num_rows, 16)):
            grp, found, own, others = (rows.column(rows.schema.get_field_index(n)) for n in ("grp", "sets", "own", "others"))
            members = found.flatten()
            every, tokens = members.field("node").to_pylist(), [_numbers(x, np.uint64) for x in members.field("tokens")]
            links, weights, packs, at = [], [], [], 0
            for n, alone, travels in zip(found.value_lengths().to_pylist(), own.to_pylist(), others.to_pylist()):
                nodes, sets = every[at:at + n], tokens[at:at + n]
                at += n
                links.append([{"src": nodes[i], "dst": nodes[j]} for i, j in _links(sets, None, t)[0]] if alone else [])
                packs.append(_pack(nodes, sets) if travels else None)
                weights.append(len(packs[-1]["tokens"]) + len(packs[-1]["places"]) if travels else 0)
            yield pa.RecordBatch.from_arrays([grp.cast(out.field(0).type), *(pa.array(x, out.field(n).type) for n, x in (
                ("links", links), ("weight", weights), ("packed", packs)))], schema=out)
    return run


def _compare(t: Fraction):
    def run(batches: Iterator[pa.RecordBatch], out: pa.Schema) -> Iterator[pa.RecordBatch]:
        at, other, b = None, [], []
        for rows in batches:
            found = []
            for g2, s1, s2 in zip(*(rows.column(rows.schema.get_field_index(n)) for n in ("g2", "s1", "s2"))):
                if g2.as_py() != at:        # pairs of one group come one after the other
                    at, (other, b) = g2.as_py(), _unpack(s2)
                ids, a = _unpack(s1)
                found += [(ids[i], other[j]) for i, j in _links(a, b, t)[0]]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], out.field(k).type) for k in (0, 1)], schema=out)
    return run


def component_ids(nodes: DataFrame, forest: DataFrame) -> DataFrame:
    """``nodes`` (column ``node``) with ``component_id``, the smallest node reachable."""
    found = components(written(forest, "forest")).checkpoint()
    return nodes.join(found, "node", "left").withColumn("component_id", F.coalesce("component_id", "node"))
