"""Prefix trie of conversations: z-fast tries of batches, merged by prefix hash.

A node is a distinct sequence of first turns; it is named by a 128-bit hash of that sequence (the
xor of two 64-bit hashes of each turn and its place, so a running xor gives the names of
all prefixes of a conversation, over any number of tasks).

1. Turns are numbered and named in the order of conversation and turn, spread by range
   (``ranking.fixed_order``): a conversation of any length runs over many tasks.
2. Each task takes its rows in batches and inserts every conversation (or the part of one in the
   batch) into a z-fast trie: compacted nodes in a hash table by their handle, the prefix at the
   two-fattest number in the depths of their edge. Fat binary search finds the exit node in a
   logarithm of the length; the exit edge is split where the conversation leaves it. What the batch's conversations share is
   one compacted edge, however many they are.
3. Edges are expanded to one row per node with its members in the batch, and merged over all batches by
   the node's name: smallest member, number of members.
4. Nodes with the same smallest member form a path downwards (a chain); chains hang on nodes of chains with
   smaller ids. Sums over subtrees are sums over chains, by pointer doubling (the rounds are a logarithm of the
   depth of the tree of chains), then running sums up each chain.

Defined cases: null roles and texts are empty; turns are ordered by turn (null first), ties by the digest of role
and text; rows repeated in full stay repeated turns; rows with a null conversation id take no part; a conversation without
turns ends at the root; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexgrid.llm.common import map_batches, written
from lexgrid.operators.ranking import carried, fixed_order, running_sums

BATCH = 1 << 15             # turns of a batch, at most (and one Arrow batch)
CHUNK_BITS = 12             # ids of one string of ends: those that share their high bits
MAX_ROUNDS = 64


def two_fattest(a: int, b: int) -> int:
    """The number in ``(a, b]`` that the largest power of two divides."""
    return b & (-1 << ((a ^ b).bit_length() - 1))


class ZFastTrie:
    """A compacted trie over the prefix names of rows, below one prefix of depth ``base``.

    Row ``r`` is one depth of one conversation; rows of a conversation follow each other. A string is the rows
    from ``first`` on, at depths ``base + 1 .. top``.
    """

    def __init__(self, names: list, base: int):
        self.names, self.base = names, base
        # per compacted node: depths (low, high] of its edge, the row of its first depth, its parent, strings ending here, smallest conversation
        self.low, self.high, self.row, self.parent, self.ends, self.least = [], [], [], [], [], []
        self.handles: dict = {}     # prefix name at the two-fattest depth of the edge -> node
        self.firsts: dict = {}      # prefix name at the first depth of the edge -> node
        self._node(base, base, 0, -1)

    def _node(self, low: int, high: int, row: int, parent: int) -> int:
        k = len(self.low)
        for part, value in ((self.low, low), (self.high, high), (self.row, row), (self.parent, parent), (self.ends, 0), (self.least, None)):
            part.append(value)
        if high > low:
            self._hook(k)
        return k

    def _hook(self, k: int) -> None:
        low, high, row = self.low[k], self.high[k], self.row[k]
        self.handles[self.names[row + two_fattest(low, high) - low - 1]] = k
        self.firsts[self.names[row]] = k

    def exit_node(self, first: int, top: int) -> tuple[int, int]:
        """Node whose edge the string leaves (or ends on), and the depth down to which both agree."""
        names, base, at, a, b = self.names, self.base, 0, self.base, top
        while a < b:
            f = two_fattest(a, b)
            k = self.handles.get(names[first + f - base - 1])
            if k is None:
                b = f - 1
                continue
            at, high, row, low = k, self.high[k], self.row[k], self.low[k]
            if high > top or names[first + high - base - 1] != names[row + high - low - 1]:
                return at, self._agree(k, first, f, min(high, top))
            a = high
        if a < top:
            k = self.firsts.get(names[first + a - base])
            if k is not None:
                return k, self._agree(k, first, a + 1, min(self.high[k], top))
        return at, a

    def _agree(self, k: int, first: int, known: int, most: int) -> int:
        """Deepest equal prefix in an edge, by binary search: names of longer prefixes differ from where texts part."""
        row, low, names, base = self.row[k], self.low[k], self.names, self.base
        while known < most:
            mid = (known + most + 1) // 2
            if names[first + mid - base - 1] == names[row + mid - low - 1]:
                known = mid
            else:
                most = mid - 1
        return known

    def insert(self, first: int, top: int, conv: int) -> None:
        at, depth = self.exit_node(first, top)
        if depth < self.high[at]:                       # split: the upper part is a new node
            low, high, row = self.low[at], self.high[at], self.row[at]
            del self.handles[self.names[row + two_fattest(low, high) - low - 1]]
            upper = self._node(low, depth, row, self.parent[at])
            self.low[at], self.row[at], self.parent[at] = depth, row + depth - low, upper
            self._hook(at)
            at = upper
        if depth < top:
            at = self._node(depth, top, first + depth - self.base, at)
        self.ends[at] += 1
        self.least[at] = conv if self.least[at] is None else min(self.least[at], conv)

    def expanded(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per node of the expanded trie: a row of it, its members, its smallest member."""
        low, high = np.array(self.low, np.int64), np.array(self.high, np.int64)
        members, least = list(self.ends), list(self.least)
        for k in np.argsort(-high, kind="stable").tolist():
            up = self.parent[k]
            if up >= 0:
                members[up] += members[k]
                least[up] = least[k] if least[up] is None else min(least[up], least[k])
        size = high - low
        rows = np.repeat(np.array(self.row, np.int64) - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
        return rows, np.repeat(np.array(members, np.int64), size), np.repeat(np.array(least, np.int64), size)


_EXPANDED = "kind int, a bigint, b bigint, up_a bigint, up_b bigint, conv bigint, depth bigint, n bigint, bytes bigint"


def _named(b: pa.RecordBatch, last: tuple) -> tuple[dict[str, np.ndarray], tuple]:
    """Prefix names of sorted rows; ``last``: conversation and name of the row before the batch."""
    col = {n: b.column(n).to_numpy(zero_copy_only=False) for n in ("conv", "pos", "hash_a", "hash_b", "bytes", "last")}
    n = len(col["conv"])
    change = np.r_[col["conv"][0] != last[0], col["conv"][1:] != col["conv"][:-1]]
    begins = np.flatnonzero(np.r_[True, change[1:]])
    for k, out in enumerate("ab"):
        own = np.bitwise_xor.accumulate(col["hash_" + out])
        held = b.column("held_" + out).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        base = held[begins] ^ np.where(begins > 0, own[begins - 1], 0)
        if not change[0]:
            base[0] = last[1 + k]
        col[out] = own ^ np.repeat(base, np.diff(np.r_[begins, n]))
    col["begins"] = begins
    return col, (col["conv"][-1], col["a"][-1], col["b"][-1])


def _batches(batches: Iterator[pa.RecordBatch], kind: pa.Schema) -> Iterator[pa.RecordBatch]:
    last = (None, 0, 0)
    for whole in batches:
        for at in range(0, whole.num_rows, BATCH):
            col, last = _named(whole.slice(at, BATCH), last)
            a, b, conv, pos = col["a"], col["b"], col["conv"], col["pos"]
            up_a, up_b = a ^ col["hash_a"], b ^ col["hash_b"]
            names, tries = list(zip(a.tolist(), b.tolist())), {}
            begins = col["begins"].tolist()
            for first, end in zip(begins, [*begins[1:], len(a)]):
                # a conversation that began in an earlier batch hangs on the prefix it has reached
                under, base = (int(up_a[first]), int(up_b[first])), int(pos[first]) - 1
                if under not in tries:
                    tries[under] = ZFastTrie(names, base)
                tries[under].insert(first, base + end - first, int(conv[first]))
            rows, members, least = (np.concatenate(x) for x in zip(*(t.expanded() for t in tries.values())))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                (np.zeros(len(rows), np.int64), a[rows], b[rows], up_a[rows], up_b[rows], least, pos[rows], members, col["bytes"][rows]),
                kind.types)], schema=kind)
            ends = np.flatnonzero(col["last"])
            one = np.ones(len(ends), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                (one, a[ends], b[ends], up_a[ends], up_b[ends], conv[ends], pos[ends], one, col["bytes"][ends]), kind.types)], schema=kind)


def narrow_turns(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, digest, bytes, place, one``: a turn without its text; ``place`` tells rows repeated in full apart, so that they spread."""
    said, who = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    return written(rows.where(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("conv"), F.col(turn).alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said))).alias("digest"),
        F.octet_length(said).cast("bigint").alias("bytes"), F.monotonically_increasing_id().alias("place"), F.lit(1).cast("bigint").alias("one")), "turns")


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``conv, pos, digest, bytes``: turns with their place, from 1."""
    return running_sums(fixed_order(turns, ["conv", "turn", "digest", "place"]), "conv", {"pos": "one"}).select("conv", "pos", "digest", "bytes")


def shared_heads(turns: DataFrame, heads: Column, donor: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first ``heads`` turns (``most`` at most) of conversation ``donor``, then go on with
    their own turns after as many; both are expressions of ``conv``.

    Returns ``conv, pos, digest, bytes, last`` and the ids without any turn.
    """
    place = written(numbered_turns(turns), "numbered")
    sizes = place.groupBy("conv").agg(F.max("pos").alias("n"))
    convs = sizes.select("conv", "n", heads.cast("bigint").alias("h"), donor.alias("donor"))
    given = sizes.select(F.col("conv").alias("donor"), F.col("n").alias("has"))
    convs = written(convs.join(given, "donor", "left").withColumn("got", F.least("h", F.coalesce("has", F.lit(0)))).withColumn(
        "size", F.col("got") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).select("conv", "h", "donor", "got", "size"), "rebuilt")
    own = place.join(convs.select("conv", "h", "got", "size"), "conv").where("pos > h").select(
        "conv", (F.col("pos") - F.col("h") + F.col("got")).alias("pos"), "digest", "bytes", "size")
    first = place.where(F.col("pos") <= most).select(F.col("conv").alias("donor"), "pos", "digest", "bytes")
    lent = convs.select("conv", "donor", "got", "size").join(first, "donor").where("pos <= got").select("conv", "pos", "digest", "bytes", "size")
    rows = own.unionByName(lent).withColumn("last", F.col("pos") == F.col("size")).drop("size")
    return rows, convs.where("size = 0").select("conv")


def _subtree_sums(chains: DataFrame, sums: tuple[str, ...]) -> DataFrame:
    """``chain`` and, per column of ``sums``, its total over the chain and all that hang below it (``up``: the chain it hangs on)."""
    state = chains.select("chain", F.col("up").alias("hop"), *sums).checkpoint()
    for _ in range(MAX_ROUNDS):
        if state.where("hop IS NOT NULL").isEmpty():
            return state.drop("hop")
        below = state.where("hop IS NOT NULL").groupBy(F.col("hop").alias("chain")).agg(*[F.sum(c).alias(f"below_{c}") for c in sums])
        jumps = state.select(F.col("chain").alias("hop"), F.col("hop").alias("next"))
        state = state.join(below, "chain", "left").join(jumps, "hop", "left").select(
            "chain", F.col("next").alias("hop"), *[(F.col(c) + F.coalesce(f"below_{c}", F.lit(0))).alias(c) for c in sums]).checkpoint()
    raise RuntimeError(f"chains deeper than 2 ** {MAX_ROUNDS}")


def _digests(batches: Iterator[pa.RecordBatch], kind: pa.Schema) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's strings of ids, in order; rows come sorted by node."""
    now, state, done = None, None, []
    for batch in batches:
        for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids"))):
            if (a, b) == now:
                state.update(b",")
            else:
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = (a, b), hashlib.sha256()
            state.update(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kind.types)], schema=kind)
            done = []
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*now, state.hexdigest()), kind.types)], schema=kind)


def prefix_trie(rows: DataFrame, empty: DataFrame) -> DataFrame:
    """Nodes of the trie over ``conv, pos, digest, bytes, last`` (places from 1, without gaps) and conversations without turns.

    Per node ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (bytes of the last turns that all members but one need not store, summed over the subtree), ``ends_sha256``.
    """
    placed = rows.select("conv", "pos", F.xxhash64("digest", "pos").alias("hash_a"), F.xxhash64("pos", "digest").alias("hash_b"), "bytes", "last")
    fixed = fixed_order(placed, ["conv", "pos"])
    held = carried(fixed, "conv", {c: F.bit_xor(f"hash_{c[-1]}").alias(c) for c in ("held_a", "held_b")}, F.bit_xor)
    # at most one conversation a partition began earlier
    ready = fixed.join(F.broadcast(held.withColumnsRenamed({"conv": "_c"})), (F.col("_pid") == F.col("_p")) & (F.col("conv") == F.col("_c")), "left")
    parts = written(map_batches(ready.select(*placed.columns, "held_a", "held_b"), _batches, _EXPANDED), "expanded")

    ends = parts.where("kind = 1").select("a", "b", "conv").unionByName(empty.select(F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"), "conv"))
    merged = parts.where("kind = 0").groupBy("a", "b").agg(F.min("conv").alias("conv"), F.sum("n").alias("n"), *[
        F.first(c).alias(c) for c in ("up_a", "up_b", "depth", "bytes")])
    root = ends.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n")).where("n > 0").select(
        F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"), "conv", "n", *[
            F.lit(None).cast("bigint").alias(c) for c in ("up_a", "up_b")], F.lit(0).cast("bigint").alias("depth"), F.lit(0).cast("bigint").alias("bytes"))
    nodes = written(merged.unionByName(root).withColumn("saved", (F.col("n") - 1) * F.col("bytes")), "nodes")

    # chains: nodes of one smallest member, hanging on a node of another
    chains = nodes.groupBy("conv").agg(F.min(F.struct("depth", "up_a", "up_b")).alias("top"), F.max("depth").alias("bottom"), F.sum("saved").alias("saved"))
    chains = chains.select(F.col("conv").alias("chain"), "top.*", "bottom", "saved")
    holders = nodes.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv").alias("up"))
    chains = written(chains.join(holders, ["up_a", "up_b"], "left").select(
        "chain", "up", "bottom", "saved", F.col("depth").alias("top"), (F.col("depth") - 1).alias("at")), "chains")
    hung = chains.where("up IS NOT NULL").groupBy(F.col("up").alias("conv"), F.col("at").alias("depth")).agg(F.count(F.lit(1)).alias("hung"))
    bare = chains.join(hung.withColumnsRenamed({"conv": "chain", "depth": "bottom"}), ["chain", "bottom"], "left")
    totals = _subtree_sums(bare.select("chain", "up", "saved", F.col("hung").isNull().cast("bigint").alias("leaves")), ("saved", "leaves"))
    below = chains.where("up IS NOT NULL").select("chain", "up", "at").join(totals, "chain").groupBy(
        F.col("up").alias("conv"), F.col("at").alias("depth")).agg(
            F.count(F.lit(1)).alias("hung"), F.sum("saved").alias("below_saved"), F.sum("leaves").alias("below_leaves"))

    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint"))
    # the tops' parents are on other chains; the side of the chains has one row per chain, so a long chain is split by the skew join
    full = nodes.join(below, ["conv", "depth"], "left").join(
        chains.select(F.col("chain").alias("conv"), "up", "top", "bottom"), "conv").select(
            "a", "b", "conv", "depth", "n", (zero("hung") + (F.col("depth") < F.col("bottom")).cast("bigint")).alias("n_children"),
            F.when(F.col("depth") > F.col("top"), F.col("conv")).otherwise(F.col("up")).alias("parent_conv_id"),
            (F.col("saved") + zero("below_saved")).alias("own_saved"),
            (zero("below_leaves") + ((F.col("depth") == F.col("bottom")) & F.col("hung").isNull()).cast("bigint")).alias("own_leaves"))
    summed = running_sums(fixed_order(full, ["conv", F.col("depth").desc()]), "conv", {"saved_tokens": "own_saved", "n_leaves": "own_leaves"})

    strings = ends.groupBy("a", "b", F.shiftright("conv", CHUNK_BITS).alias("chunk")).agg(F.sort_array(F.collect_list("conv")).alias("ids")).select(
        "a", "b", "chunk", F.array_join(F.transform("ids", lambda c: c.cast("string")), ",").alias("ids"))
    hashed = map_batches(strings.repartition("a", "b").sortWithinPartitions("a", "b", "chunk"), _digests, "a bigint, b bigint, ends_sha256 string")
    return summed.join(hashed, ["a", "b"], "left").select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
