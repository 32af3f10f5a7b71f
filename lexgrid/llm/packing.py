"""Packing token sequences with non-negative least squares.

1. One Arrow pass tokenises each text, cuts full windows and leaves a tail
   shorter than a window. It also numbers, inside its own partition, the full
   windows and the tails of each length class, so no later global sort is needed;
   the table it writes fixes these numbers.
2. The histogram of tails over length classes (at most ``WINDOW // GRAIN``
   numbers) goes to the driver. Combinations of up to three classes that fill a
   window are enumerated, repeat counts are solved by non-negative least
   squares against the histogram and rounded down, and what is left is packed
   greedily, largest class first. All this depends on the classes only, never
   on the number of documents.
3. Each tail gets its rank in its class (partition offset plus local number);
   the plan is a table of rank intervals, so a join by class and interval
   gives the sequence. Offsets are running sums inside a sequence.

Defined cases: a null or empty text is the end token alone; repeated rows are
packed once each; null keys are carried through; an empty table gives no rows;
only the named columns are read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexgrid.llm.common import map_slices, written

WINDOW = 2048
GRAIN = 8
END_ID = 1
DEPTH = 3


@cache
def _encoder(path: str):
    """``text -> ids`` of the tokenizer file, without special tokens added.

    For a byte-level BPE file whose merges follow its ranks the same ids come
    out of tiktoken four times as fast (tests compare both). Texts that contain an added token's
    string, and any text that library refuses, go to the file's own tokenizer.
    """
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(path)
    slow = lambda text: own.encode(text, add_special_tokens=False).ids
    spec = json.load(open(path, encoding="utf-8"))
    ranks = _ranks(spec)
    if ranks is None:
        return slow
    import tiktoken
    fast = tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
    added = [t["content"] for t in spec.get("added_tokens") or ()]

    def encode(text: str) -> list[int]:
        if any(a in text for a in added):
            return slow(text)
        try:
            return fast.encode_ordinary(text)
        except Exception:  # a pattern limit of that library on odd texts
            return slow(text)
    return encode


# fixed value: the split pattern of byte-level BPE pre-tokenisation
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Token bytes to id, or None unless ids run in the order of the merges."""
    pre = spec.get("pre_tokenizer") or {}
    if spec["model"].get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") \
            or spec.get("normalizer") or not pre.get("use_regex", True):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    special = {t["content"] for t in spec.get("added_tokens") or ()}
    vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    order = [vocab[a + b] for a, b in merges]
    if order != sorted(order) or any(len(t) > 1 and i < 256 for t, i in vocab.items()):
        return None
    try:
        return {bytes(char[c] for c in t): i for t, i in vocab.items()}
    except KeyError:
        return None


def _cut(path: str, window: int, grain: int, end_id: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(path)
        part = TaskContext.get().partitionId()
        full = 0
        seen = np.zeros(window // grain + 2, np.int64)
        for frame in frames:
            rows = []
            for key, text in zip(frame["doc_id"], frame["text"]):
                ids = encode(text) if isinstance(text, str) else []
                raw = np.array([*ids, end_id], "<u4")
                crcs = [zlib.crc32(raw[i:i + window].tobytes()) for i in range(0, len(raw), window)]
                n_full, tail = divmod(len(raw), window)
                size = -(-tail // grain)
                rows.append((key, len(raw), part, full, tail, size, int(seen[size]), crcs))
                full += n_full
                seen[size] += tail > 0
            yield pd.DataFrame(rows, columns=["doc_id", "doc_tokens", "part", "first_full", "tail", "size", "place", "crcs"])
    return run


def combinations(classes: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Up to ``DEPTH`` of the given sizes that fill ``capacity`` exactly, largest first."""
    have = {int(c) for c in classes}
    out: list[tuple[int, ...]] = [(capacity,)] if capacity in have else []
    for a in sorted(have, reverse=True):
        if capacity - a in have and capacity - a <= a:
            out.append((a, capacity - a))
        for b in sorted(have, reverse=True):
            c = capacity - a - b
            if b <= a and 0 < c <= b and c in have:
                out.append((a, b, c))
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """Non-negative least squares by the active-set method of Lawson and Hanson."""
    m, n = a.shape
    x = np.zeros(n)
    active = np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(b).max(initial=0.0)))
    for _ in range(rounds or 3 * m):
        gain = a.T @ (b - a @ x)
        gain[active] = -np.inf
        if not n or gain.max() <= tolerance:
            break
        active[int(gain.argmax())] = True
        while True:
            s = np.zeros(n)
            s[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            if s[active].min() > 0:
                break
            low = active & (s <= 0)
            step = float(np.min(x[low] / np.maximum(x[low] - s[low], 1e-300)))
            x = x + step * (s - x)
            active &= x > tolerance * 1e-3
            x[~active] = 0
            if not active.any():
                s = x
                break
        x = s
    return x


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """``(sizes of one sequence, repeats)``, using every entry of the histogram exactly once."""
    left = {int(k): int(v) for k, v in histogram.items() if v > 0}
    out: list[tuple[tuple[int, ...], int]] = []
    sizes = np.array(sorted(left), int)
    combos = combinations(sizes, capacity)
    if combos:
        row = {int(s): i for i, s in enumerate(sizes)}
        a = np.zeros((len(sizes), len(combos)))
        for j, combo in enumerate(combos):
            for s in combo:
                a[row[s], j] += 1
        x = nnls(a, np.array([left[int(s)] for s in sizes], float))
        for j in np.argsort(-x):
            need = {s: combos[j].count(s) for s in combos[j]}
            repeats = min(int(x[j] + 1e-6), *[left[s] // k for s, k in need.items()])
            if repeats > 0:
                out.append((combos[j], repeats))
                for s, k in need.items():
                    left[s] -= k * repeats
    while left := {s: n for s, n in left.items() if n}:
        combo, room = [], capacity
        used = dict.fromkeys(left, 0)
        for s in sorted(left, reverse=True):
            while s <= room and used[s] < left[s]:
                combo.append(s)
                used[s] += 1
                room -= s
        repeats = min(left[s] // k for s, k in used.items() if k)
        out.append((tuple(combo), repeats))
        for s, k in used.items():
            left[s] -= k * repeats
    return out


def pack(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW,
         grain: int = GRAIN, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A piece's ids are the document's ids (end token last) from ``start`` on;
    ``offset`` is its place in the sequence. Sequences hold ``window`` ids at most.
    """
    spark = docs.sparkSession
    id_type = docs.schema[key].dataType.simpleString()
    cut = written(map_slices(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), _cut(tokenizer_path, window, grain, end_id),
        f"doc_id {id_type}, doc_tokens bigint, part int, first_full bigint, tail int, size int, place bigint, "
        "crcs array<bigint>"), "cut")
    full = F.floor(F.col("doc_tokens") / window).cast("bigint")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: bounded by the partitions of the scan
    fulls = cut.groupBy("part").agg(F.sum(full).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before(Window.orderBy("part"))), F.lit(0)).alias("full_base"), "n")
    tails = cut.where("tail > 0").groupBy("part", "size").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["size"]: r["n"] for r in tails.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    n_full = fulls.agg(F.sum("n")).first()[0] or 0
    # at most three intervals a combination, and the combinations come from window / grain classes
    intervals, used, at = [], {}, int(n_full)
    for sizes, repeats in plan(histogram, window // grain):
        for slot, s in enumerate(sizes):
            intervals.append((s, used.get(s, 0), used.get(s, 0) + repeats, at, slot))
            used[s] = used.get(s, 0) + repeats
        at += repeats
    steps = spark.createDataFrame(pd.DataFrame(intervals, columns=["size", "lo", "hi", "sequence", "slot"]).astype("int64"),
                                  "size bigint, lo bigint, hi bigint, sequence bigint, slot bigint") if intervals else \
        spark.createDataFrame([], "size bigint, lo bigint, hi bigint, sequence bigint, slot bigint")
    ranked = cut.where("tail > 0").join(tails.select("part", "size", F.coalesce(F.sum("n").over(
        before(Window.partitionBy("size").orderBy("part"))), F.lit(0)).alias("base")), ["part", "size"]).select(
            "doc_id", "doc_tokens", "tail", "size", (F.col("base") + F.col("place")).alias("rank"), F.element_at("crcs", -1).alias("crc"))
    placed = ranked.alias("r").join(F.broadcast(steps.alias("s")), F.expr(
        "r.size = s.size AND r.rank >= s.lo AND r.rank < s.hi")).select(
            "doc_id", (F.col("doc_tokens") - F.col("tail")).alias("start"), F.col("tail").cast("bigint").alias("length"),
            F.col("crc").alias("ids_crc32"), "doc_tokens", (F.col("sequence") + F.col("rank") - F.col("lo")).alias("sequence_id"), "slot")
    inside = before(Window.partitionBy("sequence_id").orderBy("slot"))
    last = placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("bigint")).drop("slot")
    whole = cut.where(F.col("doc_tokens") >= window).join(F.broadcast(fulls.select("part", "full_base")), "part").select(
        "doc_id", "doc_tokens", (F.col("full_base") + F.col("first_full")).alias("first"),
        F.posexplode(F.slice("crcs", F.lit(1), full.cast("int"))).alias("i", "crc")).select(
            "doc_id", (F.col("i") * window).cast("bigint").alias("start"), F.lit(window).cast("bigint").alias("length"),
            F.col("crc").alias("ids_crc32"), "doc_tokens", (F.col("first") + F.col("i")).cast("bigint").alias("sequence_id"),
            F.lit(0).cast("bigint").alias("offset"))
    return whole.unionByName(last)
