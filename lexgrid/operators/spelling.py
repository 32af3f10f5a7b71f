"""Spelling signatures of names, and a persistent index over them.

Two names are *variants* when they hold the same digits and share a signature:

* deleting at most ``k`` characters from each makes them equal (k = 1 covers one
  substitution, one insertion or deletion, and a swap of neighbouring
  characters). Results shorter than ``min_len`` don't count, except the name itself;
* names written without spaces between words (Han script): they share a beginning of ``STEM`` characters or more
  that is at least half of each and tells enough. A beginning tells the sum of ``log2(names / names with it)`` over its
  character bigrams, and enough is ``2 log2(names)``, the point where chance alone gives about one pair. The name of a place or a
  kind of shop, which many names share, tells little, so it links nothing.

Signatures are 128-bit hashes, two running xors of the characters and their places. The hash of any deletion
variant comes from running totals, so a name of L characters costs about L signatures of a few bytes for k = 1,
whatever its length, and no variant string is ever made. All names of a signature link to the smallest of them: star edges,
linear in the signatures, never all pairs.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgrid.operators.components import connected_components
from lexgrid.session import scratch_path

DEFAULT_K = 1
DEFAULT_MIN_LEN = 2
STEM = 4
TOGETHER = 1 << 18
PRIOR = 8                   # names without any of the bigrams at hand that are counted from the start
HAN = "^[^ ]*[\\x{4E00}-\\x{9FFF}][^ ]*$"
NODE, SIGNATURE = ["n1", "n2"], ["s1", "s2"]

_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_STEM_TAG = np.uint64(0x5851F42D4C957F2D)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 (bijective on 64 bits)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _cells(points: np.ndarray, place: np.ndarray, seed: int) -> np.ndarray:
    return _mix(_mix(points.astype(np.uint64) + np.uint64(seed)) ^ (place.astype(np.uint64) * np.uint64(seed)))


def _running(points: np.ndarray, shift: int, seed: int) -> np.ndarray:
    """Per row (a name), the running xor over characters and their places, ``shift`` places further left; entry i covers the first i."""
    place = np.arange(points.shape[1], dtype=np.uint64) - np.uint64(shift)
    cells = _cells(points, place, seed)
    return np.concatenate([np.zeros((len(points), 1), np.uint64), np.bitwise_xor.accumulate(cells, axis=1)], 1)


def _variants(points: np.ndarray, k: int, seed: int) -> list[np.ndarray]:
    """Per row, hashes of the name with exactly 0, 1, ... ``k`` characters deleted (in the order of the deleted places)."""
    n = points.shape[1]
    total = [_running(points, m, seed) for m in range(k + 1)]
    out = [total[0][:, n:]]
    held, last = np.zeros((len(points), 1), np.uint64), np.full(1, -1)      # what stands before the last deletion, and its place
    for m in range(1, min(k, n) + 1):
        room = n - 1 - last
        at = np.repeat(last + 1, room) + np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room)
        held = np.repeat(held, room, axis=1) ^ total[m - 1][:, at] ^ total[m - 1][:, np.repeat(last + 1, room)]
        last = at
        out.append(held ^ total[m][:, n:] ^ total[m][:, at + 1])
    return out


def _alike_long(names: list[str], k: int, min_len: int, weights: list[list[int] | None], bound: int) -> tuple[np.ndarray, np.ndarray]:
    """``many_signatures`` of names of one length."""
    points = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(names), -1)
    n = points.shape[1]
    digit = (points >= 48) & (points <= 57)
    length = np.arange(2, n + 1)
    told = np.array([w if w else [-1] * len(length) for w in weights], np.int64).reshape(len(names), -1)
    with_stems = np.array([bool(w) for w in weights])[:, None]
    good = with_stems & (length >= max(STEM, -(-n // 2))) & (np.cumsum(told, 1) >= bound)
    columns = []
    for seed in _SEEDS:
        with np.errstate(over="ignore"):
            cells = np.where(digit, _cells(points, np.cumsum(digit, 1) - 1, seed ^ 0xFF), np.uint64(0))
            own = _mix(np.bitwise_xor.reduce(cells, axis=1) + digit.sum(1).astype(np.uint64))
            found = [v for m, v in enumerate(_variants(points, k, seed)) if m == 0 or n - m >= min_len]
            found.append(_running(points, 0, seed)[:, 2:] ^ _STEM_TAG)
            columns.append(_mix(np.concatenate(found, 1) ^ own[:, None]))
    kept = np.ones(columns[0].shape, bool)
    kept[:, kept.shape[1] - good.shape[1]:] = good
    row, one, two = np.nonzero(kept)[0], columns[0][kept], columns[1][kept]
    order = np.lexsort((two, one, row))
    row, one, two = row[order], one[order], two[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])]
    return row[new], np.stack([one[new], two[new]], 1).view(np.int64)


def many_signatures(names: list[str], k: int, min_len: int, weights: list[list[int] | None], bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Which name, and rows of two 64-bit hashes: the distinct signatures of each name (``weights``: of its bigrams, for
    its stems). Names of one length are worked out together, about ``TOGETHER`` signatures at a time."""
    order = sorted(range(len(names)), key=lambda i: len(names[i]))
    at, who, rows = 0, [np.empty(0, np.int64)], [np.empty((0, 2), np.int64)]
    while at < len(order):
        n = len(names[order[at]])
        most, stop = max(1, TOGETHER // (n + sum(math.comb(n, m) for m in range(k + 1)))), at + 1
        while stop < len(order) and stop - at < most and len(names[order[stop]]) == n:
            stop += 1
        part = order[at:stop]
        row, found = _alike_long([names[i] for i in part], k, min_len, [weights[i] for i in part], bound)
        who.append(np.array(part, np.int64)[row])
        rows.append(found)
        at = stop
    return np.concatenate(who), np.concatenate(rows)


def name_signatures(name: str, k: int, min_len: int, weights: list[int] | None, bound: int) -> np.ndarray:
    """Rows of two 64-bit hashes: the distinct signatures of one name (``weights``: of its bigrams, for its stems)."""
    return many_signatures([name], k, min_len, [weights], bound)[1]


def distinct_names(names: DataFrame, name: str) -> DataFrame:
    """``n1, n2, name``: the distinct names, not null, and a 128-bit hash to move them by. They are read many times, so
    ``names`` is worked out here, once (a filter in front would be pushed down and work the names out again)."""
    one = names.select(F.col(name).alias("name")).distinct().checkpoint().where(F.col("name").isNotNull())
    return one.select(F.xxhash64("name").alias("n1"), F.xxhash64(F.reverse("name"), F.length("name")).alias("n2"), "name")


def _bigrams(named: DataFrame) -> DataFrame:
    han = named.where(F.regexp_like("name", F.lit(HAN)) & (F.length("name") >= STEM))
    grams = F.transform(F.sequence(F.lit(1), F.length("name") - 1), lambda i: F.substring("name", i, F.lit(2)))
    return han.select(*NODE, F.posexplode(grams).alias("pos", "gram"))


@dataclass
class NameStatistics:
    """How much each bigram of the names without spaces tells (``gram, weight``, thousandths of a bit), and what is enough."""

    grams: DataFrame
    bound: int

    @classmethod
    def of(cls, named: DataFrame) -> "NameStatistics":
        """Statistics of ``distinct_names``."""
        grams = _bigrams(named)
        n = PRIOR + named.where(F.regexp_like("name", F.lit(HAN)) & (F.length("name") >= STEM)).count()
        held = grams.select(*NODE, "gram").distinct().groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
        weight = F.round(1000 * F.log2(F.lit(float(n)) / F.col("n"))).cast("bigint")
        return cls(held.select("gram", weight.alias("weight")).checkpoint(), round(2000 * math.log2(n)))


def _signature_rows(k: int, min_len: int, bound: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n1, n2 = (b.column(c).to_numpy() for c in NODE)
            who, rows = many_signatures(b.column("name").to_pylist(), k, min_len, b.column("weights").to_pylist(), bound)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (n1[who], n2[who], rows[:, 0], rows[:, 1])], names=NODE + SIGNATURE)
    return run


def signatures(named: DataFrame, k: int, min_len: int, statistics: NameStatistics) -> DataFrame:
    """``n1, n2, s1, s2``: a row per name and signature."""
    told = _bigrams(named).join(statistics.grams, "gram", "left").groupBy(*NODE).agg(
        F.array_sort(F.collect_list(F.struct("pos", F.coalesce("weight", F.lit(statistics.bound // 2)).alias("w")))).alias("g"))
    ready = named.join(told.select(*NODE, F.col("g.w").alias("weights")), NODE, "left").select(*NODE, "name", "weights")
    return ready.mapInArrow(_signature_rows(k, min_len, statistics.bound), "n1 bigint, n2 bigint, s1 bigint, s2 bigint")


def _with_company(sigs: DataFrame) -> DataFrame:
    """The rows whose signature several names have."""
    node = F.struct(*NODE)
    several = sigs.groupBy(*SIGNATURE).agg(F.min(node).alias("lo"), F.max(node).alias("hi")).where("lo < hi").select(*SIGNATURE)
    return sigs.join(several, SIGNATURE)


def variant_links(names: DataFrame, name: str, k: int = DEFAULT_K, min_len: int = DEFAULT_MIN_LEN,
                  statistics: NameStatistics | None = None) -> DataFrame:
    """Star edges ``src -> dst`` (dst = smallest name sharing a signature)."""
    return links_between(distinct_names(names, name), k, min_len, statistics)


def links_between(named: DataFrame, k: int = DEFAULT_K, min_len: int = DEFAULT_MIN_LEN, statistics: NameStatistics | None = None) -> DataFrame:
    """``variant_links`` of ``distinct_names``."""
    sigs = signatures(named, k, min_len, statistics or NameStatistics.of(named)).checkpoint()
    shared = _with_company(sigs).join(named, NODE).select("name", *SIGNATURE).checkpoint()
    rep = shared.groupBy(*SIGNATURE).agg(F.min("name").alias("rep"))
    return (shared.join(rep, SIGNATURE).where(F.col("name") != F.col("rep"))
            .select(F.col("name").alias("src"), F.col("rep").alias("dst")).distinct())


def largest_blocks(names: DataFrame, name: str, n: int = 20, k: int = DEFAULT_K, min_len: int = DEFAULT_MIN_LEN) -> DataFrame:
    """``s1, s2, names, example``: the signatures that most names share, counted exactly (top ``n``: the report's length)."""
    named = distinct_names(names, name)
    shared = _with_company(signatures(named, k, min_len, NameStatistics.of(named)).checkpoint()).join(named, NODE)
    return shared.groupBy(*SIGNATURE).agg(F.count(F.lit(1)).alias("names"), F.min("name").alias("example")).orderBy(
        F.desc("names"), "example", *SIGNATURE).limit(n)


class SpellingIndex:
    """Clusters of names that grow by batches, in the folder ``path``.

    Tables, bucketed by hash so that a lookup shuffles the batch only: ``names`` (n1, n2, name, cluster as it
    was when the name came), ``signatures`` (s1, s2, cluster as it was), and ``merged`` (version, cluster, now), the few clusters that
    later names joined; the last version holds. A cluster is named by the smallest hash of its first batch and keeps that name until it
    is joined to an older one, so ids are stable. Bigram statistics, ``k`` and the bucket count are fixed when
    the index is made and kept beside it; so a name's links don't depend on what comes later, and many
    batches give the clusters of one.
    """

    TABLES = {"names": "n1 BIGINT, n2 BIGINT, name STRING, c1 BIGINT, c2 BIGINT", "signatures": "s1 BIGINT, s2 BIGINT, c1 BIGINT, c2 BIGINT"}

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, k: int = DEFAULT_K,
                 min_len: int = DEFAULT_MIN_LEN, statistics: NameStatistics | None = None):
        """Opens the index in ``path``, or makes one there (``statistics`` are needed for that)."""
        self.spark, self.path = spark, path or scratch_path(spark, "spelling-index")
        if not self._made():
            if statistics is None:
                raise ValueError(f"no index in {self.path}, and no statistics to make one")
            n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            statistics.grams.write.parquet(f"{self.path}/grams")
            spark.createDataFrame([], "version int, c1 bigint, c2 bigint, m1 bigint, m2 bigint").write.parquet(f"{self.path}/merged")
            spark.createDataFrame([(json.dumps({"buckets": n, "k": k, "min_len": min_len, "bound": statistics.bound}),)], "value string"
                                  ).write.text(f"{self.path}/settings")
        fixed = json.loads(spark.read.text(f"{self.path}/settings").first()[0])
        if buckets is not None and buckets != fixed["buckets"]:
            raise ValueError(f"the index in {self.path} has {fixed['buckets']} buckets, not {buckets}")
        self.buckets, self.k, self.min_len = fixed["buckets"], fixed["k"], fixed["min_len"]
        self.statistics = NameStatistics(spark.read.parquet(f"{self.path}/grams"), fixed["bound"])
        stem = "spelling_" + hashlib.md5(self.path.encode()).hexdigest()
        self._tables = {t: f"{stem}_{t}" for t in self.TABLES}
        for t, columns in self.TABLES.items():
            by = "n1, n2" if t == "names" else "s1, s2"
            spark.sql(f"CREATE TABLE IF NOT EXISTS `{self._tables[t]}` ({columns}) USING parquet CLUSTERED BY ({by}) INTO {self.buckets} BUCKETS "
                      f"LOCATION '{self.path}/{t}'")

    def _made(self) -> bool:
        try:
            return not self.spark.read.text(f"{self.path}/settings").isEmpty()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return False

    def _merged(self) -> tuple[int, DataFrame]:
        """The last version of the joined clusters; a batch writes the next one."""
        merged = self.spark.read.parquet(f"{self.path}/merged")
        last = merged.agg(F.max("version")).first()[0] or 0
        return last, merged.where(F.col("version") == last).drop("version")

    def _now(self, rows: DataFrame) -> DataFrame:
        """``rows`` with their cluster ``c1, c2`` as it is now."""
        return rows.join(self._merged()[1], ["c1", "c2"], "left").withColumns({
            "c1": F.coalesce("m1", "c1"), "c2": F.coalesce("m2", "c2")}).drop("m1", "m2")

    def clusters(self) -> DataFrame:
        """``name, c1, c2`` of every name so far."""
        return self._now(self.spark.table(self._tables["names"])).select("name", "c1", "c2")

    def _append(self, table: str, rows: DataFrame) -> None:
        by = NODE if table == "names" else SIGNATURE
        rows.select(*[c.split()[0] for c in self.TABLES[table].split(", ")]).repartition(self.buckets, *by).write.insertInto(self._tables[table])
        self.spark.catalog.refreshTable(self._tables[table])

    def add(self, names: DataFrame, name: str) -> None:
        """Take in the names that are new; only their signatures are looked up."""
        known = self.spark.table(self._tables["names"])
        new = distinct_names(names, name).join(known.select(*NODE).hint("merge"), NODE, "left_anti").checkpoint()
        sigs = signatures(new, self.k, self.min_len, self.statistics).checkpoint()
        hits = self._now(sigs.join(self.spark.table(self._tables["signatures"]).hint("merge"), SIGNATURE)).select(
            *NODE, "c1", "c2").distinct().checkpoint()
        rep = sigs.groupBy(*SIGNATURE).agg(F.min(F.struct(*NODE)).alias("rep"), F.max(F.struct(*NODE)).alias("far")).where("rep < far")
        # nodes of the graph: new names, and old clusters, which come first in their order
        old, fresh = (lambda a, b: F.struct(F.lit(0).alias("kind"), F.col(a).alias("a"), F.col(b).alias("b"))), (
            lambda a, b: F.struct(F.lit(1).alias("kind"), F.col(a).alias("a"), F.col(b).alias("b")))
        edges = hits.select(fresh("n1", "n2").alias("src"), old("c1", "c2").alias("dst")).unionByName(
            sigs.join(rep, SIGNATURE).select(fresh("n1", "n2").alias("src"), fresh("rep.n1", "rep.n2").alias("dst")).where("src <> dst").distinct())
        found = connected_components(edges).checkpoint()
        joined = found.where("node.kind = 0 AND node <> component").select(
            F.col("node.a").alias("c1"), F.col("node.b").alias("c2"), F.col("component.a").alias("m1"), F.col("component.b").alias("m2"))
        # clusters that had been joined to one that is joined now follow it
        last, before = self._merged()
        follow = joined.select(F.col("c1").alias("m1"), F.col("c2").alias("m2"), F.col("m1").alias("t1"), F.col("m2").alias("t2"))
        moved = before.join(follow, ["m1", "m2"], "left").select("c1", "c2", F.coalesce("t1", "m1").alias("m1"), F.coalesce("t2", "m2").alias("m2"))
        moved.unionByName(joined).withColumn("version", F.lit(last + 1)).checkpoint().write.mode("append").parquet(f"{self.path}/merged")
        of_new = found.where("node.kind = 1").select(F.col("node.a").alias("n1"), F.col("node.b").alias("n2"), "component")
        placed = new.join(of_new, NODE, "left").select(*NODE, "name", F.coalesce("component.a", "n1").alias("c1"), F.coalesce("component.b", "n2").alias("c2")).checkpoint()
        self._append("signatures", sigs.join(self.spark.table(self._tables["signatures"]).hint("merge"), SIGNATURE, "left_anti").join(
            placed.drop("name"), NODE).groupBy(*SIGNATURE).agg(F.min(F.struct("c1", "c2")).alias("c")).select(*SIGNATURE, "c.c1", "c.c2"))
        self._append("names", placed)
