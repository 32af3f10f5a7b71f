"""Exact global positions without a single-partition window.

Two routes:

* ``hash_positions`` — order by ``md5(seed:key)``. Rows fall into hex-prefix
  buckets (uniform whatever the data, because the hash is); the per-bucket
  counts form a table bounded by ``16**digits`` rows whose running sum is
  broadcast back, and ``row_number`` runs inside each bucket. One shuffle, keyed
  by bucket.
* ``sorted_positions`` — any order. A range-partitioned sort of the order's columns alone, which
  end in a unique key (so a hot leading value is still split between
  partitions), materialised with ``checkpoint()`` so the partition layout is
  fixed, then ``offset(partition) + index inside the partition``. The offsets
  table has one row per partition. Spark sizes the partitions and, with
  ``spark.cleaner.referenceTracking.cleanCheckpoints``, removes the checkpoint when its frame is gone.

``running_sums`` gives running totals inside groups over the same layout, so that a
group of any size is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lexgrid.session import ensure_checkpoint_dir


def hash_key(key: Column | str, seed: int | str) -> Column:
    """``md5('<seed>:<key>')`` as 32 lower-case hex digits (same in DuckDB); a null key counts as empty."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(k.cast("string"), F.lit(""))))


def hash_bucket(h: Column, digits: int) -> Column:
    return F.conv(F.substring(h, 1, digits), 16, 10).cast("int")


def _offsets(counts: DataFrame, bucket: str, n: str, out: str) -> DataFrame:
    """Exclusive running sum over a small, bounded table (buckets or partitions)."""
    w = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(bucket, F.coalesce(F.sum(n).over(w), F.lit(0)).cast("long").alias(out))


def hash_positions(df: DataFrame, key: str, seed: int | str = 42, name: str = "position",
                   digits: int = 4) -> DataFrame:
    """Add ``name`` = 1-based position of each row in ``(md5(seed:key), key)`` order."""
    if not 1 <= digits <= 6:
        raise ValueError("digits must be in 1..6")
    hashed = df.withColumn("_h", hash_key(key, seed)).withColumn("_b", hash_bucket(F.col("_h"), digits))
    counts = hashed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    # bounded by 16**digits rows: safe to broadcast
    offsets = F.broadcast(_offsets(counts, "_b", "_n", "_off"))
    w = Window.partitionBy("_b").orderBy("_h", key)
    return (hashed.join(offsets, "_b")
            .withColumn(name, (F.col("_off") + F.row_number().over(w)).cast("long"))
            .drop("_h", "_b", "_off"))


def hash_threshold(df: DataFrame, key: str, k: int | Callable[[int], int], seed: int | str = 42,
                   digits: int = 5) -> tuple[str, object] | None:
    """The ``(hash, key)`` of the k-th row in hash order, or None when k < 1.

    ``k`` may be a function of the row count. The key column is read twice:
    once for the bucket counts (a table bounded by ``16**digits`` rows, cached
    while the boundary is found) and once for a row_number over the rows of
    the boundary bucket (about n / 16**digits rows, uniform by construction).
    """
    hashed = df.select(key).withColumn("_h", hash_key(key, seed)) \
        .withColumn("_b", hash_bucket(F.col("_h"), digits))
    counts = hashed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")).cache()
    try:
        if callable(k):
            total = counts.agg(F.sum("_n")).first()[0] or 0
            k = k(int(total))
        if k < 1:
            return None
        w = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
        cum = counts.withColumn("_cum", F.sum("_n").over(w))
        boundary = cum.where(F.col("_cum") >= k).orderBy("_b").select("_b", "_n", "_cum").first()
    finally:
        counts.unpersist()
    if boundary is None:
        return None
    b_star, n_b, cum_b = boundary["_b"], boundary["_n"], boundary["_cum"]
    r = k - (cum_b - n_b)
    inner = Window.partitionBy("_b").orderBy("_h", key)
    row = (hashed.where(F.col("_b") == b_star)
           .withColumn("_r", F.row_number().over(inner))
           .where(F.col("_r") == r).select("_h", key).first())
    return (row["_h"], row[key])


def at_or_before(key: str, threshold: tuple[str, object], seed: int | str) -> Column:
    """Row predicate: ``(hash, key) <= threshold`` in hash order."""
    h = hash_key(key, seed)
    th, tk = threshold
    return (h < F.lit(th)) | ((h == F.lit(th)) & (F.col(key) <= F.lit(tk)))


def sorted_positions(df: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """Add ``name`` = 1-based position in ``order`` (which must end in a unique key).

    Where ``order`` names columns, only these are sorted: their scan is pruned, the sorted keys are
    what is checkpointed, and the rows get their position by a join on the unique key, so the other
    columns are read once. An order with expressions sorts the rows as they are.
    """
    if any(not isinstance(c, str) for c in order) or set(df.columns) <= set(order):
        return numbered(df, order, name)
    return with_positions(df, key_positions(df, order, name), order[-1])


def key_positions(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``key, name``: the position of each key (the last column of ``order``), one narrow row each."""
    return numbered(df.select(*dict.fromkeys(order)), order, name).select(order[-1], name)


def with_positions(df: DataFrame, keys: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Rows of ``df`` with the other columns of ``keys``; the key may be null once."""
    own = keys.withColumnRenamed(key, "_key")
    joined = df.join(own, F.col(key).eqNullSafe(F.col("_key")), how)
    return joined if how == "left_semi" else joined.drop("_key")


def fixed_order(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``df`` sorted by range, in partitions fixed by a reliable checkpoint, with ``_pid``, the partition.

    Spark sizes the partitions by their bytes. Meant for narrow rows: they are written
    into ``spark.checkpoint.dir``.
    """
    ensure_checkpoint_dir(df.sparkSession)
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    return df.repartitionByRange(*cols).sortWithinPartitions(*cols).checkpoint(eager=True).withColumn(
        "_pid", F.spark_partition_id())


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """``sorted_positions`` of narrow rows: a range-partitioned sort, then offset + index in the partition."""
    tagged = fixed_order(df, order).withColumn("_mid", F.monotonically_increasing_id())
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: safe to broadcast
    offsets = F.broadcast(_offsets(counts, "_pid", "_n", "_off"))
    local_index = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (tagged.join(offsets, "_pid").withColumn(name, (F.col("_off") + local_index + 1).cast("long"))
            .drop("_pid", "_mid", "_off"))


def running_sums(fixed: DataFrame, group: str, sums: Mapping[str, str]) -> DataFrame:
    """Add running totals inside each group, the row itself included.

    ``fixed`` comes from ``fixed_order`` with ``group`` first in the order; ``sums`` names the
    (long, not null) column behind each total. A group may run over any number of partitions: what
    earlier partitions hold of it is one row per partition and group, and only groups
    that began earlier, at most one a partition, are broadcast back. Null is a group like any other.
    """
    carry = carried(fixed, group, {out: F.sum(c).alias(out) for out, c in sums.items()}, F.sum)
    held = {out: f"_before_{out}" for out in sums}
    ready = fixed.join(F.broadcast(carry.withColumnsRenamed({**held, group: "_g"})), (F.col("_pid") == F.col("_p"))
                       & F.col(group).eqNullSafe(F.col("_g")), "left").drop("_p", "_g")
    fields = [f for f in ready.schema.fields if f.name not in held.values()]
    schema = StructType([*fields, *[StructField(out, LongType(), True) for out in sums]])

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        last, total, started = None, dict.fromkeys(sums, 0), False
        for b in batches:
            if not b.num_rows:
                continue
            g = b.column(group)
            if pa.types.is_dictionary(g.type):
                g = g.cast(g.type.value_type)
            change = np.ones(b.num_rows, bool)
            same = pc.fill_null(pc.equal(g[1:], g[:-1]), False).to_numpy(zero_copy_only=False)
            null = g.is_null().to_numpy(zero_copy_only=False)
            change[1:] = ~(same | (null[1:] & null[:-1]))
            change[0] = not (started and g[0].as_py() == last)
            begins = np.flatnonzero(change)
            extra = []
            for out, c in sums.items():
                own = np.cumsum(b.column(c).to_numpy(zero_copy_only=False).astype(np.int64))
                base = np.zeros(len(own), np.int64)
                before = pc.fill_null(b.column(held[out]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                # the total at the start of each run, then what earlier partitions hold
                at = np.concatenate([[0], begins]) if not len(begins) or begins[0] else begins
                start = before[at] - np.where(at > 0, own[at - 1], 0)
                if not change[0]:
                    start[0] = total[out]
                base = np.repeat(start, np.diff(np.r_[at, len(own)]))
                own = own + base
                total[out] = int(own[-1])
                extra.append(pa.array(own))
            last, started = g[-1].as_py(), True
            yield pa.RecordBatch.from_arrays([b.column(f.name) for f in fields] + extra, names=schema.names)

    return ready.mapInArrow(run, schema)


def carried(fixed: DataFrame, group: str, totals: Mapping[str, Column], add: Callable[[str], Column]) -> DataFrame:
    """``_p, group, totals``: what partitions before ``_p`` hold of a group, where they hold any of it."""
    per = fixed.groupBy("_pid", group).agg(*totals.values())
    w = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return per.select(F.col("_pid").alias("_p"), group, F.count(F.lit(1)).over(w).alias("_earlier"),
                      *[add(c).over(w).alias(c) for c in totals]).where("_earlier > 0").drop("_earlier")
