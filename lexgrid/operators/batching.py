"""Row slices, fixed-size batches and per-batch padding.

Batches follow an explicit order (ending in a unique key), numbered from 0,
``size`` rows each, the last possibly short. Only the order's columns are sorted
(``ranking.sorted_positions``). Padding width is the longest row of the batch, a
window partitioned by it: at most ``size`` rows per key for batches, so no skew.

``PositionIndex`` keeps a table in its order, cut into ranges of known positions, so
that later slices and batches read their own ranges only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexgrid.functions.sequences import pad_to, padded_mask, truncate
from lexgrid.operators.ranking import key_positions, sorted_positions, with_positions


def row_slice(df: DataFrame, start: int, stop: int | None, order: Sequence[Column | str]) -> DataFrame:
    """Rows ``start`` (inclusive) .. ``stop`` (exclusive) of ``order``, 0-based, clipped.

    Exact positions of the keys, whatever the size of the slice; the rows themselves are read once and
    not sorted (they are where ``order`` holds expressions).
    """
    if any(not isinstance(c, str) for c in order):
        return _between(sorted_positions(df, order, "_pos"), "_pos", start, stop).drop("_pos")
    keys = _between(key_positions(df, order, "_pos"), "_pos", start, stop)
    return with_positions(df, keys, order[-1], "left_semi")


def _between(df: DataFrame, pos: str, start: int, stop: int | None) -> DataFrame:
    if start < 0 or (stop is not None and stop < start):
        raise ValueError("need 0 <= start <= stop")
    cond = F.col(pos) > start
    return df.where(cond if stop is None else cond & (F.col(pos) <= stop))


class PositionIndex:
    """A stored copy of a table in its order: ``_pos``, the 1-based position, and ``_part``, the
    range of ``rows`` positions it lies in, which is the folder too.

    A slice, or a run of batches, reads the folders of its own ranges and no others.
    """

    def __init__(self, spark: SparkSession, path: str, rows: int):
        self.spark, self.path, self.rows = spark, path, rows

    @classmethod
    def build(cls, df: DataFrame, order: Sequence[str], path: str, rows: int = 1 << 20) -> "PositionIndex":
        placed = sorted_positions(df, order, "_pos").withColumn("_part", F.floor((F.col("_pos") - 1) / rows).cast("long"))
        placed.repartition("_part").sortWithinPartitions("_part", "_pos").write.partitionBy("_part").parquet(path)
        return cls(df.sparkSession, path, rows)

    def slice(self, start: int, stop: int | None = None) -> DataFrame:
        """C7 from the index, with ``_pos``."""
        stored = _between(self.spark.read.parquet(self.path), "_pos", start, stop).where(F.col("_part") >= start // self.rows)
        if stop is not None:
            stored = stored.where(F.col("_part") <= max(stop - 1, start) // self.rows)
        return stored.drop("_part")

    def batches(self, first: int, last: int, size: int = 16, batch_col: str = "batch_id") -> DataFrame:
        """Q5 from the index: batches ``first`` .. ``last`` (inclusive) of ``size`` rows."""
        return self.slice(first * size, (last + 1) * size).withColumn(
            batch_col, F.floor((F.col("_pos") - 1) / size).cast("long")).drop("_pos")


def make_batches(df: DataFrame, order: Sequence[Column | str], size: int = 16,
                 batch_col: str = "batch_id", position_col: str | None = None) -> DataFrame:
    """Q5: ``batch_id = floor((position - 1) / size)`` over an exact global position."""
    if size < 1:
        raise ValueError("size must be >= 1")
    pos = position_col or "_pos"
    ranked = sorted_positions(df, order, pos)
    out = ranked.withColumn(batch_col, F.floor((F.col(pos) - 1) / size).cast("long"))
    return out if position_col else out.drop(pos)


def pad_batch(df: DataFrame, ids: str, batch_col: str = "batch_id", side: str = "right",
              pad_id: int = 0, max_len: int | None = None, out_ids: str = "input_ids",
              out_mask: str = "attention_mask") -> DataFrame:
    """Q2 + Q3 + Q4: truncate, then pad every row to the longest row of its batch."""
    arr = truncate(ids, max_len) if max_len else F.col(ids)
    staged = df.withColumn("_ids", arr)
    width = F.max(F.size("_ids")).over(Window.partitionBy(batch_col))
    return (staged.withColumn("_w", width)
            .withColumn(out_mask, padded_mask("_ids", F.col("_w"), side))
            .withColumn(out_ids, pad_to("_ids", F.col("_w"), pad_id, side))
            .drop("_ids", "_w"))


def padded_batches(df: DataFrame, order: Sequence[Column | str], ids: str, size: int = 16,
                   side: str = "right", pad_id: int = 0, max_len: int | None = None,
                   batch_col: str = "batch_id", out_ids: str = "input_ids",
                   out_mask: str = "attention_mask") -> DataFrame:
    """Q5 + Q2-Q4: ``make_batches`` then ``pad_batch``, both with ``size`` rows a batch."""
    padded = pad_batch(make_batches(df, order, size, batch_col), ids, batch_col, side, pad_id, max_len, out_ids, out_mask)
    return padded.select(*df.columns, batch_col, out_ids, out_mask)


def unpad(ids: Column | str, mask: Column | str) -> Column:
    """Inverse of padding: keep ids whose mask is 1."""
    i = F.col(ids) if isinstance(ids, str) else ids
    m = F.col(mask) if isinstance(mask, str) else mask
    kept = F.filter(F.arrays_zip(i.alias("i"), m.alias("m")), lambda z: z["m"] == 1)
    return F.transform(kept, lambda z: z["i"])
