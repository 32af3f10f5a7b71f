"""Reproducible train/test splits.

``split_exact`` matches a shuffled hold-out of exactly ``ceil(test_size * n)``
rows. It is independent of partitioning (the order is ``md5(seed:key)``), and
the final plan is a narrow projection: the only shuffles are over the key
column in three scalar-sized actions (see ``ranking.hash_threshold``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgrid.operators.ranking import at_or_before, hash_key, hash_positions, hash_threshold

TEST = "test"
TRAIN = "train"


def test_rows(n: int, test_size: float | int) -> int:
    """Number of test rows: a fraction is rounded up, an int is taken as is."""
    if isinstance(test_size, int):
        if not 0 <= test_size <= n:
            raise ValueError("test_size out of range")
        return test_size
    if not 0.0 <= test_size <= 1.0:
        raise ValueError("test_size must be in [0, 1]")
    return min(n, math.ceil(test_size * n))


def split_exact(df: DataFrame, key: str, test_size: float | int = 0.2, seed: int = 42,
                split_col: str = "split") -> DataFrame:
    """Add ``split`` = 'test' for the first ceil(test_size*n) rows in hash order.

    The size is exact for a key that is unique and not null; any other key is an
    error, as rows of one key can't be told apart (make one first, e.g. from
    file and line). The check is one aggregation over the key column.
    """
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(key).isNull())
    if not repeated.isEmpty():
        raise ValueError(f"split_exact needs a unique key without nulls: {key}")
    thr = hash_threshold(df, key, lambda n: test_rows(n, test_size), seed)
    if thr is None:
        return df.withColumn(split_col, F.lit(TRAIN))
    return df.withColumn(split_col, F.when(at_or_before(key, thr, seed), F.lit(TEST))
                         .otherwise(F.lit(TRAIN)))


def split_by_hash(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42,
                  split_col: str = "split") -> DataFrame:
    """Approximate size, no action and no shuffle; also valid on a stream."""
    h = hash_key(key, seed)
    u = F.conv(F.substring(h, 1, 8), 16, 10).cast("long")
    cut = int(round(test_size * (1 << 32)))
    return df.withColumn(split_col, F.when(u < F.lit(cut), F.lit(TEST)).otherwise(F.lit(TRAIN)))


def split_summary(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows and columns per split."""
    ncols = len([c for c in df.columns if c != split_col])
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("rows"),
                                     F.lit(ncols).cast("long").alias("columns"))


def seeded_shuffle(df: DataFrame, key: str, seed: int = 42, name: str = "position") -> DataFrame:
    """A seeded permutation: ``position`` in ``md5(seed:key)`` order (exact, 1-based)."""
    return hash_positions(df, key, seed, name)
