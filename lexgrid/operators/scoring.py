"""Model scoring as a column function.

The model is always a user callable. ``make_predict_fn`` is called once per
Python worker (``predict_batch_udf`` caches it), and receives Arrow-backed
NumPy batches, so the per-row cost is one array element, not one Python call.
Keep the UDF last in its stage: filters, joins and projections run before it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DataType, DoubleType, LongType, StringType, StructField,
                               StructType)

from lexgrid.operators.batching import make_batches

DEFAULT_BATCH = 16


def class_scorer(make_predict_fn: Callable, batch_size: int = DEFAULT_BATCH):
    """A column function text -> ``array<double>`` logits."""
    return predict_batch_udf(make_predict_fn, return_type=ArrayType(DoubleType()),
                             batch_size=batch_size)


def text_generator(make_predict_fn: Callable, batch_size: int = DEFAULT_BATCH):
    """A column function prompt -> generated text (the callable must be deterministic)."""
    return predict_batch_udf(make_predict_fn, return_type=StringType(), batch_size=batch_size)


def score_classes(df: DataFrame, text: str, make_predict_fn: Callable,
                  batch_size: int = DEFAULT_BATCH, out: str = "logits") -> DataFrame:
    return df.withColumn(out, class_scorer(make_predict_fn, batch_size)(F.col(text)))


def generate(df: DataFrame, prompt: str, make_predict_fn: Callable,
             batch_size: int = DEFAULT_BATCH, out: str = "generated") -> DataFrame:
    return df.withColumn(out, text_generator(make_predict_fn, batch_size)(F.col(prompt)))


def score_exact_batches(df: DataFrame, batch_col: str, make_batch_fn: Callable,
                        out: str, out_type: DataType) -> DataFrame:
    """Score whole ``make_batches`` groups when a callable needs the exact batch.

    ``make_batch_fn()`` returns ``f(pdf) -> sequence`` (one value per row of the
    batch). Groups hold at most the batch size, so no group is unbounded.
    """
    schema = StructType(list(df.schema.fields) + [StructField(out, out_type, True)])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        fn = _cached(make_batch_fn)
        pdf = pdf.copy()
        pdf[out] = list(fn(pdf))
        return pdf

    return df.groupBy(batch_col).applyInPandas(run, schema=schema)


def score_ordered_batches(df: DataFrame, order: Sequence[Column | str], size: int,
                          make_batch_fn: Callable, out: str, out_type: DataType,
                          batch_col: str = "batch_id") -> DataFrame:
    """Q5 + exact-batch scoring: one model call per batch of ``make_batches``, in order.

    A batch goes to one task; a task takes its batches one after the other in an ordered
    ``mapInPandas`` pass that holds back at most one batch of rows between Arrow batches.
    ``make_batch_fn`` is as in ``score_exact_batches``.
    """
    schema = StructType(list(df.schema.fields) + [StructField(batch_col, LongType(), True),
                                                  StructField(out, out_type, True)])
    cols = [f.name for f in schema.fields[:-1]]
    batched = make_batches(df, order, size, batch_col, "_pos").repartition(batch_col).sortWithinPartitions(batch_col, "_pos").select(*cols)

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        fn = _cached(make_batch_fn)
        pdf = pdf.reset_index(drop=True)
        pdf[out] = list(fn(pdf))
        return pdf

    def runs(batches):
        carry = None
        for pdf in batches:
            if carry is not None:
                pdf = pd.concat([carry, pdf], ignore_index=True)
            if pdf.empty:
                continue
            tail = pdf[batch_col] == pdf[batch_col].iat[-1]
            ready, carry = pdf[~tail], pdf[tail]
            if not ready.empty:
                yield pd.concat([score(g) for _, g in ready.groupby(batch_col, sort=False)],
                                ignore_index=True)
        if carry is not None and not carry.empty:
            yield score(carry)

    return batched.mapInPandas(runs, schema)


_CACHE: dict[int, tuple[Callable, Callable]] = {}
_CACHE_SIZE = 2


def _cached(make_fn: Callable) -> Callable:
    """The model built by ``make_fn``, once per factory object in this worker.

    A factory pickled by value is a new object in every task, so the cache
    keeps only the last few models instead of one per task. The factory is
    held with its model, so its ``id`` cannot be reused while cached.
    """
    key = id(make_fn)
    hit = _CACHE.get(key)
    if hit is None or hit[0] is not make_fn:
        while len(_CACHE) >= _CACHE_SIZE:
            _CACHE.pop(next(iter(_CACHE)))
        hit = _CACHE[key] = (make_fn, make_fn())
    return hit[1]
