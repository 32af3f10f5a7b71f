"""Registered queries: splits, permutations, batches and slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgrid.operators import batching as B
from lexgrid.operators import splits as X
from lexgrid.plans.catalog import register
from lexgrid.plans.sqltext import hash_sql
from lexgrid.plans.tables import load
from lexgrid.session import scratch_path

SEED = 42
TEST_SIZE = 0.2
BATCH = 16

_SPLIT_SQL = f"""
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {hash_sql('doc_id', SEED)}, doc_id)
                         <= ceil({TEST_SIZE} * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
FROM documents
"""


@register("split_exact_documents", _SPLIT_SQL)
def split_exact_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact 20 % hold-out of documents, seeded, independent of partitioning."""
    docs = load(spark, sf_dir, "documents").select("doc_id")
    return X.split_exact(docs, "doc_id", TEST_SIZE, SEED)


@register("split_exact_conversations", f"""
WITH ids AS (SELECT DISTINCT conv_id FROM conversations),
s AS (SELECT conv_id, CASE WHEN row_number() OVER (ORDER BY {hash_sql('conv_id', SEED)}, conv_id)
                      <= ceil({TEST_SIZE} * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
      FROM ids)
SELECT c.conv_id, c.turn, s.split FROM conversations c JOIN s USING (conv_id)
""")
def split_exact_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 keyed by conversation: every turn goes where its conversation goes."""
    conv = load(spark, sf_dir, "conversations").select("conv_id", "turn")
    ids = conv.select("conv_id").distinct()
    split = X.split_exact(ids, "conv_id", TEST_SIZE, SEED)
    return conv.join(split, "conv_id").select("conv_id", "turn", "split")


@register("split_by_hash_documents", f"""
SELECT doc_id,
       CASE WHEN CAST(('0x' || substr({hash_sql('doc_id', SEED)}, 1, 8)) AS BIGINT)
                 < {int(round(TEST_SIZE * (1 << 32)))} THEN 'test' ELSE 'train' END AS split
FROM documents
""")
def split_by_hash_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate hold-out, one narrow projection (stream-safe)."""
    docs = load(spark, sf_dir, "documents").select("doc_id")
    return X.split_by_hash(docs, "doc_id", TEST_SIZE, SEED)


@register("split_summary_documents", f"""
SELECT split, count(*) AS rows, CAST(3 AS BIGINT) AS columns
FROM (SELECT d.*, s.split FROM documents d JOIN ({_SPLIT_SQL}) s USING (doc_id)) x
GROUP BY split
""")
def split_summary_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and columns per split."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return X.split_summary(X.split_exact(docs, "doc_id", TEST_SIZE, SEED))


@register("seeded_shuffle_documents", f"""
SELECT doc_id, row_number() OVER (ORDER BY {hash_sql('doc_id', SEED)}, doc_id) AS position
FROM documents
""")
def seeded_shuffle_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact seeded permutation of documents."""
    docs = load(spark, sf_dir, "documents").select("doc_id")
    return X.seeded_shuffle(docs, "doc_id", SEED)


@register("make_batches_documents", f"""
SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) // {BATCH} AS BIGINT) AS batch_id
FROM documents
""")
def make_batches_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: batches of 16 in key order (last one may be short)."""
    docs = load(spark, sf_dir, "documents").select("doc_id")
    return B.make_batches(docs, ["doc_id"], BATCH)


@register("batch_sizes_documents", f"""
SELECT batch_id, count(*) AS rows FROM (
  SELECT (row_number() OVER (ORDER BY doc_id) - 1) // {BATCH} AS batch_id FROM documents) b
GROUP BY batch_id
""")
def batch_sizes_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: rows per batch (all 16 but the last)."""
    docs = load(spark, sf_dir, "documents").select("doc_id")
    return B.make_batches(docs, ["doc_id"], BATCH).groupBy("batch_id") \
        .agg(F.count(F.lit(1)).alias("rows"))


SLICE_START, SLICE_STOP = 100, 300


@register("row_slice_events", f"""
SELECT event_id, event_type FROM (
  SELECT event_id, event_type, row_number() OVER (ORDER BY ts, event_id) AS pos FROM events) e
WHERE pos > {SLICE_START} AND pos <= {SLICE_STOP}
""")
def row_slice_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows 100..299 of the events in time order (the slice is the operator)."""
    ev = load(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return B.row_slice(ev, SLICE_START, SLICE_STOP, ["ts", "event_id"]).drop("ts")


@register("row_slice_indexed", f"""
SELECT event_id, event_type, user_id FROM (
  SELECT event_id, event_type, user_id, row_number() OVER (ORDER BY ts, event_id) AS pos FROM events) e
WHERE pos > {SLICE_START} AND pos <= {SLICE_STOP}
""")
def row_slice_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows from a stored position index, which reads one range of the events only."""
    ev = load(spark, sf_dir, "events").select("event_id", "ts", "event_type", "user_id")
    index = B.PositionIndex.build(ev, ["ts", "event_id"], scratch_path(spark, "positions"), rows=1024)
    return index.slice(SLICE_START, SLICE_STOP).select("event_id", "event_type", "user_id")
