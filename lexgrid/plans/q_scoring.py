"""Registered queries: generation, answer accuracy, label encoding, exact-batch
scoring, the scoring stream, and the file sources/sinks (I4, I5, I8, E9, S1-S3, K1, K2)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from lexgrid.functions import entity as EN
from lexgrid.functions.clean import fill_missing
from lexgrid.functions import labels as L
from lexgrid.operators import metrics as M
from lexgrid.operators import scoring as S
from lexgrid.operators import splits as X
from lexgrid.plans import models
from lexgrid.plans.catalog import ALL_SCORED_SQL, SENTIMENT_PREFIX, _NAMES_SQL, all_scored, register
from lexgrid.plans.q_entity import tier_sql
from lexgrid.plans.q_text import PROMPTS_SQL, listing_prompts
from lexgrid.plans.sqltext import argmax_sql, hash_sql, length_logits_sql, sql_str
from lexgrid.plans.tables import LISTINGS_SQL, load, raw_listings
from lexgrid.session import scratch_path
from lexgrid.sources import files as IO
from lexgrid.sources import workbook as WB
from lexgrid.streaming.scoring import read_keyed, scoring_plan, start_keyed_stream, start_score_stream


def generated_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = listing_prompts(spark, sf_dir)
    return S.generate(p, "prompt", models.brand_echo)


@register("generate_brand", f"""
SELECT id, shop_brand AS generated FROM ({PROMPTS_SQL}) p
""")
def generate_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generated answer per listing prompt, Arrow-batched through the model callable."""
    return generated_listings(spark, sf_dir).select("id", "generated")


@register("answer_accuracy", f"""
SELECT tier, round(avg(CASE WHEN trim(shop_brand) = trim(brand_name) THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       count(*) AS rows, grouping(tier) = 1 AS overall
FROM (SELECT *, {tier_sql()} AS tier FROM ({PROMPTS_SQL}) p) x
GROUP BY ROLLUP (tier)
""")
def answer_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated brand vs gold, per trust tier and overall (tier null)."""
    g = generated_listings(spark, sf_dir).withColumn("tier", EN.trust_tier("laiyuan1_id", "brand_id"))
    return M.answer_accuracy(g, "generated", "brand_name", "tier")


@register("encode_label", f"""
SELECT doc_id, {_NAMES_SQL} AS pred_name, pred AS class_id FROM ({ALL_SCORED_SQL}) s
""")
def encode_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4: class names back to ids through the inverted label map."""
    s = all_scored(spark, sf_dir)
    return s.select("doc_id", "pred_name",
                    L.encode_label("pred_name", models.SENTIMENT_LABELS).alias("class_id"))


def _batch_width_model():
    """A batch-aware callable: every row sees the padded width of its batch."""
    def run(pdf: pd.DataFrame) -> np.ndarray:
        width = int(pdf["n_chars_text"].max())
        return np.full(len(pdf), width, dtype=np.int64)
    return run


@register("score_exact_batches", """
SELECT doc_id, CAST(batch_id AS BIGINT) AS batch_id,
       CAST(max(length(coalesce(text, ''))) OVER (PARTITION BY batch_id) AS INTEGER) AS batch_width
FROM (SELECT doc_id, text, (row_number() OVER (ORDER BY doc_id) - 1) // 16 AS batch_id FROM documents) b
""")
def score_exact_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5 + exact-batch scoring: the callable receives whole batches of 16, cut in
    key order; only batches at partition edges are shuffled."""
    docs = load(spark, sf_dir, "documents").select(
        "doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n_chars_text"))
    scored = S.score_ordered_batches(docs, ["doc_id"], 16, _batch_width_model, "batch_width",
                                     IntegerType())
    return scored.select("doc_id", "batch_id", "batch_width")


@register("score_stream_documents", f"""
SELECT doc_id, pred, {_NAMES_SQL} AS pred_name
FROM (SELECT doc_id, {argmax_sql('lg')} AS pred
      FROM (SELECT doc_id, {length_logits_sql(sql_str(SENTIMENT_PREFIX) + " || coalesce(text, '')")} AS lg
            FROM documents) d) s
""")
def score_stream_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I8: the scoring job as a stream over the documents files (availableNow), read back from its sink."""
    docs_schema = load(spark, sf_dir, "documents").schema
    sink = scratch_path(spark, "stream-sink")
    q = start_score_stream(spark, f"{sf_dir.rstrip('/')}/documents*.parquet", docs_schema, "doc_id",
                           "text", SENTIMENT_PREFIX, models.length_logits, models.SENTIMENT_LABELS,
                           sink, scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    return spark.read.parquet(sink)


_LABELLED_SQL = "SELECT d.doc_id, d.text, l.quality AS label FROM documents d JOIN labels l USING (doc_id)"


def _labelled_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    lab = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return docs.join(lab, "doc_id")


@register("csv_roundtrip", f"""
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '  ' || text || chr(10) WHEN 1 THEN '' WHEN 2 THEN '"' || text || ' ' ELSE text END AS text, label
FROM documents LEFT JOIN (SELECT doc_id, quality AS label FROM labels) l USING (doc_id)
""")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts, some with white space, quotes and newlines at their ends or empty, written
    as CSV and read back by header name in another column order."""
    path = scratch_path(spark, "csv")
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    lab = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    text = (F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("  "), "text", F.lit("\n"))).when(F.col("doc_id") % 5 == 1, F.lit(""))
            .when(F.col("doc_id") % 5 == 2, F.concat(F.lit('"'), "text", F.lit(" "))).otherwise(F.col("text")))
    IO.write_csv(docs.withColumn("text", text).join(lab, "doc_id", "left"), path)
    back = IO.read_labelled_csv(spark, path, "label int, text string, doc_id bigint")
    return back.select("doc_id", "text", "label")


@register("read_splits", f"""
SELECT doc_id, text, label, 'train' AS split FROM ({_LABELLED_SQL}) x
UNION ALL
SELECT doc_id, text, NULL AS label, 'test' AS split
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def read_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled train file and an unlabelled test file read as one tagged frame."""
    train_path, test_path = scratch_path(spark, "train-csv"), scratch_path(spark, "test-csv")
    labelled = _labelled_frame(spark, sf_dir)
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    IO.write_csv(labelled, train_path)
    IO.write_csv(docs.join(labelled.select("doc_id"), "doc_id", "left_anti"), test_path)
    both = IO.read_splits(spark, {"train": train_path, "test": test_path}, {
        "train": "doc_id bigint, text string, label int", "test": "doc_id bigint, text string"})
    return both.select("doc_id", "text", "label", "split")


@register("save_prepared", f"""
SELECT doc_id, text, split FROM (
  SELECT doc_id, text, CASE WHEN row_number() OVER (ORDER BY {hash_sql('doc_id')}, doc_id)
                      <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
  FROM documents) s
""")
def save_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: split documents saved partitioned by split, both splits read back."""
    path = scratch_path(spark, "prepared")
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    IO.save_prepared(X.split_exact(docs, "doc_id", 0.2, 42), path)
    return spark.read.parquet(path).select("doc_id", "text", "split")


@register("write_submission", f"""
SELECT CAST(doc_id AS VARCHAR) AS id, {_NAMES_SQL} AS prediction FROM ({ALL_SCORED_SQL}) s
""")
def write_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: scored classes written as {id, prediction} JSON lines and read back."""
    path = scratch_path(spark, "submission")
    IO.write_submission(all_scored(spark, sf_dir), "doc_id", "pred_name", path)
    return IO.read_submission(spark, path)


LISTING_COLUMNS = ["id", "shop_name", "shop_brand", "laiyuan1_id", "brand_id", "brand_name"]


@register("workbook_roundtrip", f"""
SELECT id, shop_name, shop_brand, laiyuan1_id, brand_id, brand_name FROM ({LISTINGS_SQL}) l
""")
def workbook_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: raw listings written as workbooks by the data source and read back through it,
    NA words to null, then filled: the cleaned listing table."""
    WB.register_workbooks(spark)
    path = scratch_path(spark, "workbooks")
    raw_listings(spark, sf_dir).select(*LISTING_COLUMNS).write.format("workbook").mode("append").option("maxRows", 5000).save(path)
    schema = ", ".join(f"{c} string" for c in LISTING_COLUMNS)
    parsed = spark.read.format("workbook").schema(schema).load(path)
    return fill_missing(WB.null_tokens(parsed, LISTING_COLUMNS)).select(*LISTING_COLUMNS)


_PLANTED = "CASE WHEN doc_id % 7 = 3 THEN 'abc' ELSE CAST(quality AS VARCHAR) END"


@register("reject_rows", f"""
WITH p AS (SELECT doc_id, CASE WHEN doc_id % 5 = 1 THEN NULL ELSE text END AS text, {_PLANTED} AS label FROM documents JOIN labels USING (doc_id)),
r AS (SELECT doc_id, CASE WHEN label = 'abc' THEN 'bad label' WHEN text IS NULL THEN 'no text' ELSE 'ok' END AS reason, text FROM p)
SELECT doc_id, reason, CASE WHEN reason = 'ok' THEN text END AS text, count(*) OVER (PARTITION BY reason) AS counted FROM r
""")
def reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + T1: labelled texts as CSV, some with a label that is no number and some without text; one pass writes the good rows
    and the rejects and counts both."""
    path, out = scratch_path(spark, "csv"), scratch_path(spark, "routed")
    rows = load(spark, sf_dir, "documents").select("doc_id", "text").join(load(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    label = F.when(F.col("doc_id") % 7 == 3, F.lit("abc")).otherwise(F.col("quality").cast("string"))
    IO.write_csv(rows.select("doc_id", F.when(F.col("doc_id") % 5 == 1, F.lit(None).cast("string")).otherwise(F.col("text")).alias("text"), label.alias("label")), path)
    read = IO.read_labelled_csv(spark, path, "doc_id bigint, text string, label int")
    counts = IO.route_rejects(read, {"bad label": F.col(IO.CORRUPT).isNotNull(), "no text": F.col("text").isNull()}, out)
    counted = spark.createDataFrame(list(counts.items()), "reason string, counted bigint")
    good = IO.accepted(spark, out).select("doc_id", F.lit(IO.GOOD).alias("reason"), "text")
    bad = IO.rejected(spark, out).select("doc_id", "reason", F.lit(None).cast("string").alias("text"))
    return good.unionByName(bad).join(F.broadcast(counted), "reason").select("doc_id", "reason", "text", "counted")


@register("score_stream_recovery", f"""
SELECT doc_id, pred, {_NAMES_SQL} AS pred_name, CAST(1 AS BIGINT) AS copies FROM ({ALL_SCORED_SQL}) s
""")
def score_stream_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I8: the scoring stream fails between the write of its first batch and its commit, is started again, and again for files that
    came late; every row is there once."""
    source, sink, state = (scratch_path(spark, f"stream-{x}") for x in ("source", "sink", "state"))
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    early, late = docs.where("doc_id % 4 < 3"), docs.where("doc_id % 4 = 3")
    for part in range(3):
        early.where(F.col("doc_id") % 4 == part).write.mode("append").parquet(source)

    def start(after_write=None):
        stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(source)
        plan = scoring_plan(stream, "doc_id", "text", SENTIMENT_PREFIX, models.length_logits, models.SENTIMENT_LABELS)
        return start_keyed_stream(plan, sink, state, after_write)

    def fail(batch_id: int) -> None:
        raise RuntimeError(f"stopped after the write of batch {batch_id}")

    try:
        start(fail).awaitTermination()
    except StreamingQueryException:
        pass
    start().awaitTermination()
    late.write.mode("append").parquet(source)
    start().awaitTermination()
    return read_keyed(spark, sink).groupBy("doc_id", "pred", "pred_name").agg(F.count(F.lit(1)).alias("copies"))
