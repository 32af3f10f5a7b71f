"""A training corpus from raw documents, in five stages.

``STAGES`` names the stages in order; each takes ``(spark, docs, sf_dir)`` and returns
what it keeps, with the columns of ``documents`` but for the last, which returns
packed pieces. ``run`` applies them, each to the written result of the one before.

* toxicity: documents that the classifier chain (fitted on ``labels``) calls toxic go;
* exact_dedup: of equal texts one stays;
* near_dedup: of documents linked by 5-word shingle Jaccard of 0.8 or more one stays;
* pii: personal data is replaced by its kind in brackets;
* packing: what is left is packed into sequences of 2048 tokens.

SQL cannot express the classifier, so there is no ``ORACLE_SQL``; tests hold the
stages against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgrid.llm.common import table, written
from lexgrid.llm.exact_dedup import DigestIndex, kept_rows
from lexgrid.llm.jaccard_join import one_per_component
from lexgrid.llm.packing import pack
from lexgrid.llm.pii import redacted
from lexgrid.llm.queries import tokenizer_file
from lexgrid.llm.toxicity import without_toxic
from lexgrid.session import ensure_checkpoint_dir

ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    index = DigestIndex(spark, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    kept = kept_rows(docs, index=index)
    index.close()
    return kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return one_per_component(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redacted(docs).withColumn("n_chars", F.char_length("text").cast("bigint"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("pii", pii), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
