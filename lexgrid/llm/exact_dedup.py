"""Exact deduplication against a persistent digest index (DataFrame functions only).

The index is a Parquet table bucketed and sorted by the SHA-256 of the
normalised text (every character of ``[\\x20\\x09-\\x0D]`` deleted). A batch is
reduced to one row per digest first (partial aggregation, so a group that holds
a third of the rows costs one row per task), the new digests are found with a
sort-merge anti-join against the index, and appended. Rows get their verdict
by a join on the digest whose index side has one row per key, so Spark's skew
join splits a hot digest.

Defined cases: a null text is the empty text; all texts without a visible
character form one group; of equal texts the one with the most code points
stays, then the smallest ``doc_id`` (nulls last), then, for rows repeated in
full, one of them; an empty batch gives no rows and leaves the index as
it is. Only the named key and text columns are read, so other columns may have
any name.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgrid.llm.common import fresh, named_once, written
from lexgrid.session import scratch_path

BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def normalised(text: Column) -> Column:
    for c in BLANKS:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


class DigestIndex:
    """A persistent table ``digest binary, keep_id, n_rows`` in ``path``.

    Each batch appends one row per digest it holds: the new ones with the row that stays, the known ones with
    what the batch adds to their count. Bucket count (about one per 100-200 MB of index) and type of the key are fixed
    when the index is made and kept in ``path`` + ``-settings``; opening it with others is an error.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, id_type: str | None = None):
        self.spark = spark
        self.path = path or scratch_path(spark, "digest-index")
        fixed = self._settings()
        if fixed is None:
            fixed = {"buckets": buckets or 64, "id_type": id_type or "bigint"}
            spark.createDataFrame([(json.dumps(fixed),)], "value string").write.text(f"{self.path}-settings")
        for name, asked in (("buckets", buckets), ("id_type", id_type)):
            if asked is not None and asked != fixed[name]:
                raise ValueError(f"the index in {self.path} has {name} {fixed[name]}, not {asked}")
        self.buckets = fixed["buckets"]
        self.name = "digest_index_" + hashlib.md5(self.path.encode()).hexdigest()
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{self.name}` (digest BINARY, keep_id {fixed['id_type']}, n_rows BIGINT) "
                  f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{self.path}'")

    def _settings(self) -> dict | None:
        try:
            return json.loads(self.spark.read.text(f"{self.path}-settings").first()[0])
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def rows(self) -> DataFrame:
        """One row per digest, counts summed over all batches; the buckets serve the grouping."""
        return self.spark.table(self.name).groupBy("digest").agg(F.first("keep_id").alias("keep_id"), F.sum("n_rows").alias("n_rows"))

    def append(self, entries: DataFrame) -> None:
        (entries.select("digest", "keep_id", "n_rows").repartition(self.buckets, "digest")
         .sortWithinPartitions("digest").write.insertInto(self.name))
        self.spark.catalog.refreshTable(self.name)

    def close(self) -> None:
        """Take the name out of the catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS `{self.name}`")

    def dedup(self, batch: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """Verdict per row of ``batch``; what the batch holds is appended.

        Returns ``doc_id`` (the key), ``keep_id``, ``group_size`` (rows of this
        digest in the batch, and in all batches before it), ``kept``, ``text_sha256``.
        """
        return self._verdicts(batch, key, text).select(
            "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))

    def _verdicts(self, batch: DataFrame, key: str, text: str) -> DataFrame:
        """Per row ``doc_id, digest, n_chars, keep_id, group_size, kept``."""
        rows = written(batch.select(*_named(key, text), F.monotonically_increasing_id().alias("place")), "digests")
        # ~x orders numbers downwards without overflow, and null ids come last under max
        best = F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("k"), F.bitwise_not("place").alias("p")))
        groups = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), best.alias("best")).select(
            "digest", "n", F.bitwise_not("best.k").alias("best_id"), F.bitwise_not("best.p").alias("best_place"))
        groups = written(groups, "digest-groups")
        known = self.rows().withColumnsRenamed({"keep_id": "known_id", "n_rows": "known_rows"})
        new = groups.join(known.hint("merge"), "digest", "left_anti")
        old = groups.join(known.hint("merge"), "digest")
        verdicts = written(
            new.select("digest", F.col("best_id").alias("keep_id"), "n", F.col("n").alias("group_size"), F.col("best_place").alias("keep_place"))
            .unionByName(old.select("digest", F.col("known_id").alias("keep_id"), "n", (F.col("n") + F.col("known_rows")).alias("group_size"),
                                    F.lit(None).cast("long").alias("keep_place"))), "verdicts")
        self.append(verdicts.select("digest", "keep_id", F.col("n").alias("n_rows")))
        return rows.join(verdicts, "digest").select(
            "doc_id", "digest", "n_chars", "keep_id", "group_size", F.coalesce(F.col("place") == F.col("keep_place"), F.lit(False)).alias("kept"))


def _named(key: str, text: str) -> list[Column]:
    """What tells a row from others in this operator: its key, the digest of its text, and the text's code points."""
    raw = F.coalesce(F.col(text), F.lit(""))
    return [F.col(key).alias("doc_id"), F.unhex(F.sha2(normalised(raw), 256)).alias("digest"), F.char_length(raw).cast("long").alias("n_chars")]


def kept_rows(docs: DataFrame, key: str = "doc_id", text: str = "text",
              index: DigestIndex | None = None) -> DataFrame:
    """``docs`` without the rows whose text an earlier or better row already has.

    No copy of ``docs`` is made: rows go by key, digest and length, worked out again in a second scan. Of rows that are
    alike in all three, and have the best text, one stays.
    """
    own = index or DigestIndex(docs.sparkSession)
    name = fresh(docs, "_row_name")
    name_of = lambda key, digest, n: F.concat(digest, F.coalesce(key.cast("string"), F.lit("-")).cast("binary"), F.lit(":").cast("binary"), n.cast("string").cast("binary"))
    rows = own._verdicts(docs, key, text).where("group_size > 1").select(name_of(F.col("doc_id"), F.col("digest"), F.col("n_chars")).alias("name"), "kept")
    names = written(rows.groupBy("name").agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n")).where("NOT stays OR n > 1"), "copies")
    if index is None:
        own.close()
    named = docs.withColumn(name, name_of(*_named(key, text)))
    return named_once(named, name, names.select("name", "stays")).select(*docs.columns)
