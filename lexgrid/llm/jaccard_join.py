"""N-gram Jaccard join of documents over a token-group matrix (see ``simjoin``).

A document is the set of its distinct ``k``-word shingles (64-bit hashes; words
are what stands between ASCII white space, A-Z lower-cased; a shorter text is one
shingle). Documents with equal sets collapse to the one with the smallest id
before anything is compared, so copies cost one row each.

Defined cases: null, empty and blank texts have no shingles, are linked with nothing
and are their own component; rows with a null id take part in nothing and get a
null component; rows that repeat an id belong to one document; an empty table
gives no rows; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgrid.llm.common import hash_many, map_slices, maybe_in, shingles, without_keys, written
from lexgrid.llm.simjoin import component_ids, linked_forest, pigeonhole_cells


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _sketch(k: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            sets = [np.unique(shingles(words, k)) for words in hash_many(f["text"])]
            yield pd.DataFrame({"doc_id": f["doc_id"], "size": [len(x) for x in sets], "digest": [_digest(x) for x in sets]})
    return run


def _cells(k: int, t: Fraction):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for key, words in zip(f["doc_id"], hash_many(f["text"])):
                tokens = np.unique(shingles(words, k))
                cells, need = pigeonhole_cells(tokens, t)
                rows.append((key, len(tokens), _digest(tokens), need, cells.view(np.int64)))
            yield pd.DataFrame(rows, columns=["node", "size", "digest", "need", "cells"])
    return run


def _tokens(k: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"node": f["node"], "grp": f["grp"], "tokens": [
                np.unique(shingles(words, k)).tobytes() for words in hash_many(f["text"])]})
    return run


def jaccard_components(docs: DataFrame, k: int = 5, threshold: Fraction = Fraction(4, 5), key: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """Per row ``doc_id, n_shingles, component_id``: the smallest id reachable over links with
    Jaccard ``threshold`` or more. No link is lost."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    sketches = written(map_slices(rows, _sketch(k), f"doc_id {kind}, size bigint, digest binary"), "sketches")
    known = sketches.where("size > 0 AND doc_id IS NOT NULL").select("doc_id", "digest")
    sets = written(known.groupBy("digest").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("rows")), "sets")
    copied, sets = sets.where("rows > 1").drop("rows"), sets.drop("rows")
    # the cells of a set are those of one of its rows. Ids of one row that stands for its set are taken as they are, and those
    # of copies alone left out; only rows of an id that has several, copies among them, are told apart by their digests
    alike = written(maybe_in(known, "digest", copied, "digest").join(copied, "digest").select(
        "doc_id", "digest", (F.col("doc_id") == F.col("node")).alias("stays")).groupBy("doc_id", "digest").agg(F.max("stays").alias("stays")), "copies")
    ids = alike.groupBy("doc_id").agg(F.max("stays").alias("stays")).withColumnRenamed("doc_id", "id")
    apart = written(maybe_in(known, "doc_id", ids, "id").join(ids, F.col("doc_id") == F.col("id")).groupBy("id").agg(
        F.max("stays").alias("stays"), F.count(F.lit(1)).alias("n")).where("NOT stays OR n > 1"), "ids-apart")
    several = apart.where("n > 1").select("id")

    # cells are many times the ids: they are worked out from the texts where they are read, never stored whole
    def celled(own: DataFrame) -> DataFrame:
        return map_slices(own.select("doc_id", "text"), _cells(k, threshold), f"node {kind}, size bigint, digest binary, need int, cells array<bigint>")

    own = rows.where("doc_id IS NOT NULL")
    mixed = celled(maybe_in(own, "doc_id", several, "id").join(several, F.col("doc_id") == F.col("id"))).join(
        alike.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "stays"),
        (F.col("node") == F.col("_id")) & (F.col("digest") == F.col("_digest")), "left").where("coalesce(stays, true)").dropDuplicates(["node", "digest"])
    columns = ["node", "size", "need", "cells"]
    keys = celled(without_keys(own, "doc_id", apart, "id")).select(*columns).unionByName(mixed.select(*columns)).select(
        "node", "size", "need", F.explode("cells").alias("cell"))

    def tokens_of(members: DataFrame) -> DataFrame:
        return map_slices(maybe_in(rows, "doc_id", members, "node").join(members, F.col("doc_id") == F.col("node")).select(
            "node", "grp", "text"), _tokens(k), f"node {kind}, grp bigint, tokens binary")

    found = written(component_ids(sets, linked_forest(keys, tokens_of, threshold)), "set-components")
    return sketches.join(found.select(F.col("digest").alias("_d"), "component_id"), F.col("digest") == F.col("_d"), "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def one_per_component(docs: DataFrame, k: int = 5, threshold: Fraction = Fraction(4, 5), key: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """``docs`` with the document of the smallest id of each component; rows with a null id stay."""
    gone = written(jaccard_components(docs, k, threshold, key, text).where("doc_id <> component_id").select("doc_id"), "near-copies")
    return without_keys(docs, key, gone, "doc_id")
