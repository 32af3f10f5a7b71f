"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgrid.llm import chat, merkle, prefix_trie, sql
from lexgrid.llm.best_fit import pack_best_fit
from lexgrid.llm.common import table
from lexgrid.llm.exact_dedup import DigestIndex
from lexgrid.llm.jaccard_join import jaccard_components
from lexgrid.llm.packing import pack
from lexgrid.llm.paragraph_dedup import repeat_report
from lexgrid.llm.pii import pii_report
from lexgrid.llm.secret_scan import findings, fit_network, secret_report
from lexgrid.llm.sentencepiece_codec import encoding_report
from lexgrid.llm.topk_mtree import top_k
from lexgrid.llm.toxicity import fit_chain, predict

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, twin: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if twin is not None:
            ORACLE[name] = twin
        return fn
    return deco


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


@register("op1_paragraph_dedup")
def op1_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages that other documents have too."""
    return repeat_report(table(spark, sf_dir, "documents"))


@register("op2_toxicity_chain")
def op2_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category probabilities and verdicts for every document."""
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit_chain(docs, table(spark, sf_dir, "labels")))


@register("op3_pii_spans", sql.PII)
def op3_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text."""
    return pii_report(table(spark, sf_dir, "documents"))


@register("op5_exact_dedup", sql.EXACT_DEDUP)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as one batch against an empty persistent index."""
    index = DigestIndex(spark, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    verdicts = index.dedup(table(spark, sf_dir, "documents"))
    index.close()
    return verdicts


@register("op4_chat_format", sql.CHAT)
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of control strings, formatted and read back."""
    tricky = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], rows.schema)
    return chat.chat_digests(chat.format_chats(chat.conversations(rows.unionByName(extra))))


@register("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded with the public piece model."""
    return encoding_report(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@register("op7_jaccard_join")
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with 3-word shingle Jaccard of 0.9 or more."""
    return jaccard_components(table(spark, sf_dir, "documents"), 3, Fraction(9, 10))


@register("op8_secret_scan")
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text: base rules and the network trained on what the rules label."""
    docs = table(spark, sf_dir, "documents")
    return secret_report(docs, fit_network(findings(docs)))


@register("op9_topk_mtree", sql.TOP_K)
def op9_topk_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best inner products for every vector whose id is divisible by 100."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@register("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@register("op11_merkle_manifest", sql.MERKLE)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents and a proof per document; a fifth of them are tampered with."""
    which = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    manifest = merkle.Manifest(table(spark, sf_dir, "documents"), which=which,
                               tampered={"text": F.translate("text", merkle.UPPER, merkle.LOWER)})
    return manifest.proofs().withColumnRenamed("key", "doc_id")


@register("op12_prefix_trie", sql.PREFIX_TRIE)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all conversations, rebuilt to share their first turns in fives."""
    turns = prefix_trie.narrow_turns(table(spark, sf_dir, "conversations"))
    heads = F.crc32(F.col("conv").cast("string").cast("binary")) % 9
    return prefix_trie.prefix_trie(*prefix_trie.shared_heads(turns, heads, F.col("conv") - F.col("conv") % 5, 8))


@register("op13_best_fit")
def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens by sums of squares."""
    return pack_best_fit(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
