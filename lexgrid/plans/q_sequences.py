"""Registered queries: tokens, vocabulary, padding, loss masks, decoding, sequence metrics.

Token ids here are either vocabulary ids (``build_vocab`` / ``encode``) or the
token's character length (``token_lengths``), which has an exact DuckDB twin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgrid.functions import labels as L
from lexgrid.functions import sequences as Q
from lexgrid.operators import batching as B
from lexgrid.operators import metrics as M
from lexgrid.operators import tokens as TK
from lexgrid.plans import models
from lexgrid.plans.catalog import register
from lexgrid.plans.q_text import PROMPTS_SQL, listing_prompts
from lexgrid.plans.sqltext import argmax_sql, ids_str_sql
from lexgrid.plans.tables import load

PAT = "'[^ \\n\\t\\r]+'"
MAX_LEN = 64
BATCH = 16
MARKER = (2, 3)
MIN_COUNT = 1
CHUNK = 8
EOS_ID = 0
END_ID = 100
OPEN_IDS = {"system": 101, "user": 102, "assistant": 103}


def _len_ids_sql(text: str) -> str:
    return f"list_transform(regexp_extract_all(coalesce({text}, ''), {PAT}), lambda t: length(t))"


def doc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return docs.withColumn("ids", TK.token_lengths(TK.rule_tokens(F.coalesce("text", F.lit("")))))


@register("rule_tokenise", f"""
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_tokens, {ids_str_sql('ids')} AS ids,
       CAST(coalesce(list_sum(list_transform(ids, lambda x: 1)), 0) AS BIGINT) AS mask_sum
FROM (SELECT doc_id, {_len_ids_sql('text')} AS ids FROM documents) d
""")
def rule_tokenise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 (rule route) + Q3 over whole texts."""
    d = doc_ids(spark, sf_dir)
    mask = Q.attention_mask("ids")
    return d.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                    Q.ids_to_string("ids").alias("ids"),
                    F.aggregate(mask, F.lit(0).cast("long"), lambda a, x: a + x).alias("mask_sum"))


_VOCAB_SQL = f"""
SELECT token, freq, row_number() OVER (ORDER BY freq DESC, token) + 1 AS id
FROM (SELECT token, count(*) AS freq
      FROM (SELECT unnest(regexp_extract_all(coalesce(text, ''), {PAT})) AS token FROM documents) t
      GROUP BY token) c
WHERE freq >= {MIN_COUNT}
"""


def _vocab(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    toks = docs.withColumn("tokens", TK.rule_tokens(F.coalesce("text", F.lit(""))))
    return toks, TK.build_vocab(toks, "tokens", MIN_COUNT)


@register("build_vocab", _VOCAB_SQL)
def build_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary with ids by (frequency desc, token)."""
    return _vocab(spark, sf_dir)[1]


@register("encode_tokens", f"""
WITH vocab AS ({_VOCAB_SQL}),
tok AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), {PAT})) AS token,
               unnest(range(1, len(regexp_extract_all(coalesce(text, ''), {PAT})) + 1)) AS pos
        FROM documents)
SELECT d.doc_id,
       coalesce(string_agg(CASE WHEN t.pos IS NULL THEN NULL
                                ELSE CAST(coalesce(v.id, {TK.UNK_ID}) AS VARCHAR) END, ' '
                           ORDER BY t.pos), '') AS ids,
       count(t.pos) FILTER (WHERE v.id IS NULL) AS n_unknown
FROM documents d LEFT JOIN tok t USING (doc_id) LEFT JOIN vocab v USING (token)
GROUP BY d.doc_id
""")
def encode_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens as vocabulary ids."""
    toks, vocab = _vocab(spark, sf_dir)
    enc = TK.encode(toks.select("doc_id", "tokens"), "tokens", vocab, "doc_id", "ids")
    return enc.select("doc_id", Q.ids_to_string("ids").alias("ids"),
                      F.size(F.filter("ids", lambda x: x == TK.UNK_ID)).cast("long").alias("n_unknown"))


@register("decode_tokens", f"""
SELECT doc_id, array_to_string(regexp_extract_all(coalesce(text, ''), {PAT}), ' ') AS text FROM documents
""")
def decode_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids back to text, padding put around them and skipped again."""
    toks, vocab = _vocab(spark, sf_dir)
    enc = TK.encode(toks.select("doc_id", "tokens"), "tokens", vocab, "doc_id", "ids")
    padded = enc.select("doc_id", F.concat(F.array(F.lit(TK.PAD_ID).cast("long")), "ids", F.array(F.lit(TK.PAD_ID).cast("long"))).alias("ids"))
    return TK.decode(padded, "ids", vocab, "doc_id").select("doc_id", "text")


@register("tokenise_hosted", f"""
SELECT doc_id, {ids_str_sql('ids')} AS ids FROM (SELECT doc_id, {_len_ids_sql('text')} AS ids FROM documents) d
""")
def tokenise_hosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 (hosted route): a tokenizer callable in Arrow batches over whole texts."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return TK.tokenise_with(docs, "text", models.length_tokenizer, "ids").select("doc_id", Q.ids_to_string("ids").alias("ids"))


@register("pad_batches_whole", f"""
WITH a AS (SELECT doc_id, {_len_ids_sql('text')} AS ids, (row_number() OVER (ORDER BY doc_id) - 1) // {BATCH} AS batch_id FROM documents),
w AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS width FROM a)
SELECT doc_id, CAST(batch_id AS BIGINT) AS batch_id, CAST(width AS BIGINT) AS width,
       md5({ids_str_sql('list_concat(ids, list_transform(range(width - len(ids)), lambda x: 0))')}) AS ids_md5
FROM w
""")
def pad_batches_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 + Q4 + Q5 on whole token rows: nothing is truncated, right padding."""
    padded = B.padded_batches(doc_ids(spark, sf_dir).select("doc_id", "ids"), ["doc_id"], "ids", BATCH)
    return padded.select("doc_id", "batch_id", F.size("input_ids").cast("long").alias("width"),
                         F.md5(Q.ids_to_string("input_ids")).alias("ids_md5"))


@register("pad_batches", f"""
WITH a AS (SELECT doc_id, {_len_ids_sql('text')}[1:{MAX_LEN}] AS ids,
                  (row_number() OVER (ORDER BY doc_id) - 1) // {BATCH} AS batch_id FROM documents),
w AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS width FROM a)
SELECT doc_id, CAST(batch_id AS BIGINT) AS batch_id,
       {ids_str_sql('list_concat(list_transform(range(width - len(ids)), lambda x: 0), ids)')} AS input_ids,
       {ids_str_sql('list_concat(list_transform(range(width - len(ids)), lambda x: 0), list_transform(ids, lambda x: 1))')} AS attention_mask
FROM w
""")
def pad_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 + Q3 + Q4 + Q5: truncate to 64, batches of 16 in key order, left-pad to the batch's longest."""
    # truncate first: the batch order is materialised, so only 64 ids per row travel
    d = doc_ids(spark, sf_dir).select("doc_id", Q.truncate("ids", MAX_LEN).alias("ids"))
    padded = B.padded_batches(d, ["doc_id"], "ids", BATCH, side="left", pad_id=0)
    return padded.select("doc_id", "batch_id", Q.ids_to_string("input_ids").alias("input_ids"),
                         Q.ids_to_string("attention_mask").alias("attention_mask"))


def _marker_end_sql(ids: str) -> str:
    k = len(MARKER)
    marker = "[" + ", ".join(str(m) for m in MARKER) + "]"
    return (f"CASE WHEN len({ids}) >= {k} THEN list_max(list_filter(range(0, len({ids}) - {k - 1}), "
            f"lambda i: {ids}[i + 1:i + {k}] = {marker})) + {k} END")


def _marker_labels_sql(ids: str, end: str = "e") -> str:
    """Labels from ``ids`` and a column ``end`` computed once per row by ``_marker_end_sql``."""
    return (f"list_transform({ids}, lambda x, i: CASE WHEN {end} IS NULL OR i - 1 < {end} "
            f"THEN -100 ELSE x END)")


@register("mask_by_marker", f"""
SELECT doc_id, {ids_str_sql(_marker_labels_sql('ids'))} AS labels
FROM (SELECT doc_id, ids, {_marker_end_sql('ids')} AS e
      FROM (SELECT doc_id, {_len_ids_sql('text')} AS ids FROM documents) d0) d
""")
def mask_by_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: everything up to and including the last (2, 3) marker is masked."""
    d = doc_ids(spark, sf_dir)
    return d.select("doc_id", Q.ids_to_string(Q.mask_by_marker("ids", MARKER)).alias("labels"))


@register("mask_by_boundary", f"""
SELECT id, {ids_str_sql("list_concat(list_transform(" + _len_ids_sql('prompt') + ", lambda x: -100), "
                        + _len_ids_sql('brand_name') + ")")} AS labels
FROM ({PROMPTS_SQL}) p
""")
def mask_by_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: prompt positions masked, completion ids kept."""
    p = listing_prompts(spark, sf_dir)
    pid = TK.token_lengths(TK.rule_tokens("prompt"))
    cid = TK.token_lengths(TK.rule_tokens("brand_name"))
    return p.select("id", Q.ids_to_string(Q.mask_by_boundary(pid, cid)).alias("labels"))


def _open_id_sql() -> str:
    whens = " ".join(f"WHEN '{r}' THEN {i}" for r, i in OPEN_IDS.items())
    return f"coalesce(CASE role {whens} END, 0)"


@register("mask_assistant_spans", f"""
WITH t AS (SELECT conv_id, turn, role, {_len_ids_sql('text')} AS ids FROM conversations),
p AS (SELECT conv_id, turn,
             {ids_str_sql(f"list_concat([{_open_id_sql()}], ids, [{END_ID}])")} AS in_part,
             {ids_str_sql(f"list_concat([-100], CASE WHEN role = 'assistant' THEN list_concat(ids, [{END_ID}]) ELSE list_transform(list_concat(ids, [{END_ID}]), lambda x: -100) END)")} AS lab_part
      FROM t)
SELECT conv_id, string_agg(in_part, ' ' ORDER BY turn) AS input_ids,
       string_agg(lab_part, ' ' ORDER BY turn) AS labels
FROM p GROUP BY conv_id
""")
def mask_assistant_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8: learn only assistant text and its end marker; opening markers and other turns masked."""
    conv = load(spark, sf_dir, "conversations")
    ids = TK.token_lengths(TK.rule_tokens(F.coalesce("text", F.lit(""))))
    open_map = F.create_map(*[x for r, i in OPEN_IDS.items() for x in (F.lit(r), F.lit(i))])
    open_id = F.coalesce(F.try_element_at(open_map, F.col("role")), F.lit(0))
    segs = F.array(
        F.struct(F.lit("marker").alias("role"), F.array(open_id).alias("ids")),
        F.struct(F.col("role").alias("role"), F.concat(ids, F.array(F.lit(END_ID))).alias("ids")))
    per_turn = conv.select("conv_id", F.struct(F.col("turn"), segs.alias("segs")).alias("t"))
    grouped = per_turn.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    flat = grouped.select("conv_id", F.flatten(F.transform("ts", lambda t: t["segs"])).alias("segs"))
    return flat.select("conv_id", Q.ids_to_string(Q.flatten_ids("segs")).alias("input_ids"),
                       Q.ids_to_string(Q.mask_assistant_spans("segs")).alias("labels"))


@register("extract_response", f"""
SELECT id, {ids_str_sql("list_filter(full_ids[len(p_ids) + 1:], lambda x: x <> " + str(EOS_ID) + ")")} AS response
FROM (SELECT id, {_len_ids_sql('prompt')} AS p_ids,
             list_concat({_len_ids_sql('prompt')}, {_len_ids_sql('brand_name')}, [{EOS_ID}]) AS full_ids
      FROM ({PROMPTS_SQL}) p) x
""")
def extract_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop the prompt ids and the special (end) id from a generated sequence."""
    p = listing_prompts(spark, sf_dir)
    pid = TK.token_lengths(TK.rule_tokens("prompt"))
    full = F.concat(pid, TK.token_lengths(TK.rule_tokens("brand_name")), F.array(F.lit(EOS_ID)))
    return p.select("id", Q.ids_to_string(L.extract_response(full, F.size(pid), [EOS_ID]))
                    .alias("response"))


@register("argmax_embeddings", f"""
SELECT vec_id, {argmax_sql('embedding')} AS argmax, label FROM embeddings
""")
def argmax_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index of the largest component (first on ties)."""
    e = load(spark, sf_dir, "embeddings")
    return e.select("vec_id", L.argmax("embedding").alias("argmax"), "label")


@register("argmax_positions", f"""
SELECT vec_id,
       {ids_str_sql(f"list_transform(range(len(embedding) // {CHUNK}), lambda i: list_position(embedding[i * {CHUNK} + 1:i * {CHUNK} + {CHUNK}], list_max(embedding[i * {CHUNK} + 1:i * {CHUNK} + {CHUNK}])) - 1)")} AS argmax
FROM embeddings
""")
def argmax_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding read as positions x 8-way logits; argmax per position."""
    e = load(spark, sf_dir, "embeddings")
    chunks = F.transform(F.sequence(F.lit(0), F.floor(F.size("embedding") / CHUNK).cast("int") - 1),
                         lambda i: F.slice("embedding", i * CHUNK + 1, CHUNK))
    return e.select("vec_id", Q.ids_to_string(L.argmax_positions(chunks)).alias("argmax"))


def _pred_sql(ids: str) -> str:
    return f"list_transform({ids}, lambda x, i: coalesce(CASE WHEN {ids}[i + 1] = 7 THEN 8 ELSE {ids}[i + 1] END, 0))"


@register("sequence_exact_match", f"""
WITH a0 AS (SELECT lang, {_len_ids_sql('text')} AS ids FROM documents),
a AS (SELECT lang, ids, {_marker_end_sql('ids')} AS e FROM a0),
b AS (SELECT lang, {_marker_labels_sql('ids')} AS lab, {_pred_sql('ids')} AS pred FROM a)
SELECT lang,
       round(avg(CASE WHEN coalesce(list_bool_and(list_transform(range(1, len(lab)),
             lambda t: lab[t + 1] = -100 OR pred[t] = lab[t + 1])), true) THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       count(*) AS n_rows,
       CAST(sum(CASE WHEN coalesce(list_bool_and(list_transform(lab[2:], lambda y: y = -100)), true)
                THEN 1 ELSE 0 END) AS BIGINT) AS n_fully_masked
FROM b GROUP BY lang
""")
def sequence_exact_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5 + E6: next-token predictions (7 is always mistaken for 8) against marker-masked labels."""
    d = doc_ids(spark, sf_dir)
    pred = F.transform("ids", lambda x, i: F.coalesce(
        F.when(F.try_element_at("ids", i + 2) == 7, F.lit(8)).otherwise(F.try_element_at("ids", i + 2)),
        F.lit(0)))
    staged = d.select("lang", Q.mask_by_marker("ids", MARKER).alias("lab"), pred.alias("pred"))
    return M.sequence_exact_match(staged, "pred", "lab", ["lang"])


@register("shift_pairs", f"""
WITH a0 AS (SELECT doc_id, {_len_ids_sql('text')} AS ids FROM documents),
a AS (SELECT doc_id, ids, {_marker_end_sql('ids')} AS e FROM a0),
b AS (SELECT doc_id, {_marker_labels_sql('ids')} AS lab, {_pred_sql('ids')} AS pred FROM a)
SELECT doc_id,
       CAST(len(list_filter(range(1, len(lab)), lambda t: lab[t + 1] <> -100)) AS BIGINT) AS scored,
       CAST(len(list_filter(range(1, len(lab)), lambda t: lab[t + 1] <> -100 AND pred[t] <> lab[t + 1])) AS BIGINT) AS wrong
FROM b
""")
def shift_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: per row, shifted positions that count and how many of them are wrong."""
    d = doc_ids(spark, sf_dir)
    pred = F.transform("ids", lambda x, i: F.coalesce(
        F.when(F.try_element_at("ids", i + 2) == 7, F.lit(8)).otherwise(F.try_element_at("ids", i + 2)),
        F.lit(0)))
    pairs = L.shift_and_mask(pred, Q.mask_by_marker("ids", MARKER))
    return d.select("doc_id",
                    F.size(F.filter(pairs, lambda s: s["y"] != -100)).cast("long").alias("scored"),
                    F.size(F.filter(pairs, lambda s: (s["y"] != -100) & (s["p"] != s["y"])))
                    .cast("long").alias("wrong"))

