"""Registered queries: cleaning, projection and prompt rendering."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgrid.functions import clean as C
from lexgrid.functions import prompts as T
from lexgrid.operators.conversations import assemble_conversations, few_shot_block
from lexgrid.operators.ranking import hash_key
from lexgrid.operators.splits import TEST, TRAIN, split_by_hash
from lexgrid.plans.catalog import SENTIMENT_PREFIX, register
from lexgrid.plans.sqltext import sql_str
from lexgrid.plans.tables import LISTINGS_RAW_SQL, LISTINGS_SQL, listings, load, raw_listings

# Our own wording for the brand task. Slots are the listing's fields.
LISTING_TEMPLATE = """
You sort shop listings into brands. Reply with the brand name only.
Trust order: source-1 flag first, then ids starting 9999, then ids starting 99998888.
Listing: shop_name={shop_name}; shop_brand={shop_brand}; source1={laiyuan1_id}; brand_id={brand_id}
Answer:
"""
EOS = "</s>"

# Chat markers (a parameter of the tokenizer in practice; these are ours).
OPEN_MARKERS = {"system": "<|system|>\n", "user": "<|user|>\n", "assistant": "<|assistant|>\n"}
CLOSE_MARKERS = {"system": "\n", "user": "\n", "assistant": "</s>\n"}
BOS = "<s>"
SYSTEM_TEXT = "Each message describes one shop. Name the chain it belongs to, and nothing else."
USER_TEMPLATE = ("Listing: shop_name={shop_name}; shop_brand={shop_brand}; "
                 "source1={laiyuan1_id}; brand_id={brand_id}")

WS = "[ \\t\\n\\r\\f\\x0B]"


def template_sql(template: str, alias: str | None = None) -> str:
    """DuckDB twin of ``render_template``: literal pieces and columns joined by ``||``."""
    parts: list[str] = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(sql_str(literal))
        if name is not None:
            parts.append(f"CAST({name} AS VARCHAR)")
    return "(" + " || ".join(parts or ["''"]) + ")"


def ltrim_sql(expr: str) -> str:
    return f"regexp_replace({expr}, '^{WS}+', '')"


def trim_sql(expr: str) -> str:
    return f"regexp_replace(regexp_replace({expr}, '^{WS}+', ''), '{WS}+$', '')"


def listing_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 + T9: rendered listing prompt (no answer)."""
    lst = listings(spark, sf_dir)
    return lst.withColumn("prompt", T.trim_block(T.render_template(LISTING_TEMPLATE), "left"))


PROMPTS_SQL = f"SELECT *, {ltrim_sql(template_sql(LISTING_TEMPLATE))} AS prompt FROM ({LISTINGS_SQL}) l"


@register("clean_listings", f"""
SELECT id, shop_name, shop_brand AS brand_text, laiyuan1_id, brand_id, brand_name,
       '' AS review_note
FROM ({LISTINGS_SQL}) l
""")
def clean_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 + C2 + C3 + C4 + C5 + C6 + C8 on the raw listings."""
    raw = raw_listings(spark, sf_dir)
    df = C.fill_missing(C.null_tokens(raw))
    df = C.ensure_column(df, "brand_name", "")      # present: kept
    df = C.ensure_column(df, "review_note", "x")    # absent: added ...
    df = C.blank_column(df, "review_note")          # ... then always blanked
    df = C.rename(df, {"shop_brand": "brand_text", "no_such_column": "ignored"})
    df = C.project(df, ["shop_name", "brand_text", "laiyuan1_id", "brand_id", "brand_name",
                        "review_note"], key="id")
    return C.require_columns(df, ["id", "shop_name", "brand_text", "laiyuan1_id", "brand_id",
                                  "brand_name", "review_note"])


@register("null_token_counts", f"""
SELECT count(*) FILTER (WHERE shop_brand IN ('NA', 'null')) AS brand_tokens,
       count(*) FILTER (WHERE laiyuan1_id = 'N/A') AS flag_tokens,
       count(*) AS rows
FROM ({LISTINGS_RAW_SQL}) r
""")
def null_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many cells the NA-word rule turns into nulls, per column."""
    raw = raw_listings(spark, sf_dir)
    nulled = C.null_tokens(raw, ["shop_brand", "laiyuan1_id"])
    return nulled.agg(
        F.count(F.when(F.col("shop_brand").isNull(), 1)).alias("brand_tokens"),
        F.count(F.when(F.col("laiyuan1_id").isNull(), 1)).alias("flag_tokens"),
        F.count(F.lit(1)).alias("rows"))


@register("prefix_prompt", f"""
SELECT doc_id, {sql_str(SENTIMENT_PREFIX)} || coalesce(text, '') AS prompt FROM documents
""")
def prefix_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 on every document."""
    docs = C.fill_missing(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", T.prefix_prompt("text", SENTIMENT_PREFIX).alias("prompt"))


@register("render_listing_prompt", f"""
SELECT id, CASE WHEN brand_name <> '' THEN prompt || brand_name || '{EOS}' ELSE prompt END AS full_text
FROM ({PROMPTS_SQL}) p
""")
def render_listing_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 + T3 + T9: template, left-trimmed, answer + end token when the answer is known."""
    df = listing_prompts(spark, sf_dir)
    return df.select("id", T.append_answer("prompt", "brand_name", EOS).alias("full_text"))


@register("prompt_completion", f"""
SELECT id, prompt, brand_name AS completion FROM ({PROMPTS_SQL}) p
""")
def prompt_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: prompt / completion pairs (the end token is left to the trainer)."""
    df = listing_prompts(spark, sf_dir)
    return df.select("id", "prompt", F.col("brand_name").alias("completion"))


def _chat_sql(with_answer: bool) -> str:
    user = template_sql(USER_TEMPLATE)
    parts = [sql_str(BOS),
             sql_str(OPEN_MARKERS["system"]), sql_str(SYSTEM_TEXT), sql_str(CLOSE_MARKERS["system"]),
             sql_str(OPEN_MARKERS["user"]), user, sql_str(CLOSE_MARKERS["user"])]
    if with_answer:
        parts += [sql_str(OPEN_MARKERS["assistant"]), "brand_name", sql_str(CLOSE_MARKERS["assistant"])]
    else:
        parts += [sql_str(OPEN_MARKERS["assistant"])]
    return " || ".join(parts)


@register("chat_render", f"""
SELECT id, {_chat_sql(True)} AS train_text, {_chat_sql(False)} AS infer_text
FROM ({LISTINGS_SQL}) l
""")
def chat_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 + T6: three-turn training text and two-turn inference text with a generation prompt."""
    df = listings(spark, sf_dir)
    user = T.render_template(USER_TEMPLATE)
    train = T.message_turns(F.lit(SYSTEM_TEXT), user, F.col("brand_name"))
    infer = T.message_turns(F.lit(SYSTEM_TEXT), user)
    return df.select(
        "id",
        T.apply_chat_template(train, OPEN_MARKERS, CLOSE_MARKERS, BOS).alias("train_text"),
        T.apply_chat_template(infer, OPEN_MARKERS, CLOSE_MARKERS, BOS,
                              generation_prompt=OPEN_MARKERS["assistant"]).alias("infer_text"))


@register("messages_array", f"""
SELECT id, {_chat_sql(True)} AS train_text, 3 AS turns, 'system,user,assistant' AS roles, brand_name AS answer,
       {_chat_sql(False)} AS infer_text
FROM ({LISTINGS_SQL}) l
""")
def messages_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 + T6 in array form: the message list as one column of structs, rendered from it, its roles and its answer read from it."""
    df = listings(spark, sf_dir)
    user = T.render_template(USER_TEMPLATE)
    df = df.select("id", T.to_messages(F.lit(SYSTEM_TEXT), user, F.col("brand_name")).alias("messages"), T.to_messages(F.lit(SYSTEM_TEXT), user).alias("asked"))
    return df.select(
        "id", T.apply_chat_template("messages", OPEN_MARKERS, CLOSE_MARKERS, BOS).alias("train_text"), F.size("messages").alias("turns"),
        F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"), F.element_at("messages", -1)["content"].alias("answer"),
        T.apply_chat_template("asked", OPEN_MARKERS, CLOSE_MARKERS, BOS, generation_prompt=OPEN_MARKERS["assistant"]).alias("infer_text"))


@register("strip_literal", f"""
SELECT id, prompt || replace(brand_name || '{EOS}', '{EOS}', '') AS full_text FROM ({PROMPTS_SQL}) p
""")
def strip_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The end marker taken out of the rendered answer; the user's own text is left alone."""
    df = listing_prompts(spark, sf_dir)
    answer = T.strip_literal(F.concat("brand_name", F.lit(EOS)), EOS)
    return df.select("id", F.concat("prompt", answer).alias("full_text"))


@register("trim_block", f"""
SELECT turn_key, {trim_sql('text')} AS both_sides, {ltrim_sql('text')} AS left_side
FROM (SELECT conv_id * 100 + turn AS turn_key, text FROM conversations) c
""")
def trim_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitespace (newlines included) stripped from both ends / the left end."""
    conv = load(spark, sf_dir, "conversations")
    return conv.select((F.col("conv_id") * 100 + F.col("turn")).alias("turn_key"),
                       T.trim_block("text", "both").alias("both_sides"),
                       T.trim_block("text", "left").alias("left_side"))


def _turn_sql() -> str:
    opens = " ".join(f"WHEN '{r}' THEN {sql_str(m)}" for r, m in OPEN_MARKERS.items())
    closes = " ".join(f"WHEN '{r}' THEN {sql_str(m)}" for r, m in CLOSE_MARKERS.items())
    return (f"coalesce(CASE role {opens} END, '') || coalesce(text, '') || "
            f"coalesce(CASE role {closes} END, '')")


@register("assemble_conversations", f"""
SELECT conv_id, {sql_str(BOS)} || string_agg({_turn_sql()}, '' ORDER BY turn) AS rendered,
       count(*) AS turns
FROM conversations GROUP BY conv_id
""")
def assemble_conversations_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rendered transcript per conversation from one row per turn."""
    conv = load(spark, sf_dir, "conversations")
    return assemble_conversations(conv, "conv_id", "turn", "role", "text",
                                  OPEN_MARKERS, CLOSE_MARKERS, BOS)


FEW_SHOT_K = 3
TEST_CUT = f"{round(0.2 * 2**32):08x}"      # hashes below are the test split of ``split_by_hash`` at 0.2


@register("few_shot_prompts", f"""
WITH ex AS (SELECT id, shop_name, brand_name, md5('42:' || id) AS h
            FROM ({LISTINGS_SQL}) l WHERE brand_name <> '' AND left(md5('42:' || id), 8) >= '{TEST_CUT}'
            ORDER BY h, id LIMIT {FEW_SHOT_K}),
blk AS (SELECT string_agg(shop_name || ' => ' || brand_name, chr(10) ORDER BY h, id) AS block FROM ex)
SELECT l.id, blk.block || chr(10) || l.prompt AS prompt
FROM ({PROMPTS_SQL}) l CROSS JOIN blk WHERE left(md5('42:' || l.id), 8) < '{TEST_CUT}'
""")
def few_shot_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K worked examples of the train split (stable hash order) prepended to every prompt of the test split."""
    lst = split_by_hash(listing_prompts(spark, sf_dir), "id", 0.2, 42)
    examples = lst.where((F.col("brand_name") != "") & (F.col("split") == TRAIN)).select(
        "id", F.concat(F.col("shop_name"), F.lit(" => "), F.col("brand_name")).alias("line"),
        hash_key("id", 42).alias("h"))
    # the block is k lines: fetched once and rendered as a literal of the plan
    block = few_shot_block(examples, ["h", "id"], "line", FEW_SHOT_K).first()["block"]
    return lst.where(F.col("split") == TEST).select("id", F.concat(F.lit(block).cast("string"), F.lit("\n"),
                                     F.col("prompt")).alias("prompt"))
