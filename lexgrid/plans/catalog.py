"""Registered queries: each SURVEY §2 operator bound to the driver tables.

Every query reads whole tables (or data Spark derives from them) and returns a
DataFrame; ``ORACLE`` holds the DuckDB SQL that must give the same rows. Output
conventions shared by both sides: integers are BIGINT unless the table's own
column is INT, doubles are rounded to 6 places, int arrays are rendered as
space-separated text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgrid.functions import labels as L
from lexgrid.functions import prompts as T
from lexgrid.functions.clean import fill_missing
from lexgrid.operators import metrics as M
from lexgrid.operators import scoring as S
from lexgrid.plans import models
from lexgrid.plans.sqltext import argmax_sql, length_logits_sql, macro_report_sql, sql_str
from lexgrid.plans.tables import load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# Our own prompt wording for the sentiment task.
SENTIMENT_PREFIX = "Which mood does this passage have? Answer 0 if it is negative, 1 if neutral, 2 if positive.\n"


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    lab = load(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    # no hint: the planner broadcasts the label side only when its measured
    # size is under the threshold (statically or through AQE at run time)
    return docs.join(lab, "doc_id")


def scored(docs: DataFrame) -> DataFrame:
    """Prompt (T1) -> logits (I1) -> class (I2) -> name."""
    df = fill_missing(docs, "", ["text"])
    df = df.withColumn("prompt", T.prefix_prompt("text", SENTIMENT_PREFIX))
    df = S.score_classes(df, "prompt", models.length_logits)
    return (df.withColumn("pred", L.argmax("logits"))
              .withColumn("pred_name", L.decode_label("pred", models.SENTIMENT_LABELS)))


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled documents, scored: for the metrics."""
    return scored(labelled_documents(spark, sf_dir))


def all_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, scored: no label is needed."""
    return scored(load(spark, sf_dir, "documents").select("doc_id", "text"))


SCORED_SQL = f"""
SELECT doc_id, lang, quality, toxic, lg, {argmax_sql('lg')} AS pred
FROM (SELECT d.doc_id, d.lang, l.quality, l.toxic,
             {length_logits_sql(sql_str(SENTIMENT_PREFIX) + " || coalesce(d.text, '')")} AS lg
      FROM documents d JOIN labels l USING (doc_id)) q
"""

ALL_SCORED_SQL = f"""
SELECT doc_id, lg, {argmax_sql('lg')} AS pred
FROM (SELECT doc_id, {length_logits_sql(sql_str(SENTIMENT_PREFIX) + " || coalesce(text, '')")} AS lg
      FROM documents) q
"""

_NAMES_SQL = ("CASE pred WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' "
              "WHEN 2 THEN 'positive' END")


@register("sentiment_macro_by_lang",
          macro_report_sql(SCORED_SQL, "quality", "pred", ["lang"]))
def sentiment_macro_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: score labelled documents, macro P/R/F1 + accuracy per language."""
    return M.macro_report(scored_documents(spark, sf_dir), "quality", "pred", ["lang"])


@register("score_classes", f"""
SELECT doc_id, pred, {_NAMES_SQL} AS pred_name,
       array_to_string(list_transform(lg, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ' ') AS logits
FROM ({ALL_SCORED_SQL}) s
""")
def score_classes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 + I2 + I3: logits, class id and class name of every document."""
    df = all_scored(spark, sf_dir)
    return df.select("doc_id", "pred", "pred_name",
                     F.array_join(F.transform("logits", lambda x: x.cast("bigint").cast("string")),
                                  " ").alias("logits"))


@register("macro_metrics_labels",
          macro_report_sql("SELECT quality, toxic FROM labels", "quality", "toxic"))
def macro_metrics_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 + E4 on the labels table: quality as truth, toxic as prediction."""
    return M.macro_report(load(spark, sf_dir, "labels"), "quality", "toxic")


@register("confusion_scored", f"""
SELECT quality, pred, count(*) AS n FROM ({SCORED_SQL}) s GROUP BY quality, pred
""")
def confusion_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion cells of the scored documents."""
    return M.confusion(scored_documents(spark, sf_dir), "quality", "pred")


@register("class_report_scored", f"""
WITH conf AS (SELECT quality AS y, pred AS p, count(*) AS n FROM ({SCORED_SQL}) s GROUP BY 1, 2),
cells AS (SELECT y AS cls, CASE WHEN y = p THEN n ELSE 0 END AS tp, n AS t, 0 AS pr FROM conf
          UNION ALL SELECT p, 0, 0, n FROM conf),
per AS (SELECT cls, sum(tp) AS tp, sum(t) AS t, sum(pr) AS pr FROM cells GROUP BY cls)
SELECT cls AS class,
       round(CASE WHEN pr > 0 THEN tp / pr ELSE 0.0 END, 6) AS precision,
       round(CASE WHEN t > 0 THEN tp / t ELSE 0.0 END, 6) AS recall,
       round(CASE WHEN pr + t > 0 THEN 2 * tp / (pr + t) ELSE 0.0 END, 6) AS f1,
       CAST(t AS BIGINT) AS support
FROM per
""")
def class_report_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-class precision / recall / F1 / support of the scored documents."""
    rep = M.class_report(scored_documents(spark, sf_dir), "quality", "pred")
    return rep.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
                      "support")


@register("eval_loss_scored", f"""
SELECT round(avg(ln(list_sum(list_transform(lg, lambda x: exp(x - list_max(lg))))) + list_max(lg)
                 - lg[quality + 1]), 6) AS eval_loss,
       count(*) AS rows, CAST(0 AS BIGINT) AS rows_without_loss
FROM ({SCORED_SQL}) s
""")
def eval_loss_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean cross-entropy of the length logits against quality."""
    return M.eval_loss(scored_documents(spark, sf_dir), "logits", "quality")


@register("best_checkpoint_events", """
SELECT event_type, min({'l': value, 's': event_id}).s AS best_step,
       min({'l': value, 's': event_id}).l AS best_loss
FROM events WHERE value IS NOT NULL GROUP BY event_type
""")
def best_checkpoint_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an evaluation log (run = event_type, step = event_id, loss = value)."""
    return M.best_checkpoint(load(spark, sf_dir, "events"), "event_type", "event_id", "value")
