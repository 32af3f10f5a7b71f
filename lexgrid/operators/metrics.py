"""Evaluation as aggregations.

Every metric reduces first to a small table (the confusion cells per group)
with map-side partial aggregation, so the shuffle carries one row per
(group, truth, prediction) per task, whatever the input size. Macro averages
are taken over the union of classes seen in truth and in prediction; 0/0 counts
as 0; macro F1 is the mean of per-class F1, not the harmonic mean of macro P/R.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexgrid.functions.labels import cross_entropy, fully_masked, sequence_correct

ROUND = 6


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def confusion(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per (group, truth, prediction)."""
    return df.groupBy(*by, y, p).agg(F.count(F.lit(1)).alias("n"))


def class_report(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per (group, class).

    A null truth or prediction is never a class; a null prediction still counts
    against recall of the true class.
    """
    conf = confusion(df, y, p, by)
    n = F.col("n")
    cells = conf.select(*by, F.explode(F.array(
        F.struct(F.col(y).alias("cls"), F.when(F.col(y) == F.col(p), n).otherwise(0).alias("tp"),
                 n.alias("t"), F.lit(0).cast("long").alias("pr")),
        F.struct(F.col(p).alias("cls"), F.lit(0).cast("long").alias("tp"),
                 F.lit(0).cast("long").alias("t"), n.alias("pr")),
    )).alias("c")).select(*by, "c.*").where(F.col("cls").isNotNull())
    per = cells.groupBy(*by, "cls").agg(F.sum("tp").alias("tp"), F.sum("t").alias("support"),
                                       F.sum("pr").alias("predicted"))
    tp, t, pr = F.col("tp"), F.col("support"), F.col("predicted")
    return per.select(
        *by, F.col("cls").alias("class"),
        _safe_div(tp, pr).alias("precision"),
        _safe_div(tp, t).alias("recall"),
        _safe_div(2 * tp, pr + t).alias("f1"),
        t.alias("support"))


def macro_report(df: DataFrame, y: str, p: str, by: Sequence[str] = (),
                 round_to: int | None = ROUND) -> DataFrame:
    """E3 + E4: macro precision / recall / F1 and accuracy per group.

    One pipeline over the confusion cells (no self-join), so the source (often
    a model scoring stage) is evaluated once. Each cell contributes a truth-class
    row, a predicted-class row and a group-total row.
    """
    conf = confusion(df, y, p, by)
    n = F.col("n")
    zero = F.lit(0).cast("long")
    hit = F.when(F.col(y) == F.col(p), n).otherwise(zero)
    cells = conf.select(*by, F.explode(F.array(
        F.struct(F.col(y).alias("cls"), F.lit(False).alias("total"), hit.alias("tp"),
                 n.alias("t"), zero.alias("pr")),
        F.struct(F.col(p).alias("cls"), F.lit(False).alias("total"), zero.alias("tp"),
                 zero.alias("t"), n.alias("pr")),
        F.struct(F.lit(None).cast(conf.schema[y].dataType).alias("cls"), F.lit(True).alias("total"),
                 hit.alias("tp"), n.alias("t"), zero.alias("pr")),
    )).alias("c")).select(*by, "c.*").where(F.col("cls").isNotNull() | F.col("total"))
    per = cells.groupBy(*by, "cls", "total").agg(F.sum("tp").alias("tp"), F.sum("t").alias("t"),
                                                 F.sum("pr").alias("pr"))
    tp, t, pr, cls = F.col("tp"), F.col("t"), F.col("pr"), ~F.col("total")
    out = per.groupBy(*by).agg(
        F.avg(F.when(cls, _safe_div(tp, pr))).alias("precision"),
        F.avg(F.when(cls, _safe_div(tp, t))).alias("recall"),
        F.avg(F.when(cls, _safe_div(2 * tp, pr + t))).alias("f1"),
        (F.sum(F.when(~cls, tp)) / F.sum(F.when(~cls, t))).alias("accuracy"),
        F.sum(F.when(~cls, t)).alias("rows"))
    if round_to is not None:
        out = out.select(*by, *[F.round(c, round_to).alias(c)
                                for c in ("precision", "recall", "f1", "accuracy")], "rows")
    return out


def sequence_exact_match(df: DataFrame, pred: str, label: str, by: Sequence[str] = (),
                         round_to: int | None = ROUND) -> DataFrame:
    """Share of rows right at every unmasked shifted position.

    All-masked rows count as right (both sides become -100) and are also
    counted in ``n_fully_masked``. No rows: accuracy is null.
    """
    ok = sequence_correct(pred, label).cast("double")
    acc = F.avg(ok)
    if round_to is not None:
        acc = F.round(acc, round_to)
    return df.groupBy(*by).agg(acc.alias("accuracy"), F.count(F.lit(1)).alias("n_rows"),
                               F.sum(fully_masked(label).cast("long")).alias("n_fully_masked"))


def eval_loss(df: DataFrame, logits: str, label: str, by: Sequence[str] = (),
              round_to: int | None = ROUND) -> DataFrame:
    """Mean cross-entropy of class logits against integer labels.

    Rows whose label is null or no class of the logits have no loss; ``rows_without_loss`` counts them.
    """
    loss = F.avg(cross_entropy(logits, label))
    if round_to is not None:
        loss = F.round(loss, round_to)
    return df.groupBy(*by).agg(loss.alias("eval_loss"), F.count(F.lit(1)).alias("rows"),
                               F.count_if(cross_entropy(logits, label).isNull()).alias("rows_without_loss"))


def best_checkpoint(log: DataFrame, run: str, step: str, loss: str) -> DataFrame:
    """Per run, the step with the lowest loss; ties go to the earlier step.

    ``min(struct(loss, step))`` is a plain aggregate (partial aggregation, no
    sort, no window), so a run with a huge log costs one row per task.
    """
    best = F.min(F.struct(F.col(loss).alias("l"), F.col(step).alias("s")))
    return log.where(F.col(loss).isNotNull()).groupBy(run).agg(best.alias("_b")) \
        .select(run, F.col("_b.s").alias("best_step"), F.col("_b.l").alias("best_loss"))


def answer_accuracy(df: DataFrame, pred: str, gold: str, tier: str | None = None,
                    round_to: int | None = ROUND) -> DataFrame:
    """Generated answer vs gold, white space and newlines around both ignored; overall, and per tier (rollup).

    The overall row has ``tier`` null and ``overall`` true, so a null tier's own row can be told from it.
    """
    bare = lambda c: F.regexp_replace(F.col(c), "^[ \\t\\n\\r\\f\\x0B]+|[ \\t\\n\\r\\f\\x0B]+$", "")
    hit = F.coalesce((bare(pred) == bare(gold)).cast("double"), F.lit(0.0))
    acc = F.avg(hit)
    if round_to is not None:
        acc = F.round(acc, round_to)
    if not tier:
        return df.groupBy().agg(acc.alias("accuracy"), F.count(F.lit(1)).alias("rows"))
    return df.rollup(tier).agg(acc.alias("accuracy"), F.count(F.lit(1)).alias("rows"),
                               (F.grouping(tier) == 1).alias("overall"))
