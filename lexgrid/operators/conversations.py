"""Conversation assembly and few-shot blocks.

``assemble_conversations`` turns the usual table form (one row per turn) into
one rendered transcript per conversation. The group is the conversation
itself: the output row *is* that group, so it is as large as the transcript
and no larger. Turns are ordered by ``sort_array`` on ``(turn, ...)`` inside
the aggregate, not by a sort of the whole table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgrid.functions.prompts import apply_chat_template


def assemble_conversations(turns: DataFrame, conv: str, turn: str, role: str, text: str,
                           open_markers: Mapping[str, str], close_markers: Mapping[str, str],
                           bos: str = "", out: str = "rendered") -> DataFrame:
    """``groupBy(conv)`` -> ordered messages -> T6 rendering. A turn without a conversation is one of its own."""
    said = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content"))
    known, loose = turns.where(F.col(conv).isNotNull()), turns.where(F.col(conv).isNull())
    grouped = known.groupBy(conv).agg(F.sort_array(F.collect_list(said)).alias("_m"), F.count(F.lit(1)).alias("turns")).unionByName(
        loose.select(conv, F.array(said).alias("_m"), F.lit(1).cast("bigint").alias("turns")))
    return grouped.select(conv, apply_chat_template("_m", open_markers, close_markers, bos).alias(out),
                          "turns")


def few_shot_block(examples: DataFrame, order: Sequence[str], line: str, k: int,
                   sep: str = "\n") -> DataFrame:
    """The first ``k`` example lines in a stable order, joined into one row.

    ``orderBy(...).limit(k)`` plans as a per-partition top-k and a k-row merge,
    so the block is built from at most ``k`` rows per task; the result is a
    single row of ``k`` lines, small enough to use as a literal in the prompt plan.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    top = examples.orderBy(*order).limit(k)
    keyed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.col(line).alias("_l"))
    return top.agg(F.array_join(F.transform(F.sort_array(F.collect_list(keyed)), lambda x: x["_l"]),
                                sep).alias("block"))
