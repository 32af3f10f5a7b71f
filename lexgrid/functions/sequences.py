"""Token-array algebra as higher-order column functions.

Everything here is a JVM expression over ``array<int>`` columns: no Python, no
shuffle. The ignore value for masked label positions is -100.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

IGNORE = -100


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truncate(ids: Column | str, max_len: int) -> Column:
    """Q2: keep the first ``max_len`` ids."""
    if max_len < 1:
        raise ValueError("max_len must be >= 1")
    return F.slice(_col(ids), 1, max_len)


def attention_mask(ids: Column | str) -> Column:
    """Q3: one 1 per real token."""
    return F.array_repeat(F.lit(1), F.size(_col(ids)))


def pad_to(ids: Column | str, width: Column | int, pad_id: int = 0, side: str = "right") -> Column:
    """Q4 (row part): pad ``ids`` with ``pad_id`` up to ``width``.

    A width at or below the current length pads nothing (``array_repeat`` with
    a count <= 0 is empty).
    """
    a = _col(ids)
    w = F.lit(width) if isinstance(width, int) else width
    pad = F.array_repeat(F.lit(pad_id), w - F.size(a))
    if side == "left":
        return F.concat(pad, a)
    if side == "right":
        return F.concat(a, pad)
    raise ValueError("side must be left or right")


def padded_mask(ids: Column | str, width: Column | int, side: str = "right") -> Column:
    """Q3 + Q4: attention mask padded with zeros to ``width``."""
    return pad_to(attention_mask(ids), width, 0, side)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body`` as a lambda variable.

    Without this, an expression used inside a ``transform`` lambda is
    re-evaluated for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def marker_end(ids: Column | str, marker: Sequence[int]) -> Column:
    """0-based index just past the LAST occurrence of ``marker`` in ``ids``; null if absent.

    A fold over start positions comparing ``len(marker)`` elements each: no
    per-position slice arrays. Guarded so that a row shorter than the marker
    never builds a descending ``sequence``.
    """
    a = _col(ids)
    k = len(marker)
    if k == 0:
        raise ValueError("marker must not be empty")

    def hit(i: Column) -> Column:
        cond = F.lit(True)
        for j, m in enumerate(marker):
            cond = cond & (F.element_at(a, i + (j + 1)) == F.lit(int(m)))
        return cond

    starts = F.sequence(F.lit(0), F.size(a) - k)
    last = F.aggregate(starts, F.lit(-1), lambda acc, i: F.when(hit(i), i).otherwise(acc))
    return F.when((F.size(a) >= k) & (last >= 0), last + k)


def mask_by_marker(ids: Column | str, marker: Sequence[int]) -> Column:
    """Q6: labels = ids with everything up to and including the last marker set to -100.

    All -100 when the marker is missing (nothing to learn from the row).
    """
    a = _col(ids)
    return let(marker_end(a, marker), lambda end: F.transform(
        a, lambda x, i: F.when(end.isNull() | (i < end), F.lit(IGNORE)).otherwise(x)))


def mask_by_boundary(prompt_ids: Column | str, completion_ids: Column | str) -> Column:
    """Q7: -100 over the prompt, then the completion ids."""
    p = _col(prompt_ids)
    return F.concat(F.array_repeat(F.lit(IGNORE), F.size(p)), _col(completion_ids))


def mask_assistant_spans(turns: Column | str, learn_role: str = "assistant") -> Column:
    """Q8: flatten per-turn ids, keeping only ``learn_role`` turns as labels.

    ``turns`` is ``array<struct<role: string, ids: array<int>>>``; the caller
    decides which marker ids belong to a turn (the end marker is usually part
    of the assistant's ids, the opening marker is not).
    """
    return F.flatten(F.transform(_col(turns), lambda t: F.when(
        t["role"] == learn_role, t["ids"]).otherwise(
        F.array_repeat(F.lit(IGNORE), F.size(t["ids"])))))


def flatten_ids(turns: Column | str) -> Column:
    """The input ids matching ``mask_assistant_spans`` (all turns, in order)."""
    return F.flatten(F.transform(_col(turns), lambda t: t["ids"]))


def ids_to_string(ids: Column | str, sep: str = " ") -> Column:
    """Stable text form of an int array (for sinks and oracle comparison)."""
    return F.array_join(F.transform(_col(ids), lambda x: x.cast("string")), sep)
