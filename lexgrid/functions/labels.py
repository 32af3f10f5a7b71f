"""Decoding model outputs and row-level evaluation terms.

All expressions; the aggregates that use them live in ``operators.metrics``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexgrid.functions.sequences import IGNORE, let


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def argmax(logits: Column | str) -> Column:
    """Index of the largest value, first on ties; NaN is largest; null if empty."""
    a = _col(logits)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def argmax_positions(logits: Column | str) -> Column:
    """``argmax`` per position of a ``array<array<double>>``."""
    return F.transform(_col(logits), lambda row: (F.array_position(row, F.array_max(row)) - 1).cast("int"))


def _literal_map(mapping: Mapping) -> Column:
    items: list[Column] = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def decode_label(class_id: Column | str, id2label: Mapping[int, str]) -> Column:
    """Class id -> name; an unknown id gives null."""
    return F.try_element_at(_literal_map(id2label), _col(class_id))


def invert_mapping(id2label: Mapping[int, str]) -> dict[str, int]:
    inverse: dict[str, int] = {}
    for k, v in id2label.items():
        if v in inverse:
            raise ValueError(f"label map is not one-to-one: {v!r}")
        inverse[v] = k
    return inverse


def encode_label(name: Column | str, id2label: Mapping[int, str]) -> Column:
    """I4: name -> class id through the inverse map; unknown names give null."""
    return F.try_element_at(_literal_map(invert_mapping(id2label)), _col(name))


def extract_response(ids: Column | str, prompt_len: Column | int,
                     special_ids: Sequence[int] = ()) -> Column:
    """The generated part (after ``prompt_len`` ids), without special ids."""
    a = _col(ids)
    n = F.lit(prompt_len) if isinstance(prompt_len, int) else prompt_len
    tail = F.slice(a, n + 1, F.greatest(F.size(a) - n, F.lit(0)))
    if not special_ids:
        return tail
    special = F.array(*[F.lit(int(x)) for x in special_ids])
    return F.filter(tail, lambda x: ~F.array_contains(special, x))


def shift_and_mask(pred: Column | str, label: Column | str) -> Column:
    """E5: pair pred[t] with label[t+1]; masked label positions become -100 on both sides.

    Returns ``array<struct<p:int, y:int>>`` of length n-1.
    """
    p, y = _col(pred), _col(label)
    n = F.size(y)
    ps = F.slice(p, 1, F.greatest(n - 1, F.lit(0)))
    ys = F.slice(y, 2, F.greatest(n - 1, F.lit(0)))
    return F.zip_with(ps, ys, lambda a, b: F.struct(
        F.when(b == IGNORE, F.lit(IGNORE)).otherwise(a).alias("p"), b.alias("y")))


def sequence_correct(pred: Column | str, label: Column | str) -> Column:
    """E6 (row part): every unmasked shifted position is right (all-masked rows count as right).

    Same meaning as ``forall(shift_and_mask(...), p == y)``, evaluated over
    indices so no intermediate arrays are built.
    """
    p, y = _col(pred), _col(label)
    idx = F.sequence(F.lit(1), F.greatest(F.size(y) - 1, F.lit(1)))
    ok = F.forall(idx, lambda t: (F.element_at(y, t + 1) == IGNORE)
                  | (F.try_element_at(p, t) == F.element_at(y, t + 1)))
    return F.when(F.size(y) <= 1, F.lit(True)).otherwise(F.coalesce(ok, F.lit(False)))


def fully_masked(label: Column | str) -> Column:
    y = _col(label)
    idx = F.sequence(F.lit(2), F.greatest(F.size(y), F.lit(2)))
    return F.when(F.size(y) <= 1, F.lit(True)).otherwise(
        F.forall(idx, lambda t: F.element_at(y, t) == IGNORE))


def cross_entropy(logits: Column | str, label: Column | str) -> Column:
    """E7 (row part): log-sum-exp(l) - l[y], computed stably around max(l); null for a label
    that is null or outside the logits."""
    a = _col(logits)
    lse = let(F.array_max(a), lambda m: F.log(
        F.aggregate(a, F.lit(0.0), lambda acc, x: acc + F.exp(x - m))) + m)
    y = _col(label)
    return F.when(y >= 0, lse - F.try_element_at(a, y + 1))
