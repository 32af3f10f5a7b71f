"""Prompt and chat rendering as column expressions.

Templates are parsed once on the driver into literals and column references and
become a single ``concat``; no row function is involved, so rendering stays in
whole-stage codegen.
"""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace characters trimmed by ``trim_block``: space, tab, newline,
# carriage return, form feed, vertical tab. Written out so that the Spark (Java)
# and DuckDB regex engines agree.
WHITESPACE_CLASS = "[ \\t\\n\\r\\f\\x0B]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def prefix_prompt(text: Column | str, prefix: str) -> Column:
    """``prefix`` + text. Null text gives null: fill first."""
    return F.concat(F.lit(prefix), _col(text))


def render_template(template: str, slots: Mapping[str, Column | str] | None = None) -> Column:
    """Fill ``{name}`` slots with columns; ``{{``/``}}`` are literal braces.

    Each slot defaults to the column of the same name. Adjacent literal pieces
    are merged on the driver, so the plan holds one ``concat`` per template.
    """
    slots = dict(slots or {})
    parts: list[Column] = []
    pending = ""
    for literal, name, spec, conv in string.Formatter().parse(template):
        pending += literal
        if name is None:
            continue
        if spec or conv:
            raise ValueError(f"format spec/conversion not supported in slot {name!r}")
        if pending:
            parts.append(F.lit(pending))
            pending = ""
        parts.append(_col(slots.get(name, name)).cast("string"))
    if pending:
        parts.append(F.lit(pending))
    if not parts:
        return F.lit("")
    return F.concat(*parts)


def append_answer(prompt: Column | str, answer: Column | str, eos: str = "") -> Column:
    """Prompt + answer + eos, only when the answer is non-empty."""
    a = _col(answer)
    return F.when(F.coalesce(a, F.lit("")) != "", F.concat(_col(prompt), a, F.lit(eos))) \
        .otherwise(_col(prompt))


def message(role: str, content: Column | str) -> Column:
    return F.struct(F.lit(role).alias("role"), _col(content).cast("string").alias("content"))


def message_turns(system: Column | str | None, user: Column | str,
                  assistant: Column | str | None = None) -> list[tuple[str, Column]]:
    """T5 with the roles fixed in the plan: ``[(role, content), ...]``."""
    turns = []
    if system is not None:
        turns.append(("system", _col(system).cast("string")))
    turns.append(("user", _col(user).cast("string")))
    if assistant is not None:
        turns.append(("assistant", _col(assistant).cast("string")))
    return turns


def to_messages(system: Column | str | None, user: Column | str,
                assistant: Column | str | None = None) -> Column:
    """T5: ``array<struct<role, content>>``; omit ``assistant`` for inference."""
    return F.array(*[message(role, content)
                     for role, content in message_turns(system, user, assistant)])


def _role_map(markers: Mapping[str, str]) -> Column:
    items: list[Column] = []
    for k, v in markers.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def apply_chat_template(messages: Column | str | Sequence[tuple[str, Column | str]],
                        open_markers: Mapping[str, str],
                        close_markers: Mapping[str, str] | None = None, bos: str = "",
                        generation_prompt: str | None = None) -> Column:
    """Render a message list with per-role opening/closing markers.

    ``messages`` is an ``array<struct<role, content>>`` column, or the
    ``(role, content)`` turns of ``message_turns`` when the roles are fixed in
    the plan; the latter renders as one flat ``concat`` with the markers
    resolved on the driver. ``generation_prompt`` (the opening marker of the
    next assistant turn) is appended when given, as ``add_generation_prompt``
    does. Unknown roles get empty markers.
    """
    if isinstance(messages, (list, tuple)):
        closing = close_markers or {}
        flat: list[Column] = [F.lit(bos)]
        for role, content in messages:
            flat += [F.lit(open_markers.get(role, "")), F.coalesce(_col(content), F.lit("")),
                     F.lit(closing.get(role, ""))]
        if generation_prompt:
            flat.append(F.lit(generation_prompt))
        return F.concat(*flat)
    opens = _role_map(open_markers)
    closes = _role_map(close_markers or {})
    body = F.array_join(
        F.transform(_col(messages), lambda m: F.concat(
            F.coalesce(F.try_element_at(opens, m["role"]), F.lit("")),
            F.coalesce(m["content"], F.lit("")),
            F.coalesce(F.try_element_at(closes, m["role"]), F.lit("")))),
        "")
    parts = [F.lit(bos), body]
    if generation_prompt:
        parts.append(F.lit(generation_prompt))
    return F.concat(*parts)


def strip_literal(text: Column | str, token: str) -> Column:
    """Remove every occurrence of ``token`` (apply to rendered suffixes only)."""
    return F.replace(_col(text), F.lit(token), F.lit(""))


def trim_block(text: Column | str, side: str = "both") -> Column:
    """Strip whitespace including newlines from one or both ends."""
    c = _col(text)
    if side in ("left", "both"):
        c = F.regexp_replace(c, "^" + WHITESPACE_CLASS + "+", "")
    if side in ("right", "both"):
        c = F.regexp_replace(c, WHITESPACE_CLASS + "+$", "")
    if side not in ("left", "right", "both"):
        raise ValueError("side must be left, right or both")
    return c
