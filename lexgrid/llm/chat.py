"""Chat formatting by incremental rendering of a template that is a black box.

Prefixes of one, two, ... turns are rendered and each output is compared with
the one before. What is new is the turn's span; a second rendering of the same
prefix with a probe for the turn's text shows which part of the span is markup.
A template whose output for a prefix is not the beginning of the output for
the next prefix has rewritten history: such turns are counted, and the spans
are taken again from the place where both outputs part.

All prefixes are rendered whole, at any length: nothing less tells a template's rewrites, and the cost is square in the turns. Only
a caller's template marked ``looks_back(n)`` is rendered from ``n`` turns back, and what is put together so must be the rendering of
the whole conversation (else the word doesn't hold, and all prefixes are rendered whole).

The built-in template writes ``<s>[INST] role [/INST]text</s>`` a turn. Control
strings and backslashes inside roles and texts get a backslash in front, so
every text can be read back. It is no exception: ``locate`` takes nothing about it for granted.
It goes on from the text that it made last where the turns before are the same, so a prefix costs a copy and a comparison.

Defined cases: null roles and texts are empty; turns are ordered by turn, role,
text (null turns first), rows repeated in full stay repeated turns; rows with a null
conversation key are conversations of one turn each; an empty table gives no rows;
only the named columns are read. A conversation is one result row and is put
together in one task.
"""

from __future__ import annotations

import hashlib
import re
import threading
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgrid.llm.common import map_slices

# fixed values: the control strings of the template
OPEN, MIDDLE, CLOSE = "<s>[INST] ", " [/INST]", "</s>"
CONTROL = re.compile(r"\\|<s>|</s>|\[INST\]|\[/INST\]")
TOKENS = re.compile(r"\\.|<s>\[INST\] | \[/INST\]|</s>", re.DOTALL)

PROBE = "\xa4"              # one byte a character, as most texts have: wider ones make copies and comparisons slow
RUNS = re.compile(PROBE + "+")
WHOLE = 1 << 62             # reach of a template that may look at every turn

bytes(1 << 24)              # once a block of this size was freed, glibc keeps memory for prefixes at hand and maps none anew for each

Turns = Sequence[tuple[str, str]]
Template = Callable[[Turns], str]


def looks_back(turns: int) -> Callable[[Template], Template]:
    """Marks a template that appends each turn, by that turn and ``turns`` before it alone."""
    def mark(render: Template) -> Template:
        render.reach = turns
        return render
    return mark


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\" + m.group(0), text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def _inst_turn(turn: tuple[str, str]) -> str:
    return f"{OPEN}{escape(turn[0])}{MIDDLE}{escape(turn[1])}{CLOSE}"


class _Last(threading.local):
    """What ``inst_template`` was given last, but for the last turn, its text, and the texts with the last turns that followed."""

    def __init__(self) -> None:
        self.known: list[tuple[str, str]] = []
        self.text = ""
        self.wholes: dict[tuple[str, str], str] = {}


_last = _Last()


def inst_template(turns: Turns) -> str:
    if not turns:
        return ""
    n, end = len(turns) - 1, turns[-1]
    if n == len(_last.known) + 1 and turns[n - 1] in _last.wholes:
        _last.known.append(turns[n - 1])
        _last.text, _last.wholes = _last.wholes[turns[n - 1]], {}
    _last.known.append(end)
    same = _last.known == (turns if isinstance(turns, list) else list(turns))
    _last.known.pop()
    if not same:
        known = list(turns[:n])
        _last.text, _last.wholes, _last.known = "".join(map(_inst_turn, known)), {}, known
    whole = _last.text + _inst_turn(end)
    _last.wholes[end] = whole
    if len(_last.wholes) > 2:
        del _last.wholes[next(iter(_last.wholes))]
    return whole


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation; raises ValueError on anything else."""
    turns, at, state, role = [], 0, OPEN, ""
    for m in TOKENS.finditer(formatted):
        if m.group(0)[0] == "\\":
            continue
        if m.group(0) != state:
            if state == OPEN or m.group(0) != MIDDLE:
                raise ValueError(f"unexpected {m.group(0)!r} at {m.start()}")
            continue                        # " [/INST]" can't stand unescaped in a text; kept for foreign input
        part = formatted[at:m.start()]
        if state == MIDDLE:
            role = unescape(part)
        elif state == CLOSE:
            turns.append((role, unescape(part)))
        elif part:
            raise ValueError(f"text outside turns at {at}")
        state = {OPEN: MIDDLE, MIDDLE: CLOSE, CLOSE: OPEN}[state]
        at = m.end()
    if state != OPEN or at != len(formatted):
        raise ValueError("the last turn is not closed")
    return turns


def _parted(a: str, b: str) -> int:
    """Length of the common beginning."""
    if b.startswith(a):
        return len(a)
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return lo


def _unused(out: str, clear: int = 0, probe: str = PROBE) -> str:
    """``probe``, made longer where ``out`` has it; the first ``clear`` characters don't."""
    return max([probe, *(run + PROBE for run in RUNS.findall(out, max(0, clear - len(probe) + 1)))], key=len)


def _probed(turns: list[tuple[str, str]], out: str, render: Template, probe: str, known: str = "") -> tuple[int, int] | None:
    """The span of the last turn's text in ``out``, which begins with ``known`` and lacks ``probe``; None where it can't be told
    from the markup around it. Puts the probe into ``turns``."""
    turns[-1] = (turns[-1][0], probe)
    shown = render(turns)
    at = len(known) if shown.startswith(known) else 0
    head = shown.find(probe, at)
    after = shown[head + len(probe):]
    if head >= 0 and out.startswith(shown[at:head], at) and out.endswith(after) and head + len(after) <= len(out):
        return head, len(out) - len(after)
    return None


def _near(turns: Turns, render: Template, reach: int) -> tuple[str, list[tuple[int, int]]] | None:
    """The rendering and the spans by windows; None where these don't make the whole."""
    pieces, at, spans = [], 0, []
    for k in range(len(turns)):
        window = turns[max(0, k - reach):k]
        before, now = render(window) if window else "", render([*window, turns[k]])
        if not now.startswith(before):
            return None
        found = _probed([*window, turns[k]], now, render, _unused(now)) or (len(before), len(before))
        if found[0] < len(before):
            return None
        spans.append((found[0] + at - len(before), found[1] + at - len(before)))
        pieces.append(now[len(before):])
        at += len(pieces[-1])
    out = "".join(pieces)
    return (out, spans) if not turns or render(turns) == out else None


def locate(turns: Turns, render: Template) -> tuple[str, list[tuple[int, int]], int]:
    """The full rendering, the span of each turn's text in it, and how many prefixes rewrote history.

    A turn whose text can't be told from the markup around it (the template
    drops it, or its markup depends on it) gets an empty span where the turn begins.
    """
    reach = getattr(render, "reach", WHOLE)
    told = _near(turns, render, reach) if reach < WHOLE else None
    if told is not None:
        return *told, 0
    turns = list(turns)
    out, spans, rewrites, probe = "", [], 0, PROBE
    for k in range(len(turns)):
        before, out = out, render(turns[:k + 1])
        start = _parted(before, out)
        probe = _unused(out, start, probe)
        if start < len(before):
            rewrites += 1
            spans = [s if s[1] <= start else (-1, -1) for s in spans]
        spans.append(_probed(turns[:k + 1], out, render, probe, before if start == len(before) else "") or (start, start))
    if any(s[0] < 0 for s in spans):        # rewritten parts: look for their texts in order, in what is left
        at, fixed = 0, []
        for (role, text), s in zip(turns, spans):
            if s[0] < 0:
                found = out.find(escape(text), at)
                s = (found, found + len(escape(text))) if found >= 0 else (at, at)
            fixed.append(s)
            at = max(at, s[1])
        spans = fixed
    return out, spans, rewrites


def conversations(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turns``: one row per conversation, turns in order."""
    one = rows.select(F.col(key).alias("conv_id"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    known = one.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return known.unionByName(one.where(F.col("conv_id").isNull()).select("conv_id", F.array("t").alias("turns")))


def format_chats(chats: DataFrame, render: Template = inst_template, learn: str = "assistant") -> DataFrame:
    """``conv_id, formatted, roles, spans, loss, n_rewrites``.

    ``spans`` are the texts' places (code points, end exclusive), ``loss``
    those of the ``learn`` role.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for conv, turns in zip(f["conv_id"], f["turns"]):
                pairs = [(t["role"], t["text"]) for t in turns]
                out, spans, rewrites = locate(pairs, render)
                loss = [s for s, (r, _) in zip(spans, pairs) if r == learn]
                rows.append((conv, out, [r for r, _ in pairs], _records(spans), _records(loss), rewrites))
            yield pd.DataFrame(rows, columns=["conv_id", "formatted", "roles", "spans", "loss", "n_rewrites"])

    span = "array<struct<start:int,end:int>>"
    kind = chats.schema["conv_id"].dataType.simpleString()
    return map_slices(chats.select("conv_id", "turns"), run,
                      f"conv_id {kind}, formatted string, roles array<string>, spans {span}, loss {span}, n_rewrites bigint")


def _records(spans: Sequence[tuple[int, int]]) -> list[dict]:
    return [{"start": a, "end": b} for a, b in spans]


def chat_digests(formatted: DataFrame) -> DataFrame:
    """Figures read back from the formatted texts and their loss masks alone."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for conv, text, loss, rewrites in zip(f["conv_id"], f["formatted"], f["loss"], f["n_rewrites"]):
                turns = read_back(text)
                learnt = "".join(unescape(text[s["start"]:s["end"]]) for s in loss)
                said = "".join(f"{r}\n{t}\n" for r, t in turns)
                rows.append((conv, len(turns), _sha(said), len(learnt), _sha(learnt), len(text), rewrites))
            yield pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                              "formatted_chars", "n_rewrites"])

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return map_slices(formatted.select("conv_id", "formatted", "loss", "n_rewrites"), run,
                      f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
             "formatted_chars bigint, n_rewrites bigint")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
