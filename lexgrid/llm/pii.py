"""Personal data spans with DataFrame functions only.

Regular expressions propose spans, checksums confirm them (Luhn for cards,
mod-97 for bank account numbers, ranges for addresses and social security
numbers), and words in the neighbouring text move the score. The four base
kinds stay whatever their score; the added kinds need ``MIN_SCORE``.

Offsets come from the text between the matches (``split``) and the matches
(``regexp_extract_all``) of the same pattern, summed up in code points by a
fold in blocks, so a text with very many matches costs about n**1.5, not n**2.
The patterns are possessive and start only where a run of their characters
starts, so each is linear in the length of the text; their matches are those
of the plain patterns (tests hold them against those).

Defined cases: a null text is the empty text and has no spans; repeated rows each
get their row; only the named columns are read; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexgrid.functions.sequences import let
from lexgrid.llm.common import fresh

BLOCK = 256
NEAR = 40
MIN_SCORE = 0.6
SPAN = "array<struct<kind:string,start:long,end:long,score:double>>"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    hint: str               # a cheap test a text must pass before the pattern is tried
    base: bool
    score: float
    words: tuple[str, ...]  # in the text near by, in any case: these raise the score


KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", True, 0.8,
         ("mail", "contact", "write")),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+", ".", True, 0.6, ("ip", "address", "host", "server")),
    Kind("card", r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++", "", True, 0.8, ("card", "visa", "credit", "payment")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", True, 0.7, ("phone", "tel", "call", "mobile")),
    Kind("iban", r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,}", "", False, 0.7, ("iban", "account", "bank")),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "-", False, 0.4, ("ssn", "social security")),
)
ALNUM = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
IP_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def luhn(digits: Column) -> Column:
    """The Luhn sum of a string of digits ends in 0."""
    doubled = lambda d: d * 2 - F.when(d > 4, 9).otherwise(0)
    total = F.aggregate(
        F.transform(F.split(F.reverse(digits), ""), lambda c, i: let(c.cast("int"), lambda d: F.when(
            i % 2 == 1, doubled(d)).otherwise(d))), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """The first four characters moved behind, letters as 10 to 35: the number is 1 modulo 97."""
    turned = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))
    return F.aggregate(
        F.transform(F.split(turned, ""), lambda c: F.position(c, F.lit(ALNUM)) - 1),
        F.lit(0), lambda a, v: F.when(v < 0, a).when(v > 9, (a * 100 + v) % 97).otherwise((a * 10 + v) % 97)) == 1


def confirmed(kind: str, m: Column, before: Column, after: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.regexp_like(m, F.lit(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$"))
    if kind == "card":
        return let(F.regexp_replace(m, "[^0-9]", ""), lambda d: F.length(d).between(14, 19) & luhn(d))
    if kind == "phone":
        return F.length(F.regexp_replace(m, "[^0-9]", "")).between(10, 15)
    if kind == "iban":
        return (F.length(m) <= 34) & mod97(m)
    return ~F.regexp_like(m, F.lit("^(?:000|666|9)|-00-|-0000$")) & ~F.regexp_like(before, F.lit("[0-9-]$")) \
        & ~F.regexp_like(after, F.lit("^[0-9-]"))


def _spans(text: Column, kind: Kind) -> Column:
    """Spans of one kind, in order."""
    pieces = F.split(text, kind.pattern, -1)
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))

    def judged(found: Column, pieces: Column) -> Column:
        rows = F.zip_with(F.zip_with(found, F.slice(pieces, 1, F.size(found)), lambda m, b: F.struct(
            m.alias("m"), b.alias("before"))), F.slice(pieces, 2, F.size(found)), lambda x, a: F.struct(
                F.length(x["before"]).alias("gap"), F.length(x["m"]).alias("len"),
                F.when(confirmed(kind.name, x["m"], x["before"], a), _score(kind, x["before"], a)).alias("score")))
        return _placed(rows, kind.name)

    spans = let(F.struct(found.alias("f"), pieces.alias("p")), lambda x: F.when(
        F.size(x["f"]) == 0, F.array().cast(SPAN)).otherwise(judged(x["f"], x["p"])))
    return F.when(F.contains(text, F.lit(kind.hint)), spans).otherwise(F.array().cast(SPAN)) if kind.hint else spans


def _score(kind: Kind, before: Column, after: Column) -> Column:
    near = F.lower(F.concat(F.right(before, F.lit(NEAR)), F.lit("\n"), F.left(after, F.lit(NEAR))))
    return F.lit(kind.score) + F.when(F.regexp_like(near, F.lit("|".join(kind.words))), 0.3).otherwise(0.0)


def _placed(rows: Column, kind: str) -> Column:
    """Running offsets over gaps and lengths, block by block; unconfirmed matches go."""
    state = f"struct<at:long,out:{SPAN}>"
    zero = lambda at: F.struct(at.cast("long").alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        return F.struct((start + x["len"]).cast("long").alias("at"), F.when(x["score"].isNull(), acc["out"]).otherwise(
            F.concat(acc["out"], F.array(F.struct(
                F.lit(kind).alias("kind"), start.cast("long").alias("start"),
                (start + x["len"]).cast("long").alias("end"), x["score"].cast("double").alias("score"))))).cast(SPAN).alias("out")).cast(state)

    def block(acc: Column, b: Column) -> Column:
        inner = F.aggregate(F.slice(rows, b * BLOCK + 1, BLOCK), zero(acc["at"]).cast(state), step)
        return let(inner, lambda r: F.struct(r["at"].alias("at"), F.concat(acc["out"], r["out"]).alias("out")).cast(state))

    blocks = F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / BLOCK).cast("int"))
    return F.aggregate(blocks, zero(F.lit(0)).cast(state), block, lambda s: s["out"])


def pii_spans(df: DataFrame, text: str = "text", name: str = "pii", min_score: float = MIN_SCORE) -> DataFrame:
    """Add ``name``: all spans (kind, start, end, score) by start, then in the order of ``KINDS``."""
    t = F.coalesce(F.col(text), F.lit(""))
    per_kind = [_spans(t, k) if k.base else F.filter(_spans(t, k), lambda s: s["score"] >= min_score) for k in KINDS]
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k.name, i)])
    ordered = F.transform(F.array_sort(F.transform(F.concat(*per_kind), lambda s: F.struct(
        s["start"].alias("start"), F.element_at(rank, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"),
        s["score"].alias("score")))), lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score")))
    return df.withColumn(name, ordered)


def written_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: counts of the base kinds, a digest of the base spans, all spans, counts of the added kinds."""
    found = pii_spans(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")))
    count = lambda k: F.size(F.filter("pii", lambda s: s["kind"] == k)).cast("long")
    base = [k.name for k in KINDS if k.base]
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(written_spans(F.filter("pii", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        written_spans(F.col("pii")).alias("spans"),
        *[count(k.name).alias(f"n_{k.name}") for k in KINDS if not k.base])


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; where spans overlap, the
    one that starts first (then the kind listed first) counts and the others are dropped."""
    own = fresh(docs, "_pii")
    found = pii_spans(docs, text, own)
    # of overlapping spans the first counts
    chosen = F.aggregate(own, F.array().cast(SPAN), lambda a, s: F.when(
        (F.size(a) > 0) & (F.try_element_at(a, F.lit(-1))["end"] > s["start"]), a).otherwise(F.concat(a, F.array(s))))
    t = F.coalesce(F.col(text), F.lit(""))
    # a piece of text before each span, the span's kind, and the text behind the last one
    parts = let(chosen, lambda c: F.flatten(F.zip_with(c, F.concat(F.array(F.lit(0).cast("long")), F.transform(c, lambda s: s["end"])),
        lambda s, at: F.when(s.isNotNull(), F.array(F.substr(t, (at + 1).cast("int"), (s["start"] - at).cast("int")),
                                                    F.concat(F.lit("["), s["kind"], F.lit("]"))))
        .otherwise(F.array(F.substr(t, (at + 1).cast("int")))))))
    return found.withColumn(text, F.when(F.size(own) == 0, F.col(text)).otherwise(F.array_join(parts, ""))).drop(own)
