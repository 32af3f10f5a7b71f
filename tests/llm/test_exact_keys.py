"""Keys and other columns come back as they were given, whatever stands beside them; odd vectors; long conversations."""

import functools
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexgrid.llm import chat
from lexgrid.llm.best_fit import pack_best_fit
from lexgrid.llm.exact_dedup import DigestIndex, kept_rows
from lexgrid.llm.jaccard_join import jaccard_components, one_per_component
from lexgrid.llm.merkle import Manifest
from lexgrid.llm.packing import pack
from lexgrid.llm.paragraph_dedup import repeat_report, without_repeats
from lexgrid.llm.pii import pii_report, redacted
from lexgrid.llm.queries import tokenizer_file
from lexgrid.llm.secret_scan import findings, fit_network, secret_report
from lexgrid.llm.sentencepiece_codec import encoding_report
from lexgrid.llm.topk_mtree import top_k
from lexgrid.llm.toxicity import fit_chain, predict, without_toxic

BIG = 2**53 + 1
KEYS = [BIG, None, BIG + 2, -BIG, 7]
WORDS = " ".join(f"w{i}" for i in range(80))
TEXTS = [" ".join(f"own{i}" for i in range(60)) + "\n" + WORDS, "no id", None, WORDS, "bad"]
KIND = "doc_id bigint, text string, n_chars bigint, tags array<bigint>, small int"
ROWS = [(k, t, None if i % 2 else BIG + i, [BIG, None], None if i else 3) for i, (k, t) in enumerate(zip(KEYS, TEXTS))]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, KIND).coalesce(1)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(BIG, 0, 0), (BIG + 2, 1, 0), (7, 1, 0), (-BIG, 0, 0)], "doc_id bigint, quality int, toxic int")


def ids(df, column="doc_id"):
    return sorted((r[column] is not None, r[column] or 0) for r in df.collect())


EVERY = sorted((k is not None, k or 0) for k in KEYS)


def test_reports_keep_keys(docs, labels):
    path = tokenizer_file("byte_bpe_50k.json")
    assert ids(predict(docs, fit_chain(docs, labels))) == EVERY
    assert ids(pii_report(docs)) == EVERY
    assert ids(DigestIndex(docs.sparkSession, buckets=2).dedup(docs)) == EVERY
    assert ids(encoding_report(docs, tokenizer_file("piece_bpe_32k.model"))) == EVERY
    assert ids(jaccard_components(docs)) == EVERY
    assert ids(secret_report(docs, fit_network(findings(docs)))) == EVERY
    assert ids(pack(docs, path)) == EVERY and ids(pack_best_fit(docs, path)) == EVERY
    assert ids(Manifest(docs.withColumns({"source": F.lit("s"), "lang": F.lit("l")})).proofs(), "key") == EVERY
    report = repeat_report(docs).collect()
    assert {r.doc_id for r in report} == {BIG, -BIG} and {r.first_doc_id for r in report} == {-BIG}


def test_filters_keep_columns(docs, labels):
    want = {(r[0], r[2], tuple(r[3]), r[4]) for r in ROWS}
    for df in (without_toxic(docs, labels), kept_rows(docs), one_per_component(docs), redacted(docs), without_repeats(docs)):
        assert df.columns == docs.columns
        assert {(r.doc_id, r.n_chars, tuple(r.tags), r.small) for r in df.collect()} == want


def test_chat_keeps_keys(spark):
    rows = [(BIG, 0, "user", "a"), (None, 0, "user", "b"), (BIG + 2, None, "assistant", "c")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").coalesce(1)
    got = chat.chat_digests(chat.format_chats(chat.conversations(df)))
    assert ids(got, "conv_id") == [(False, 0), (True, BIG), (True, BIG + 2)]


def by_hand(rows, k):
    """Top k by integer products, zeros after the shorter vectors."""
    whole = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows]
    out = []
    for i, q in whole:
        if i % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in whole if j != i)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def test_vectors_of_odd_length_and_size_take_part(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1), rng.uniform(-1, 1)]) for i in range(1, 300)] + [(0, [0.5]), (400, [200000.0, 0.0]), (401, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows + [(500, None), (600, [float("nan"), 1.0])], "vec_id bigint, embedding array<float>")
    got = sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 100 == 0).collect())
    assert got == by_hand(rows, 10)


def test_long_conversations_cost_their_length():
    turns = [("user" if i % 2 else "assistant", f"turn {i} </s> " * 3) for i in range(40_000)]
    began = time.time()
    out, spans, rewrites = chat.locate(turns, chat.inst_template)
    assert time.time() - began < 60 and rewrites == 0
    assert out == chat.inst_template(turns) and all(chat.unescape(out[a:b]) == t for (a, b), (_, t) in zip(spans[::97], turns[::97]))


@pytest.mark.parametrize("name, template", [
    ("drops the oldest", lambda turns: chat.inst_template(turns[-50:])),
    ("end mark once it is long", lambda turns: chat.inst_template(turns) + ("" if len(turns) < 90 else "!")),
    ("counts its turns", lambda turns: "".join(f"{i}>{t}\n" for i, (_, t) in enumerate(turns))),
    ("looks one back", lambda turns: "".join(("same " if i and turns[i - 1][0] == r else "other ") + t + ";" for i, (r, t) in enumerate(turns))),
])
def test_templates_that_look_back(monkeypatch, name, template):
    rng = random.Random(name)
    turns = [(rng.choice("ab"), "x" * rng.randrange(4) + str(i)) for i in range(150)]
    got = chat.locate(turns, template)
    monkeypatch.setattr(chat, "WHOLE", 10**9)
    assert got == chat.locate(turns, template)


def test_no_length_hides_a_rewrite():
    """Windows can't see that the 50th prefix alone is rendered otherwise; the count must not depend on the length."""
    def once(turns):
        return ("#" if len(turns) == 50 else "") + chat.inst_template(turns)

    turns = [("user" if i % 2 else "assistant", f"turn {i}") for i in range(80)]
    for n, rewrites in ((49, 0), (50, 1), (51, 2), (80, 2)):
        out, spans, got = chat.locate(turns[:n], once)
        assert out == once(turns[:n]) and got == rewrites and [out[a:b] for a, b in spans] == [t for _, t in turns[:n]]


def test_built_in_template_is_rendered_by_prefixes():
    """Nothing stands beside the template that spares op4 the prefixes: each is rendered whole, twice, and a rewrite is seen."""
    turns = [("user" if i % 2 else "assistant", f"turn {i % 7} \\ </s> \xa4 {chr(0x1f600) if i > 20 else ''}") for i in range(60)]
    given = []

    @functools.wraps(chat.inst_template)
    def seen(some):
        given.append(list(some))
        return chat.inst_template(some)

    out, spans, rewrites = chat.locate(turns, seen)
    assert (out, rewrites) == (plain_inst(turns), 0) and [chat.unescape(out[a:b]) for a, b in spans] == [t for _, t in turns]
    for k in range(60):
        assert turns[:k + 1] in given and any(g[:-1] == turns[:k] and g[-1][0] == turns[k][0] and g[-1] != turns[k] for g in given if len(g) == k + 1)

    @functools.wraps(chat.inst_template)
    def once(some):
        return ("#" if len(some) == 50 else "") + chat.inst_template(some)

    out, spans, rewrites = chat.locate(turns, once)
    assert (out, rewrites) == (plain_inst(turns), 2) and [chat.unescape(out[a:b]) for a, b in spans] == [t for _, t in turns]


def plain_inst(turns):
    return "".join(f"<s>[INST] {chat.escape(r)} [/INST]{chat.escape(t)}</s>" for r, t in turns)


def test_built_in_template_depends_on_its_turns_alone():
    rng = random.Random(8)
    turns = []
    for _ in range(4000):
        step = rng.randrange(6)
        if step < 3:
            turns = [*turns, (rng.choice("ab"), rng.choice(["", "x", "</s>", "\xa4\xa4", "\\"]))]
        elif step == 3:
            turns = turns[:rng.randrange(len(turns) + 1)]
        elif turns:
            turns = list(turns)
            turns[rng.choice([-1, rng.randrange(len(turns))])] = ("c", str(step))
        assert chat.inst_template(rng.choice([list, tuple])(turns)) == plain_inst(turns)


@pytest.mark.parametrize("texts", [["\xa4", "a\xa4", "\xa4\xa4b", "", "\xa4" * 5], ["\ue000", "x\xa4", "\xa4", "\ue000\ue000"]])
def test_probes_beside_their_like(texts):
    """Texts without markup around them that hold or end in the probe's character."""
    turns = [("user", t) for t in texts]
    out, spans, rewrites = chat.locate(turns, lambda some: "".join(t for _, t in some))
    assert rewrites == 0 and [out[a:b] for a, b in spans] == texts


@pytest.mark.parametrize("n", [0, 1, 2, 3, 40, 150])
def test_reach_is_the_templates_word(n):
    plain = lambda turns: "".join(("same " if i and turns[i - 1][0] == r else "other ") + t + ";" for i, (r, t) in enumerate(turns))
    rng = random.Random(n)
    turns = [(rng.choice("ab"), "x" * rng.randrange(4) + str(i)) for i in range(n)]
    calls = []

    def counted(turns):
        calls.append(len(turns))
        return plain(turns)

    assert chat.locate(turns, chat.looks_back(1)(counted)) == chat.locate(turns, plain)
    assert sum(calls) <= 7 * n              # windows of two turns, at any length
    assert chat.locate(turns, chat.looks_back(0)(lambda turns: plain(turns))) == chat.locate(turns, plain)     # its word doesn't hold
