"""Edge rows from FIXTURES.md §4 for the column expressions."""

import math

from pyspark.sql import functions as F

from lexgrid.functions import clean as C
from lexgrid.functions import entity as EN
from lexgrid.functions import labels as L
from lexgrid.functions import prompts as T
from lexgrid.functions import sequences as Q
from lexgrid.operators.batching import unpad


def test_null_tokens_then_fill(spark):
    df = spark.createDataFrame([("NA",), ("",), (None,), ("Nathan",)], "v string")
    out = [r.v for r in C.fill_missing(C.null_tokens(df)).collect()]
    assert out == ["", "", "", "Nathan"]


def test_ensure_and_blank(spark):
    without = spark.createDataFrame([("a",)], "id string")
    with_col = spark.createDataFrame([("a", "Maple")], "id string, brand_name string")
    assert C.ensure_column(without, "brand_name").first().brand_name == ""
    assert C.ensure_column(with_col, "brand_name").first().brand_name == "Maple"
    assert C.blank_column(with_col, "brand_name").first().brand_name == ""


def test_rename_strict_and_require(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    assert C.rename(df, {"x": "z", "missing": "q"}).columns == ["z", "y"]
    try:
        C.rename(df, {"missing": "q"}, strict=True)
        raise AssertionError("strict rename should raise")
    except KeyError:
        pass
    try:
        C.require_columns(df, ["x"])
        raise AssertionError("extra column should raise")
    except ValueError:
        pass


def test_append_answer_and_trim(spark):
    df = spark.createDataFrame([("P", ""), ("P", "Maple")], "p string, a string")
    got = [r.t for r in df.select(T.append_answer("p", "a", "</s>").alias("t")).collect()]
    assert got == ["P", "PMaple</s>"]
    t = spark.createDataFrame([("\n  x",)], "s string").select(T.trim_block("s", "left").alias("t"))
    assert t.first().t == "x"


def test_render_template_braces(spark):
    df = spark.createDataFrame([("Tea", "B1")], "shop_name string, brand string")
    out = df.select(T.render_template("{{'n': '{shop_name}'}} -> {brand}").alias("t")).first().t
    assert out == "{'n': 'Tea'} -> B1"


def test_strip_literal_only_on_suffix(spark):
    df = spark.createDataFrame([("user says </s>", "answer</s>")], "u string, a string")
    r = df.select(F.concat("u", T.strip_literal("a", "</s>")).alias("t")).first().t
    assert r == "user says </s>answer"


def test_chat_template(spark):
    df = spark.createDataFrame([("hi", "yo")], "u string, a string")
    msgs = T.to_messages(F.lit("sys"), F.col("u"), F.col("a"))
    r = df.select(T.apply_chat_template(msgs, {"system": "[S]", "user": "[U]", "assistant": "[A]"},
                                        {"assistant": "</s>"}, "<s>").alias("t")).first().t
    assert r == "<s>[S]sys[U]hi[A]yo</s>"


def test_chat_template_fixed_roles_match_array_form(spark):
    df = spark.createDataFrame([("hi", "yo"), ("x", None)], "u string, a string")
    opens, closes = {"system": "[S]", "user": "[U]", "assistant": "[A]"}, {"assistant": "</s>"}
    for args in [(F.lit("sys"), F.col("u"), F.col("a")), (None, F.col("u"))]:
        for gen in [None, "[A]"]:
            arr = T.apply_chat_template(T.to_messages(*args), opens, closes, "<s>", gen)
            flat = T.apply_chat_template(T.message_turns(*args), opens, closes, "<s>", gen)
            rows = df.select(arr.alias("a"), flat.alias("f")).collect()
            assert all(r.a == r.f for r in rows)
    odd = [("tool", F.col("u"))]
    assert df.select(T.apply_chat_template(odd, opens, closes).alias("t")).first().t == "hi"


def test_truncate_and_pad_left(spark):
    df = spark.createDataFrame([([1, 2],), ([1, 2, 3, 4, 5],), (list(range(900)),)], "ids array<int>")
    t = df.select(Q.truncate("ids", 4).alias("t"))
    padded = t.select(Q.pad_to("t", 4, 0, "left").alias("p"), Q.padded_mask("t", 4, "left").alias("m"))
    rows = padded.collect()
    assert [len(r.p) for r in rows] == [4, 4, 4]
    assert rows[0].p == [0, 0, 1, 2] and rows[0].m == [0, 0, 1, 1]
    back = padded.select(unpad("p", "m").alias("u")).collect()
    assert back[0].u == [1, 2]


def test_mask_by_marker_last_occurrence(spark):
    df = spark.createDataFrame([([1, 7, 8, 2, 7, 8, 3],), ([1, 2, 3],), ([7],)], "ids array<int>")
    got = [r.m for r in df.select(Q.mask_by_marker("ids", [7, 8]).alias("m")).collect()]
    assert got[0] == [-100, -100, -100, -100, -100, -100, 3]
    assert got[1] == [-100, -100, -100]
    assert got[2] == [-100]


def test_mask_by_boundary(spark):
    df = spark.createDataFrame([([4, 5], [6])], "p array<int>, c array<int>")
    assert df.select(Q.mask_by_boundary("p", "c").alias("m")).first().m == [-100, -100, 6]


def test_argmax_and_decode(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([float("nan"), 1.0, 2.0],), ([],)],
                               "l array<double>")
    got = [r.a for r in df.select(L.argmax("l").alias("a")).collect()]
    assert got == [1, 0, None]
    d = spark.createDataFrame([(9,), (1,)], "c int").select(
        L.decode_label("c", {0: "neg", 1: "neu", 2: "pos"}).alias("n")).collect()
    assert [r.n for r in d] == [None, "neu"]
    e = spark.createDataFrame([("pos",), ("zzz",)], "n string").select(
        L.encode_label("n", {0: "neg", 1: "neu", 2: "pos"}).alias("c")).collect()
    assert [r.c for r in e] == [2, None]


def test_sequence_correct_cases(spark):
    rows = [([9, 5, 6, 7], [-100, -100, 5, 6]), ([9, 5, 6, 7], [-100, -100, 5, 8]),
            ([1, 2, 3], [-100, -100, -100])]
    df = spark.createDataFrame(rows, "p array<int>, y array<int>")
    got = [r.ok for r in df.select(L.sequence_correct("p", "y").alias("ok")).collect()]
    assert got == [True, False, True]


def test_cross_entropy(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], 2)], "l array<double>, y int")
    v = df.select(L.cross_entropy("l", "y").alias("ce")).first().ce
    expect = math.log(sum(math.exp(x) for x in (1.0, 2.0, 3.0))) - 3.0
    assert abs(v - expect) < 1e-12


def test_trust_tier(spark):
    rows = [("yes", "9999285"), ("", "99997"), ("", "999988885"), ("", "123"), ("yes", "999988885"), ("no", "1"), ("N/A", "1"), (" YES ", "1"), (None, None)]
    df = spark.createDataFrame(rows, "flag string, bid string")
    got = [r.t for r in df.select(EN.trust_tier("flag", "bid").alias("t")).collect()]
    assert got == [1, 2, 3, 4, 1, 4, 4, 1, 4]


def test_normalise_name(spark):
    rows = [("Maple Tea (North Gate)",), ("Maple Tea（North Gate）",), ("Plain Name",),
            ("ＭＡＰＬＥ　Tea",)]
    df = spark.createDataFrame(rows, "n string")
    got = [r.x for r in df.select(EN.normalise_name("n").alias("x")).collect()]
    assert got == ["maple tea", "maple tea", "plain name", "maple tea"]
