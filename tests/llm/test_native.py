"""Exact deduplication and personal data: SQL twins, brute force, plans, odd inputs."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from lexgrid.llm.exact_dedup import DigestIndex, kept_rows
from lexgrid.llm.pii import pii_report, pii_spans, redacted
from lexgrid.llm.queries import ORACLE, QUERIES
from lexgrid.plans.verify import compare, duckdb_views

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, texts, start=0):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts, start)], DOC)


@pytest.mark.parametrize("name", sorted(set(ORACLE) & set(QUERIES)))
def test_twin(spark, small_dir, name):
    diff = compare(QUERIES[name](spark, small_dir), duckdb_views(small_dir), ORACLE[name])
    assert diff is None, diff


def norm(t):
    return re.sub("[ \t-\r]", "", t or "")


def test_exact_dedup_rules(spark):
    texts = ["a b", "ab", "a  b", None, "", " \n", "B", "a\tb ", "ab"]
    got = {r.doc_id: r for r in DigestIndex(spark, buckets=4).dedup(docs(spark, texts)).collect()}
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(norm(t), []).append(i)
    for key, ids in groups.items():
        keep = min(ids, key=lambda i: (-len(texts[i] or ""), i))
        for i in ids:
            assert (got[i].keep_id, got[i].group_size, got[i].kept) == (keep, len(ids), i == keep)
            assert got[i].text_sha256 == hashlib.sha256(key.encode()).hexdigest()


def test_index_persists_between_batches(spark):
    index = DigestIndex(spark, buckets=4)
    index.dedup(docs(spark, ["x", "y", "y"])).collect()
    again = DigestIndex(spark, index.path, buckets=4)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in again.dedup(docs(spark, ["y ", "z", "x", "z"], 10)).collect()}
    assert got == {10: (1, 3, False), 11: (11, 2, True), 12: (0, 2, False), 13: (11, 2, False)}
    assert again.rows().count() == 3
    plan = again.rows().hint("merge").join(spark.table(again.name), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan      # the buckets serve the join


def test_index_keeps_its_settings_and_counts(spark):
    texts = [f"text {i}" for i in range(50)]
    index = DigestIndex(spark, buckets=4)
    sizes = []
    for _ in range(3):
        sizes.append({r.group_size for r in index.dedup(docs(spark, texts)).collect()})
    assert sizes == [{1}, {2}, {3}]
    index.close()
    again = DigestIndex(spark, index.path)
    assert again.buckets == 4 and again.rows().count() == 50 and {r.n_rows for r in again.rows().collect()} == {3}
    got = again.dedup(docs(spark, texts + ["new"], 100)).collect()
    assert [r.doc_id for r in got if r.kept] == [150] and {r.keep_id for r in got if not r.kept} == set(range(50))
    for wrong in ({"buckets": 7}, {"id_type": "string"}):
        with pytest.raises(ValueError, match="the index in"):
            DigestIndex(spark, index.path, **wrong)
    plan = again.rows()._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan       # the buckets serve the counts


def test_batches_with_copies_keep_one_of_each(spark):
    index = DigestIndex(spark, buckets=3)
    first = kept_rows(docs(spark, ["a", "a ", "b", "c"]), index=index)
    assert sorted(r.doc_id for r in first.collect()) == [1, 2, 3]
    second = kept_rows(docs(spark, ["b", "d", "d", "a"], 10), index=index)
    assert sorted(r.doc_id for r in second.collect()) == [11]


def test_exact_dedup_odd_rows(spark):
    rows = [(1, "t"), (1, "t"), (None, "t"), (None, "u"), (2, "t")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"digest": F.lit(1), "n_rows": F.lit(2), "_key": F.lit(3)})
    got = DigestIndex(spark, buckets=2).dedup(df).collect()
    assert len(got) == 5 and sum(r.kept for r in got) == 2
    assert {r.group_size for r in got if r.keep_id == 1} == {4}
    assert DigestIndex(spark, buckets=2).dedup(df.limit(0)).count() == 0
    left = kept_rows(df.where("doc_id IS NULL OR doc_id = 2"))
    assert left.columns == df.columns and {(r.doc_id, r.text) for r in left.collect()} == {(2, "t"), (None, "u")}


def test_kept_rows_of_repeated_ids(spark):
    kind = "doc_id bigint, text string"
    rows = [(1, "t"), (1, "t"), (None, "t"), (None, "u"), (2, "t"), (3, "t"), (3, "only here"), (4, "full"), (4, "full"), (5, "a"), (5, "a b"), (5, "ab")]
    left = kept_rows(spark.createDataFrame(rows, kind))
    assert sorted(((r.doc_id or 0), r.text) for r in left.collect()) == [(0, "u"), (1, "t"), (3, "only here"), (4, "full"), (5, "a"), (5, "a b")]
    assert [tuple(r) for r in kept_rows(spark.createDataFrame([(1, "t"), (1, "t"), (2, "t")], kind)).collect()] == [(1, "t")]
    assert [tuple(r) for r in kept_rows(spark.createDataFrame([(None, "t"), (None, "t")], kind)).collect()] == [(None, "t")]


def test_hot_digest_plan(spark):
    df = docs(spark, ["same"] * 300 + [str(i) for i in range(50)])
    out = DigestIndex(spark, buckets=4).dedup(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
    assert out.where("kept").count() == 51


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    s = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
    return s % 10 == 0


def brute(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or "", re.ASCII):
            d = re.sub("[^0-9]", "", m.group(0))
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group(0).split(".")),
                  "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), rank, m.end(), kind))
    return [(k, a, b) for a, _, b, k in sorted(out)]


TRICKY = ["a@b.c@d.e", "a@b.c_d@e.f", "x@y z@w.com.", "@b.c a@.b a@b", "%@-.-", "1.2.3.4.5.6.7.8", "256.1.1.1 0000255.1.1.1 1.2.3", "12.3.4.5.",
          "4111 1111 1111 1111", "4111-1111-1111-1111 0", "41111111111111112 4111111111111111", "5  5", "+1 (415) 555-2671", "+1+1 234 567 8901-", "+12345678901234567",
          "é4111111111111111ü a@b.co", "😀 a@b.co 😀 1.1.1.1", None, "", "9" * 3000, "a" * 5000, "." * 3000, "1." * 3000, "a@" * 500 + "b.c", "+1 " * 400]


def test_pii_base_spans(spark):
    rng = random.Random(4)
    texts = TRICKY + ["".join(rng.choice("a1.@+- 4()0") for _ in range(rng.randrange(60))) for _ in range(600)]
    texts += ["4111111111111111 a@b.co 10.0.0.1 +1 415 555 2671 " * 400]
    got = {r.doc_id: r for r in pii_report(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        want = brute(t)
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert got[i].base_sha256 == hashlib.sha256(line.encode()).hexdigest(), (i, (t or "")[:80], got[i].spans[:200], line[:200])
        assert [got[i][f"n_{k}"] for k in BASE] == [sum(x[0] == k for x in want) for k in BASE]


def test_pii_added_kinds(spark):
    texts = ["IBAN GB82WEST12345698765432 ok", "GB82WEST12345698765433", "ssn 123-45-6789", "123-45-6789 alone", "ssn 000-45-6789", "SSN: 1123-45-6789"]
    got = [r.spans for r in pii_report(docs(spark, texts)).orderBy("doc_id").collect()]
    assert got == ["iban:5:27", "", "ssn:4:15", "", "", ""]


def test_pii_scores_and_columns(spark):
    df = docs(spark, ["mail a@b.co", "a@b.co"]).withColumns({"kind": F.lit(1), "start": F.lit(2), "end": F.lit(3)})
    got = [[(s["kind"], round(s["score"], 2)) for s in r.pii] for r in pii_spans(df).orderBy("doc_id").collect()]
    assert got == [[("email", 1.1)], [("email", 0.8)]]
    assert pii_spans(df).columns == [*df.columns, "pii"]
    plan = pii_report(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert pii_report(df.limit(0)).count() == 0


def test_redaction(spark):
    texts = ["é a@b.co, 1.1.1.1!", None, "plain", "+4111111111111111 x", "a@b.co" * 3]
    got = [r.text for r in redacted(docs(spark, texts)).orderBy("doc_id").collect()]
    assert got[:4] == ["é [email], [ip]!", None, "plain", "+[card] x"] and got[4].startswith("[email]") and "@b.co" not in got[4][:12]
