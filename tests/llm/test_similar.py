"""Jaccard join, paragraph deduplication, top-k search: against brute force."""

import glob
import os
import random
import re
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexgrid.llm import common, jaccard_join, paragraph_dedup, simjoin, topk_mtree
from lexgrid.llm.common import hash_many, hash_words, maybe_in, shingles, without_keys, written
from lexgrid.llm.graph import components
from lexgrid.llm.jaccard_join import jaccard_components, one_per_component
from lexgrid.llm.paragraph_dedup import merge, repeat_report, signatures, without_repeats
from lexgrid.llm.simjoin import pigeonhole_cells
from lexgrid.session import checkpoint_root

WORDS = [f"w{i}" for i in range(400)]


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[ \t-\r]+", text) if w]


def shingle_set(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute_components(texts, k, t):
    sets = {i: shingle_set(x, k) for i, x in texts.items()}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and both * t.denominator >= t.numerator * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(rng, n):
    """Texts in chains of small edits, copies, short and empty texts."""
    out = []
    while len(out) < n:
        base = [rng.choice(WORDS) for _ in range(rng.choice([2, 3, 5, 12, 40, 120, 300]))]
        for _ in range(rng.randrange(1, 9)):
            out.append(" ".join(base))
            base = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                base[rng.randrange(len(base))] = rng.choice(WORDS)
            if rng.random() < 0.2:
                base += [rng.choice(WORDS) for _ in range(rng.randrange(6))]
    return out[:n]


@pytest.mark.parametrize("k, t", [(3, Fraction(9, 10)), (5, Fraction(4, 5)), (2, Fraction(1, 2))])
def test_jaccard_components(spark, k, t):
    rng = random.Random(k)
    texts = dict(enumerate([*near_copies(rng, 260), None, "", " \n", "one", "ONE", "one two", "A b C d E f"]))
    df = spark.createDataFrame([(i, x) for i, x in texts.items()], "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, k, t).collect()}
    assert got == brute_components(texts, k, t)


def test_second_pass(spark, monkeypatch):
    """Groups of three: connected sets of a home are not compared again, and no link is lost."""
    monkeypatch.setattr(simjoin, "GROUP_ROWS", 3)
    rng = random.Random(9)
    base = [rng.choice(WORDS) for _ in range(150)]
    drifting = []
    for _ in range(60):         # near copies of one text, then of what became of it
        drifting.append(" ".join(base[:rng.randrange(140, 150)]))
        base = list(base)
        base[rng.randrange(len(base))] = rng.choice(WORDS)
    texts = dict(enumerate([*drifting, *near_copies(rng, 120), *drifting[:5]]))
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, 3, Fraction(9, 10)).collect()}
    assert got == brute_components(texts, 3, Fraction(9, 10))
    assert len({c for _, c in got.values()}) < len(texts) - 60


def test_cells_are_not_stored(spark, monkeypatch):
    """Cells are many times the ids: no table that the join writes before the first filter holds them."""
    made = []
    for module in (jaccard_join, simjoin):
        keep = module.written
        monkeypatch.setattr(module, "written", lambda df, name, *a, keep=keep, **b: made.append((name, keep(df, name, *a, **b))) or made[-1][1])
    texts = dict(enumerate([" ".join(f"t{i}x{j}" for j in range(200)) for i in range(30)] + ["a b c d e f"] * 3))
    df = spark.createDataFrame([(i, x) for i, x in texts.items()], "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, 5, Fraction(4, 5)).collect()}
    assert got == brute_components(texts, 5, Fraction(4, 5))
    assert made and not [name for name, df in made if any(kind.startswith("array") for _, kind in df.dtypes) and not name.endswith("groups")]


def test_jaccard_rows_of_one_id(spark):
    """Ids of several rows, copies among them: every set of a kept text is linked, rows of copies add nothing."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (2, b), (3, b + " end"), (4, a), (4, a), (5, c), (6, c + " end"), (6, c), (7, c), (None, a), (8, None)]
    got = {tuple(r) for r in jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"), 5, Fraction(4, 5)).collect()}
    assert got == {(1, 36, 1), (2, 36, 1), (2, 36, 2), (3, 37, 2), (4, 36, 1), (5, 36, 5), (6, 37, 5), (6, 36, 5), (7, 36, 5), (None, 36, None), (8, 0, 8)}


def test_the_lighter_group_travels(spark, monkeypatch):
    """A heavy group that many light ones meet stays where it is; each group is read as one that meets itself, too."""
    rng, ways = np.random.default_rng(3), []
    keep = simjoin.written

    def seen(df, name, *a, **b):
        out = keep(df, name, *a, **b)
        if name == "t-ways":
            ways.extend(out.collect())
        return out

    monkeypatch.setattr(simjoin, "written", seen)
    base = rng.integers(1, 2**63, 70_000, dtype=np.uint64)
    heavy = {i: np.unique(base[i * 1000:(i + 1) * 1000]) for i in range(70)}          # more tokens than 16 bits count
    light = {100 + i: np.unique(np.r_[heavy[i][:950], rng.integers(1, 2**63, 20, dtype=np.uint64)]) for i in range(20)}
    light[200] = light[119]
    sets = {**heavy, **light}
    seats = spark.createDataFrame([(n, 500 if n < 100 else 119 if n == 200 else n) for n in sets], "node bigint, grp bigint")
    pairs = spark.createDataFrame([(500, g) if g % 2 else (g, 500) for g in range(100, 120)] + [(119, 119)], "g1 bigint, g2 bigint")
    tokens = spark.createDataFrame([(n, bytearray(x.tobytes())) for n, x in sets.items()], "node bigint, tokens binary")
    found = simjoin._compared(seats, pairs, lambda m: m.join(tokens, "node").select("node", "grp", "tokens"), Fraction(4, 5), "t")
    assert sorted(map(tuple, ways)) == [(g, 500) for g in range(100, 120)]
    by = {r.node: r.component_id for r in components(found).collect()}
    assert by == {**{n: n for n in range(20)}, **{100 + n: n for n in range(20)}, 200: 19}


def test_settings_of_a_write_are_put_back(spark):
    """Shuffle files go with the write that made them; the session keeps its own settings."""
    names = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch")
    before = [spark.conf.get(x) for x in names]

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    out = written(spark.range(100).repartition(1).mapInArrow(sizes, "n bigint"), "small-batches", batch=7)
    assert max(r.n for r in out.collect()) == 7
    with pytest.raises(Exception, match="no such thing"):
        written(spark.range(1).select(F.raise_error(F.lit("no such thing"))), "broken", batch=7)
    assert [spark.conf.get(x) for x in names] == before


def test_jaccard_odd_rows(spark):
    rows = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, "a B  c"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(7) for c in ("node", "cell", "grp", "size", "_hit", "_page")})
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in jaccard_components(df, 3).collect())
    assert got == [(0, 0), (1, 1), (1, 1), (2, 1), (3, 3)]
    left = one_per_component(df, 3)
    assert left.columns == df.columns
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 1, 1, 3]
    assert jaccard_components(df.limit(0), 3).count() == 0


def test_cells_lose_no_link():
    rng = np.random.default_rng(1)
    for t in (Fraction(9, 10), Fraction(4, 5), Fraction(1, 2)):
        for n in (1, 2, 3, 5, 9, 10, 11, 30, 200, 900):
            for _ in range(20):
                a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
                drop = rng.permutation(len(a))[:rng.integers(0, n + 1)]
                b = np.unique(np.r_[np.delete(a, drop), rng.integers(0, 2**63, rng.integers(0, n + 1), dtype=np.uint64)])
                both = len(np.intersect1d(a, b))
                if both and both * t.denominator >= t.numerator * (len(a) + len(b) - both):
                    (ca, na), (cb, nb) = pigeonhole_cells(a, t), pigeonhole_cells(b, t)
                    assert len(np.intersect1d(ca, cb)) >= max(na, nb) >= 1


def test_word_hashes():
    texts = ["Hello  wörld\thello", "", None, "x" * 300_000 + " y " + "z " * 200_000, "a"]
    got = list(hash_many(texts))
    assert [len(g) for g in got] == [3, 0, 0, 200_002, 1]
    assert got[0][0] == got[0][2] != got[0][1]
    assert np.array_equal(got[3], hash_words(texts[3].encode())[0])
    assert len(np.unique(next(hash_many([" ".join(map(str, range(100_000)))])))) == 100_000
    assert [len(shingles(got[0], k)) for k in (1, 3, 4)] == [3, 1, 1]


def test_key_filters(spark):
    df = spark.createDataFrame([(i if i % 7 else None, i) for i in range(300)], "id bigint, n int")
    keys = spark.range(0, 300, 3)
    ids = {r.id for r in maybe_in(df, "id", keys, "id").join(keys, "id").collect()}
    assert ids == {i for i in range(300) if i % 3 == 0 and i % 7}
    left = without_keys(df, "id", keys, "id")
    assert left.columns == ["id", "n"]
    assert sorted(r.n for r in left.collect()) == [i for i in range(300) if i % 3 or not i % 7]
    assert without_keys(df, "id", keys.limit(0), "id").count() == 300


def test_key_filter_is_its_hash(spark):
    """A row passes if, and only if, its slot is that of a key (a null has one too); the filter's words are read where they lie."""
    keys = spark.range(0, 6000, 3).select(F.concat(F.lit("k"), "id").alias("key"))
    df = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), F.lit(1).alias("n")).unionByName(
        spark.createDataFrame([(None, 1)], "key string, n int"))
    # few slots, in one page: every bit of its words is met
    small = 4096
    with pytest.MonkeyPatch.context() as m:
        m.setattr(common, "FILTER_BITS", small)
        found = maybe_in(df, "key", keys, "key")
        plan = found._jdf.queryExecution().toString()
        got = {r.key for r in found.collect()}
        slot = F.pmod(F.xxhash64("key"), F.lit(small))
        slots = {r[0] for r in keys.select(slot).collect()}
        want = {r.key for r in df.select("key", slot.alias("s")).collect() if r.s in slots}
    assert got == want and 6000 < len(want) < 20_000
    assert "getbit" in plan and "pow(" not in plan.lower()


def test_links_of_few_sets():
    """Groups of a set or two, and pairs of such groups, against the formula."""
    rng = np.random.default_rng(8)
    t = Fraction(4, 5)
    met = 0
    for _ in range(400):
        base = np.sort(rng.integers(0, 2**63, int(rng.integers(1, 30)), dtype=np.uint64))
        a, b = (np.unique(np.r_[base[rng.random(len(base)) < 0.95], rng.integers(0, 2**63, int(rng.integers(0, 3)), dtype=np.uint64), base[:1]])
                for _ in range(2))
        same = len(np.intersect1d(a, b))
        linked = Fraction(same, len(a) + len(b) - same) >= t
        met += linked
        assert simjoin._links([a, b], None, t) == (([(0, 1)], 1) if linked else ([], 0))
        assert simjoin._links([a], [b], t) == (([(0, 0)], 1) if linked else ([], 0))
        assert simjoin._links([a], None, t) == ([], 0)
    assert 50 < met < 350


def test_lone_sets_need_no_union(monkeypatch):
    def union(*_, **__):
        raise AssertionError("a union was built")
    sets = [np.arange(5, 40, dtype=np.uint64), np.arange(5, 41, dtype=np.uint64)]
    monkeypatch.setattr(simjoin.np, "unique", union)
    assert simjoin._links(sets[:1], None, Fraction(4, 5)) == ([], 0)
    assert simjoin._links(sets[:1], sets[1:], Fraction(4, 5)) == ([(0, 0)], 1)
    packed = simjoin._pack(["x"], sets[:1])
    kind = pa.struct([("nodes", pa.list_(pa.string())), *((n, pa.binary()) for n in ("tokens", "sizes", "places"))])
    nodes, back = simjoin._unpack(pa.scalar(packed, kind))
    assert nodes == ["x"] and len(back) == 1 and np.array_equal(back[0], sets[0])


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(110)] + [(300, i) for i in range(301, 380)] + [(i, i + 1) for i in range(500, 540)]
    got = {r.node: r.component_id for r in components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def prose(rng, n):
    return [rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n)]


def test_paragraph_dedup(spark):
    rng = random.Random(9)
    passage, para = prose(rng, 51), prose(rng, 70)
    edited = list(para)
    edited[10] = "changed"
    own = " ".join(prose(rng, 60))
    texts = [
        " ".join(prose(rng, 80) + passage + prose(rng, 33)),                 # 0: a passage inside a line
        "é " * 3 + " ".join(prose(rng, 20)) + "\n" + " ".join(passage[:20]) + "\n" + " ".join(passage[20:]),    # 1: over lines
        " ".join(prose(rng, 30)) + "\n" + " ".join(para) + "\nend",          # 2
        "start\n" + " ".join(edited) + "\n" + " ".join(prose(rng, 90)),      # 3: an edited paragraph
        own + "\n" + own,                                                    # 4: repeats itself only
        " ".join(prose(rng, 200)), None, "", "short",                        # 5 to 8: clean
        " ".join(passage[:40] + prose(rng, 60)),                             # 9: a part below the bound
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumns({c: F.lit(1) for c in ("start", "end", "removed", "hash")})
    got = {r.doc_id: r for r in repeat_report(df).collect()}
    assert set(got) == {0, 1, 2, 3}
    assert [got[i].first_doc_id for i in range(4)] == [0, 0, 2, 2]
    assert [got[i].n_removed for i in range(4)] == [0, 1, 0, 1]
    a, b = map(int, got[3].removals.split(":"))
    assert texts[3][a:b] == " ".join(edited)
    a, b = map(int, got[1].removals.split(":"))
    assert 44 <= len(texts[1][a:b].split()) <= 51 and set(texts[1][a:b].split()) <= set(passage)
    out = without_repeats(df)
    assert out.columns == df.columns
    kept = {r.doc_id: r.text for r in out.collect()}
    assert kept[3] == texts[3].replace(" ".join(edited), "") and kept[0] == texts[0] and kept[6] is None
    assert repeat_report(df.limit(0)).count() == 0


def test_spent_units_go(spark):
    """Windows go when the shared ones are written, bands when the cells that are shared are; places stay for the result."""
    line = " ".join(f"w{i}" for i in range(60))
    own = [f"{line}\n\n" + " ".join(f"d{d}x{i}" for i in range(9)) for d in range(4)]
    root = checkpoint_root(spark).removeprefix("file://")
    before = set(glob.glob(f"{root}/units-*"))
    got = repeat_report(spark.createDataFrame(enumerate(own), "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.repeats for r in got} == {d: f"0:{len(line)}" for d in range(4)}
    (units,) = set(glob.glob(f"{root}/units-*")) - before
    assert [os.path.basename(x) for x in glob.glob(f"{units}/part=*")] == ["part=1"]


def test_paragraph_dedup_hot_paragraph(spark):
    rng = random.Random(3)
    hot = " ".join(prose(rng, 60))
    rows = [(i, hot if i % 3 == 0 else " ".join(prose(rng, 60))) for i in range(150)] + [(0, hot), (None, hot)]
    got = {r.doc_id: r for r in repeat_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert set(got) == set(range(0, 150, 3)) and sum(r.n_removed for r in got.values()) == 49


def test_paragraph_dedup_short_lines_and_blocks(spark):
    rng = random.Random(21)
    line, five, wrapped = prose(rng, 20), prose(rng, 5), prose(rng, 60)
    near, edited = list(line), list(wrapped)
    near[0] = "changed"
    edited[30] = "changed"
    lay = lambda w, n: "\n".join(" ".join(w[i:i + n]) for i in range(0, len(w), n))
    other = lambda n: " ".join(prose(rng, n))
    texts = [
        " ".join(line) + "\n" + other(30),                                          # 0
        other(9) + "\n" + " ".join(line),                                           # 1: an equal short line
        " ".join(near) + "\n" + other(45),                                          # 2: a near one
        other(12) + "\n \n" + lay(wrapped, 12) + "\n\n" + other(8),                # 3: a wrapped paragraph
        lay(edited, 7) + "\n\t\n" + other(11),                                      # 4: edited, wrapped otherwise
        " ".join(five) + "\n" + other(11), other(13) + "\n" + " ".join(five),       # 5, 6: one shingle
        " ".join(five[:4]) + "\n" + other(9), " ".join(five[:4]) + "\n" + other(9),  # 7, 8: none
    ]
    got = {r.doc_id: r for r in repeat_report(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    cut = {i: [texts[i][slice(*map(int, x.split(":")))] for x in r.removals.split(",") if x] for i, r in got.items()}
    assert cut == {0: [], 1: [" ".join(line)], 2: [" ".join(near)], 3: [], 4: [lay(edited, 7)], 5: [], 6: [" ".join(five)]}
    assert [got[i].first_doc_id for i in (0, 1, 2, 3, 4, 5, 6)] == [0, 0, 0, 3, 3, 5, 5]


def test_paragraph_dedup_repeats_in_the_keeping_document(spark):
    rng = random.Random(22)
    line, para = " ".join(prose(rng, 20)), " ".join(prose(rng, 60))
    x, y = " ".join(prose(rng, 40)), " ".join(prose(rng, 30))
    texts = [f"{line}\nx y z\n{para}\n{line}\n{para}", f"{x}\n{para}", f"{y}\n{line}"]
    kept = {r.doc_id: r.text for r in without_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert kept == {0: f"{line}\nx y z\n{para}\n\n", 1: f"{x}\n", 2: f"{y}\n"}


def test_paragraph_dedup_texts_of_one_id(spark):
    rng = random.Random(23)
    rows = []
    for i in range(0, 24, 2):
        para = prose(rng, 60)
        rows += [(i, " ".join(para)), (i, " ".join(prose(rng, 70))), (i, None), (i, "short"), (i + 1, " ".join([*para[:59], "changed"]))]
    rng.shuffle(rows)
    got = {r.doc_id: r for r in repeat_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert set(got) == set(range(24))
    edited = {i: t for i, t in rows if i % 2}
    assert all(got[i].removals == f"0:{len(edited[i])}" and got[i].first_doc_id == i - 1 for i in edited)


def test_signatures_of_overlapping_ranges():
    rng = np.random.default_rng(5)
    tokens = rng.integers(0, 2**63, 90, dtype=np.uint64)
    begins = rng.integers(0, 89, 40)
    ends = np.array([rng.integers(a + 1, 91) for a in begins])
    ends[:3] = 90
    got = signatures(tokens, begins, ends)
    for a, b, row in zip(begins, ends, got):
        assert np.array_equal(row, signatures(tokens[a:b], np.array([0]), np.array([b - a]))[0])


def test_merge():
    assert merge([(5, 9), (0, 3), (3, 4), (8, 12)]) == [(0, 4), (5, 12)]


def test_merge_of_many_rows():
    rng = np.random.default_rng(4)
    rows = [[(a, a + int(rng.integers(1, 9))) for a in rng.integers(0, 60, int(n)).tolist()] for n in rng.integers(0, 12, 200)]
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    place = np.array([a << 32 | b for r in rows for a, b in r], np.int64)
    for some in (slice(None), slice(0, 0)):
        own = rows if some == slice(None) else [[] for _ in rows]
        count, chars, texts = paragraph_dedup._merge(row[some], place[some], len(rows))
        want = [merge(r) for r in own]
        assert count.tolist() == [len(w) for w in want] and chars.tolist() == [sum(b - a for a, b in w) for w in want]
        assert texts == [",".join(f"{a}:{b}" for a, b in w) for w in want]


def test_paragraph_tokens_are_hashed_together(monkeypatch):
    """Paragraphs of many texts share the calls that hash words; their sets are those of each alone."""
    rng, calls = random.Random(2), []
    words_of = hash_words
    monkeypatch.setattr(paragraph_dedup, "hash_words", lambda *a: calls.append(1) or words_of(*a))
    texts = [" ".join(rng.choice(["Ä", "é x", "word", "Other", "日本", "\ttab"]) + str(rng.randrange(50)) for _ in range(rng.randrange(8, 40))) for _ in range(50)]
    wanted = [[{"node": b"%d.%d" % (i, j), "grp": j, "start": 0, "end": end} for j, end in enumerate((len(t), len(t) - 3))] for i, t in enumerate(texts)]
    frames = paragraph_dedup._paragraph_tokens(iter([pd.DataFrame({"text": texts, "wanted": wanted})]))
    got = {r.node: (r.grp, r.tokens) for f in frames for r in f.itertuples()}
    assert len(got) == 100 and len(calls) < 5
    for t, own in zip(texts, wanted):
        for w in own:
            alone = np.unique(shingles(words_of(t[:w["end"]].encode())[0], 5))
            assert got[w["node"]] == (w["grp"], alone.tobytes())


def brute_top(rows, k):
    ok = [(i, v) for i, v in rows if i is not None and v is not None and len(v) == 3 and all(x is not None and np.isfinite(x) for x in v)]
    whole = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in ok]
    out = set()
    for q, v in whole:
        if q % 100 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q)[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("page, pivots", [(512, 128), (8, 5)])
def test_top_k(spark, monkeypatch, page, pivots):
    monkeypatch.setattr(topk_mtree, "PAGE", page)
    monkeypatch.setattr(topk_mtree, "PIVOTS", pivots)
    monkeypatch.setattr(topk_mtree, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(8)
    rows = [(int(i), [float(x) for x in rng.normal(0, 1, 3)]) for i in range(0, 900, 2)]
    rows += [(1001 + i, [0.5, -0.25, 0.125]) for i in range(200)] + [(2000, [0.0, 0.0, 0.0]), (2100, [0.5, -0.25, 0.125])]
    rows += [(2200, None), (2300, [1.0, None, 0.0]), (2400, [float("nan"), 0.0, 0.0]), (2500, [float("inf"), 0.0, 0.0]), (None, [9.0, 9.0, 9.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumns({"node": F.lit(1), "ring": F.lit(2)})
    rows32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = {tuple(r) for r in topk_mtree.top_k(df, F.col("vec_id") % 100 == 0).collect()}
    assert got == brute_top(rows32, 10)


def test_top_k_few_rows(spark):
    kind = "vec_id bigint, embedding array<float>"
    asked = F.col("vec_id") % 100 == 0
    assert topk_mtree.top_k(spark.createDataFrame([], kind), asked).count() == 0
    assert topk_mtree.top_k(spark.createDataFrame([(1, [1.0])], kind), asked).count() == 0
    assert topk_mtree.top_k(spark.createDataFrame([(0, None)], kind), asked).count() == 0
    got = topk_mtree.top_k(spark.createDataFrame([(0, [1.0]), (100, [2.0]), (5, [0.5])], kind), asked).collect()
    assert {tuple(r) for r in got} == {(0, 1, 100, 2048 * 1024), (0, 2, 5, 512 * 1024), (100, 1, 0, 2048 * 1024), (100, 2, 5, 1024 * 1024)}
