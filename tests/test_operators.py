"""Invariants of the shuffling operators against brute force on small inputs."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from lexgrid.operators import batching as B
from lexgrid.operators import metrics as M
from lexgrid.operators import ranking as R
from lexgrid.operators import spelling as SP
from lexgrid.operators import splits as X
from lexgrid.operators.components import connected_components, with_singletons
from lexgrid.operators.resolve import ListingIndex, canonical_names, name_clusters, resolve_listings
from lexgrid.operators import tokens as TK


def _md5_order(keys, seed=42):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))


def test_split_exact_independent_of_partitioning(spark):
    base = spark.range(5000).withColumnRenamed("id", "key")
    got = []
    for parts in (3, 7):
        df = X.split_exact(base.repartition(parts), "key", 0.2, 42)
        got.append(sorted(r.key for r in df.where("split = 'test'").collect()))
    assert len(got[0]) == 1000 and got[0] == got[1]
    assert got[0] == sorted(_md5_order(range(5000))[:1000])


def test_split_exact_rounds_up(spark):
    df = X.split_exact(spark.range(7).withColumnRenamed("id", "key"), "key", 0.2, 42)
    assert df.where("split = 'test'").count() == 2
    empty = X.split_exact(spark.range(0).withColumnRenamed("id", "key"), "key", 0.2, 42)
    assert empty.count() == 0


def test_hash_positions_match_brute_force(spark):
    keys = list(range(0, 3000, 3))
    df = spark.createDataFrame([(k,) for k in keys], "key long").repartition(5)
    got = {r.key: r.position for r in R.hash_positions(df, "key", 7, digits=2).collect()}
    want = {k: i + 1 for i, k in enumerate(_md5_order(keys, 7))}
    assert got == want


def test_sorted_positions_hot_leading_value(spark):
    # a third of the rows share one leading value: the unique tie-break still splits them
    rows = [(0 if i % 3 == 0 else i, i) for i in range(3000)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "grp long, key long").repartition(6)
    got = {r.key: r.position for r in R.sorted_positions(df, ["grp", "key"]).collect()}
    want = {k: i + 1 for i, (_, k) in enumerate(sorted(rows))}
    assert got == want


def test_batches_1500_rows(spark):
    df = spark.range(1500).withColumnRenamed("id", "key")
    sizes = B.make_batches(df, ["key"], 16).groupBy("batch_id").count().collect()
    by = {r.batch_id: r["count"] for r in sizes}
    assert len(by) == 94 and by[93] == 12 and all(by[b] == 16 for b in range(93))


def test_pad_batch_equal_widths(spark):
    rows = [(i, list(range(i % 11))) for i in range(100)]
    df = spark.createDataFrame(rows, "key long, ids array<int>")
    padded = B.pad_batch(B.make_batches(df, ["key"], 16), "ids", side="right")
    widths = padded.groupBy("batch_id").agg(F.countDistinct(F.size("input_ids")).alias("w"))
    assert all(r.w == 1 for r in widths.collect())


def test_padded_batches_match_window_padding(spark):
    import random
    rnd = random.Random(7)
    rows = [(i, None if i % 37 == 5 else [rnd.randrange(9) for _ in range(rnd.randrange(0, 30))])
            for i in range(700)]
    df = spark.createDataFrame(rows, "key long, ids array<int>")
    for max_len in (20, None):
        want = {r.key: (r.batch_id, r.ids, r.input_ids, r.attention_mask) for r in
                B.pad_batch(B.make_batches(df, ["key"], 16), "ids", side="left", pad_id=-1,
                            max_len=max_len).collect()}
        # 3 and 64 range partitions: batches inside one partition and batches over several
        for parts in ("3", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            try:
                out = B.padded_batches(df, ["key"], "ids", 16, side="left", pad_id=-1,
                                       max_len=max_len)
                assert out.columns == ["key", "ids", "batch_id", "input_ids", "attention_mask"]
                got = {r.key: (r.batch_id, r.ids, r.input_ids, r.attention_mask)
                       for r in out.collect()}
            finally:
                spark.conf.set("spark.sql.shuffle.partitions", "8")
            assert got == want


def test_positions_sort_keys_only(spark, tmp_path):
    spark.range(500).selectExpr("id AS key", "repeat('x', 100) AS payload").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = R.sorted_positions(df, ["key"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Scan ExistingRDD" in plan      # payload once, keys from the checkpoint


def test_position_index_reads_its_ranges(spark, tmp_path):
    rows = [(i * 7919 % 1000, "p%d" % i) for i in range(1000)]
    df = spark.createDataFrame(rows, "key long, p string")
    index = B.PositionIndex.build(df, ["key"], str(tmp_path / "index"), rows=64)
    want = sorted(rows)
    for start, stop in ((0, 5), (60, 70), (100, 300), (990, None), (1000, 2000)):
        got = index.slice(start, stop)
        assert sorted((r.key, r.p) for r in got.collect()) == want[start:stop]
        scan = next(line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line)
        assert f"_part#" in scan.split("PartitionFilters: [")[1].split("]")[0] and f">= {start // 64}" in scan
    batch = index.batches(3, 4, 16).collect()
    assert sorted((r.key, r.p) for r in batch) == want[48:80] and {r.batch_id for r in batch} == {3, 4}


@pytest.mark.parametrize("partitions", [1, 7])
def test_running_sums_over_partitions(spark, partitions):
    rng = random.Random(partitions)
    # one group holds most rows, null is a group too
    rows = [(None if i % 50 == 0 else 5 if i % 3 else rng.randrange(30), i, rng.randrange(-9, 10)) for i in range(2000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g long, k long, x long").withColumn("one", F.lit(1).cast("long"))
    fixed = df.repartitionByRange(partitions, "g", "k").sortWithinPartitions("g", "k").checkpoint().withColumn("_pid", F.spark_partition_id())
    got = {r.k: (r.n, r.s) for r in R.running_sums(fixed, "g", {"n": "one", "s": "x"}).collect()}
    want, at = {}, {}
    for g, k, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        n, s = at.get(g, (0, 0))
        at[g] = want[k] = (n + 1, s + x)
    assert got == want


def test_row_slice_clips(spark):
    df = spark.range(10).withColumnRenamed("id", "key")
    assert sorted(r.key for r in B.row_slice(df, 8, 20, ["key"]).collect()) == [8, 9]


def test_row_slice_is_exact(spark):
    df = spark.range(3000).select(((F.col("id") * 7) % 13).alias("g"), F.col("id").alias("key"))
    want = sorted((-((i * 7) % 13), i) for i in range(3000))
    for start, stop in [(0, 16), (1488, 1504), (2990, 3100), (5, 5)]:
        got = sorted((-r.g, r.key) for r in B.row_slice(df, start, stop, [F.col("g").desc(), "key"]).collect())
        assert got == want[start:stop]


def test_macro_report_fixture(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (1, 2)], "y int, p int")
    r = M.macro_report(df, "y", "p").first()
    assert (r.precision, r.recall, r.f1, r.accuracy) == (0.222222, 0.333333, 0.266667, 0.5)


def test_best_checkpoint_tie_goes_earlier(spark):
    log = spark.createDataFrame([("r", 25, 0.5), ("r", 50, 0.3), ("r", 75, 0.3)],
                                "run string, step int, loss double")
    assert M.best_checkpoint(log, "run", "step", "loss").first().best_step == 50


def test_sequence_exact_match_empty(spark):
    df = spark.createDataFrame([], "p array<int>, y array<int>")
    r = M.sequence_exact_match(df, "p", "y").first()
    assert r.accuracy is None and r.n_rows == 0


def _union_find(edges, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    comps = {}
    for n in nodes:
        comps.setdefault(find(n), []).append(n)
    return {n: min(members) for members in comps.values() for n in members}


def test_components_small_fixture(spark):
    for order in ([("a", "b"), ("b", "c"), ("d", "e")], [("e", "d"), ("c", "b"), ("b", "a")]):
        df = spark.createDataFrame(order, "src string, dst string")
        got = {r.node: r.component for r in connected_components(df).collect()}
        assert got == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d"}


def test_components_random_graph_and_long_chain(spark):
    rnd = random.Random(3)
    nodes = list(range(400))
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(250)]
    edges += [(1000 + i, 1001 + i) for i in range(200)]  # a long path
    nodes += list(range(1000, 1201))
    df = spark.createDataFrame(edges, "src long, dst long")
    comps = connected_components(df)
    got = {r.node: r.component for r in
           with_singletons(spark.createDataFrame([(n,) for n in nodes], "n long"), "n", comps).collect()}
    assert got == _union_find(edges, nodes)


def _deleted(name, k, min_len):
    from itertools import combinations
    out = {name}
    for m in range(1, min(k, len(name)) + 1):
        for gone in combinations(range(len(name)), m):
            v = "".join(c for i, c in enumerate(name) if i not in gone)
            out |= {v} if len(v) >= min_len else set()
    return out


@pytest.mark.parametrize("k", [1, 2])
def test_variants_match_brute_force(spark, k):
    rng = random.Random(k)
    names = sorted({"".join(rng.choice("ab1é") for _ in range(rng.randrange(1, 9))) for _ in range(150)} | {"x" * 271, "x" * 270, "y" * 600, "z" + "y" * 599})
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "n string")
    got = {(r.src, r.dst) for r in SP.variant_links(df, "n", k).collect()}
    members = {}
    for n in names:
        for v in _deleted(n, k, 2) if len(n) < 100 else ():
            members.setdefault((v, "".join(c for c in n if c.isdigit())), []).append(n)
    want = {(n, min(own)) for own in members.values() for n in own if n != min(own)}
    assert {(a, b) for a, b in got if len(a) < 100} == want
    # names of any length: one character apart, or a shifted one
    assert {(a, b) for a, b in got if len(a) >= 100} == {("x" * 271, "x" * 270), ("z" + "y" * 599, "y" * 600)}


def test_clusters_of_names(spark):
    names = spark.createDataFrame([("old rod",), ("cold rod",), ("hot rod",), ("bold rod",)], "n string")
    got = {r.name: r.cluster for r in name_clusters(names, "n").collect()}
    assert got["cold rod"] == got["old rod"] == got["bold rod"] == "bold rod"
    assert got["hot rod"] == "hot rod"
    blocks = SP.largest_blocks(names, "n", 3).collect()
    assert blocks[0].names == 3 and blocks[0].example == "bold rod"      # all but "hot rod" can become "old rod"


def test_common_beginnings_are_no_evidence(spark):
    places = ["北京大学食堂", "北京大学书店", "北京大学药房", "北京大学超市", "上海南站咖啡", "上海南站书店"]
    brands = ["168台球俱乐部", "168台球棋牌连锁", "蓝鲸工坊饮品", "蓝鲸工坊咖啡馆", "蓝鲸工坊茶"]
    got = {r.name: r.cluster for r in name_clusters(spark.createDataFrame([(n,) for n in places + brands], "n string"), "n").collect()}
    assert got["168台球俱乐部"] == got["168台球棋牌连锁"] and len({got[n] for n in places if n.startswith("北京")}) == 4
    # with more names around, a beginning that only three share tells more
    more = places + brands + ["甲%s乙丙丁" % chr(0x5000 + i) for i in range(200)] + ["北京%s大学" % chr(0x6000 + i) for i in range(200)]
    got = {r.name: r.cluster for r in name_clusters(spark.createDataFrame([(n,) for n in more], "n string"), "n").collect()}
    assert len({got[n] for n in brands[2:]}) == 1 and len({got[n] for n in places if n.startswith("北京")}) == 4


def _partition(pairs):
    out = {}
    for name, cluster in pairs:
        out.setdefault(cluster, set()).add(name)
    return sorted(map(sorted, out.values()))


def test_spelling_index_by_batches(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randrange(2, 7))) for _ in range(120)] + ["华南%s茶" % c for c in "甲乙丙丁"] + [None]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, n string")
    statistics = SP.NameStatistics.of(SP.distinct_names(df, "n"))
    index = SP.SpellingIndex(spark, statistics=statistics, buckets=3)
    seen = {}
    for part in range(4):
        index.add(df.where(F.col("i") % 4 == part), "n")
        now = {r.name: (r.c1, r.c2) for r in index.clusters().collect()}
        # ids are stable: a cluster keeps its id, or takes that of another old one
        assert {now[n] for n in seen} <= set(seen.values())
        seen = now
    want = _partition((r.name, r.cluster) for r in name_clusters(df, "n", statistics=statistics).collect())
    again = SP.SpellingIndex(spark, index.path)
    assert again.buckets == 3 and _partition((r.name, (r.c1, r.c2)) for r in again.clusters().collect()) == want
    index.add(df, "n")
    assert index.clusters().count() == len(set(words)) - 1
    with pytest.raises(ValueError, match="buckets"):
        SP.SpellingIndex(spark, index.path, buckets=5)
    plan = spark.table(index._tables["signatures"]).hint("merge").join(
        spark.table(index._tables["signatures"]).withColumnsRenamed({"c1": "d1", "c2": "d2"}), SP.SIGNATURE)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan       # the buckets serve the lookup


def test_labels_outrank_tiers_over_batches(spark):
    kind = "id string, shop_name string, shop_brand string, laiyuan1_id string, brand_id string, brand_name string"
    train = spark.createDataFrame([("1", "Blue Cafe", "Blu", "yes", "1", ""), ("2", "Blue Cafe (North)", "blue!", "", "2", "BLUE"),
                                   ("3", "Red Bar", "Red", "", "3", "")], kind)
    test = spark.createDataFrame([("4", "Bluee Cafe", "Blux", "yes", "0", ""), ("5", "Redd Bar", "", "", "5", ""), ("6", "", "Redd", "", "6", ""),
                                  ("7", None, None, "", "7", "")], kind)
    index = ListingIndex(spark, gold="brand_name")
    index.add(train)
    assert {r.id: r.brand_name for r in index.resolve(train).collect()} == {"1": "BLUE", "2": "BLUE", "3": "Red"}
    index.add(test)
    got = {r.id: r.brand_name for r in index.resolve(train.unionByName(test)).collect()}
    one = {r.id: r.brand_name for r in resolve_listings(train.unionByName(test), gold="brand_name").collect()}
    assert got == one == {"1": "BLUE", "2": "BLUE", "3": "Red", "4": "BLUE", "5": "Red", "6": "Red", "7": ""}


def test_canonical_prefers_tier_then_key(spark):
    df = spark.createDataFrame([("c", 3, "k1", "x"), ("c", 2, "k3", "y"), ("c", 2, "k2", "z")],
                               "cl string, tier int, key string, v string")
    r = canonical_names(df, "cl", "tier", "key", "v").first()
    assert (r.canonical, r.canonical_key) == ("z", "k2")


def test_encode_and_decode(spark):
    docs = spark.createDataFrame([(1, "a b a c"), (2, ""), (3, "c c d"), (4, None)], "doc_id long, text string")
    toks = docs.withColumn("tokens", TK.rule_tokens("text"))
    vocab = TK.build_vocab(toks, "tokens", 1)
    assert {r.token: r.id for r in vocab.collect()} == {"c": 2, "a": 3, "b": 4, "d": 5}
    enc = TK.encode(toks, "tokens", vocab, "doc_id")
    assert {r.doc_id: r.ids for r in enc.collect()} == {1: [3, 4, 3, 2], 2: [], 3: [2, 2, 5], 4: None}
    back = TK.decode(enc.withColumn("ids", F.concat(F.array(F.lit(TK.PAD_ID).cast("long")), "ids")), "ids", vocab, "doc_id", "back")
    assert {r.doc_id: r.back for r in back.collect()} == {1: "a b a c", 2: "", 3: "c c d", 4: None}
    # rare tokens are left out on request, and become the unknown id
    common = TK.build_vocab(toks, "tokens", 2)
    assert {r.token for r in common.collect()} == {"a", "c"}
    assert {r.doc_id: r.ids for r in TK.encode(toks, "tokens", common, "doc_id").collect()}[3] == [2, 2, TK.UNK_ID]


def test_null_and_repeated_keys(spark):
    from lexgrid.operators.splits import seeded_shuffle, split_exact
    df = spark.createDataFrame([("a",), ("b",), (None,), ("c",)], "k string")
    assert sorted(r.position for r in seeded_shuffle(df, "k").collect()) == [1, 2, 3, 4]
    for bad in (df, spark.createDataFrame([("a",), ("a",)], "k string")):
        with pytest.raises(ValueError, match="unique key"):
            split_exact(bad, "k", 0.5)


def test_listings_resolve_without_losing_rows(spark):
    rows = [("1", "168 Club (East)", "168台球棋牌连锁", "", "999988881"), ("2", "168 Room", "168台球俱乐部", "", "99991"),
            ("3", "", "KFC", "no", "5"), ("4", None, "Maple", "", "6"), ("5", " ", "Starlight", "", "7"), ("6", None, None, "", "8"),
            ("7", "Star Cafe", "Star Cafe", "yes", "9"), ("8", "Other", "Starr Cafe", "", "10"), ("9", "肯德基", "", "", "11"), ("10", "肯得基", "KFC", "", "12"),
            ("11", "Zone 11", "Brand#11", "", "13"), ("12", "Zone 12", "Brand#12", "", "14")]
    df = spark.createDataFrame(rows, "id string, shop_name string, shop_brand string, laiyuan1_id string, brand_id string")
    got = {r.id: r.brand_name for r in resolve_listings(df).collect()}
    assert got == {"1": "168台球俱乐部", "2": "168台球俱乐部", "3": "KFC", "4": "Maple", "5": "Starlight", "6": "", "7": "Star Cafe", "8": "Star Cafe",
                   "9": "KFC", "10": "KFC", "11": "Brand#11", "12": "Brand#12"}


def test_short_and_long_names(spark):
    names = spark.createDataFrame([("ab",), ("ac",), ("abc",), ("abd",), ("x" * 5000,)], "n string")
    got = {r.name: r.cluster for r in name_clusters(names, "n").collect()}
    assert got["abc"] == got["abd"] and got["ac"] != got["x" * 5000] and len(got) == 5


def test_answers_ending_in_newlines(spark):
    from lexgrid.operators.metrics import answer_accuracy
    df = spark.createDataFrame([("KFC\n", "KFC", 1), ("x", "KFC", None)], "p string, g string, tier int")
    got = {(r.tier, r.overall): (r.accuracy, r.rows) for r in answer_accuracy(df, "p", "g", "tier").collect()}
    assert got == {(1, False): (1.0, 1), (None, False): (0.0, 1), (None, True): (0.5, 2)}


def test_tokenise_with_user_tokenizer(spark):
    def make():
        return lambda texts: [[len(w) for w in t.split()] for t in texts]
    df = spark.createDataFrame([("ab cde",), (None,)], "text string")
    got = [r.input_ids for r in TK.tokenise_with(df, "text", make).collect()]
    assert got == [[2, 3], []]


def test_test_rows_rule():
    assert X.test_rows(5000, 0.2) == 1000
    assert X.test_rows(7, 0.2) == 2
    assert X.test_rows(10, 3) == 3
    assert X.test_rows(3, 0.5) == math.ceil(1.5)


def test_rule_tokens_edge_cases(spark):
    import re
    texts = ["  a b\n\nc\t", "", " \n\t\r ", "x", " nbsp stays　wide ", "a\r\nb  c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)],
                               "k int, text string")
    got = {r.k: r.t for r in df.select("k", TK.rule_tokens("text").alias("t")).collect()}
    assert got[99] is None
    for i, t in enumerate(texts):
        assert got[i] == re.findall(r"[^ \n\t\r]+", t), (t, got[i])


def test_ordered_batch_scoring_matches_grouped(spark):
    from pyspark.sql.types import LongType

    from lexgrid.operators import scoring as S

    def _batch_stats_model():
        import numpy as np

        def run(pdf):
            # depends on the whole batch: its size and its largest value
            return np.full(len(pdf), len(pdf) * 1000 + int(pdf["v"].max()), dtype=np.int64)
        return run

    df = spark.range(1000).select(F.col("id").alias("key"), ((F.col("id") * 7919) % 613).alias("v"))
    want = {r.key: (r.batch_id, r.s) for r in S.score_exact_batches(
        B.make_batches(df, ["key"], 16), "batch_id", _batch_stats_model, "s", LongType()).collect()}
    for parts in ("3", "70"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            out = S.score_ordered_batches(df, ["key"], 16, _batch_stats_model, "s", LongType())
            assert out.columns == ["key", "v", "batch_id", "s"]
            got = {r.key: (r.batch_id, r.s) for r in out.collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert got == want


def test_lookup_works_its_rows_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def tokens(text):
        seen.add(1)
        return text.split()

    rows = [(i, f"a b{i % 5} c{i} a") for i in range(200)]
    vocab = spark.createDataFrame([("a", 2), ("b0", 3), ("c7", 4)], "token string, id bigint")
    df = spark.createDataFrame(rows, "doc_id bigint, text string").select("doc_id", tokens("text").alias("tokens"))
    got = {r.doc_id: r.ids for r in TK.encode(df, "tokens", vocab, "doc_id").collect()}
    assert len(got) == 200 and got[0] == [2, 3, 1, 2] and got[7] == [2, 1, 4, 2]
    assert seen.value == 200


def test_vocabulary_of_odd_tokens(spark):
    df = spark.createDataFrame([(["x", None, "x", "é"],), ([],), (None,), (["é", "", "x"],)], "tokens array<string>")
    vocab = TK.build_vocab(df, "tokens")
    assert vocab.dtypes == [("token", "string"), ("freq", "bigint"), ("id", "bigint")]
    assert sorted(tuple(r) for r in vocab.collect()) == [("", 1, 4), ("x", 3, 2), ("é", 2, 3)]


def test_clusters_work_their_names_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def shown(name):
        seen.add(1)
        return name

    rows = [("red fox",), ("red fix",), ("blue",), (None,), ("北京大学云山",), ("北京大学云海",), ("red fox",)]
    names = spark.createDataFrame(rows, "raw string").select(shown("raw").alias("name"))
    got = {r.name: r.cluster for r in name_clusters(names, "name").collect()}
    assert seen.value == len(rows)
    assert set(got) == {r[0] for r in rows if r[0]} and got["red fox"] == got["red fix"] == "red fix" and got["blue"] == "blue"


def test_signatures_of_many_names_are_those_of_each():
    rng = random.Random(12)
    names = ["".join(rng.choice("ab1é云山 9") for _ in range(rng.randrange(12))) for _ in range(300)]
    weights = [[rng.randrange(4000) for _ in range(len(n) - 1)] if len(n) >= 4 and i % 2 else None for i, n in enumerate(names)]
    for k in (0, 1, 2):
        who, rows = SP.many_signatures(names, k, 2, weights, 9000)
        for i, n in enumerate(names):
            assert rows[who == i].tolist() == SP.name_signatures(n, k, 2, weights[i], 9000).tolist()
