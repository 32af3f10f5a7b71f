"""Merkle manifest, conversation trie and best-fit packing against plain versions and odd inputs."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexgrid.llm import merkle, prefix_trie
from lexgrid.llm.best_fit import pack_best_fit, sum_of_squares
from lexgrid.llm.queries import QUERIES, tokenizer_file

BIG = 2**53 + 1


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- Merkle manifest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def plain_manifest(rows, tampered):
    """leaf, subroot, root, proof, folded root of every row, by plain loops."""
    def leaf(r, text):
        return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))

    def climb(level):
        out = [level]
        while len(out[-1]) > 1:
            out.append([H("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
        return out

    def path(levels, i):
        for level in levels[:-1]:
            run = i // 16 * 16
            yield level[run:i], level[i + 1:run + 16]
            i //= 16

    trees = defaultdict(list)
    for r in rows:
        trees[(r[3] is not None, (r[3] or "").encode())].append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    sources = sorted(trees)
    built = {s: climb([x[2] for x in sorted(trees[s], key=lambda x: x[:3])]) for s in sources}
    top = climb([built[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, (_, _, own, r) in enumerate(sorted(trees[s], key=lambda x: x[:3])):
            steps = [*path(built[s], i), *path(top, k)]
            lower = r[1] if r[1] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
            folded = leaf(r, lower) if tampered(r) else own
            for a, b in steps:
                folded = H("".join(a) + folded + "".join(b))
            out.append((r[0], own, built[s][-1][0], top[-1][0], H("".join("".join(a + b) for a, b in steps)), folded, folded == top[-1][0]))
    return out


def key(row):
    return tuple((v is not None, str(v)) for v in row)


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16}, {"a": 17, "b": 1, None: 3}, {"hot": 700, "b": 257, "é": 256, None: 1, "": 16},
                                   {f"s{i}": 1 for i in range(40)}])
def test_manifest_is_the_plain_one(spark, sizes):
    rng = random.Random(len(sizes))
    rows, at = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((at if at % 7 else BIG + at, rng.choice(["Ab c", "é", "", None, "x" * 50, "TEXT"]) , rng.choice(["en", None]), source, rng.choice([1, None])))
            at += 1
    if len(rows) > 3:
        rows += [rows[0], (None, "Null Key", None, rows[0][3], None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, DOC).repartition(5)
    which = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    m = merkle.Manifest(df, which=which, tampered={"text": F.translate("text", merkle.UPPER, merkle.LOWER)})
    got = [tuple(r) for r in m.proofs().collect()]
    want = plain_manifest(rows, lambda r: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert not all(g[-1] for g in got) or len(rows) < 20


def test_manifest_of_nothing(spark):
    m = merkle.Manifest(spark.createDataFrame([], DOC))
    assert m.root is None and m.proofs().collect() == []


def test_manifest_reads_named_columns_only(spark):
    rows = [(1, "T", "en", "s", 1), (2, "U", "en", "s", 1)]
    plain = merkle.Manifest(spark.createDataFrame(rows, DOC)).proofs().collect()
    wide = spark.createDataFrame(rows, DOC).withColumns({c: F.lit("x") for c in ("tree", "key", "digest", "place", "idx", "height", "_pid", "tampered", "one")})
    assert sorted(merkle.Manifest(wide).proofs().collect()) == sorted(plain)


def test_manifest_stores_every_second_level(spark):
    df = spark.range(5000).selectExpr("id AS doc_id", "'t' AS text", "'en' AS lang", "'s' AS source", "1L AS n_chars")
    m = merkle.Manifest(df)
    assert [x.count() for x in m.forest.levels] == [5000, 20, 1] and m.leaves.select("height").first()[0] == 4


# ---- conversation trie

def test_two_fattest():
    for a in range(40):
        for b in range(a + 1, 41):
            zeros = lambda x: (x & -x)
            assert prefix_trie.two_fattest(a, b) == max(range(a + 1, b + 1), key=zeros)


def test_trie_of_a_batch_is_the_set_of_prefixes():
    rng = random.Random(5)
    for trial in range(300):
        base = rng.choice([0, 0, 3, 8])
        words = "ab" if trial % 2 else "abcdef"
        strings = ["".join(rng.choice(words) for _ in range(rng.randrange(1, rng.choice([3, 12, 40])))) for _ in range(rng.randrange(1, 40))]
        names, places = [], []
        for s in strings:
            places.append(len(names))
            names += [s[:i + 1] for i in range(len(s))]
        trie = prefix_trie.ZFastTrie(names, base)
        for conv, (s, first) in enumerate(zip(strings, places)):
            trie.insert(first, base + len(s), conv)
            assert trie.names[trie.row[0]] == names[0]
        rows, members, least = trie.expanded()
        got = {names[r]: (int(n), int(c)) for r, n, c in zip(rows, members, least)}
        want = {p: (sum(s.startswith(p) for s in strings), min(i for i, s in enumerate(strings) if s.startswith(p))) for p in names}
        assert got == want and len(rows) == len(want)
        for s in {*strings, *("".join(rng.choice(words) for _ in range(15)) for _ in range(10))}:
            trie.names = names + [s[:i + 1] for i in range(len(s))]
            _, depth = trie.exit_node(len(names), base + len(s))
            assert depth - base == max([0, *(i for i in range(1, len(s) + 1) if s[:i] in want)])


def test_batches_cut_anywhere_give_the_same_prefixes():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 9, 200)
    conv = np.repeat(np.arange(200), lengths)
    pos = np.concatenate([np.arange(1, n + 1) for n in lengths])
    turn = rng.integers(0, 2, len(conv))
    hashes = rng.integers(-2**62, 2**62, (2, 10, 2))
    cols = {"conv": conv, "pos": pos, "hash_a": hashes[turn, pos, 0], "hash_b": hashes[turn, pos, 1], "bytes": turn + 1,
            "last": pos == np.repeat(lengths, lengths)}
    none = pa.array([None] * len(conv), pa.int64())
    whole = pa.RecordBatch.from_arrays([*map(pa.array, cols.values()), none, none], names=[*cols, "held_a", "held_b"])
    kind = pa.schema([("kind", pa.int32()), *[(c, pa.int64()) for c in ("a", "b", "up_a", "up_b", "conv", "depth", "n", "bytes")]])

    def nodes(size):
        out = defaultdict(lambda: [0, 10**9])
        for b in prefix_trie._batches(iter([whole.slice(i, size) for i in range(0, len(conv), size)]), kind):
            for r in b.to_pylist():
                if r["kind"] == 0:
                    n = out[r["a"], r["b"], r["up_a"], r["up_b"], r["depth"], r["bytes"]]
                    n[0], n[1] = n[0] + r["n"], min(n[1], r["conv"])
        return dict(out)

    want = nodes(len(conv))
    assert sum(n for n, _ in want.values()) == len(conv)
    for size in (1, 7, 50):
        assert nodes(size) == want


def plain_trie(convs):
    """Node rows of ``{conv: [(role, text), ...]}``."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    rows = {}
    for p, own in members.items():
        below = [q for q in members if q[:len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(len(r) == len(q) + 1 and r[:len(q)] == q for r in below)]
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(p))
        rows[p] = (min(own), len(p), min(members[p[:-1]]) if p else None, len(own), len(kids), len(leaves),
                   sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q), H(ends))
    return sorted(rows.values(), key=key)


def plain_rebuilt(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs[c].append(((turn is not None, turn or 0, tie), role, text))
    own = {c: [(r, t) for _, r, t in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


CHAT = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("case", ["few words", "one hot", "nested", "odd"])
def test_trie_is_the_plain_one(spark, tmp_path, case):
    rng = random.Random(case)
    rows = []
    if case == "few words":
        for c in range(60):
            rows += [(c + (BIG if c % 4 == 0 else 0), t, "user", rng.choice("ab")) for t in range(rng.randrange(1, 9))]
    elif case == "one hot":
        for c in range(90):
            rows += [(c, t, "user", "same %d" % t) for t in range(3)] if c % 3 else [(c, t, "user", rng.choice(["same 0", "x", "é"])) for t in range(rng.randrange(5))]
        rows += [(200, t, "user", str(t)) for t in range(300)]
    elif case == "nested":          # each conversation leaves the one before a turn later: chains on chains
        for c in range(40):
            rows += [(c, t, "user", "p%d" % t if t < c else "q%d" % c) for t in range(c + 1)]
    else:
        rows = [(1, None, None, None), (1, 0, "user", ""), (None, 3, "user", "no id"), (7, 1, "a", "b"), (7, 1, "a", "b"), (8, 2, "a", "b"),
                (8, 1, None, "x" * 5000), (10, 0, "u", "z"), (-7, 0, "u", "z")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, CHAT).withColumns({c: F.lit(1) for c in ("pos", "conv", "_pid", "a", "b")}).repartition(4)
    folder = tmp_path / "t"
    df.write.parquet(str(folder / "conversations.parquet"))
    got = [tuple(r) for r in QUERIES["op12_prefix_trie"](spark, str(folder)).collect()]
    assert sorted(got, key=key) == plain_trie(plain_rebuilt(rows))


def test_trie_of_nothing(spark, tmp_path):
    spark.createDataFrame([], CHAT).write.parquet(str(tmp_path / "conversations.parquet"))
    assert QUERIES["op12_prefix_trie"](spark, str(tmp_path)).collect() == []


# ---- best-fit packing

def places(plan):
    out = {}
    for size, lo, hi, sequence, offset in plan.tolist():
        for r in range(lo, hi):
            assert out.setdefault((size, r), (sequence + r - lo, offset)) == (sequence + r - lo, offset)
    return out


def check_places(histogram, window, found):
    assert sorted(found) == sorted((s, r) for s, n in histogram.items() for r in range(n))
    inside = defaultdict(list)
    for (size, _), (sequence, offset) in found.items():
        inside[sequence].append((offset, size))
    for own in inside.values():
        at = 0
        for offset, size in sorted(own):
            assert offset == at
            at += size
        assert at <= window
    return len(inside)


def test_sum_of_squares_takes_the_least_sum():
    """One piece at a time against the definition, with every choice tried."""
    rng = random.Random(1)
    for _ in range(20):
        window = 24
        histogram = {s: rng.randrange(6) for s in range(1, window)}
        counts, sequences = defaultdict(int), 0
        for size in sorted(histogram, reverse=True):
            for _ in range(histogram[size]):
                def after(gap):
                    c = dict(counts)
                    c[gap] -= 1
                    if gap > size:
                        c[gap - size] = c.get(gap - size, 0) + 1
                    return sum(v * v for v in c.values())
                fit = [g for g in sorted(counts) if g >= size and counts[g]]
                gap = min(fit, key=after) if fit else None
                if gap is None:
                    sequences += 1
                    gap = window
                else:
                    counts[gap] -= 1
                if gap > size:
                    counts[gap - size] += 1
        assert check_places(histogram, window, places(sum_of_squares(histogram, window))) == sequences


@pytest.mark.parametrize("decisions", [1 << 17, 500, 20])
def test_sum_of_squares_fills(decisions):
    rng = random.Random(2)
    histogram = {s: rng.randrange(60) for s in range(1, 256)} | {100: 4000}
    n = check_places(histogram, 256, places(sum_of_squares(histogram, 256, decisions)))
    bound = max(-(-sum(s * c for s, c in histogram.items()) // 256), sum(c for s, c in histogram.items() if s > 128))
    assert n <= 1.12 * bound
    assert len(sum_of_squares({}, 256)) == 0


def gaps_of(plan, window):
    used = np.zeros(int((plan[:, 3] + plan[:, 2] - plan[:, 1]).max(initial=0)), int)
    for size, lo, hi, sequence, _ in plan.tolist():
        used[sequence:sequence + hi - lo] += size
    return np.bincount(window - used, minlength=window).tolist()


def test_sum_of_squares_at_any_number_of_pieces():
    """Pieces decided together are packed as one at a time, however many there are."""
    rng = random.Random(9)
    for most in (3, 40, 700):
        for window in (5, 24, 61):
            histogram = {s: rng.randrange(most) for s in range(1, window)}
            plans = [sum_of_squares(histogram, window, decisions) for decisions in (0, 20, 1 << 40)]
            assert gaps_of(plans[0], window) == gaps_of(plans[1], window) == gaps_of(plans[2], window)
            assert plans[0].tolist() == plans[2].tolist()
            check_places(histogram, window, places(plans[0]))


def test_plan_does_not_grow_with_the_pieces():
    histogram = {s: 1 + s * 7919 % 23 for s in range(1, 256)}
    small, large = (sum_of_squares({s: n * k for s, n in histogram.items()}, 256) for k in (20, 2000))
    assert len(large) < 2 * len(small)
    assert abs(sum(gaps_of(large, 256)) / 100 - sum(gaps_of(small, 256))) < 3


def test_best_fit_round_trip(spark):
    from tokenizers import Tokenizer
    rng = random.Random(4)
    own = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    words = ["alpha", " be", "7", "\n", " été", "  ", "x<|endoftext|>y"]
    texts = [None, "", "a", "same", "same", "one " * 5000, "tok " * 1023, "tok " * 1022, "a" * 40000] + [
        "".join(rng.choice(words) for _ in range(rng.randrange(700))) for _ in range(150)]
    rows = [(BIG + 2 * i, t) for i, t in enumerate(texts)] + [(None, "no id"), (BIG, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(1) for c in ("tail", "rank", "part", "piece")}).repartition(4)
    pieces = pack_best_fit(df, tokenizer_file("byte_bpe_50k.json")).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append((p.offset, p.length))
    for own_pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(own_pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert set(by_doc) == {k for k, _ in rows}
    want = defaultdict(list)
    for k, t in rows:
        ids = np.array([*own.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids), 1024), len(ids)]
        want[k] += [(i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
    for k, own_pieces in by_doc.items():
        assert sorted((p.piece, p.start, p.length, p.ids_crc32) for p in own_pieces) == sorted(want[k])
    assert pack_best_fit(spark.createDataFrame([], "doc_id bigint, text string"), tokenizer_file("byte_bpe_50k.json")).collect() == []
