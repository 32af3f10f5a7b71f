"""Paragraph deduplication against all pairs of paragraphs, and the toxicity chain against its formula."""

import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from lexgrid.llm import toxicity
from lexgrid.llm.common import shingles
from lexgrid.llm.paragraph_dedup import SHINGLE, SIMILAR, WINDOW, band_keys, repeated_spans, signatures

WORD = re.compile("[^ \t-\r]+")


def lowered(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def paragraphs(text):
    """``start, end, words`` of every line, and every block of several lines, of five words or more."""
    found = [(m.start(), m.end(), text.count("\n", 0, m.start()), lowered(m.group())) for m in WORD.finditer(text or "")]
    out = set()
    for apart in (1, 2):
        at = 0
        while at < len(found):
            stop = at + 1
            while stop < len(found) and found[stop][2] - found[stop - 1][2] < apart:
                stop += 1
            if stop - at >= SHINGLE:
                out.add((found[at][0], found[stop - 1][1], tuple(w for *_, w in found[at:stop])))
            at = stop
    return out


def grams(words):
    return frozenset(words[i:i + SHINGLE] for i in range(len(words) - SHINGLE + 1))


def plain_spans(texts):
    """``doc, start, end, first_doc, removed`` of all repeated paragraphs, by comparing all pairs."""
    where = defaultdict(list)
    for doc, text in texts.items():
        for start, end, words in paragraphs(text):
            where[words].append((doc, start, end))
    nodes = sorted(where)
    sets = [grams(n) for n in nodes]
    order = sorted(range(len(nodes)), key=lambda i: len(sets[i]))
    root = list(range(len(nodes)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    for x, i in enumerate(order):
        for j in order[x + 1:]:
            if len(sets[i]) < SIMILAR * len(sets[j]):
                break
            common = len(sets[i] & sets[j])
            if common and Fraction(common, len(sets[i]) + len(sets[j]) - common) >= SIMILAR:
                links.append((i, j))
                root[find(i)] = find(j)
    clusters = defaultdict(list)
    for i, n in enumerate(nodes):
        clusters[find(i)] += where[n]
    out = set()
    for own in clusters.values():
        kept = min(own)
        if max(own)[0] > kept[0]:
            out |= {(d, a, b, kept[0], d != kept[0] or a >= kept[2]) for d, a, b in own}
    return out, [(nodes[i], nodes[j]) for i, j in links]


@pytest.fixture(scope="module")
def real(spark, small_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}


def test_repeats_are_those_of_all_pairs(spark, small_dir, real):
    want, links = plain_spans(real)
    assert len(links) > 3 and len(want) > 50
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    got = {tuple(r) for r in repeated_spans(docs).collect()}
    assert want <= got
    # the rest are windows inside lines: so many words, and another document has them too
    flat = {d: " " + " ".join(WORD.findall(lowered(t or ""))) + " " for d, t in real.items()}
    for doc, start, end, first, _ in got - want:
        words = WORD.findall(lowered(real[doc][start:end]))
        passage = " " + " ".join(words) + " "
        assert len(words) == WINDOW and passage in flat[first] and sum(passage in t for t in flat.values()) > 1


def test_bands_find_pairs_at_the_threshold():
    """Measured recall of the bands on pairs of sets at, and little above, the least similarity."""
    rng = np.random.default_rng(5)
    met = []
    for trial in range(300):
        n = int(rng.integers(20, 200))
        words = rng.integers(1, 2**63, n + 40, dtype=np.uint64)
        a = shingles(words[:n], 1)
        drop = n - int(np.ceil(n * 8 / 9))                  # equal sizes: drop d of n on both sides gives (n - d) / (n + d)
        b = np.r_[a[drop:], shingles(words[n:n + drop], 1)]
        keys = [band_keys(signatures(s, np.array([0]), np.array([len(s)])))[0] for s in (a, b)]
        met.append(bool((keys[0] == keys[1]).any()))
    assert np.mean(met) >= 0.99


def test_chain_is_its_formula():
    """Each category's probability from word presence, shape and the earlier probabilities, one text at a time."""
    rng = np.random.default_rng(3)
    vocabulary = [f"word{i}" for i in range(60)]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(1, 40))) for _ in range(300)] + ["", "word1"]
    labels = np.array([[("word1 " in t + " "), ("word2 " in t + " "), ("word1 " in t + " ") and ("word2 " in t + " ")] for t in texts], float)
    slots = [np.unique(h & toxicity.MASK).astype(np.int32) for h in toxicity.hash_many(texts, toxicity.NON_WORD)]
    shape = np.array([toxicity._shape(t) for t in texts], float)
    chain = toxicity.fit_rows(slots, shape, labels, ["a", "b", "both"])
    got = chain.probabilities(texts)
    for t, own, dense, p in zip(texts, slots, shape, got):
        earlier = []
        for k in range(3):
            z = chain.bias[k] + sum(chain.words[c, k] for c in {int(chain.column[s]) for s in own} - {-1}) + float(dense @ chain.dense[:, k])
            z += sum(w * q for w, q in zip(chain.earlier[:k, k], earlier))
            earlier.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        assert np.allclose(p, earlier, atol=1e-9)
    assert np.mean((got >= chain.thresholds) == (labels > 0)) > 0.95
