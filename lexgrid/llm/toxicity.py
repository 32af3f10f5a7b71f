"""Toxicity categories by a chain of linear classifiers.

Categories are predicted one after the other. Each is a logistic regression on
word presence (hashed words chosen by chi-square) and a few shape figures of the whole
text, plus the probabilities of all earlier categories. Later models are
trained on out-of-fold probabilities of the earlier ones, so that they see
the same kind of error as at prediction; the earlier models are then refitted
on every training row. The threshold of a category is the one with the best F1
on out-of-fold probabilities.

Training rows are a bounded sample: rows of the label table whose key hashes
low, ``SAMPLE_ROWS`` in expectation (all, if there are fewer). Prediction
reads every row and whole texts. The fitted model is a small constant
(``2**HASH_BITS`` slot numbers and some weights) sent with the task.

Defined cases: a null or empty text has no words and gets the model's intercepts;
a row without a label is only predicted; rows with null labels are not trained
on; a category that has one class only in the sample predicts that class; with no
labelled row at all every probability is 0; repeated rows each get a row;
only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexgrid.llm.common import NON_WORD, hash_many, keep_where, map_slices

HASH_BITS = 18
SAMPLE_ROWS = 12_000
WORDS_PER_CATEGORY = 512
FOLDS = 3
RIDGE = 1.0
CRITICAL = 27.0     # chi-square of one in 2**18 slots by chance at about 5 % over all slots
SHAPE = 5
MASK = np.uint64((1 << HASH_BITS) - 1)

#: name and the condition on the label columns that makes a row positive, in chain order
CATEGORIES = (("low_quality", "quality = 0"), ("toxic", "toxic = 1"), ("toxic_low_quality", "toxic = 1 AND quality = 0"))


def _shape(text: str | None) -> list[float]:
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    if not len(raw):
        return [0.0] * SHAPE
    n = len(raw)
    share = np.bincount(_CLASS[raw], minlength=5) / n
    return [np.log1p(n) / 10, *(share[1:5] * 4).tolist()]


_CLASS = np.zeros(256, np.uint8)  # 0 letter, 1 white space, 2 digit, 3 upper case, 4 other ASCII
_CLASS[:128] = 4
_CLASS[[*range(97, 123)]] = 0
_CLASS[[*range(65, 91)]] = 3
_CLASS[[*range(48, 58)]] = 2
_CLASS[[0x20, *range(0x09, 0x0E)]] = 1


def _features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        yield f.drop(columns="text").assign(
            slots=[np.unique(h & MASK).astype(np.int32) for h in hash_many(f["text"], NON_WORD)],
            shape=[_shape(t) for t in f["text"]])


@dataclass
class Chain:
    names: list[str]
    column: np.ndarray        # hash slot to column, -1 if unused
    words: np.ndarray         # column x category
    dense: np.ndarray         # SHAPE x category
    earlier: np.ndarray       # earlier probability x category
    bias: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, texts: Sequence[str | None]) -> np.ndarray:
        score = np.empty((len(texts), len(self.names)))
        for i, (t, h) in enumerate(zip(texts, hash_many(texts, NON_WORD))):
            at = self.column[h & MASK]
            at = np.unique(at[at >= 0])
            score[i] = self.words[at].sum(0) + np.array(_shape(t)) @ self.dense + self.bias
        out = np.zeros_like(score)
        for k in range(len(self.names)):
            out[:, k] = _sigmoid(score[:, k] + out[:, :k] @ self.earlier[:k, k])
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the last weight is the intercept."""
    x = np.c_[x, np.ones(len(x), x.dtype)]
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        w[-1] = 30.0 if len(y) and y.max() else -30.0
        return w
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-6
    for _ in range(15):
        p = _sigmoid(x @ w)
        hess = (x * (p * (1 - p) + 1e-9)[:, None].astype(x.dtype)).T @ x
        step = np.linalg.solve(hess + np.diag(ridge), x.T @ (p - y) + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-4:
            break
    return w


def _chosen(row: np.ndarray, slot: np.ndarray, y: np.ndarray, count: int) -> np.ndarray:
    """The slots with the highest chi-square against ``y``, of those in five rows or more that aren't chance."""
    n, pos = len(y), float(y.sum())
    df = np.bincount(slot, minlength=1 << HASH_BITS).astype(float)
    hit = np.bincount(slot, weights=y[row], minlength=1 << HASH_BITS)
    base = df * pos / max(n, 1)
    gain = (hit - base) ** 2 / np.maximum(base * (1 - df / max(n, 1)) * (1 - pos / max(n, 1)), 1e-9)
    gain[(df < 5) | (gain < CRITICAL)] = 0
    best = np.argsort(-gain, kind="stable")[:count]
    return np.sort(best[gain[best] > 0])


def _best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    if not y.any():
        return 1.0
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    s = p[order]
    f1[:-1][s[:-1] == s[1:]] = -1   # equal scores stay together
    k = int(f1.argmax())
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(s[k])


def fit_rows(slots: list[np.ndarray], shape: np.ndarray, labels: np.ndarray, names: Sequence[str]) -> Chain:
    """Fit the chain on rows in memory; ``labels`` is rows x categories of 0 and 1."""
    n, k_all = labels.shape
    row = np.repeat(np.arange(n), [len(s) for s in slots])
    slot = np.concatenate([*slots, np.empty(0, np.int32)]).astype(np.int64)
    fold = np.arange(n) % FOLDS
    held = np.zeros((n, k_all))         # out-of-fold probabilities
    columns, weights, thresholds = [], [], []

    def matrix(picked: np.ndarray, k: int) -> np.ndarray:
        at = np.full(1 << HASH_BITS, -1, np.int64)
        at[picked] = np.arange(len(picked))
        x = np.zeros((n, len(picked) + SHAPE + k), np.float32)
        use = at[slot] >= 0
        x[row[use], at[slot[use]]] = 1
        x[:, len(picked):len(picked) + SHAPE] = shape
        x[:, len(picked) + SHAPE:] = held[:, :k]
        return x

    for k in range(k_all):
        y = labels[:, k].astype(np.float64)
        for f in range(FOLDS):
            train, test = fold != f, fold == f
            if not test.any():
                continue
            inside = train[row]
            place = np.cumsum(train) - 1
            x = matrix(_chosen(place[row[inside]], slot[inside], y[train], WORDS_PER_CATEGORY), k)
            w = _logistic(x[train], y[train])
            held[test, k] = _sigmoid(x[test] @ w[:-1] + w[-1])
        picked = _chosen(row, slot, y, WORDS_PER_CATEGORY)
        columns.append(picked)
        weights.append(_logistic(matrix(picked, k), y))
        thresholds.append(_best_threshold(held[:, k], y) if n else 1.0)
    every = np.unique(np.concatenate(columns))
    column = np.full(1 << HASH_BITS, -1, np.int32)
    column[every] = np.arange(len(every))
    words, dense = np.zeros((len(every), k_all)), np.zeros((SHAPE, k_all))
    earlier, bias = np.zeros((k_all, k_all)), np.zeros(k_all)
    for k, (picked, w) in enumerate(zip(columns, weights)):
        words[column[picked], k] = w[:len(picked)]
        dense[:, k] = w[len(picked):len(picked) + SHAPE]
        earlier[:k, k] = w[len(picked) + SHAPE:-1]
        bias[k] = w[-1]
    return Chain(list(names), column, words, dense, earlier, bias, np.array(thresholds))


def fit_chain(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
              categories: Sequence[tuple[str, str | Column]] = CATEGORIES, sample_rows: int = SAMPLE_ROWS) -> Chain:
    """Fit on a bounded, hash-drawn sample of the labelled rows."""
    as_col = lambda c: F.expr(c) if isinstance(c, str) else c
    flagged = labels.select(F.col(key).alias("_key"), *[as_col(c).cast("int").alias(f"_y{i}") for i, (_, c) in enumerate(categories)]
                            ).dropna()
    total = flagged.count()
    share = min(1.0, sample_rows / max(total, 1))
    picked = flagged.where(F.pmod(F.xxhash64("_key", F.lit(11)), F.lit(1 << 31)) < F.lit(int(share * (1 << 31))))
    # the sample is bounded by sample_rows, so it may be broadcast
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(F.broadcast(picked), "_key")
    types = ", ".join(f"_y{i} int" for i in range(len(categories)))
    key_type = docs.schema[key].dataType.simpleString()
    got = map_slices(rows.select("_key", *[f"_y{i}" for i in range(len(categories))], "text"), _features,
                     f"_key {key_type}, {types}, slots array<int>, shape array<double>").toArrow()
    slots = [np.asarray(v.values, np.int32) for v in got["slots"]]
    shape = np.array(got["shape"].to_pylist(), float).reshape(len(slots), SHAPE)
    y = np.array([got[f"_y{i}"].to_pylist() for i in range(len(categories))], float).T.reshape(len(slots), len(categories))
    keys = np.array([str(k) for k in got["_key"].to_pylist()])
    order = np.argsort(keys, kind="stable")     # the same folds whatever the order of arrival
    return fit_rows([slots[i] for i in order], shape[order], y[order], [name for name, _ in categories])


def predict(docs: DataFrame, chain: Chain, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``p_<category>`` and ``<category>`` (over its threshold) for every row."""
    names = chain.names

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            p = chain.probabilities(f["text"].tolist())
            out = {"doc_id": f["doc_id"]}
            out |= {f"p_{c}": p[:, i].round(6) for i, c in enumerate(names)}
            out |= {c: p[:, i] >= chain.thresholds[i] for i, c in enumerate(names)}
            yield pd.DataFrame(out)

    key_type = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {key_type}, " + ", ".join([f"p_{c} double" for c in names] + [f"{c} boolean" for c in names])
    return map_slices(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), run, schema)


def without_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                  category: str = "toxic") -> DataFrame:
    """``docs`` without the rows that the chain rejects, in one pass over the texts."""
    chain = fit_chain(docs, labels, key, text)
    k = chain.names.index(category)

    return keep_where(docs, text, lambda texts: chain.probabilities(texts)[:, k] < chain.thresholds[k])
