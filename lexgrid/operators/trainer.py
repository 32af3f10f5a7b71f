"""A text classifier trained by mini-batches, with a log.

Multinomial logistic regression on hashed term frequencies. Rows are dealt into batches by
a hash of their key. One step is one Spark job over one batch's files: every task sums the gradients of its
rows, the sums are added per weight, and the driver, which holds the weights (``settings x classes x features``, fixed
by the arguments), takes an Adam step. All settings and folds are trained at once: a scan gives the gradients
of all of them.

Every ``eval_every`` steps the held-out rows are scored, a line per setting is added to the log, and the whole state
(weights, moments, step) is written; ``train`` goes on from the last state it finds, and the result is that of
a run without a break. The log is what ``metrics.best_checkpoint`` reads, and the state of its best step is restored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgrid.operators.metrics import best_checkpoint
from lexgrid.operators.tokens import rule_tokens
from lexgrid.session import scratch_path

RATE, DECAY, DECAY2, TINY = 0.05, 0.9, 0.999, 1e-8
LOG = "setting int, fold int, reg_param double, step int, eval_loss double, accuracy double"


@dataclass(frozen=True)
class Setting:
    """One model of a run: its ridge, and the fold it leaves out of training (-1: none)."""

    reg_param: float = 0.0
    fold: int = -1


def token_slots(text: str, features: int) -> Column:
    """Lower-case tokens hashed into ``features`` slots."""
    return F.transform(rule_tokens(F.lower(F.coalesce(F.col(text), F.lit("")))), lambda t: F.pmod(F.xxhash64(t), F.lit(features)).cast("int"))


def hashed_rows(df: DataFrame, key: str, text: str, label: str, features: int, batches: int, folds: int) -> DataFrame:
    """``label, batch, fold, slots`` of the labelled rows, dealt into batches and folds by their key."""
    deal = lambda n, salt: F.pmod(F.xxhash64(F.col(key), F.lit(salt)), F.lit(max(n, 1))).cast("int")
    return df.where(F.col(label).isNotNull()).select(F.col(label).cast("int").alias("label"), deal(batches, 71).alias("batch"),
                                                     deal(folds, 72).alias("fold"), token_slots(text, features).alias("slots"))


def _scores(slots, weights: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Distinct slots of each row, their scaled counts, and its scores (rows x settings x classes)."""
    places, values = [], []
    out = np.zeros((len(slots), weights.shape[0], weights.shape[1]))
    for i, row in enumerate(slots):
        at, n = np.unique(np.asarray(row, np.int64), return_counts=True)
        value = n / np.sqrt((n * n).sum()) if len(at) else n.astype(float)
        places.append(at)
        values.append(value)
        out[i] = weights[:, :, at] @ value + weights[:, :, -1]
    return places, values, out


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _gradients(weights, folds: Sequence[int]):
    """Per task: summed gradients of every setting, one row per touched weight column, and how many rows each setting saw."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = weights.value
        total = np.zeros(w.shape)
        seen = np.zeros(w.shape[0])
        for f in frames:
            places, values, scores = _scores(f["slots"], w)
            error = _softmax(scores)
            error[np.arange(len(f)), :, f["label"].to_numpy()] -= 1
            used = np.not_equal.outer(f["fold"].to_numpy(), np.array(folds))
            error *= used[:, :, None]
            seen += used.sum(0)
            for at, value, e in zip(places, values, error):
                total[:, :, at] += e[:, :, None] * value
                total[:, :, -1] += e
        touched = np.flatnonzero(np.abs(total).sum((0, 1)))
        yield pd.DataFrame({"slot": np.r_[touched, -1], "g": [*[total[:, :, t].ravel().tolist() for t in touched], seen.tolist()]})
    return run


def _judged(weights, folds: Sequence[int]):
    """Per task and setting: rows, loss and hits on the rows of its fold."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = weights.value
        sums = np.zeros((w.shape[0], 3))
        for f in frames:
            label = f["label"].to_numpy()
            scores = _scores(f["slots"], w)[2]
            p = _softmax(scores)[np.arange(len(f)), :, label]
            mine = np.equal.outer(f["fold"].to_numpy(), np.array(folds))
            sums += np.stack([mine.sum(0), (-np.log(np.maximum(p, 1e-300)) * mine).sum(0), ((scores.argmax(-1) == label[:, None]) & mine).sum(0)], 1)
        yield pd.DataFrame({"setting": np.arange(len(sums)), "n": sums[:, 0], "loss": sums[:, 1], "hits": sums[:, 2]})
    return run


class Trainer:
    """Trains ``settings`` on ``train``; ``test`` is held out for settings without a fold, the fold's rows for the others."""

    def __init__(self, train: DataFrame, test: DataFrame, key: str, text: str, label: str, classes: int, settings: Sequence[Setting],
                 path: str | None = None, features: int = 1 << 12, batches: int = 4, eval_every: int = 5):
        self.spark: SparkSession = train.sparkSession
        self.path = path or scratch_path(self.spark, "training")
        self.settings, self.classes, self.features, self.batches, self.eval_every = list(settings), classes, features, batches, eval_every
        folds = max((s.fold for s in settings), default=-1) + 1
        self.scans = 0              # passes over the rows by this object
        if self._last() is None:
            hashed_rows(train, key, text, label, features, batches, folds).write.partitionBy("batch").parquet(f"{self.path}/train")
            hashed_rows(test, key, text, label, features, 1, 1).drop("batch").write.parquet(f"{self.path}/test")
            zero = np.zeros((len(settings), classes, features + 1))
            self._save(0, zero, np.zeros_like(zero), np.zeros_like(zero))

    # state: one row per setting and step, weights and moments as packed doubles
    def _save(self, step: int, weights: np.ndarray, first: np.ndarray, second: np.ndarray, log: list[tuple] = ()) -> None:
        rows = [(step, i, *(x[i].tobytes() for x in (weights, first, second))) for i in range(len(self.settings))]
        self.spark.createDataFrame(rows, "step int, setting int, weights binary, first binary, second binary").coalesce(1).write.mode("append").parquet(f"{self.path}/state")
        if log:
            self.spark.createDataFrame(log, LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        # the marker comes last: a state without it is not used
        self.spark.createDataFrame([(json.dumps({"step": step}),)], "value string").coalesce(1).write.mode("append").text(f"{self.path}/marks")

    def _last(self) -> int | None:
        try:
            marks = [json.loads(r[0])["step"] for r in self.spark.read.text(f"{self.path}/marks").collect()]
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return max(marks, default=None)

    def state(self, step: int) -> list[np.ndarray]:
        """Weights and moments after ``step`` (as first written, should a broken write have left another copy)."""
        rows = {r.setting: r for r in self.spark.read.parquet(f"{self.path}/state").where(F.col("step") == step).collect()}
        shape = (self.classes, self.features + 1)
        return [np.stack([np.frombuffer(rows[i][c], np.float64).reshape(shape) for i in range(len(self.settings))]) for c in ("weights", "first", "second")]

    def _step(self, weights: np.ndarray, step: int) -> np.ndarray:
        """Mean gradients over one batch, with the ridge."""
        self.scans += 1
        sent = self.spark.sparkContext.broadcast(weights)
        folds = [s.fold for s in self.settings]
        rows = self.spark.read.parquet(f"{self.path}/train").where(F.col("batch") == step % self.batches)
        per_task = rows.mapInPandas(_gradients(sent, folds), "slot int, g array<double>")
        # one row per weight column comes back, whatever the rows: added up by Spark, in an order fixed by the slots
        place = F.posexplode("g").alias("i", "v")
        summed = per_task.select("slot", place).groupBy("slot", "i").agg(F.sum(F.col("v").cast("decimal(38,18)")).cast("double").alias("v")).groupBy(
            "slot").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("g")).select("slot", F.col("g.v").alias("g")).toArrow()
        sent.unpersist()
        total, seen = np.zeros(weights.shape), np.zeros(len(folds))
        for slot, g in zip(summed["slot"].to_pylist(), summed["g"].to_pylist()):
            if slot < 0:
                seen = np.array(g)
            else:
                total[:, :, slot] = np.array(g).reshape(weights.shape[:2])
        ridge = np.array([s.reg_param for s in self.settings])[:, None, None]
        grad = total / np.maximum(seen, 1)[:, None, None]
        grad[:, :, :-1] += ridge * weights[:, :, :-1]
        return grad

    def _evaluate(self, weights: np.ndarray, step: int) -> list[tuple]:
        sent = self.spark.sparkContext.broadcast(weights)
        folds = [s.fold for s in self.settings]
        test, train = (self.spark.read.parquet(f"{self.path}/{t}") for t in ("test", "train"))
        sums = test.select("label", F.lit(-1).alias("fold"), "slots")
        self.scans += 1
        if any(k >= 0 for k in folds):
            sums = sums.unionByName(train.select("label", "fold", "slots"))
        # settings without a fold are judged on the test rows (fold -1), the others on their own fold
        judged = sums.mapInPandas(_judged(sent, folds), "setting int, n double, loss double, hits double").groupBy("setting").agg(
            F.sum("n").alias("n"), F.sum("loss").alias("loss"), F.sum("hits").alias("hits")).collect()
        sent.unpersist()
        return [(int(r.setting), self.settings[r.setting].fold, float(self.settings[r.setting].reg_param), step,
                 round(r.loss / r.n, 9) if r.n else None, r.hits / r.n if r.n else None) for r in sorted(judged)]

    def train(self, steps: int) -> DataFrame:
        """Go on to ``steps`` steps in all, from the last written state; returns the log."""
        step = self._last()
        weights, first, second = self.state(step)
        while step < steps:
            grad = self._step(weights, step)
            step += 1
            first = DECAY * first + (1 - DECAY) * grad
            second = DECAY2 * second + (1 - DECAY2) * grad * grad
            weights = weights - RATE * (first / (1 - DECAY ** step)) / (np.sqrt(second / (1 - DECAY2 ** step)) + TINY)
            if step % self.eval_every == 0 or step == steps:
                self._save(step, weights, first, second, self._evaluate(weights, step))
        return self.log()

    def log(self) -> DataFrame:
        """E8's input: ``setting, fold, reg_param, step, eval_loss, accuracy``, one line per setting and evaluation."""
        return self.spark.read.schema(LOG).parquet(f"{self.path}/log").dropDuplicates(["setting", "step"])

    def best(self) -> dict[int, int]:
        """Setting -> step with the least held-out loss."""
        return {r.setting: r.best_step for r in best_checkpoint(self.log(), "setting", "step", "eval_loss").collect()}

    def chosen(self) -> tuple[int, int]:
        """M3: the setting with the least best loss, and its step; folds of one ridge are averaged."""
        losses: dict[float, list[float]] = {}
        rows = {r.setting: r for r in best_checkpoint(self.log(), "setting", "step", "eval_loss").collect()}
        for i, s in enumerate(self.settings):
            losses.setdefault(s.reg_param, []).append(rows[i].best_loss)
        ridge = min(losses, key=lambda r: (np.mean(losses[r]), r))
        setting = min(i for i, s in enumerate(self.settings) if s.reg_param == ridge)
        return setting, rows[setting].best_step

    def predict(self, df: DataFrame, key: str, text: str, setting: int, step: int) -> DataFrame:
        """``key, prediction`` with the weights of ``setting`` after ``step``."""
        features = self.features
        sent = self.spark.sparkContext.broadcast(self.state(step)[0][setting:setting + 1])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                scores = _scores(b.column(1).to_pylist(), sent.value)[2][:, 0] if b.num_rows else np.zeros((0, 1))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores.argmax(-1).astype(np.int32))], names=[key, "prediction"])

        return df.select(key, token_slots(text, features).alias("slots")).mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, prediction int")
