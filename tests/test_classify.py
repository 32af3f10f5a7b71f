"""The Spark ML baseline: quality, save and load, choice of a setting, labels outside the logits."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from lexgrid.operators import classify as MC
from lexgrid.operators import metrics as M


@pytest.fixture(scope="module")
def halves(spark):
    rows = [(i, ("sunny warm bright " if i % 3 else "rainy cold grey ") + f"w{i % 17} w{i % 5}", int(i % 3 > 0)) for i in range(240)]
    df = spark.createDataFrame(rows, "id int, text string, label int")
    return df.where("id < 180"), df.where("id >= 180")


def test_beats_the_majority_and_converges(halves):
    train, test = halves
    model = MC.fit_text_classifier(train, "text", "label", 0.01, 100, 1 << 12)
    report = MC.evaluate(model, test, "label").first()
    assert report.accuracy > 0.95 and report.eval_loss < 0.3
    iterations, converged = MC.convergence(model, 100)
    assert converged and 0 < iterations < 100
    assert MC.convergence(MC.fit_text_classifier(train, "text", "label", 0.0, 1, 1 << 12), 1) == (1, False)


def test_reloaded_model_predicts_the_same(spark, halves):
    train, test = halves
    model = MC.fit_text_classifier(train, "text", "label", 0.01, 50, 1 << 12)
    path = os.path.join(tempfile.mkdtemp(prefix="model-"), "m")
    MC.save_model(model, path)
    a, b = (MC.predict(m, test, logits=None).select("id", "prediction").collect() for m in (model, MC.load_model(path)))
    assert sorted(a) == sorted(b)


def test_lowest_loss_is_chosen(spark, halves):
    train, test = halves
    log, best = MC.select_model(train, test, "text", "label", [5.0, 0.01, 50.0], 50, 1 << 12)
    rows = log.collect()
    assert [r.chosen for r in rows] == [r.eval_loss == min(x.eval_loss for x in rows) for r in rows]
    assert MC.evaluate(best, test, "label").first().eval_loss == min(r.eval_loss for r in rows)
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_label_outside_the_logits(spark):
    df = spark.createDataFrame([([0.0, 1.0], 0), ([0.0, 1.0], 5), ([0.0, 1.0], -1), ([0.0, 1.0], None)], "logits array<double>, label int")
    r = M.eval_loss(df, "logits", "label").first()
    assert (r.rows, r.rows_without_loss) == (4, 3) and abs(r.eval_loss - 1.313262) < 1e-6
    assert M.eval_loss(df.where(F.lit(False)), "logits", "label").first().eval_loss is None
