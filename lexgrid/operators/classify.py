"""A baseline text classifier on Spark ML.

The reference fine-tunes a single-GPU model; the distributed stand-in is a
Spark ML pipeline: rule tokens -> hashed term frequencies -> IDF -> multinomial
logistic regression. Hashing keeps the feature space fixed (no vocabulary pass,
nothing collected to the driver); the optimiser's gradient sums run as tree
aggregations over the executors. Evaluation reuses the metric operators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgrid.functions.labels import cross_entropy
from lexgrid.operators.metrics import best_checkpoint, macro_report

DEFAULT_FEATURES = 1 << 18


def text_features(text: str, num_features: int = DEFAULT_FEATURES) -> list:
    tok = RegexTokenizer(inputCol=text, outputCol="_tokens", pattern="[ \\n\\t\\r]+", gaps=True,
                         toLowercase=True)
    tf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features)
    return [tok, tf, IDF(inputCol="_tf", outputCol="_features")]


def regression(label: str, reg_param: float = 0.0, max_iter: int = 50) -> LogisticRegression:
    return LogisticRegression(featuresCol="_features", labelCol=label, family="multinomial",
                              regParam=reg_param, maxIter=max_iter, predictionCol="_prediction",
                              rawPredictionCol="_raw", probabilityCol="_probability")


def fit_text_classifier(train: DataFrame, text: str, label: str, reg_param: float = 0.0,
                        max_iter: int = 50, num_features: int = DEFAULT_FEATURES) -> PipelineModel:
    """M1: fit the pipeline (label must be a 0-based class index)."""
    features = Pipeline(stages=text_features(text, num_features)).fit(train)
    return PipelineModel([*features.stages, regression(label, reg_param, max_iter).fit(_ready(features, train, label))])


def _ready(features: PipelineModel, train: DataFrame, label: str) -> DataFrame:
    """The narrow feature rows, dealt over the cores: every pass of the optimiser reads them, and texts may lie in one split."""
    return features.transform(train.withColumn(label, F.col(label).cast("double"))).select(label, "_features").repartition(
        train.sparkSession.sparkContext.defaultParallelism)


def convergence(model: PipelineModel, max_iter: int) -> tuple[int, bool]:
    """Iterations of the fit, and whether it ended before ``max_iter``."""
    done = int(model.stages[-1].summary.totalIterations)
    return done, done < max_iter


def predict(model: PipelineModel, df: DataFrame, out: str = "prediction",
            logits: str | None = "logits") -> DataFrame:
    scored = model.transform(df).withColumn(out, F.col("_prediction").cast("int"))
    if logits:
        scored = scored.withColumn(logits, vector_to_array("_raw"))
    return scored.drop("_tokens", "_tf", "_features", "_raw", "_probability", "_prediction")


def evaluate(model: PipelineModel, test: DataFrame, label: str) -> DataFrame:
    """Macro P/R/F1, accuracy and the eval loss (softmax cross-entropy of the margins)."""
    scored = predict(model, test).withColumn(label, F.col(label).cast("int")).select(label, "prediction", "logits").cache()
    try:
        # scalars: the mean loss, and the one-row report it is attached to
        loss = scored.agg(F.round(F.avg(cross_entropy("logits", label)), 6)).first()[0]
        report = macro_report(scored, label, "prediction").withColumn("eval_loss", F.lit(loss).cast("double"))
        return test.sparkSession.createDataFrame(report.collect(), report.schema)
    finally:
        scored.unpersist()


def save_model(model: PipelineModel, path: str) -> None:
    """M2: persist to a shared folder (one path per run)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def select_model(train: DataFrame, test: DataFrame, text: str, label: str,
                 reg_params: Sequence[float], max_iter: int = 50,
                 num_features: int = DEFAULT_FEATURES) -> tuple[DataFrame, PipelineModel]:
    """M3: fit one model per setting, keep the lowest eval loss (ties: first setting).

    Features are fitted and computed once and shared by all settings; each candidate's row
    says how many iterations its fit took and whether it converged.
    """
    spark = train.sparkSession
    features = Pipeline(stages=text_features(text, num_features)).fit(train)
    ready = _ready(features, train, label).cache()
    try:
        rows, fitted = [], []
        for i, rp in enumerate(reg_params):
            m = PipelineModel([*features.stages, regression(label, float(rp), max_iter).fit(ready)])
            loss = evaluate(m, test, label).first()["eval_loss"]
            rows.append((i, float(rp), float(loss), *convergence(m, max_iter)))
            fitted.append(m)
    finally:
        ready.unpersist()
    log = spark.createDataFrame(rows, "candidate int, reg_param double, eval_loss double, iterations int, converged boolean")
    best = best_checkpoint(log.withColumn("run", F.lit("grid")), "run", "candidate", "eval_loss")
    chosen = best.first()["best_step"]
    out = log.withColumn("chosen", F.col("candidate") == F.lit(chosen))
    return out, fitted[chosen]
