"""Training, scoring, saving and inspection of classifiers.

Training is ``pyspark.ml``: every fit is a series of distributed passes over the
training rows. Penalties and weights are set so that the optimum is the one the
usual single-machine estimators define, not Spark's default.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import DefaultParamsReader, MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomekit.functions import bce_loss, threshold_label
from outcomekit.operators.evaluate import roc_auc, score_points
from outcomekit.sources.files import SourceNotFound, read_parquet

HISTORY_SCHEMA = (
    "model string, step int, loss double, val_loss double, accuracy double, val_accuracy double, val_auc double"
)


def spread(df: DataFrame, rows_each: int = 4_096) -> DataFrame:
    """``df`` in enough partitions to keep the cores busy, but not with fewer than ``rows_each`` rows.

    Training passes over the rows many times; a table read back from few files would
    keep most cores idle. Tables of more partitions than cores stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    have = df.rdd.getNumPartitions()
    if have >= cores:
        return df
    want = min(cores, -(-df.count() // rows_each))
    return df.repartition(want) if want > have else df


def fit_logistic(
    train: DataFrame,
    features: str = "features",
    label: str = "label",
    weight: str | None = None,
    c: float = 1.0,
    max_iter: int = 1000,
    tol: float = 1e-6,
) -> LogisticRegressionModel:
    """L2-penalized logistic regression with inverse penalty ``c``.

    The penalty is on the sum of the losses and on unscaled coefficients, so Spark's
    parameter, which is relative to the mean loss, is 1 / (c x sum of weights).
    """
    total = train.agg(F.sum(weight).alias("w") if weight else F.count("*").alias("w")).first()["w"]
    estimator = LogisticRegression(
        featuresCol=features,
        labelCol=label,
        regParam=1.0 / (c * float(total)),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=tol,
        family="binomial",
    )
    if weight:
        estimator = estimator.setWeightCol(weight)
    return estimator.fit(train)


def fit_forest(
    train: DataFrame,
    features: str = "features",
    label: str = "label",
    weight: str | None = None,
    trees: int = 100,
    depth: int = 10,
    seed: int = 42,
) -> RandomForestClassificationModel:
    """Random forest; class weights are those of the whole training set, for every tree.

    The node a row is in is kept for each tree, so a pass does not walk all trees from their roots; the
    trees are the same. It takes 4 bytes per row and tree, in memory or on the executors' disks.
    """
    estimator = RandomForestClassifier(
        featuresCol=features, labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="auto",
        cacheNodeIds=True,
    )
    if weight:
        estimator = estimator.setWeightCol(weight)
    return estimator.fit(train)


def _perceptron(
    width: int, hidden: Sequence[int], features: str, label: str, max_iter: int, seed: int, tol: float = 1e-6
) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(
        featuresCol=features,
        labelCol=label,
        layers=[width, *hidden, 2],
        maxIter=max_iter,
        seed=seed,
        tol=tol,
        blockSize=128,
    )


def fit_perceptron(
    train: DataFrame,
    width: int,
    hidden: Sequence[int] = (64, 32),
    features: str = "features",
    label: str = "label",
    max_iter: int = 200,
    seed: int = 42,
    tol: float = 1e-4,
) -> MultilayerPerceptronClassificationModel:
    """Feed-forward net with sigmoid hidden layers, fitted with l-bfgs on all rows per step.

    Stops before ``max_iter`` once the loss improves by less than ``tol``.
    """
    return _perceptron(width, hidden, features, label, max_iter, seed, tol).fit(train)


def replicate_by_class(train: DataFrame, label: str = "label") -> DataFrame:
    """Repeat the rows of each class a whole number of times, towards the largest class.

    For estimators that take no weights.
    """
    counts = {r[label]: r["n"] for r in train.groupBy(label).agg(F.count("*").alias("n")).collect()}
    most = max(counts.values())
    copies = F.lit(1)
    for value, n in counts.items():
        copies = F.when(F.col(label) == F.lit(value), F.lit(round(most / n))).otherwise(copies)
    return train.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def score(model: Model, df: DataFrame, name: str | None = None, keep: Sequence[str] = ("label",)) -> DataFrame:
    """Probability of class 1 and predicted label for every row.

    A model without probabilities gives its prediction as score.
    """
    out = model.transform(df)
    if "probability" in out.columns:
        p = vector_to_array("probability")[1]
    else:
        p = F.col("prediction")
    named = [F.lit(name).alias("model")] if name else []
    return out.select(
        *keep, *named, p.cast("double").alias("score"), F.col("prediction").cast("int").alias("prediction")
    )


@dataclass
class EarlyStop:
    """Outcome of a fit that stops once the validation figure no longer improves."""

    model: MultilayerPerceptronClassificationModel
    best: MultilayerPerceptronClassificationModel
    best_step: int
    history: list[tuple] = field(default_factory=list)

    def history_table(self, spark) -> DataFrame:
        return spark.createDataFrame(self.history, HISTORY_SCHEMA)

    @property
    def steps_run(self) -> int:
        return len(self.history)

    @property
    def accuracy_gap(self) -> float:
        """Training minus validation accuracy at the last step."""
        return self.history[-1][4] - self.history[-1][5]


def fit_early_stopping(
    train: DataFrame,
    validation: DataFrame,
    width: int,
    hidden: Sequence[int] = (64, 32),
    features: str = "features",
    label: str = "label",
    step_iter: int = 5,
    max_steps: int = 20,
    patience: int = 15,
    restore_best: bool = True,
    monitor: str = "val_loss",
    seed: int = 42,
    name: str = "perceptron",
    save_best_to: str | None = None,
    save_monitor: str = "val_auc",
    resume_in: str | None = None,
) -> EarlyStop:
    """Train in steps of a few iterations and watch the validation rows.

    Each step is a distributed fit that starts from the weights of the last one.
    ``monitor`` is ``val_loss`` (lower is better) or ``val_auc``. The model best by
    ``save_monitor`` is saved to ``save_best_to`` whenever it improves.

    With ``resume_in``, a shared folder, every step leaves its model and state there, and a call
    that finds some goes on after the last whole step, as if it had not been stopped. The folder is
    that of one fit: it is refused if settings differ. ``max_steps`` may be raised.
    """
    estimator = _perceptron(width, hidden, features, label, step_iter, seed)
    spark = train.sparkSession
    settings = repr((width, list(hidden), features, label, step_iter, patience, monitor, seed, name))
    kept = load_state(spark, resume_in, settings) if resume_in else None
    best, best_value, best_step, waited, saved_value = None, None, 0, 0, None
    history: list[tuple] = []
    model = None
    if kept:
        best_value, best_step, waited, saved_value = (kept[k] for k in ("best_value", "best_step", "waited", "saved_value"))
        history = [tuple(h) for h in kept["history"]]
        model = load_model(f"{resume_in}/step-{len(history)}", spark)
        best = load_model(f"{resume_in}/step-{best_step}", spark)
    steps = range(len(history) + 1, max_steps + 1) if waited < patience else ()
    # Every step reads the rows again; lost blocks are made anew from the source.
    train, validation = train.persist(), validation.persist()
    try:
        for step in steps:
            if model is not None:
                estimator = estimator.setInitialWeights(model.weights)
            model = estimator.fit(train)
            figures = _figures(model, train, validation, label)
            seen, held = figures["train"], figures["held"]
            auc = None
            if monitor == "val_auc" or (save_best_to and save_monitor == "val_auc"):
                auc = roc_auc(score_points(score(model, validation, keep=[label]), label=label)).first()["roc_auc"]
            history.append((name, step, seen["loss"], held["loss"], seen["accuracy"], held["accuracy"], auc))
            worth = {"val_loss": -held["loss"], "val_auc": auc if auc is not None else float("-inf")}
            value = worth[monitor]
            if save_best_to and (saved_value is None or worth[save_monitor] > saved_value):
                saved_value = worth[save_monitor]
                save_model(model, save_best_to)
            if best_value is None or value > best_value:
                best, best_value, best_step, waited = model, value, step, 0
            else:
                waited += 1
            if resume_in:
                save_model(model, f"{resume_in}/step-{step}")
                state = {"best_value": best_value, "best_step": best_step, "waited": waited, "saved_value": saved_value}
                save_state(spark, resume_in, step, state | {"settings": settings, "history": history})
            if waited >= patience:
                break
    finally:
        train.unpersist()
        validation.unpersist()
    return EarlyStop(best if restore_best else model, best, best_step, history)


def save_state(spark: SparkSession, folder: str, step: int, state: dict) -> None:
    """Add the state of a step to those in the folder. It is written after the step's model, so it stands for both."""
    line = spark.createDataFrame([(step, json.dumps(state))], "step int, state string").coalesce(1)
    line.write.mode("append").parquet(f"{folder}/states")


def load_state(spark: SparkSession, folder: str, settings: str) -> dict | None:
    """State of the last step in the folder."""
    try:
        states = read_parquet(spark, f"{folder}/states", "step int, state string")
    except SourceNotFound:
        return None
    last = states.orderBy(F.desc("step")).first()
    state = json.loads(last["state"]) if last else None
    if state and state["settings"] != settings:
        raise ValueError(f"{folder} holds a fit with other settings")
    return state


def _figures(model: Model, train: DataFrame, validation: DataFrame, label: str) -> dict[str, dict[str, float]]:
    """Loss and accuracy on both tables, in one job."""
    rows = train.withColumn("part", F.lit("train")).unionByName(validation.withColumn("part", F.lit("held")))
    right = (threshold_label("score") == F.col(label).cast("int")).cast("double")
    out = score(model, rows, keep=[label, "part"]).groupBy("part")
    out = out.agg(F.avg(bce_loss(label, "score")).alias("loss"), F.avg(right).alias("accuracy")).collect()
    return {r["part"]: r.asDict() for r in out}


def loss_history(model, name: str, spark) -> DataFrame:
    """Training loss at every iteration of one fit."""
    summary = model.summary() if callable(model.summary) else model.summary
    rows = [(name, i, float(v)) for i, v in enumerate(summary.objectiveHistory)]
    return spark.createDataFrame(rows, "model string, step int, loss double")


def named_values(names: Iterable[str], values: Iterable[float], spark, column: str) -> DataFrame:
    """Small table of one figure per feature."""
    rows = [(n, float(v)) for n, v in zip(names, values, strict=True)]
    return spark.createDataFrame(rows, f"feature string, {column} double")


def coefficient_table(model: LogisticRegressionModel, names: Sequence[str], spark) -> DataFrame:
    return named_values(names, model.coefficients.toArray(), spark, "coefficient")


def importance_table(model: RandomForestClassificationModel, names: Sequence[str], spark) -> DataFrame:
    return named_values(names, model.featureImportances.toArray(), spark, "importance")


def save_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str, spark):
    """Load whatever kind of model was saved at the path."""
    return DefaultParamsReader.loadParamsInstance(path, spark)


