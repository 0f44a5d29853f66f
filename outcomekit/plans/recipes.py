"""One configurable run from raw customer rows to metric records.

A recipe says how nulls, categories, splits, scales and class sizes are handled
and which models are trained. The nine in ``RECIPES`` differ only in settings.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomekit.functions import lenient_double, map_values
from outcomekit.operators import clean, features as fe, models
from outcomekit.operators.bootstrap import fit_bootstrap_forest
from outcomekit.operators.evaluate import evaluate
from outcomekit.operators.resample import smote
from outcomekit.operators.split import HashSplit
from outcomekit.session import stage, staged_run

#: Iterations of one step of a fit that may stop early.
STEP = 5


@dataclass(frozen=True)
class ModelSpec:
    """A classifier and the training rows it gets; ``patience`` counts iterations.

    A forest with ``per_bootstrap`` weights the classes in the sample of every tree, not once for all.
    """

    name: str
    kind: str  # "logistic", "forest" or "perceptron"
    hidden: tuple[int, ...] = (64, 32)
    iterations: int = 100
    weighted: bool = False
    per_bootstrap: bool = False
    resampled: bool = True
    early_stop: bool = False
    patience: int = 15
    restore_best: bool = True
    monitor: str = "val_loss"


@dataclass(frozen=True)
class Recipe:
    name: str
    models: tuple[ModelSpec, ...]
    null_policy: str = "median"  # or "drop"
    fill_scope: str = "train"  # or "all"
    trim: bool = False
    replace: bool = False
    encode: str = "onehot"  # or "auto"
    extra_categories: tuple[str, ...] = ()
    parts: Mapping[str, float] = field(default_factory=lambda: {"test": 0.15, "validation": 0.15})
    stratify: bool = True
    scale: str = "numbers"  # or "all"
    scale_scope: str = "train"  # "train", "all" or "resampled"
    balance: str = "none"  # "none", "smote", "weights" or "both"
    inclusive: bool = False
    seed: int = 42


@dataclass(frozen=True)
class Layout:
    """Columns of the table a recipe works on."""

    key: str = "customer_id"
    target: str = "churn"
    raw_number: str = "total_charges_raw"
    number: str = "total_charges"
    scaled: tuple[str, ...] = ("tenure", "monthly_charges", "total_charges")
    placeholders: Mapping[str, str] = field(default_factory=lambda: {"No orders": "No"})


@dataclass(frozen=True)
class Prepared:
    """Table with ``split``, ``label`` and feature columns; the training rows to fit on."""

    table: DataFrame
    train: DataFrame
    resampled: DataFrame
    names: tuple[str, ...]
    layout: Layout

    def part(self, split: str) -> DataFrame:
        return self.table.where(F.col("split") == split)

    def vectors(self, df: DataFrame, keep: Sequence[str] = ("label",)) -> DataFrame:
        return fe.assemble(df, self.names, keep=keep)


def prepare(df: DataFrame, recipe: Recipe, layout: Layout | None = None) -> Prepared:
    """Clean, encode, split, scale and balance as the recipe says."""
    lay = layout or Layout()
    rows = lenient_rows(df, recipe, lay)
    if recipe.null_policy == "drop":
        rows = clean.drop_null_rows(rows)
    texts = [*clean.columns_of_kind(rows, "text"), *recipe.extra_categories]
    rows = stage(rows)
    if recipe.encode == "auto":
        encoder = fe.AutoEncode.fit(rows, texts)
    else:
        encoder = fe.OneHot.fit(rows, texts)
    rows = encoder.transform(rows)
    stratum = "label" if recipe.stratify else None
    rows = HashSplit.fit(rows, lay.key, recipe.parts, stratum, recipe.seed).transform(rows)
    in_train = F.col("split") == "train"
    if recipe.null_policy == "median":
        scope = in_train if recipe.fill_scope == "train" else None
        rows = clean.MedianFill.fit(rows, [lay.number], scope).transform(rows)
    names = tuple(fe.feature_columns(rows, "label", others=[lay.key, "split"]))
    rows = rows.select(lay.key, "label", "split", *[F.col(f"`{c}`").cast("double").alias(c) for c in names])
    to_scale = list(names) if recipe.scale == "all" else list(lay.scaled)
    scaler = None
    if recipe.scale_scope != "resampled":
        scaler = fe.Standardize.fit(rows, to_scale, in_train if recipe.scale_scope == "train" else None)
        rows = scaler.transform(rows)
    rows = stage(rows)
    train = rows.where(in_train)
    grown = train
    if recipe.balance in ("smote", "both"):
        grown = stage(smote(train, lay.key, "label", names, seed=recipe.seed))
    if scaler is None:
        scaler = fe.Standardize.fit(grown, to_scale)
        rows, grown = scaler.transform(rows), scaler.transform(grown)
        train = rows.where(in_train)
    return Prepared(rows, train, grown, names, lay)


def lenient_rows(df: DataFrame, recipe: Recipe, lay: Layout) -> DataFrame:
    """Number text to numbers, target to 0/1, placeholders to plain values."""
    rows = df.withColumn(lay.number, lenient_double(lay.raw_number, recipe.trim)).drop(lay.raw_number)
    rows = rows.withColumn("label", map_values(lay.target, fe.YES_NO)).drop(lay.target)
    rows = clean.replace_values(rows, lay.placeholders) if recipe.replace else rows
    for c in recipe.extra_categories:
        rows = rows.withColumn(c, F.col(c).cast("string"))
    kept = [c for c in rows.columns if c not in recipe.extra_categories]
    return rows.select(*kept, *recipe.extra_categories)


def train(
    prepared: Prepared,
    spec: ModelSpec,
    recipe: Recipe,
    save_best_to: str | None = None,
    resume_in: str | None = None,
) -> Model:
    """Fit one model; with ``balance`` "weights" or "both" every model has its classes weighted.

    A fit that may stop early keeps its best model in a folder of ``save_best_to`` named by the model,
    and its steps in one of ``resume_in``, from which another call goes on.
    """
    rows = prepared.resampled if spec.resampled else prepared.train
    if spec.kind == "forest" and spec.per_bootstrap:
        key = prepared.layout.key
        return fit_bootstrap_forest(stage(prepared.vectors(rows, keep=[key, "label"])), key, seed=recipe.seed)
    weight = None
    weighted = spec.weighted or recipe.balance in ("weights", "both")
    if weighted and spec.kind != "perceptron":
        rows = fe.ClassWeights.fit(rows, "label").transform(rows, "label")
        weight = "weight"
    elif weighted:
        rows = models.replicate_by_class(rows)
    fit_on = models.spread(stage(prepared.vectors(rows, keep=["label", *([weight] if weight else [])])))
    if spec.kind == "logistic":
        return models.fit_logistic(fit_on, weight=weight, max_iter=spec.iterations)
    if spec.kind == "forest":
        return models.fit_forest(fit_on, weight=weight, seed=recipe.seed)
    width = len(prepared.names)
    if spec.early_stop:
        held = stage(prepared.vectors(prepared.part("validation")))
        return models.fit_early_stopping(
            fit_on, held, width, spec.hidden, step_iter=STEP, max_steps=-(-spec.iterations // STEP),
            patience=-(-spec.patience // STEP), restore_best=spec.restore_best, monitor=spec.monitor, seed=recipe.seed,
            save_best_to=f"{save_best_to.rstrip('/')}/{spec.name}" if save_best_to else None,
            resume_in=f"{resume_in.rstrip('/')}/{spec.name}" if resume_in else None,
        ).model
    return models.fit_perceptron(fit_on, width, spec.hidden, max_iter=spec.iterations, seed=recipe.seed)


def run(
    df: DataFrame, recipe: Recipe, layout: Layout | None = None, part: str = "test", save_best_to: str | None = None
) -> DataFrame:
    """Prepare, train every model, and evaluate them all on one part in one job.

    The metric records, one per model, are read before the tables staged on the way are deleted.
    """
    spark = df.sparkSession
    with staged_run(spark) as release:
        try:
            prepared = prepare(df, recipe, layout)
            held = stage(prepared.vectors(prepared.part(part)))
            fitted = [(spec, train(prepared, spec, recipe, save_best_to)) for spec in recipe.models]
            scored = reduce(DataFrame.unionByName, [models.score(m, held, spec.name) for spec, m in fitted])
            if recipe.inclusive:
                scored = scored.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
            records = evaluate(scored, ["model"])
            return spark.createDataFrame(records.collect(), records.schema)
        finally:
            release()


# Held-out rows for early stopping come from the original rows, before any are made up.
_TWO_WAY_TAIL = {"test": 0.2, "validation": 0.08}
_TWO_WAY_FIFTH = {"test": 0.2, "validation": 0.16}
_SIXTY = {"test": 0.2, "validation": 0.2}


def _net(hidden=(64, 32), iterations=100, **kw) -> ModelSpec:
    return ModelSpec("perceptron", "perceptron", hidden, iterations, **kw)


RECIPES: dict[str, Recipe] = {
    r.name: r
    for r in [
        Recipe(
            "three_models",
            (
                _net(iterations=20, early_stop=True, patience=15),
                ModelSpec("logistic", "logistic", iterations=1000, weighted=True),
                ModelSpec("forest", "forest", weighted=True),
            ),
            balance="smote",
        ),
        Recipe(
            "net_on_all_scaled",
            (_net((64, 32), 100, early_stop=True, patience=15),),
            extra_categories=("senior",), parts=_TWO_WAY_FIFTH, scale="all", balance="smote",
        ),
        Recipe(
            "auto_encoded_net_and_logistic",
            (
                _net((128, 64), 100, early_stop=True, patience=10),
                ModelSpec("logistic", "logistic", iterations=2000, weighted=True, resampled=False),
            ),
            replace=True, encode="auto", fill_scope="all", parts=_TWO_WAY_TAIL, scale_scope="all",
            balance="smote", inclusive=True,
        ),
        Recipe(
            "weighted_small_net",
            (_net((16, 8), 50, weighted=True),),
            null_policy="drop", parts=_TWO_WAY_FIFTH, stratify=False, scale="all", balance="weights",
        ),
        Recipe("plain_net_three_way", (_net((64, 32), 200),), parts=_SIXTY, scale="all"),
        Recipe(
            "auto_encoded_net_vs_logistic",
            (
                _net((128, 64), 100, early_stop=True, patience=10),
                ModelSpec("logistic", "logistic", iterations=2000, weighted=True, resampled=False),
            ),
            replace=True, encode="auto", fill_scope="all", parts=_TWO_WAY_FIFTH, scale_scope="all",
            balance="smote", inclusive=True,
        ),
        Recipe(
            "resample_then_scale",
            (ModelSpec("logistic", "logistic", iterations=1000), _net((64, 32), 100, early_stop=True, patience=10)),
            null_policy="drop", trim=True, parts=_TWO_WAY_FIFTH, scale="all", scale_scope="resampled",
            balance="smote", inclusive=True,
        ),
        Recipe(
            "resample_then_scale_unstratified",
            (
                ModelSpec("logistic", "logistic", iterations=1000),
                _net((64, 32), 50, early_stop=True, patience=10, restore_best=False),
            ),
            null_policy="drop", parts=_TWO_WAY_FIFTH, stratify=False, scale="all", scale_scope="resampled",
            balance="smote",
        ),
        Recipe(
            "logistic_vs_net_three_way",
            (
                ModelSpec("logistic", "logistic", iterations=1000, resampled=False),
                _net((64, 32), 200, resampled=False),
            ),
            parts=_SIXTY, scale="all",
        ),
    ]
}
