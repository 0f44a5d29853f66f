"""A recipe's preparation and one of its models as a single pipeline, to be saved and applied to raw rows."""

from __future__ import annotations

from pyspark.ml import Pipeline

from outcomekit.operators import features as fe, prepared as pr
from outcomekit.plans.recipes import Layout, ModelSpec, Recipe

IN_TRAIN = "split = 'train'"


def whole_pipeline(recipe: Recipe, spec: ModelSpec, layout: Layout | None = None) -> Pipeline:
    """Stages from raw rows to scores; fitting it gives a ``PipelineModel`` that ``models.save_model`` saves.

    Medians, scales and class weights are learned as the recipe says. Made-up rows of rare classes are no
    stage, since a stage must give new rows one row each: where the recipe would make some, classes are
    weighted, or rows repeated for nets.
    """
    lay = layout or Layout()
    not_features = [lay.key, "label", "split", "weight"]
    stages = [
        pr.LenientNumber(column=lay.raw_number, to=lay.number, trim=recipe.trim),
        pr.MapValues(column=lay.target, to="label", mapping=fe.YES_NO),
    ]
    if recipe.replace:
        stages.append(pr.ReplaceValues(mapping=dict(lay.placeholders)))
    if recipe.extra_categories:
        stages.append(pr.TextColumns(columns=list(recipe.extra_categories)))
    stratum = "label" if recipe.stratify else None
    stages += [
        pr.Encode(auto=recipe.encode == "auto", others=not_features),
        pr.SplitByHash(key=lay.key, fractions=dict(recipe.parts), stratum=stratum, seed=recipe.seed),
        pr.FillMedians(columns=[lay.number], fit_on=IN_TRAIN if recipe.fill_scope == "train" else None),
        pr.Scale(
            columns=None if recipe.scale == "all" else list(lay.scaled),
            others=not_features,
            fit_on=None if recipe.scale_scope == "all" else IN_TRAIN,
        ),
    ]
    weighted = spec.weighted or recipe.balance != "none"
    if spec.kind == "perceptron":
        options = {"hidden": spec.hidden, "max_iter": spec.iterations, "seed": recipe.seed}
    else:
        options = {"max_iter": spec.iterations} if spec.kind == "logistic" else {"seed": recipe.seed}
        if weighted:
            stages.append(pr.WeighClasses(label="label", fit_on=IN_TRAIN))
            options["weight"] = "weight"
    stages += [
        pr.Assemble(others=not_features),
        pr.Train(kind=spec.kind, options=options, replicate=weighted and spec.kind == "perceptron", fit_on=IN_TRAIN),
    ]
    return Pipeline(stages=stages)
