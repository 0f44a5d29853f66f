"""Preparation as stages of a ``pyspark.ml`` pipeline, so that what was fitted is saved with the model.

Every stage wraps a step of this package: an estimator learns its state from the rows that ``fit_on``
names, and the model it gives holds that state as JSON, which is all that is written to its folder. A
pipeline of them and a classifier is one ``PipelineModel`` from raw rows to a score: saved, loaded in
another session, and applied to rows the fit has not seen, with the medians, levels, cuts, scales and
weights of the fit.

A column that a stage without state reads may be missing in new rows (a target that is not known yet);
the stage then leaves them as they are. States hold numbers, text, booleans and nulls; keys and strata of
another type are refused when the pipeline is fitted.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from outcomekit.functions import lenient_double, map_values
from outcomekit.operators import clean, features, models
from outcomekit.operators.split import Cut, HashSplit


class _Stage(DefaultParamsReadable, DefaultParamsWritable):
    """A stage whose arguments, or learned state, are one parameter that is saved as text."""

    settings = Param(Params._dummy(), "settings", "arguments or learned state as JSON", TypeConverters.toString)

    def __init__(self, **settings) -> None:
        super().__init__()
        self._set(settings=json.dumps(settings))

    def get(self, name: str, default=None):
        return json.loads(self.getOrDefault(self.settings)).get(name, default)


class _Fixed(_Stage, Transformer):
    """A stage without state."""


class _Fitted(_Stage, Model):
    """A stage with the state that its estimator learned."""


class _Learner(_Stage, Estimator):
    """A stage that learns from the rows that the condition ``fit_on`` holds for; all rows without it."""

    def rows(self, df: DataFrame) -> DataFrame:
        condition = self.get("fit_on")
        return df.where(condition) if condition else df


class LenientNumber(_Fixed):
    """Number text ``column`` as a number in ``to``; what is no number is null."""

    def _transform(self, df: DataFrame) -> DataFrame:
        column = self.get("column")
        if column not in df.columns:
            return df
        return df.withColumn(self.get("to"), lenient_double(column, self.get("trim", False))).drop(column)


class MapValues(_Fixed):
    """Values of ``column`` by ``mapping`` in ``to``; other values are null."""

    def _transform(self, df: DataFrame) -> DataFrame:
        column = self.get("column")
        if column not in df.columns:
            return df
        return df.withColumn(self.get("to"), map_values(column, self.get("mapping"))).drop(column)


class ReplaceValues(_Fixed):
    """Whole values of all text columns by ``mapping``."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return clean.replace_values(df, self.get("mapping"))


class TextColumns(_Fixed):
    """``columns`` as text, so that they are encoded like categories."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: df[c].cast("string") for c in self.get("columns")})


class FillMedians(_Learner):
    """Nulls of ``columns`` by exact medians."""

    def _fit(self, df: DataFrame) -> FilledMedians:
        return FilledMedians(medians=clean.MedianFill.fit(self.rows(df), self.get("columns")).medians)


class FilledMedians(_Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        return clean.MedianFill(self.get("medians")).transform(df)


class Encode(_Learner):
    """All text columns but ``others``: one-hot columns, or with ``auto`` 1/0 for Yes/No and Male/Female domains."""

    def _fit(self, df: DataFrame) -> Encoded:
        texts = clean.columns_of_kind(df, "text", exclude=self.get("others", []))
        if self.get("auto", False):
            fitted = features.AutoEncode.fit(self.rows(df), texts)
            return Encoded(mapped=fitted.mapped, levels=fitted.one_hot.levels)
        return Encoded(mapped={}, levels=features.OneHot.fit(self.rows(df), texts).levels)


class Encoded(_Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        return features.AutoEncode(self.get("mapped"), features.OneHot(self.get("levels"))).transform(df)


class SplitByHash(_Learner):
    """``to`` with the part of each row, by ``fractions`` of each ``stratum``."""

    def _fit(self, df: DataFrame) -> SplitAtCuts:
        names = {n: self.get(n) for n in ("key", "stratum", "seed", "rest")}
        split = HashSplit.fit(
            self.rows(df), names["key"], self.get("fractions"), names["stratum"], names["seed"], names["rest"]
        )
        cuts = [[c.stratum, c.part, c.draw, c.key] for c in split.cuts]
        return SplitAtCuts(**names, parts=list(split.parts), cuts=cuts, strata=list(split.strata), to=self.get("to", "split"))

    def __init__(self, **settings) -> None:
        super().__init__(**{"stratum": None, "seed": 42, "rest": "train", **settings})


class SplitAtCuts(_Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        cuts = tuple(Cut(*c) for c in self.get("cuts"))
        names = [self.get(n) for n in ("key", "seed", "stratum")]
        split = HashSplit(*names, tuple(self.get("parts")), self.get("rest"), cuts, tuple(self.get("strata")))
        if names[2] is not None and names[2] not in df.columns:
            return df
        return split.transform(df, self.get("to"))


class Scale(_Learner):
    """``columns``, or all numbers but ``others``, less their mean and over their standard deviation."""

    def _fit(self, df: DataFrame) -> Scaled:
        cols = self.get("columns") or clean.columns_of_kind(df, "numeric", exclude=self.get("others", []))
        return Scaled(stats={c: list(s) for c, s in features.Standardize.fit(self.rows(df), cols).stats.items()})


class Scaled(_Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        return features.Standardize({c: tuple(s) for c, s in self.get("stats").items()}).transform(df)


class WeighClasses(_Learner):
    """``weight`` by class of ``label``: the fewer rows, the more each weighs."""

    def _fit(self, df: DataFrame) -> WeighedClasses:
        fitted = features.ClassWeights.fit(self.rows(df), self.get("label"))
        return WeighedClasses(label=self.get("label"), weights=[[c, w] for c, w in fitted.weights.items()])


class WeighedClasses(_Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        if self.get("label") not in df.columns:
            return df
        return features.ClassWeights({c: w for c, w in self.get("weights")}).transform(df, self.get("label"))


class Assemble(_Learner):
    """All columns but ``others`` as the vector ``features``; which they are is learned, so new rows may lack ``others``."""

    def _fit(self, df: DataFrame) -> Assembled:
        return Assembled(names=[c for c in df.columns if c not in self.get("others", [])])


class Assembled(_Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        names = self.get("names")
        return features.assemble(df, names, keep=[c for c in df.columns if c not in names])

    def names(self) -> list[str]:
        return self.get("names")


class Train(_Learner):
    """A classifier of ``kind`` with ``options`` of its fitting function; the model it gives is Spark's own.

    A net takes no weights: with ``replicate`` the rows of rare classes are repeated instead.
    """

    def _fit(self, df: DataFrame) -> Model:
        rows = self.rows(df)
        if self.get("replicate", False):
            rows = models.replicate_by_class(rows)
        options = self.get("options", {})
        rows = models.spread(rows.select("features", "label", *([options["weight"]] if options.get("weight") else [])))
        if self.get("kind") == "perceptron":
            width = rows.schema["features"].metadata["ml_attr"]["num_attrs"]
            hidden = tuple(options.get("hidden", (64, 32)))
            return models.fit_perceptron(rows, width, **{**options, "hidden": hidden})
        fits = {"logistic": models.fit_logistic, "forest": models.fit_forest}
        return fits[self.get("kind")](rows, **options)


def stage_of(pipeline: Model, kind: type) -> Model:
    """The first stage of a fitted pipeline that is of a kind."""
    return next(s for s in pipeline.stages if isinstance(s, kind))


def feature_names(pipeline: Model) -> Sequence[str]:
    return stage_of(pipeline, Assembled).names()
