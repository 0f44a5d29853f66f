"""Fitted preparation, saved and loaded with its model."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from outcomekit.operators import models, prepared as pr
from outcomekit.operators.features import ClassWeights, OneHot, Standardize
from outcomekit.operators.split import HashSplit
from outcomekit.plans import recipes
from outcomekit.plans.whole import whole_pipeline


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        (
            i,
            None if i % 17 == 0 else (" " if i % 13 == 0 else str(i * 1.5)),
            i % 7,
            float(i % 31),
            ["Yes", "No"][i % 2],
            ["a", "b.c", "d e", None][i % 4],
            ["Yes", "No"][i % 3 == 0 or i % 5 == 0],
        )
        for i in range(400)
    ]
    names = "customer_id long, total_charges_raw string, tenure long, monthly_charges double, paperless string, contract string, churn string"
    return spark.createDataFrame(rows, names)


def saved(model, path):
    models.save_model(model, path)
    return models.load_model(path, None)


def test_states_are_kept(spark, raw, tmp_path):
    label = pr.MapValues(column="churn", to="label", mapping={"Yes": 1, "No": 0})
    stages = [
        label,
        pr.LenientNumber(column="total_charges_raw", to="total_charges"),
        pr.SplitByHash(key="customer_id", fractions={"test": 0.2}, stratum="label", seed=3),
        pr.FillMedians(columns=["total_charges"], fit_on="split = 'train'"),
        pr.WeighClasses(label="label", fit_on="split = 'train'"),
        pr.Encode(others=["split"]),
        pr.Scale(columns=["tenure"], fit_on="split = 'train'"),
    ]
    fitted = Pipeline(stages=stages).fit(raw)
    again = saved(fitted, str(tmp_path / "p"))
    assert isinstance(again, PipelineModel)
    want, got = fitted.transform(raw), again.transform(raw)
    assert got.dtypes == want.dtypes and sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    # The same figures as the steps of their own.
    rows = label.transform(raw)
    split = HashSplit.fit(rows, "customer_id", {"test": 0.2}, "label", 3).transform(rows)
    train = split.where("split = 'train'")
    weights = {r.label: r.weight for r in got.select("label", "weight").distinct().collect()}
    assert weights == ClassWeights.fit(train, "label").weights
    mean, sd = Standardize.fit(train, ["tenure"]).stats["tenure"]
    first = got.orderBy("customer_id").first()
    assert first.tenure == (0 - mean) / sd
    assert set(OneHot.fit(raw, ["contract"]).output_columns()) <= set(got.columns)
    assert {r.customer_id: r.split for r in got.collect()} == {r.customer_id: r.split for r in split.collect()}
    median = train.select(F.expr("try_cast(total_charges_raw AS double)").alias("x")).agg(F.median("x")).first()[0]
    assert first.total_charges == median


@pytest.mark.parametrize("kind", ["logistic", "forest", "perceptron"])
def test_a_loaded_pipeline_scores_new_rows(spark, raw, tmp_path, kind):
    recipe = recipes.Recipe("saved", (), encode="auto", balance="weights")
    spec = recipes.ModelSpec(kind, kind, hidden=(4,), iterations=5)
    fitted = whole_pipeline(recipe, spec).fit(raw)
    other = spark.newSession()
    again = saved(fitted, str(tmp_path / kind))
    new = other.createDataFrame(
        [(9_000, "12", 3, 4.0, "No", "unseen"), (9_001, "x", None, None, None, None)],
        "customer_id long, total_charges_raw string, tenure long, monthly_charges double, paperless string, contract string",
    )
    assert pr.feature_names(again) == pr.feature_names(fitted)
    known = models.score(again, raw, keep=["customer_id"]).orderBy("customer_id").collect()
    assert known == models.score(fitted, raw, keep=["customer_id"]).orderBy("customer_id").collect()
    got = models.score(again, new.where("customer_id = 9000"), keep=["customer_id"]).collect()
    assert len(got) == 1 and 0 <= got[0].score <= 1
    assert pr.stage_of(again, pr.FilledMedians).transform(
        new.selectExpr("cast(null as double) AS total_charges")
    ).first()[0] is not None


def test_keys_that_cannot_be_kept_are_refused(spark):
    df = spark.sql("SELECT date'2024-01-01' + cast(id AS int) AS k FROM range(50)")
    with pytest.raises(TypeError):
        pr.SplitByHash(key="k", fractions={"test": 0.5}).fit(df)
