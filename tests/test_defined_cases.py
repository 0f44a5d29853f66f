"""Cases that are refused or defined rather than lost."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from outcomekit.operators import evaluate, features, profile
from outcomekit.operators.resample import smote
from outcomekit.plans import recipes
from registry.core import customers


@pytest.mark.parametrize("labels", [[0.0, -1.0], [0.0, 0.5]])
def test_dense_counts_refuse_what_has_no_place(spark, labels):
    with pytest.raises(ValueError, match="whole numbers"):
        profile.dense_class_counts(spark.createDataFrame([(x,) for x in labels], "label double"), "label")


def test_dense_counts_list_gaps(spark):
    got = profile.dense_class_counts(spark.createDataFrame([(0,), (3,), (3,), (None,)], "label int"), "label").collect()
    assert sorted(map(tuple, got)) == [(0, 1), (1, 0), (2, 0), (3, 2)]


def test_rows_without_a_score_stay_in_the_cells(spark):
    rows = [("m", 1, 0.9, 1), ("m", 0, 0.2, 0), ("m", 1, None, 1), ("m", 0, None, 0), ("none", 1, None, 0)]
    scored = spark.createDataFrame(rows, "model string, label int, score double, prediction int")
    cells = {r.model: (r.tn, r.fp, r.fn, r.tp) for r in evaluate.confusion(scored, ["model"]).collect()}
    found = {r.model: r for r in evaluate.evaluate(scored).collect()}
    assert {m: (r.tn, r.fp, r.fn, r.tp) for m, r in found.items()} == cells == {"m": (2, 0, 0, 2), "none": (0, 0, 1, 0)}
    assert found["m"].roc_auc == 1.0 and found["none"].roc_auc is None
    assert evaluate.evaluate(scored.where("model = 'm'"), []).first().roc_auc == 1.0


def test_assembled_names_may_hold_dots(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, 4.0)], "label int, `a.b` double, a_b double, `_0` double")
    out = features.assemble(df, ["a.b", "a_b", "_0"], keep=["label"])
    assert out.columns == ["label", "features"] and list(out.first().features) == [2.0, 3.0, 4.0]
    named = out.schema["features"].metadata["ml_attr"]["attrs"]["numeric"]
    assert [a["name"] for a in named] == ["a.b", "a_b", "_0"]


@pytest.mark.parametrize("missing", [None, float("nan")])
def test_resampling_refuses_unknown_features(spark, missing):
    rows = [(i, i % 3 == 0, float(i)) for i in range(12)] + [(99, True, missing)]
    df = spark.createDataFrame(rows, "id long, flag boolean, x double").withColumn("y", F.col("flag").cast("int"))
    with pytest.raises(ValueError, match="nulls or NaN"):
        smote(df, "id", "y", ["x"])


def test_workers_need_no_package_on_their_path(tmp_path):
    """Functions run in Python workers started from another folder, where the package cannot be imported."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from outcomekit.session import build_session
from outcomekit.operators.explain import linear_permutation_importance
spark = build_session("elsewhere", master="local[2]", spark__sql__shuffle__partitions="2", spark__checkpoint__dir={str(tmp_path)!r})
df = spark.range(50).selectExpr("id", "CAST(id % 2 AS INT) AS y", "CAST(id % 2 AS DOUBLE) - 0.5 AS x")
print("ROWS", linear_permutation_importance(df, "id", "y", {{"x": 1.0}}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 1" in out.stdout, out.stderr[-2000:]


def test_a_recipe_leaves_nothing_staged(spark):
    rows = customers(spark, "/root/testdata/sf0.001").cache()
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(folder.rglob("*.parquet"))
    recipe = recipes.Recipe("small", (recipes.ModelSpec("l", "logistic", iterations=5),), balance="smote")
    assert recipes.run(rows, recipe).count() == 1
    assert set(folder.rglob("*.parquet")) == before
