"""Forests weighted by bootstrap sample: same for any partitioning, weights and joined trees by brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from outcomekit.operators import bootstrap, features, forests, models

CUTS = bootstrap.poisson_cuts()


def drawn_copies(key, seed, tree):
    d = int(hashlib.md5(f"{key}|{seed}|tree {tree}".encode()).hexdigest()[:8], 16)
    return sum(d >= c for c in CUTS)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(800, 4)).round(2)
    y = (x[:, 0] + x[:, 1] > 0.8).astype(int)
    rows = [(i, int(y[i]), *map(float, x[i])) for i in range(800)]
    df = spark.createDataFrame(rows, ["k", "label", "a", "b", "c", "d"])
    return features.assemble(df, ["a", "b", "c", "d"], keep=["k", "label"])


def test_same_model_for_any_partitioning(spark, vectors):
    found = []
    for n in (1, 16):
        model = bootstrap.fit_bootstrap_forest(vectors.repartition(n), "k", trees=6, depth=4, rows_each=300)
        trees = forests.read_trees(model, spark)
        found.append([(t.feature.tolist(), t.threshold.tolist(), t.shares.tolist()) for t in trees])
    assert len(found[0]) == 6 and found[0] == found[1]
    assert len({str(t) for t in found[0]}) == 6


def test_joined_forest_averages_its_trees_and_can_be_saved(spark, vectors, tmp_path):
    model = bootstrap.fit_bootstrap_forest(vectors, "k", trees=4, depth=3)
    models.save_model(model, str(tmp_path / "m"))
    again = models.load_model(str(tmp_path / "m"), spark)
    scored = models.score(again, vectors, keep=["k", "label"]).orderBy("k").toPandas()
    columns = list(np.array([r.features.toArray() for r in vectors.orderBy("k").collect()]).T)
    votes = np.mean([t.votes(columns) for t in forests.read_trees(model, spark)], axis=0)
    assert np.abs(votes - scored["score"]).max() < 1e-12
    assert (scored["prediction"] == scored["label"]).mean() > 0.85
    assert again.getNumTrees == 4 and abs(sum(again.featureImportances.toArray()) - 1) < 1e-9


def test_class_weights_are_those_of_each_sample(vectors):
    labels = {r.k: r.label for r in vectors.collect()}
    got = bootstrap.class_weights(vectors, "k", "label", 3, seed=7)
    for t, weights in enumerate(got):
        n = {c: sum(drawn_copies(k, 7, t) for k, y in labels.items() if y == c) for c in (0, 1)}
        assert 700 < sum(n.values()) < 900
        for c in (0, 1):
            assert abs(weights[c] - sum(n.values()) / (2 * n[c])) <= 1 / bootstrap.GRAIN
    assert got[0] != got[1]


def test_trees_read_their_samples_without_drawing_again(vectors, monkeypatch):
    plans = []
    fit = bootstrap.RandomForestClassifier.fit

    def seen(self, rows, *args):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return fit(self, rows, *args)

    monkeypatch.setattr(bootstrap.RandomForestClassifier, "fit", seen)
    bootstrap.fit_bootstrap_forest(vectors, "k", trees=3, depth=2)
    # What stands above the persisted rows is done in each of a tree's passes.
    assert len(plans) == 3 and all("md5" not in p.split("InMemoryRelation")[0] for p in plans)
    assert all("InMemoryRelation" in p for p in plans)


def test_copies_follow_the_draw(spark):
    draws = [0, CUTS[0] - 1, CUTS[0], CUTS[1], CUTS[5], 2**32 - 1]
    df = spark.createDataFrame([(d,) for d in draws], "d long").select(bootstrap.copies("d").alias("n"))
    assert [r.n for r in df.collect()] == [sum(d >= c for c in CUTS) for d in draws]


def test_rare_class_missing_from_samples(spark):
    # One row of class 1: samples without it still know two classes.
    df = spark.createDataFrame([(i, int(i == 5), float(i)) for i in range(30)], "k int, label int, x double")
    v = features.assemble(df, ["x"], keep=["k", "label"])
    model = bootstrap.fit_bootstrap_forest(v, "k", trees=6, depth=2)
    assert model.numClasses == 2 and models.score(model, v).count() == 30
    assert any(drawn_copies(5, 42, t) == 0 for t in range(6)) and any(drawn_copies(5, 42, t) for t in range(6))


def test_odd_tables_are_refused(spark, vectors):
    with pytest.raises(ValueError, match="no labelled rows"):
        bootstrap.fit_bootstrap_forest(vectors.limit(0), "k", trees=2)
    with pytest.raises(ValueError, match="no labelled rows"):
        bootstrap.fit_bootstrap_forest(vectors.withColumn("label", F.lit(None).cast("int")), "k", trees=2)
