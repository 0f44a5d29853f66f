"""Permutation importance by trees against scoring rows made anew."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from outcomekit.operators import explain, features, forests, models


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(1_500, 6)).round(2)
    y = ((x[:, 0] + x[:, 1] * x[:, 2] > 0.2) ^ (rng.random(1_500) < 0.05)).astype(int)
    names = [f"f{i}" for i in range(5)] + ["f.5"]
    rows = [(i, int(y[i]), *map(float, x[i])) for i in range(1_500)]
    return spark.createDataFrame(rows, ["k", "label", *names[:5], "last"]).withColumnRenamed("last", names[5]), names


@pytest.fixture(scope="module")
def forest(data):
    df, names = data
    return models.fit_forest(features.assemble(df, names, keep=["label"]), trees=12, depth=5)


def test_trees_vote_as_the_model(spark, data, forest):
    df, names = data
    trees = forests.read_trees(forest, spark)
    rows = df.orderBy("k").select(*[F.col(f"`{c}`") for c in names]).toPandas().to_numpy()
    share = np.mean([t.votes(list(rows.T)) for t in trees], axis=0)
    scored = models.score(forest, features.assemble(df, names, keep=["k"]), keep=["k"]).orderBy("k").toPandas()
    assert np.abs(share - scored["score"].to_numpy()).max() < 1e-12


def test_nodes_of_rows_are_kept_and_trees_stay_the_same(spark, data, forest):
    df, names = data
    walked = RandomForestClassifier(numTrees=12, maxDepth=5, seed=42, cacheNodeIds=False)
    plain = walked.fit(features.assemble(df, names, keep=["label"]))
    assert forest.getCacheNodeIds() and not plain.getCacheNodeIds()
    found = [[(t.feature.tolist(), t.threshold.tolist(), t.shares.tolist()) for t in forests.read_trees(m, spark)] for m in (forest, plain)]
    assert len(found[0]) == 12 and found[0] == found[1]


@pytest.mark.parametrize("block_rows", [400, 20_000])
def test_importance_equals_that_of_rows_made_anew(data, forest, block_rows):
    df, names = data
    want = {
        r.feature: (r.importance, r.importance_std)
        for r in explain.permutation_importance(forest, df, "k", "label", names, repeats=3).collect()
    }
    got = forests.forest_permutation_importance(forest, df, "k", "label", names, repeats=3, block_rows=block_rows)
    found = {r.feature: (r.importance, r.importance_std) for r in got.collect()}
    assert found.keys() == want.keys()
    # Votes are added in another order, which may turn a tie.
    assert all(np.allclose(found[f], want[f], atol=2 / 1_500) for f in names)
    assert max(found, key=lambda f: found[f][0]) == "f0"


def test_unused_features_change_nothing(spark, data):
    df, names = data
    constant = df.withColumn("zero", F.lit(0.0))
    every = [*names, "zero"]
    model = models.fit_forest(features.assemble(constant, every, keep=["label"]), trees=5, depth=3)
    got = forests.forest_permutation_importance(model, constant, "k", "label", every, repeats=2)
    assert {r.feature: r.importance for r in got.collect()}["zero"] == 0.0
    assert forests.trees_by_feature(forests.read_trees(model, spark), 7)[6] == []


def test_only_walks_that_a_new_value_changes_are_repeated(spark, data, forest, monkeypatch):
    df, names = data
    trees = forests.read_trees(forest, spark)
    x = df.orderBy("k").select(*[F.col(f"`{c}`") for c in names]).toPandas().to_numpy().T
    given = np.stack([[np.roll(x[f], s) for s in (1, 5)] for f in range(len(names))])
    walks, walk = [], forests.Tree.walk
    monkeypatch.setattr(forests.Tree, "walk", lambda tree, node, *rest, **named: walks.append(len(node)) or walk(tree, node, *rest, **named))
    for t in trees:
        change = np.zeros(given.shape)
        used = sorted(set(t.feature[t.feature >= 0].tolist()))
        votes = forests._changed_votes(t, used, x, given, change)
        assert votes.tolist() == t.votes(x).tolist()
        for f in range(len(names)):
            for r in range(2):
                moved = [*x[:f], given[f, r], *x[f + 1 :]]
                assert np.allclose(votes + change[f, r], t.votes(moved), atol=1e-12)
    walks.clear()
    forests._changed_votes(t, used, x, given, np.zeros(given.shape))
    # Whole walks would be one of all rows for each feature in use and repeat.
    assert sum(walks[1:]) < 0.6 * len(used) * 2 * x.shape[1]
    # A row given its own values is not walked again.
    walks.clear()
    forests._changed_votes(t, used, x, np.repeat(x[:, None], 2, axis=1), np.zeros(given.shape))
    assert len(walks) == 1
