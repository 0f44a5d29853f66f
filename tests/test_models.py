import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from outcomekit.functions import draw
from outcomekit.operators import evaluate as ev, explain, features, models, topk


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(21)
    x = rng.normal(size=(600, 3))
    y = (x[:, 0] * 2 - x[:, 1] + rng.logistic(size=600) > 0.8).astype(int)
    rows = [(i, int(y[i]), *map(float, x[i])) for i in range(600)]
    return spark.createDataFrame(rows, "k int, label int, a double, b double, c double").cache(), x, y


@pytest.fixture(scope="module")
def vectors(table):
    return features.assemble(table[0], ["a", "b", "c"], keep=["k", "label"]).cache()


def newton(x, y, w, c=1.0):
    """Optimum of sum of weighted losses + |beta|^2 / (2c), intercept free."""
    design = np.column_stack([np.ones(len(x)), x])
    penalty = np.diag([0.0] + [1.0 / c] * x.shape[1])
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        grad = design.T @ (w * (p - y)) + penalty @ beta
        beta -= np.linalg.solve(design.T @ (design * (w * p * (1 - p))[:, None]) + penalty, grad)
    return beta


def test_logistic_reaches_the_penalized_optimum(vectors, table):
    _, x, y = table
    model = models.fit_logistic(vectors)
    want = newton(x, y, np.ones(len(y)))
    assert [model.intercept, *model.coefficients.toArray()] == pytest.approx(want.tolist(), abs=1e-3)


def test_weighted_logistic_reaches_the_weighted_optimum(vectors, table):
    _, x, y = table
    weights = features.ClassWeights.fit(vectors, "label")
    model = models.fit_logistic(weights.transform(vectors, "label"), weight="weight")
    want = newton(x, y, np.array([weights.weights[v] for v in y]))
    assert [model.intercept, *model.coefficients.toArray()] == pytest.approx(want.tolist(), abs=1e-3)


def test_scores_are_probabilities_and_separate(vectors, spark):
    fitted = {
        "logistic": models.fit_logistic(vectors),
        "forest": models.fit_forest(vectors, trees=20, depth=5),
        "net": models.fit_perceptron(vectors, 3, (8, 4), max_iter=60),
    }
    for name, model in fitted.items():
        scored = models.score(model, vectors, name).cache()
        assert scored.where("score < 0 or score > 1 or score is null").count() == 0
        record = ev.evaluate(scored).first()
        assert record.model == name and record.roc_auc > 0.75
        assert scored.where((F.col("score") > 0.5).cast("int") != F.col("prediction")).count() == 0


def test_forest_importances_sum_to_one(vectors, spark):
    model = models.fit_forest(vectors, trees=10, depth=4)
    table = models.importance_table(model, ["a", "b", "c"], spark)
    assert table.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert topk.top_k(table, "feature", "importance", 1).first().feature == "a"


def test_coefficient_table_is_signed(vectors, spark):
    got = {r.feature: r.coefficient for r in models.coefficient_table(models.fit_logistic(vectors), ["a", "b", "c"], spark).collect()}
    assert got["a"] > 0 > got["b"]


def test_saved_model_scores_the_same(vectors, spark, tmp_path):
    for name, model in (
        ("logistic", models.fit_logistic(vectors)),
        ("net", models.fit_perceptron(vectors, 3, (4,), max_iter=10)),
    ):
        path = str(tmp_path / name)
        models.save_model(model, path)
        again = models.score(models.load_model(path, spark), vectors, keep=["k", "label"])
        assert again.exceptAll(models.score(model, vectors, keep=["k", "label"])).count() == 0


def test_loss_history_falls(vectors, spark):
    model = models.fit_perceptron(vectors, 3, (8, 4), max_iter=30)
    losses = [r.loss for r in models.loss_history(model, "net", spark).orderBy("step").collect()]
    assert np.isfinite(losses).all() and losses[-1] < losses[0]


def test_early_stopping_stops_and_keeps_the_best(vectors, spark):
    train, held = vectors.where("k % 3 <> 0"), vectors.where("k % 3 = 0")
    stop = models.fit_early_stopping(train, held, 3, (8, 4), step_iter=20, max_steps=12, patience=2)
    losses = [h[3] for h in stop.history]
    assert stop.best_step == int(np.argmin(losses)) + 1
    assert stop.steps_run == 12 or stop.steps_run == stop.best_step + 2
    kept = ev.log_loss(models.score(stop.model, held)).first().log_loss
    assert kept == pytest.approx(min(losses))
    table = stop.history_table(spark)
    assert table.count() == stop.steps_run and table.where("loss is null or val_accuracy is null").count() == 0


def test_early_stopping_on_area_without_restoring(vectors, spark, tmp_path):
    train, held = vectors.where("k % 3 <> 0"), vectors.where("k % 3 = 0")
    path = str(tmp_path / "best")
    stop = models.fit_early_stopping(
        train, held, 3, (4,), step_iter=5, max_steps=3, patience=3, monitor="val_auc", restore_best=False,
        save_best_to=path,
    )
    saved = models.load_model(path, spark)
    assert saved.weights.toArray().tolist() == stop.best.weights.toArray().tolist()
    assert all(0.5 < h[6] <= 1 for h in stop.history)
    assert models.score(stop.model, held).count() == held.count()


def test_stopped_fit_goes_on_where_it_was(vectors, spark, tmp_path):
    train, held = vectors.where("k % 3 <> 0"), vectors.where("k % 3 = 0")
    options = {"step_iter": 4, "patience": 2, "resume_in": str(tmp_path / "fit")}
    part = models.fit_early_stopping(train, held, 3, (4,), max_steps=3, **options)
    rest = models.fit_early_stopping(train, held, 3, (4,), max_steps=7, **options)
    whole = models.fit_early_stopping(train, held, 3, (4,), step_iter=4, patience=2, max_steps=7)
    assert rest.history[: part.steps_run] == part.history and rest.steps_run == whole.steps_run
    assert np.allclose([h[2:6] for h in rest.history], [h[2:6] for h in whole.history], atol=1e-9)
    assert rest.best_step == whole.best_step
    assert np.allclose(rest.best.weights.toArray(), whole.best.weights.toArray(), atol=1e-7)
    # A finished fit is read back without a step.
    again = models.fit_early_stopping(train, held, 3, (4,), max_steps=rest.steps_run, **options)
    assert again.history == rest.history and again.best_step == rest.best_step
    with pytest.raises(ValueError, match="other settings"):
        models.fit_early_stopping(train, held, 3, (5,), max_steps=3, **options)


def test_state_counts_only_once_it_is_whole(spark, tmp_path):
    folder = str(tmp_path / "states")
    assert models.load_state(spark, folder, "s") is None
    models.save_state(spark, folder, 1, {"settings": "s", "best_value": None, "history": [["m", 1, 0.5]]})
    models.save_state(spark, folder, 2, {"settings": "s", "best_value": -0.25, "history": [["m", 1, 0.5], ["m", 2, 0.25]]})
    assert models.load_state(spark, folder, "s")["best_value"] == -0.25


def test_replication_balances(spark):
    df = spark.createDataFrame([(0,)] * 30 + [(1,)] * 10, "label int")
    assert {r.label: r["count"] for r in models.replicate_by_class(df).groupBy("label").count().collect()} == {0: 30, 1: 30}


def brute_importance(x, y, weights, intercept, names, order, repeats, seed=42):
    """The same rotation over one block, row by row."""
    x, y = x[order], y[order]
    margin = intercept + x @ weights
    base = ((margin > 0) == (y == 1)).mean()
    out = {}
    for j, name in enumerate(names):
        drops = []
        for r in range(repeats):
            shift = explain.rotation(name, r, seed, len(x))
            moved = x.copy()
            moved[:, j] = [x[(i + shift) % len(x), j] for i in range(len(x))]
            drops.append(base - (((intercept + moved @ weights) > 0) == (y == 1)).mean())
        out[name] = (np.mean(drops), np.std(drops))
    return out


def test_linear_importance_equals_brute_force(table, spark):
    df, x, y = table
    weights = {"a": 2.0, "b": -1.0, "c": 0.0}
    order = [r.k for r in df.orderBy(draw("k", 42, "permute"), "k").collect()]
    want = brute_importance(x, y, np.array([2.0, -1.0, 0.0]), -0.8, list(weights), order, 10)
    got = explain.linear_permutation_importance(df.repartition(16), "k", "label", weights, -0.8).collect()
    for r in got:
        assert (r.importance, r.importance_std) == (pytest.approx(want[r.feature][0]), pytest.approx(want[r.feature][1]))
    assert {r.feature: r.importance for r in got}["c"] == 0.0


@pytest.mark.parametrize("block_rows", [50_000, 100])
def test_any_model_importance_equals_the_linear_one(table, vectors, block_rows):
    df, _, _ = table
    model = models.fit_logistic(vectors)
    weights = dict(zip(["a", "b", "c"], model.coefficients.toArray()))
    linear = explain.linear_permutation_importance(
        df, "k", "label", weights, model.intercept, repeats=3, block_rows=block_rows
    )
    general = explain.permutation_importance(
        model, df, "k", "label", ["a", "b", "c"], repeats=3, block_rows=block_rows
    )
    want = {r.feature: r.importance for r in linear.collect()}
    assert {r.feature: pytest.approx(r.importance) for r in general.collect()} == want
    assert want["a"] > want["c"]


def test_rotation_never_stays_in_place():
    assert all(1 <= explain.rotation("f", r, 42, 10) <= 9 for r in range(200))
    assert explain.rotation("f", 0, 42, 1) == 0
    assert Vectors.dense([1.0]).size == 1


@pytest.mark.parametrize("block_rows", [1, 7, 64, 300, 1000])
def test_permutation_does_not_depend_on_blocks(spark, block_rows):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(301, 2))
    y = (x[:, 0] + 0.2 * x[:, 1] > 0).astype(int)
    rows = [(i, int(c), float(a), float(b)) for i, (c, (a, b)) in enumerate(zip(y, x, strict=True))]
    df = spark.createDataFrame(rows, "k long, y int, a double, b double")
    weights = {"a": 1.0, "b": 0.2}
    order = [r.k for r in df.orderBy(draw("k", 42, "permute"), "k").select("k").collect()]
    x, y = x[order], y[order] == 1
    base = (x @ [1.0, 0.2] > 0) == y
    want = {}
    for j, name in enumerate(weights):
        drops = []
        for r in range(10):
            moved = x.copy()
            moved[:, j] = np.roll(x[:, j], -explain.rotation(name, r, 42, len(x)))
            drops.append(base.mean() - (((moved @ [1.0, 0.2]) > 0) == y).mean())
        want[name] = (np.mean(drops), np.std(drops))
    got = explain.linear_permutation_importance(df, "k", "y", weights, block_rows=block_rows).collect()
    for r in got:
        assert (r.importance, r.importance_std) == pytest.approx(want[r.feature])


def test_tasks_give_donors_not_whole_rows_for_any_model(spark, vectors, table, monkeypatch):
    df, x, _ = table
    made, give = [], explain._with_donors

    def counted(*args):
        out = give(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(explain, "_with_donors", counted)
    explain.permutation_importance(models.fit_logistic(vectors), df, "k", "label", ["a", "b", "c"], repeats=4).collect()
    assert made == [len(x)]
