from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from outcomekit.plans import recipes
from outcomekit.plans.recipes import RECIPES, ModelSpec, prepare
from registry.core import customers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    df = customers(spark, SF)
    # A blank charge, which the smallest tables lack.
    blank = F.when(F.col("customer_id") % 29 == 0, F.lit(" ")).otherwise(F.col("total_charges_raw"))
    return df.withColumn("total_charges_raw", blank).cache()


@pytest.mark.parametrize("name", list(RECIPES))
def test_prepared_tables(rows, name):
    recipe = RECIPES[name]
    got = prepare(rows, recipe)
    dropped = rows.where("total_charges_raw = ' '").count() if recipe.null_policy == "drop" else 0
    assert got.table.count() == rows.count() - dropped
    assert got.table.select(*[F.col(f"`{c}`") for c in got.names]).na.drop("any").count() == got.table.count()
    assert {r.split for r in got.table.select("split").distinct().collect()} == {"train", *recipe.parts}
    if recipe.balance in ("smote", "both"):
        counts = [r["count"] for r in got.resampled.groupBy("label").count().collect()]
        assert len(set(counts)) == 1
    else:
        assert got.resampled.count() == got.train.count()
    fitted_on = {"train": got.train, "all": got.table, "resampled": got.resampled}[recipe.scale_scope]
    for c in ("tenure", "monthly_charges", "total_charges"):
        row = fitted_on.agg(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).first()
        assert row.m == pytest.approx(0, abs=1e-9) and row.s == pytest.approx(1)


def test_held_out_rows_do_not_reach_the_fit(rows):
    recipe = replace(RECIPES["logistic_vs_net_three_way"])
    first = prepare(rows, recipe)
    held = [r.customer_id for r in first.part("test").select("customer_id").collect()]
    spoiled = rows.withColumn(
        "total_charges_raw", F.when(F.col("customer_id").isin(held), F.lit("1e12")).otherwise(F.col("total_charges_raw"))
    )
    again = prepare(spoiled, recipe)
    assert first.train.select("customer_id", "total_charges").exceptAll(
        again.train.select("customer_id", "total_charges")
    ).count() == 0


def test_run_gives_a_record_per_model(rows):
    recipe = replace(
        RECIPES["three_models"],
        models=(
            ModelSpec("perceptron", "perceptron", (4,), 10, early_stop=True),
            ModelSpec("logistic", "logistic", iterations=50, weighted=True),
            ModelSpec("weighted net", "perceptron", (4,), 10, weighted=True, resampled=False),
        ),
    )
    out = {r.model: r for r in recipes.run(rows, recipe).collect()}
    assert set(out) == {"perceptron", "logistic", "weighted net"}
    sizes = {r.tn + r.fp + r.fn + r.tp for r in out.values()}
    assert len(sizes) == 1


#: What each recipe's early stopping watches, waits for and holds out, and its class balance.
EARLY = {
    "three_models": [(20, "val_loss", 15, True)],
    "net_on_all_scaled": [(100, "val_loss", 15, True)],
    "auto_encoded_net_and_logistic": [(100, "val_loss", 10, True)],
    "auto_encoded_net_vs_logistic": [(100, "val_loss", 10, True)],
    "resample_then_scale": [(100, "val_loss", 10, True)],
    "resample_then_scale_unstratified": [(50, "val_loss", 10, False)],
}
HELD_OUT = {
    "net_on_all_scaled": 0.16,
    "weighted_small_net": 0.16,
    "auto_encoded_net_vs_logistic": 0.16,
    "resample_then_scale": 0.16,
    "resample_then_scale_unstratified": 0.16,
}
HIDDEN = {"net_on_all_scaled": (64, 32), "weighted_small_net": (16, 8), "auto_encoded_net_vs_logistic": (128, 64)}


@pytest.mark.parametrize("name", list(RECIPES))
def test_settings(name):
    recipe = RECIPES[name]
    early = [(m.iterations, m.monitor, m.patience, m.restore_best) for m in recipe.models if m.early_stop]
    assert early == EARLY.get(name, [])
    if name in HELD_OUT:
        assert recipe.parts["validation"] == HELD_OUT[name]
    if name in HIDDEN:
        assert [m.hidden for m in recipe.models if m.kind == "perceptron"] == [HIDDEN[name]]


def test_early_stopping_fires_and_saves_the_best(rows, tmp_path, monkeypatch):
    recipe = replace(
        RECIPES["net_on_all_scaled"], models=(ModelSpec("net", "perceptron", (3,), 400, early_stop=True, patience=10),)
    )
    seen = []
    fit = recipes.models.fit_early_stopping

    def watched(*args, **options):
        seen.append(fit(*args, **options))
        return seen[-1]

    monkeypatch.setattr(recipes.models, "fit_early_stopping", watched)
    assert recipes.run(rows, recipe, save_best_to=str(tmp_path)).count() == 1
    assert seen[0].steps_run < 400 // recipes.STEP and (tmp_path / "net" / "metadata").exists()


def test_balance_by_weights_is_effective(rows, monkeypatch):
    plain = replace(RECIPES["weighted_small_net"], balance="none", models=(ModelSpec("l", "logistic", iterations=50),))
    prepared = prepare(rows, plain)
    weights = []
    fit = recipes.models.fit_logistic

    def watched(train, weight=None, **options):
        weights.append(weight)
        return fit(train, weight=weight, **options)

    monkeypatch.setattr(recipes.models, "fit_logistic", watched)
    for balance in ("none", "weights", "both"):
        recipes.train(prepared, plain.models[0], replace(plain, balance=balance))
    assert weights == [None, "weight", "weight"]
