"""Training, scoring, inspection and whole recipes."""

from __future__ import annotations

import os
import uuid
from dataclasses import replace as changed
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomekit.functions import linear_margin, sigmoid, threshold_label
from outcomekit.operators import bootstrap, evaluate as ev, explain, features, forests, models, topk
from outcomekit.plans import recipes
from outcomekit.plans.whole import whole_pipeline
from outcomekit.session import scratch_dir, stage
from registry.core import customers, draw_sql, query
from registry.preparing import FIGURES_SQL, FILLED_SQL, FLAGS_SQL, LEVELS_SQL, NUMBERS, filled, split_sql
from registry.profiling import LABELED_SQL, rounded

# A scorecard over the customer columns.
WEIGHTS = {
    "senior": 0.25,
    "tenure": -0.03125,
    "monthly_charges": 0.0000152587890625,
    "total_charges": -0.0000002384185791015625,
    "paperless_Yes": -0.375,
}
INTERCEPT = 0.5

MARGIN = f"{INTERCEPT}::DOUBLE" + "".join(f" + ({w:.25f}::DOUBLE) * {c}" for c, w in WEIGHTS.items())
TEST_SQL = (
    FILLED_SQL
    + f""", held AS (SELECT customer_id, label, split, senior::DOUBLE AS senior, tenure::DOUBLE AS tenure, monthly_charges,
        total_charges, CASE WHEN paperless = 'Yes' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS paperless_Yes FROM filled),
      scored AS (SELECT *, {MARGIN} AS margin FROM held)
"""
)


def scorecard_rows(spark, sf) -> DataFrame:
    df = filled(spark, sf)
    df = df.withColumn("paperless_Yes", F.when(F.col("paperless") == "Yes", 1.0).otherwise(0.0))
    return df.select("customer_id", "label", "split", *[F.col(c).cast("double").alias(c) for c in WEIGHTS])


@query(
    "m08_probability",
    f"""WITH {TEST_SQL} SELECT customer_id, label, round(1.0 / (1.0 + exp(-margin)), 6) AS score FROM scored""",
)
def probability(spark, sf):
    rows = scorecard_rows(spark, sf).withColumn("score", sigmoid(linear_margin(WEIGHTS, INTERCEPT)))
    return rounded(rows.select("customer_id", "label", "score"), "score")


@query(
    "m09_predict_label",
    f"""WITH {TEST_SQL} SELECT customer_id, label, CASE WHEN margin > 0 THEN 1 ELSE 0 END AS prediction FROM scored""",
)
def predict_label(spark, sf):
    rows = scorecard_rows(spark, sf).withColumn("score", sigmoid(linear_margin(WEIGHTS, INTERCEPT)))
    return rows.select("customer_id", "label", threshold_label("score").alias("prediction"))


_PAIRS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, ({w:.25f}::DOUBLE) AS w, r FROM (SELECT unnest(range(0, 10)) AS r) t" for c, w in WEIGHTS.items()
)
_PICK = "CASE feature " + " ".join(f"WHEN '{c}' THEN {{t}}.{c}" for c in WEIGHTS) + " END"
PERMUTED_SQL = (
    TEST_SQL
    + f""", test AS (SELECT *, row_number() OVER (ORDER BY {draw_sql('customer_id', "'permute'")}, customer_id) - 1 AS pos,
        count(*) OVER () AS n FROM scored WHERE split = 'test'),
      pairs AS ({_PAIRS}),
      shifts AS (SELECT feature, w, r,
          (1 + CAST(floor({draw_sql("feature || ':' || r", "'shift'")} / 4294967296.0::DOUBLE * ((SELECT any_value(n) FROM test) - 1)) AS BIGINT)) AS shift
        FROM pairs),
      moved AS (SELECT feature, r, a.label, a.margin - w * {_PICK.format(t='a')} + w * {_PICK.format(t='b')} AS margin
        FROM shifts, test a, test b WHERE b.pos = (a.pos + shift) % a.n),
      drops AS (SELECT feature, r, (SELECT avg(CASE WHEN (margin > 0) = (label = 1) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) FROM test)
          - avg(CASE WHEN (margin > 0) = (label = 1) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS loss FROM moved GROUP BY feature, r),
      importance AS (SELECT feature, avg(loss) AS importance, stddev_pop(loss) AS importance_std FROM drops GROUP BY feature)
"""
)


def _linear_importance(spark, sf):
    test = scorecard_rows(spark, sf).where(F.col("split") == "test")
    return explain.linear_permutation_importance(test, "customer_id", "label", WEIGHTS, INTERCEPT)


@query(
    "m12_permutation",
    f"""WITH {PERMUTED_SQL} SELECT feature, round(importance, 6) AS importance, round(importance_std, 6) AS importance_std
        FROM importance""",
)
def permutation(spark, sf):
    return rounded(_linear_importance(spark, sf), "importance", "importance_std")


def model_data(spark, sf, balance="none"):
    recipe = changed(recipes.RECIPES["three_models"], balance=balance)
    return recipes.prepare(customers(spark, sf), recipe), recipe


def _test_record(spark, data, fitted):
    held = stage(data.vectors(data.part("test")))
    parts = [models.score(m, held, name) for name, m in fitted.items()]
    return ev.evaluate(reduce(DataFrame.unionByName, parts), ["model"])


def _fit(data, recipe, name, kind, **options):
    return recipes.train(data, recipes.ModelSpec(name, kind, **options), recipe)


# The optimum of the penalized loss is unique, so a fit can be checked against Newton steps in SQL.
LINEAR = ["senior", "months"]


def newton_sql(
    weight: str, where: str = "split = 'train'", steps: int = 25, flag: str = "senior::DOUBLE", number: str = "tenure"
) -> str:
    """CTEs that end in ``fit(b0, b1, b2)``: intercept, senior and scaled months, inverse penalty 1."""
    return f""", ranged AS (SELECT avg({number}::DOUBLE) AS mu, stddev_pop({number}::DOUBLE) AS sd FROM filled WHERE split = 'train'),
      class_n AS (SELECT label AS cl, count(*) AS n_c, sum(count(*)) OVER () AS n_all FROM filled WHERE {where} GROUP BY label),
      x AS (SELECT customer_id, split, label, {flag} AS x1, ({number} - mu) / sd AS x2, {weight} AS w
            FROM filled, ranged, class_n WHERE cl = label),
      step AS (
        SELECT 0 AS i, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2
        UNION ALL
        SELECT i + 1,
          b0 - (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / det,
          b1 - (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / det,
          b2 - (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / det
        FROM (SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS det
          FROM (SELECT i, b0, b1, b2, sum(w * (p - label)) AS g0, sum(w * (p - label) * x1) + b1 AS g1,
              sum(w * (p - label) * x2) + b2 AS g2, sum(w * p * (1 - p)) AS h00, sum(w * p * (1 - p) * x1) AS h01,
              sum(w * p * (1 - p) * x2) AS h02, sum(w * p * (1 - p) * x1 * x1) + 1 AS h11,
              sum(w * p * (1 - p) * x1 * x2) AS h12, sum(w * p * (1 - p) * x2 * x2) + 1 AS h22
            FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM step, x WHERE {where} AND i < {steps}) r
            GROUP BY i, b0, b1, b2) s) t),
      fit AS (SELECT b0, b1, b2 FROM step WHERE i = {steps})"""


BALANCED_SQL = "n_all::DOUBLE / (2 * n_c)"


def linear_data(spark, sf):
    """Customers with a split and two features, one of them scaled on the training rows."""
    df = filled(spark, sf).select("customer_id", "label", "split", "senior", F.col("tenure").alias("months"))
    return features.Standardize.fit(df, ["months"], F.col("split") == "train").transform(df)


def linear_fit(df, balanced=False):
    rows = df.where(F.col("split") == "train")
    if balanced:
        rows = features.ClassWeights.fit(rows, "label").transform(rows, "label")
    keep = ["label", "weight"] if balanced else ["label"]
    vectors = models.spread(features.assemble(rows, LINEAR, keep=keep))
    return models.fit_logistic(vectors, weight="weight" if balanced else None, tol=1e-10)


def _all_coefficients(spark, model):
    named = models.coefficient_table(model, LINEAR, spark)
    return named.unionByName(models.named_values(["intercept"], [model.intercept], spark, "coefficient"))


_FIT_ROWS = """SELECT 'intercept' AS feature, round(b0, 3) AS coefficient FROM fit
        UNION ALL SELECT 'senior', round(b1, 3) FROM fit UNION ALL SELECT 'months', round(b2, 3) FROM fit"""


@query("m01_logistic_optimum", f"WITH RECURSIVE {FILLED_SQL} {newton_sql('1.0::DOUBLE')} {_FIT_ROWS}")
def logistic_optimum(spark, sf):
    return rounded(_all_coefficients(spark, linear_fit(linear_data(spark, sf))), "coefficient", digits=3)


@query("m02_logistic_balanced_optimum", f"WITH RECURSIVE {FILLED_SQL} {newton_sql(BALANCED_SQL)} {_FIT_ROWS}")
def logistic_balanced_optimum(spark, sf):
    return rounded(_all_coefficients(spark, linear_fit(linear_data(spark, sf), True)), "coefficient", digits=3)


@query(
    "m10_top_coefficients",
    f"""WITH RECURSIVE {FILLED_SQL} {newton_sql('1.0::DOUBLE')}, named AS (
          SELECT 'senior' AS feature, b1 AS coefficient FROM fit UNION ALL SELECT 'months', b2 FROM fit)
        SELECT feature, round(coefficient, 3) AS coefficient FROM named ORDER BY coefficient DESC, feature LIMIT 10""",
)
def top_coefficients(spark, sf):
    named = models.coefficient_table(linear_fit(linear_data(spark, sf)), LINEAR, spark)
    return rounded(topk.top_k(named, "feature", "coefficient", 10), "coefficient", digits=3)


@query(
    "m07_final_loss",
    f"""WITH RECURSIVE {FILLED_SQL} {newton_sql('1.0::DOUBLE')}
        SELECT round(avg(-(label * ln(p) + (1 - label) * ln(1 - p))) + any_value(b1 * b1 + b2 * b2) / (2 * count(*)), 5) AS loss
        FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM x, fit WHERE split = 'train') r""",
)
def final_loss(spark, sf):
    history = models.loss_history(linear_fit(linear_data(spark, sf)), "logistic", spark)
    return rounded(topk.top_k(history.withColumn("name", F.lit("")), "name", "step", 1).select("loss"), "loss", digits=5)


@query(
    "m07_accuracy_gap",
    f"""WITH RECURSIVE {FILLED_SQL} {newton_sql(BALANCED_SQL)}, right_or_not AS (
          SELECT split, CASE WHEN (b0 + b1 * x1 + b2 * x2 > 0) = (label = 1) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS hit
          FROM x, fit)
        SELECT round(avg(hit) FILTER (WHERE split = 'train'), 6) AS accuracy,
               round(avg(hit) FILTER (WHERE split = 'validation'), 6) AS val_accuracy,
               round(avg(hit) FILTER (WHERE split = 'train') - avg(hit) FILTER (WHERE split = 'validation'), 6) AS accuracy_gap
        FROM right_or_not""",
)
def accuracy_gap(spark, sf):
    df = linear_data(spark, sf)
    rows = features.assemble(df, LINEAR, keep=["label", "split"])
    scored = models.score(linear_fit(df, True), rows, keep=["label", "split"])
    return rounded(ev.accuracy_gap(scored), "accuracy", "val_accuracy", "accuracy_gap")


_ANY_PAIRS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, r FROM (SELECT unnest(range(0, 10)) AS r) t" for c in LINEAR
)


@query(
    "m12_permutation_fitted",
    f"""WITH RECURSIVE {FILLED_SQL} {newton_sql(BALANCED_SQL)},
      test AS (SELECT *, row_number() OVER (ORDER BY {draw_sql('customer_id', "'permute'")}, customer_id) - 1 AS pos,
        count(*) OVER () AS n FROM x, fit WHERE split = 'test'),
      pairs AS ({_ANY_PAIRS}),
      shifts AS (SELECT feature, r,
          (1 + CAST(floor({draw_sql("feature || ':' || r", "'shift'")} / 4294967296.0::DOUBLE * ((SELECT any_value(n) FROM test) - 1)) AS BIGINT)) AS shift
        FROM pairs),
      moved AS (SELECT feature, r, a.label, a.b0 + a.b1 * (CASE feature WHEN 'senior' THEN b.x1 ELSE a.x1 END)
          + a.b2 * (CASE feature WHEN 'months' THEN b.x2 ELSE a.x2 END) AS margin
        FROM shifts, test a, test b WHERE b.pos = (a.pos + shift) % a.n),
      drops AS (SELECT feature, r, (SELECT avg(CASE WHEN (b0 + b1 * x1 + b2 * x2 > 0) = (label = 1) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) FROM test)
          - avg(CASE WHEN (margin > 0) = (label = 1) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS loss FROM moved GROUP BY feature, r)
      SELECT feature, round(avg(loss), 6) AS importance, round(stddev_pop(loss), 6) AS importance_std FROM drops GROUP BY feature""",
)
def permutation_fitted(spark, sf):
    df = linear_data(spark, sf)
    held = df.where(F.col("split") == "test")
    out = explain.permutation_importance(linear_fit(df, True), held, "customer_id", "label", LINEAR)
    return rounded(out, "importance", "importance_std")


def sound_scores(model, data: recipes.Prepared) -> DataFrame:
    """Rows and positives of each part, and how many scores or labels break the rules."""
    scored = models.score(model, data.vectors(data.table, ["label", "split"]), keep=["label", "split"])
    s = F.col("score")
    return scored.groupBy("split").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("label") == 1).alias("positives"),
        F.count_if(s.isNull() | (s < 0) | (s > 1)).alias("outside"),
        F.count_if((s > 0.5).cast("int") != F.col("prediction")).alias("disagreeing"),
    )


SOUND_SQL = f"""WITH {FILLED_SQL} SELECT split, count(*) AS n_rows, count(*) FILTER (WHERE label = 1) AS positives,
        0::BIGINT AS outside, 0::BIGINT AS disagreeing FROM filled GROUP BY split"""


@query("m03_forest_scores", SOUND_SQL)
def forest_scores(spark, sf):
    data, recipe = model_data(spark, sf)
    return sound_scores(_fit(data, recipe, "forest", "forest", weighted=True), data)


@query("m04_network_scores", SOUND_SQL)
def network_scores(spark, sf):
    data, recipe = model_data(spark, sf)
    net = _fit(data, recipe, "network", "perceptron", hidden=(64, 32), iterations=100, weighted=True)
    return sound_scores(net, data)


@query("m05_perceptron_scores", SOUND_SQL)
def perceptron_scores(spark, sf):
    data, recipe = model_data(spark, sf)
    return sound_scores(_fit(data, recipe, "perceptron", "perceptron", hidden=(64, 32), iterations=200), data)


def _stopped(data, recipe):
    return _fit(data, recipe, "stopped", "perceptron", hidden=(64, 32), iterations=100, early_stop=True, patience=15)


@query("m06_stopped_scores", SOUND_SQL)
def stopped_scores(spark, sf):
    data, recipe = model_data(spark, sf)
    return sound_scores(_stopped(data, recipe), data)


@query(
    "m11_importance_total",
    f"""WITH {FILLED_SQL}, {LEVELS_SQL}
        SELECT count(*) + {1 + len(NUMBERS)} AS n_features, 1.0::DOUBLE AS total, 0::BIGINT AS negative FROM levels""",
)
def importance_total(spark, sf):
    data, recipe = model_data(spark, sf)
    table = models.importance_table(_fit(data, recipe, "forest", "forest", weighted=True), data.names, spark)
    return rounded(
        table.agg(
            F.count("*").alias("n_features"),
            F.sum("importance").alias("total"),
            F.count_if(F.col("importance") < 0).alias("negative"),
        ),
        "total",
    )


# A rule on two of all encoded features that no single one of them tells; a model that learns nothing fails.
PAIRED_RULE = "has_returns = 'Yes' AND paperless = 'Yes'"
PAIRED_SQL = f"WITH {FILLED_SQL} SELECT customer_id, CAST({PAIRED_RULE} AS INT) AS prediction FROM filled"


def paired_rows(spark, sf, rule=PAIRED_RULE) -> DataFrame:
    return stage(customers(spark, sf).withColumn("churn", F.when(F.expr(rule), "Yes").otherwise("No")))


def paired_data(spark, sf, rule=PAIRED_RULE):
    """The rule as outcome, with all features of the recipes."""
    recipe = changed(recipes.RECIPES["three_models"], balance="none", scale="all")
    return recipes.prepare(paired_rows(spark, sf, rule), recipe), recipe


def predictions(model, data: recipes.Prepared) -> DataFrame:
    scored = models.score(model, data.vectors(data.table, ["customer_id"]), keep=["customer_id"])
    return scored.select("customer_id", "prediction")


@query("m03_forest_rule", PAIRED_SQL)
def forest_rule(spark, sf):
    data, recipe = paired_data(spark, sf)
    return predictions(_fit(data, recipe, "forest", "forest", weighted=True), data)


@query("m03_forest_bootstrap_rule", PAIRED_SQL)
def forest_bootstrap_rule(spark, sf):
    data, recipe = paired_data(spark, sf)
    return predictions(_fit(data, recipe, "forest", "forest", per_bootstrap=True), data)


@query("m04_network_rule", PAIRED_SQL)
def network_rule(spark, sf):
    data, recipe = paired_data(spark, sf)
    net = _fit(data, recipe, "network", "perceptron", hidden=(64, 32), iterations=100, weighted=True)
    return predictions(net, data)


@query("m05_perceptron_rule", PAIRED_SQL)
def perceptron_rule(spark, sf):
    data, recipe = paired_data(spark, sf)
    return predictions(_fit(data, recipe, "perceptron", "perceptron", hidden=(64, 32), iterations=200), data)


@query("m06_stopped_rule", PAIRED_SQL)
def stopped_rule(spark, sf):
    data, recipe = paired_data(spark, sf)
    return predictions(_stopped(data, recipe), data)


@query("m06_resumed_rule", PAIRED_SQL)
def resumed_rule(spark, sf):
    """Stopped after three steps and gone on with by a second call."""
    data, recipe = paired_data(spark, sf)
    folder = os.path.join(scratch_dir(spark), f"fit-{uuid.uuid4().hex}")
    spec = recipes.ModelSpec("resumed", "perceptron", (64, 32), 3 * recipes.STEP, early_stop=True)
    recipes.train(data, spec, recipe, resume_in=folder)
    return predictions(recipes.train(data, changed(spec, iterations=100), recipe, resume_in=folder), data)


# Segment and region go with no other column, so none stands in for them.
PLACE_RULE = "segment = 'BUILDING' OR region = 'ASIA'"


@query(
    "m11_importance_rule",
    f"""WITH {FILLED_SQL}, {LEVELS_SQL}, {FLAGS_SQL}, {FIGURES_SQL}, strength AS (
          SELECT feature, abs(corr(value, CAST({PLACE_RULE} AS INT)::DOUBLE)) AS r
          FROM figures JOIN filled USING (customer_id) GROUP BY feature)
        SELECT feature FROM strength ORDER BY r DESC, feature LIMIT 2""",
)
def importance_rule(spark, sf):
    data, recipe = paired_data(spark, sf, PLACE_RULE)
    model = _fit(data, recipe, "forest", "forest", weighted=True)
    return topk.top_k(models.importance_table(model, data.names, spark), "feature", "importance", 2).select("feature")


# Trees of one split on 0/1 features, each on its own bootstrap sample with the class weights of that sample.
STUMP_FEATURES = ["senior", "paperless_Yes", "has_returns_Yes", "region_ASIA"]
STUMP_TREES = 5
STUMPS_SQL = f"""WITH {FILLED_SQL}, flagged AS (SELECT customer_id, split, label, senior::DOUBLE AS senior,
          CASE WHEN paperless = 'Yes' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS paperless_Yes,
          CASE WHEN has_returns = 'Yes' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS has_returns_Yes,
          CASE WHEN region = 'ASIA' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS region_ASIA FROM filled),
      tall AS (SELECT * FROM flagged UNPIVOT (value FOR feature IN ({", ".join(STUMP_FEATURES)}))),
      drawn AS (SELECT customer_id, label, t, {draw_sql("customer_id", "'tree ' || t")} AS d
        FROM filled, (SELECT unnest(range({STUMP_TREES})) AS t) n WHERE split = 'train'),
      samples AS (SELECT customer_id, label, t,
          {" + ".join(f"CAST(d >= {c} AS INT)" for c in bootstrap.poisson_cuts())} AS copies FROM drawn),
      weights AS (SELECT t, label, floor(sum(sum(copies)) OVER (PARTITION BY t) / (2.0::DOUBLE * sum(copies)) * 1048576.0::DOUBLE + 0.5)
          / 1048576.0::DOUBLE AS w FROM samples GROUP BY t, label),
      sides AS (SELECT t, feature, value, sum(copies * w * s.label) AS w1, sum(copies * w) AS w_all
        FROM samples s JOIN weights USING (t, label) JOIN tall USING (customer_id) GROUP BY t, feature, value),
      impure AS (SELECT t, feature, sum(w_all * 2 * (w1 / w_all) * (1 - w1 / w_all)) AS left_over FROM sides WHERE w_all > 0 GROUP BY t, feature),
      best AS (SELECT t, arg_min(feature, left_over) AS feature FROM impure GROUP BY t)
      SELECT customer_id, round(avg(w1 / w_all), 6) AS score
      FROM best JOIN tall USING (feature) JOIN sides USING (t, feature, value) GROUP BY customer_id"""


@query("m03_forest_bootstrap_stumps", STUMPS_SQL)
def forest_bootstrap_stumps(spark, sf):
    df = features.OneHot.fit(filled(spark, sf), ["paperless", "has_returns", "region"]).transform(filled(spark, sf))
    train = features.assemble(df.where(F.col("split") == "train"), STUMP_FEATURES, keep=["customer_id", "label"])
    model = bootstrap.fit_bootstrap_forest(train, "customer_id", trees=STUMP_TREES, depth=1, subset="all")
    scored = models.score(model, features.assemble(df, STUMP_FEATURES, keep=["customer_id"]), keep=["customer_id"])
    return rounded(scored.drop("prediction"), "score")


@query(
    "s06_reloaded_scores",
    f"""WITH RECURSIVE {FILLED_SQL} {newton_sql('1.0::DOUBLE')}
        SELECT customer_id, round(1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))), 3) AS score FROM x, fit WHERE split = 'test'""",
)
def reloaded_scores(spark, sf):
    df = linear_data(spark, sf)
    path = os.path.join(scratch_dir(spark), f"model-{uuid.uuid4().hex}")
    models.save_model(linear_fit(df), path)
    held = features.assemble(df.where(F.col("split") == "test"), LINEAR, keep=["customer_id"])
    scored = models.score(models.load_model(path, spark), held, keep=["customer_id"])
    return rounded(scored.select("customer_id", "score"), "score", digits=3)


def reloaded_pipeline(df, recipe: recipes.Recipe, spec: recipes.ModelSpec, layout: recipes.Layout | None = None):
    """A pipeline from raw rows to scores, fitted, saved, and loaded again."""
    spark = df.sparkSession
    path = os.path.join(scratch_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    models.save_model(whole_pipeline(recipe, spec, layout).fit(df), path)
    return models.load_model(path, spark)


@query(
    "s06_pipeline_reloaded",
    f"""WITH RECURSIVE {FILLED_SQL} {newton_sql(
        "1.0::DOUBLE", flag="CASE WHEN paperless = 'Yes' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END", number="total_charges")}
        SELECT customer_id, split, round(1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))), 3) AS score FROM x, fit""",
)
def pipeline_reloaded(spark, sf):
    df = stage(customers(spark, sf).select("customer_id", "total_charges_raw", "paperless", "churn"))
    recipe = recipes.Recipe("saved", (), encode="auto")
    fitted = reloaded_pipeline(
        df, recipe, recipes.ModelSpec("logistic", "logistic", iterations=1000), recipes.Layout(scaled=("total_charges",))
    )
    return rounded(models.score(fitted, df, keep=["customer_id", "split"]).drop("prediction"), "score", digits=3)


def paired_predictions(spark, sf, spec: recipes.ModelSpec) -> DataFrame:
    df = paired_rows(spark, sf)
    fitted = reloaded_pipeline(df, recipes.Recipe("saved", (), scale="all"), spec)
    # A new row has no target.
    return models.score(fitted, df.drop("churn"), keep=["customer_id"]).drop("score")


@query("s06_pipeline_reloaded_forest", PAIRED_SQL)
def pipeline_reloaded_forest(spark, sf):
    return paired_predictions(spark, sf, recipes.ModelSpec("forest", "forest", weighted=True))


@query("s06_pipeline_reloaded_network", PAIRED_SQL)
def pipeline_reloaded_network(spark, sf):
    return paired_predictions(spark, sf, recipes.ModelSpec("perceptron", "perceptron", (64, 32), iterations=200))


@query("m01_logistic")
def logistic(spark, sf):
    data, recipe = model_data(spark, sf)
    return _test_record(spark, data, {"logistic": _fit(data, recipe, "logistic", "logistic", iterations=1000)})


@query("m02_logistic_balanced")
def logistic_balanced(spark, sf):
    data, recipe = model_data(spark, sf, "smote")
    fitted = {
        "weighted": _fit(data, recipe, "weighted", "logistic", iterations=2000, weighted=True, resampled=False),
        "resampled": _fit(data, recipe, "resampled", "logistic", iterations=1000, weighted=True),
    }
    return _test_record(spark, data, fitted)


@query("m03_forest")
def forest(spark, sf):
    data, recipe = model_data(spark, sf)
    return _test_record(spark, data, {"forest": _fit(data, recipe, "forest", "forest", weighted=True)})


@query("m04_network")
def network(spark, sf):
    data, recipe = model_data(spark, sf, "smote")
    net = _fit(data, recipe, "network", "perceptron", hidden=(64, 32), iterations=100)
    return _test_record(spark, data, {"network": net})


@query("m05_perceptron")
def perceptron(spark, sf):
    data, recipe = model_data(spark, sf)
    net = _fit(data, recipe, "perceptron", "perceptron", hidden=(64, 32), iterations=200)
    return models.loss_history(net, "perceptron", spark)


def _early(spark, sf, **options):
    data, _ = model_data(spark, sf)
    train = models.spread(stage(data.vectors(models.replicate_by_class(data.train))))
    held = stage(data.vectors(data.part("validation")))
    return models.fit_early_stopping(train, held, len(data.names), **options)


@query("m06_early_stopping")
def early_stopping(spark, sf):
    stop = _early(spark, sf, max_steps=8, patience=3, monitor="val_auc")
    return spark.createDataFrame(
        [(stop.steps_run, stop.best_step, float(stop.accuracy_gap))], "steps_run int, best_step int, accuracy_gap double"
    )


@query("m07_history")
def history(spark, sf):
    return _early(spark, sf, max_steps=6, patience=3).history_table(spark)


@query("m10_coefficients")
def coefficients(spark, sf):
    data, recipe = model_data(spark, sf)
    model = _fit(data, recipe, "logistic", "logistic", iterations=1000)
    return topk.top_k(models.coefficient_table(model, data.names, spark), "feature", "coefficient", 10)


@query("m11_importances")
def importances(spark, sf):
    data, recipe = model_data(spark, sf)
    model = _fit(data, recipe, "forest", "forest", weighted=True)
    return topk.top_k(models.importance_table(model, data.names, spark), "feature", "importance", 15)


@query("m12_permutation_any_model")
def permutation_any_model(spark, sf):
    data, recipe = model_data(spark, sf)
    model = _fit(data, recipe, "logistic", "logistic", iterations=1000)
    out = explain.permutation_importance(model, data.part("test"), "customer_id", "label", data.names)
    return topk.top_k(out, "feature", "importance", 15)


@query("m12_permutation_forest")
def permutation_forest(spark, sf):
    data, recipe = model_data(spark, sf)
    model = _fit(data, recipe, "forest", "forest", weighted=True)
    out = forests.forest_permutation_importance(model, data.part("test"), "customer_id", "label", data.names)
    return topk.top_k(out, "feature", "importance", 15)


# A forest that has learned who is a senior is wrong where the permuted value differs, and only there.
@query(
    "m12_permutation_rule",
    f"""WITH {FILLED_SQL}, test AS (
          SELECT *, row_number() OVER (ORDER BY {draw_sql('customer_id', "'permute'")}, customer_id) - 1 AS pos, count(*) OVER () AS n
          FROM filled WHERE split = 'test'),
        pairs AS (SELECT unnest(['senior', 'months']) AS feature, r FROM (SELECT unnest(range(0, 10)) AS r) t),
        shifts AS (SELECT feature, r, (1 + CAST(floor({draw_sql("feature || ':' || r", "'shift'")} / 4294967296.0::DOUBLE
            * ((SELECT any_value(n) FROM test) - 1)) AS BIGINT)) AS shift FROM pairs),
        drops AS (SELECT feature, r, avg(CASE WHEN feature = 'senior' AND a.senior <> b.senior THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS loss
          FROM shifts, test a, test b WHERE b.pos = (a.pos + shift) % a.n GROUP BY feature, r)
        SELECT feature, round(avg(loss), 6) AS importance, round(stddev_pop(loss), 6) AS importance_std FROM drops GROUP BY feature""",
)
def permutation_rule(spark, sf):
    df = linear_data(spark, sf).withColumn("label", F.col("senior").cast("int"))
    ruled = features.assemble(df.where(F.col("split") == "train"), LINEAR, keep=["label"])
    model = models.fit_forest(models.spread(ruled))
    test = df.where(F.col("split") == "test")
    out = forests.forest_permutation_importance(model, test, "customer_id", "label", LINEAR)
    return rounded(out, "importance", "importance_std")


@query("s06_model_save")
def model_save(spark, sf):
    data, recipe = model_data(spark, sf)
    path = os.path.join(scratch_dir(spark), f"model-{uuid.uuid4().hex}")
    models.save_model(_fit(data, recipe, "logistic", "logistic", iterations=1000), path)
    return _test_record(spark, data, {"reloaded": models.load_model(path, spark)})


def _sizes_sql(recipe: recipes.Recipe) -> str:
    """Rows and positives of each part, and of the rows that models are trained on."""
    stratum = "label" if recipe.stratify else None
    kept = "total_charges IS NOT NULL" if recipe.null_policy == "drop" else "true"
    most = "2 * greatest(count(*) FILTER (WHERE label = 0), count(*) FILTER (WHERE label = 1))"
    grown = recipe.balance in ("smote", "both")
    return f"""WITH {LABELED_SQL}, kept_rows AS (SELECT customer_id, label FROM labeled WHERE {kept}),
          parts AS ({split_sql("kept_rows", "customer_id", dict(recipe.parts), stratum)})
        SELECT split AS part, count(*) AS n_rows, count(*) FILTER (WHERE label = 1) AS positives FROM parts GROUP BY split
        UNION ALL SELECT 'trained on', {most if grown else "count(*)"},
          {most + " // 2" if grown else "count(*) FILTER (WHERE label = 1)"} FROM parts WHERE split = 'train'"""


def _register_sizes(name):
    @query(f"recipe_sizes_{name}", _sizes_sql(recipes.RECIPES[name]))
    def sizes(spark, sf):
        data = recipes.prepare(customers(spark, sf), recipes.RECIPES[name])
        trained = data.resampled.select(F.lit("trained on").alias("part"), "label")
        rows = data.table.select(F.col("split").alias("part"), "label").unionByName(trained)
        return rows.groupBy("part").agg(F.count("*").alias("n_rows"), F.count_if(F.col("label") == 1).alias("positives"))

    return sizes


def _register(name):
    @query(f"recipe_{name}")
    def run(spark, sf):
        return recipes.run(customers(spark, sf), recipes.RECIPES[name])

    return run


for _name in recipes.RECIPES:
    _register_sizes(_name)
    _register(_name)
