import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from outcomekit.operators import compare, evaluate as ev

# Confusion matrices behind the published comparison.
GOLDEN = [
    ("Neural Network", 467, 310, 30, 250),
    ("Logistic Regression", 590, 187, 74, 206),
    ("Random Forest", 596, 181, 67, 213),
]
ORDER = [g[0] for g in GOLDEN]
# The published comparison.
PUBLISHED = {
    "Neural Network": ("0.6783", "0.4464", "0.8929", "0.5952"),
    "Logistic Regression": ("0.7531", "0.5242", "0.7357", "0.6122"),
    "Random Forest": ("0.7654", "0.5406", "0.7607", "0.6320"),
}
RATES = ["accuracy", "precision", "recall", "f1"]


@pytest.fixture(scope="module")
def cells(spark):
    return spark.createDataFrame(GOLDEN, "model string, tn bigint, fp bigint, fn bigint, tp bigint")


@pytest.fixture(scope="module")
def rated(cells):
    return ev.add_rates(cells)


def test_published_rates(rated):
    rows = compare.wide_table(rated, RATES).collect()
    assert {r.model: tuple(r[m] for m in RATES) for r in rows} == PUBLISHED


def test_best_and_pairs(rated):
    best = {r.metric: r.model for r in compare.best_by_metric(rated, ORDER, RATES).collect()}
    assert best == {
        "accuracy": "Random Forest", "precision": "Random Forest", "recall": "Neural Network", "f1": "Random Forest",
    }
    assert compare.best_model(rated, "f1", ORDER).first().model == "Random Forest"
    gain = compare.relative_improvement(rated, "Neural Network", "Logistic Regression").first()
    assert gain.gain == pytest.approx(-2.77, abs=0.05) and gain.better == "Logistic Regression" and gain.improvement > 0
    assert compare.pick_pair(rated, "Neural Network", "Logistic Regression", "recall").first().choice == "Neural Network"
    points = compare.point_difference(rated, "Neural Network", "Logistic Regression").collect()
    got = {r.metric: r.points for r in points}
    assert got["recall"] == pytest.approx(100 * (250 / 280 - 206 / 280))
    assert got["precision"] == pytest.approx(100 * (250 / 560 - 206 / 393))


def test_ties_go_by_order(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", None)], "model string, f1 double")
    assert compare.best_model(df, "f1", ["b", "a"]).first().model == "b"
    assert compare.best_model(df, "f1", ["a", "b"]).first().model == "a"
    for tie, want in (("first", "a"), ("second", "b"), ("equal", "equal")):
        assert compare.pick_pair(df, "a", "b", "f1", tie).first().choice == want


def test_cost_benefit(cells):
    got = {r.model: (r.positives, r.caught, r.missed, r.net) for r in compare.cost_benefit(cells).collect()}
    assert got["Neural Network"] == (280, 250, 30, 109_500)
    assert got["Logistic Regression"][3] == 93_650 and got["Random Forest"][3] == 97_450


def test_difference_table(rated):
    rows = compare.difference_table(rated, "Neural Network", "Logistic Regression", ["f1"]).collect()
    assert rows[0].difference == pytest.approx(rows[0]["Neural Network"] - rows[0]["Logistic Regression"])


def test_report_rows(cells):
    rows = {r["class"]: r for r in ev.class_report(cells.where("model = 'Random Forest'")).collect()}
    assert rows["1"].support == 280 and rows["0"].support == 777
    assert rows["accuracy"].f1 == pytest.approx(809 / 1057) and rows["accuracy"].precision is None
    weighted = (rows["0"].f1 * 777 + rows["1"].f1 * 280) / 1057
    assert rows["weighted avg"].f1 == pytest.approx(weighted)
    assert rows["macro avg"].recall == pytest.approx((rows["0"].recall + rows["1"].recall) / 2)
    text = ev.report_text(ev.class_report(cells.where("model = 'Random Forest'"))).where("class = '1'").first().line
    assert text.split() == ["1", "0.5406", "0.7607", "0.6320", "280"]


def test_tied_scores(spark):
    data = [(0, 0.1), (1, 0.4), (0, 0.4), (1, 0.8), (0, 0.4), (1, 0.4), (0, 0.9)]
    df = spark.createDataFrame(data, "label int, score double")
    assert ev.roc_auc(ev.score_points(df)).first().roc_auc == pytest.approx(0.583333, abs=1e-6)


def test_one_class_and_no_positive_prediction(spark):
    df = spark.createDataFrame([(0, 0.1, 0), (0, 0.2, 0)], "label int, score double, prediction int")
    row = ev.evaluate(df, []).first()
    assert row.roc_auc is None and (row.precision, row.recall, row.f1, row.accuracy) == (0.0, 0.0, 0.0, 1.0)
    mixed = spark.createDataFrame([(1, 0.1, 0), (0, 0.2, 0)], "label int, score double, prediction int")
    assert tuple(ev.evaluate(mixed, []).select("precision", "recall", "f1").first()) == (0.0, 0.0, 0.0)
    report = ev.class_report(ev.confusion(mixed)).where("class = '1'").first()
    assert (report.precision, report.recall, report.f1) == (0.0, 0.0, 0.0)


def scored(spark, n=3_000):
    rng = np.random.default_rng(11)
    label = rng.random(n) < 0.3
    many = np.clip(label * 0.2 + rng.random(n) * 0.8, 0, 1)
    few = np.floor(many * 7) / 7
    hot = np.where(rng.random(n) < 0.4, 0.5, many)
    data = []
    for name, s in (("many", many), ("few", few), ("hot", hot)):
        data += [(name, int(y), float(v), int(v > 0.5)) for y, v in zip(label, s)]
    return spark.createDataFrame(data, "model string, label int, score double, prediction int"), label, {
        "many": many, "few": few, "hot": hot,
    }


def brute(label, s):
    pos, neg = s[label], s[~label]
    wins = sum((pos > v).sum() + 0.5 * (pos == v).sum() for v in neg)
    auc = wins / (len(pos) * len(neg))
    ap, last = 0.0, 0.0
    for t in np.unique(s)[::-1]:
        hit = s >= t
        recall = (label & hit).sum() / label.sum()
        ap += (recall - last) * (label & hit).sum() / hit.sum()
        last = recall
    return auc, ap


@pytest.mark.parametrize("bucket_rows", [1_000_000, 500, 30])
def test_areas_equal_brute_force_in_any_bucket_size(spark, bucket_rows):
    df, label, scores = scored(spark)
    points = ev.score_points(df, ["model"], bucket_rows=bucket_rows)
    auc = {r.model: r.roc_auc for r in ev.roc_auc(points, ["model"]).collect()}
    ap = {r.model: r.average_precision for r in ev.average_precision(points, ["model"]).collect()}
    for name, s in scores.items():
        want = brute(label, s)
        assert (auc[name], ap[name]) == (pytest.approx(want[0]), pytest.approx(want[1]))


def test_curves_do_not_depend_on_buckets_or_partitions(spark):
    df, _, _ = scored(spark)
    first = ev.score_points(df, ["model"], with_next=True)
    again = ev.score_points(df.repartition(64, "label"), ["model"], with_next=True, bucket_rows=100)
    assert first.exceptAll(again).count() == 0 and first.count() == again.count()
    curve = ev.roc_curve(first, ["model"])
    full = ev.roc_curve(first, ["model"], drop_collinear=False)
    assert curve.join(full, curve.columns, "left_anti").count() == 0 and curve.count() < full.count()
    assert curve.where("fpr = 0 and tpr = 0 and threshold = double('inf')").count() == 3
    assert curve.where("fpr = 1 and tpr = 1").count() == 3


def test_pr_curve_closes(spark):
    df, _, _ = scored(spark)
    curve = ev.precision_recall_curve(ev.score_points(df, ["model"]), ["model"])
    assert curve.where("threshold is null and precision = 1 and recall = 0").count() == 3


def test_evaluate_matches_its_parts(spark):
    df, label, scores = scored(spark)
    got = {r.model: r for r in ev.evaluate(df, ["model"], bucket_rows=200).collect()}
    parts = {r.model: r for r in ev.confusion(df, ["model"]).collect()}
    for name, row in got.items():
        assert [row[c] for c in ev.CELLS] == [parts[name][c] for c in ev.CELLS]
        assert row.roc_auc == pytest.approx(brute(label, scores[name])[0])


def test_groups_may_be_null(spark):
    df = spark.createDataFrame([(None, 0, 0.1), (None, 1, 0.9), ("a", 0, 0.9), ("a", 1, 0.1)], "m string, label int, score double")
    for rows in (1_000, 1):
        got = ev.roc_auc(ev.score_points(df, ["m"], bucket_rows=rows), ["m"]).collect()
        assert {r.m: r.roc_auc for r in got} == {None: 1.0, "a": 0.0}


def test_grid_auc_is_near_the_exact_one(spark):
    df, _, _ = scored(spark)
    exact = {r.model: r.roc_auc for r in ev.roc_auc(ev.score_points(df, ["model"]), ["model"]).collect()}
    for r in ev.grid_auc(df, ["model"]).collect():
        assert r.grid_auc == pytest.approx(exact[r.model], abs=0.005)


def test_log_loss(spark):
    df = spark.createDataFrame([(1, 0.8), (0, 0.4)], "label int, score double")
    assert ev.log_loss(df).first().log_loss == pytest.approx(-(math.log(0.8) + math.log(0.6)) / 2)


def test_confusion_long_lists_empty_cells(spark):
    df = spark.createDataFrame([("m", 1, 1)], "model string, label int, prediction int")
    rows = ev.confusion_long(ev.confusion(df, ["model"]), ["model"]).where(F.col("n") == 0)
    assert rows.count() == 3


def test_curve_reads_its_rows_once(spark):
    reads = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(value):
        reads.add(1)
        return value

    df = spark.range(400, numPartitions=2).select((F.col("id") % 2).alias("label"), (F.col("id") % 90 / 90).alias("s"))
    points = ev.score_points(df.withColumn("score", seen.asNondeterministic()("s")), bucket_rows=10)
    assert points.agg(F.sum("pos"), F.sum("neg"), F.count("*")).first() == (200, 200, 90)
    assert reads.value == 400
