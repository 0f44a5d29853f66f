"""Evaluation of scored rows and comparison of models."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomekit.operators import compare, evaluate as ev
from registry.core import SCORED_SQL, query, scored_lines
from registry.profiling import rounded

BY = ["model", "segment"]
MODELS = ["quantity", "unit_price", "mixed", "discount"]

CELLS_SQL = (
    SCORED_SQL
    + """, cells AS (SELECT model, segment,
      count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
      count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp
    FROM scored GROUP BY model, segment)
"""
)
RATES_SQL = (
    CELLS_SQL
    + """, rates0 AS (SELECT *, (tp + tn)::DOUBLE / (tn + fp + fn + tp) AS accuracy,
        coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS precision, coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS recall
      FROM cells),
    rates AS (SELECT *, coalesce(2.0::DOUBLE * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM rates0)
"""
)
POINTS_SQL = (
    RATES_SQL
    + """, counts AS (SELECT model, segment, score, count(*) FILTER (WHERE label = 1) AS pos,
        count(*) FILTER (WHERE label = 0) AS neg FROM scored GROUP BY model, segment, score),
    points AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg,
        sum(pos) OVER g AS n_pos, sum(neg) OVER g AS n_neg, row_number() OVER w AS i,
        lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg FROM counts
      WINDOW w AS (PARTITION BY model, segment ORDER BY score DESC), g AS (PARTITION BY model, segment))
"""
)
RECORD_SQL = (
    POINTS_SQL
    + """, aucs AS (SELECT model, segment,
        sum(pos::DOUBLE * (n_neg - cum_neg + neg / 2.0::DOUBLE)) / nullif(any_value(n_pos)::DOUBLE * any_value(n_neg)::DOUBLE, 0)
        AS roc_auc FROM points GROUP BY model, segment),
    record AS (SELECT rates.*, roc_auc FROM rates JOIN aucs USING (model, segment))
"""
)
ROUNDED_RATES = "round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1"


@query("e01_confusion", f"WITH {CELLS_SQL} SELECT * FROM cells")
def confusion(spark, sf):
    return ev.confusion(scored_lines(spark, sf), BY)


@query(
    "e01_confusion_long",
    f"""WITH {CELLS_SQL} SELECT model, segment, 0 AS label, 0 AS prediction, tn AS n FROM cells
        UNION ALL SELECT model, segment, 0, 1, fp FROM cells UNION ALL SELECT model, segment, 1, 0, fn FROM cells
        UNION ALL SELECT model, segment, 1, 1, tp FROM cells""",
)
def confusion_long(spark, sf):
    return ev.confusion_long(ev.confusion(scored_lines(spark, sf), BY), BY)


@query("e02_accuracy", f"WITH {RATES_SQL} SELECT model, segment, round(accuracy, 6) AS accuracy FROM rates")
def accuracy(spark, sf):
    rates = ev.add_rates(ev.confusion(scored_lines(spark, sf), BY))
    return rounded(rates.select(*BY, "accuracy"), "accuracy")


@query(
    "e03_precision_recall_f1",
    f"""WITH {RATES_SQL} SELECT model, segment, round(precision, 6) AS precision, round(recall, 6) AS recall,
        round(f1, 6) AS f1 FROM rates""",
)
def precision_recall_f1(spark, sf):
    rates = ev.add_rates(ev.confusion(scored_lines(spark, sf), BY))
    return rounded(rates.select(*BY, "precision", "recall", "f1"), "precision", "recall", "f1")


@query(
    "e04_class_report",
    f"""WITH {CELLS_SQL}, per AS (
          SELECT *, coalesce(tn::DOUBLE / nullif(tn + fn, 0), 0) AS p0, coalesce(tn::DOUBLE / nullif(tn + fp, 0), 0) AS r0,
                 coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS p1, coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS r1,
                 tn + fp AS s0, fn + tp AS s1, tn + fp + fn + tp AS s FROM cells),
        full_per AS (SELECT *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0,
                 coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1 FROM per),
        lines AS (
          SELECT model, segment, '0' AS "class", p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM full_per
          UNION ALL SELECT model, segment, '1', p1, r1, f1, s1 FROM full_per
          UNION ALL SELECT model, segment, 'accuracy', NULL, NULL, (tn + tp)::DOUBLE / s, s FROM full_per
          UNION ALL SELECT model, segment, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s FROM full_per
          UNION ALL SELECT model, segment, 'weighted avg', (p0 * s0 + p1 * s1) / s, (r0 * s0 + r1 * s1) / s,
                 (f0 * s0 + f1 * s1) / s, s FROM full_per)
        SELECT model, segment, "class", round(precision, 6) AS precision, round(recall, 6) AS recall,
               round(f1, 6) AS f1, support FROM lines""",
)
def class_report(spark, sf):
    report = ev.class_report(ev.confusion(scored_lines(spark, sf), BY), BY)
    return rounded(report, "precision", "recall", "f1")


@query(
    "e04_report_text",
    f"""WITH {CELLS_SQL}, per AS (SELECT *, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS p1,
              coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS r1 FROM cells)
        SELECT model, segment, printf('%12s%10.4f%10.4f%10.4f%10d', '1', p1, r1,
               coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0), tp + fn) AS line FROM per
        UNION ALL SELECT model, segment, printf('%12s%20s%10.4f%10d', 'accuracy', '', (tn + tp)::DOUBLE / (tn + fp + fn + tp),
               tn + fp + fn + tp) FROM cells""",
)
def report_text(spark, sf):
    lines = ev.report_text(ev.class_report(ev.confusion(scored_lines(spark, sf), BY), BY))
    return lines.where(F.col("class").isin("1", "accuracy")).select(*BY, "line")


def _points(spark, sf):
    return ev.score_points(scored_lines(spark, sf), BY)


@query(
    "e05_roc_curve",
    f"""WITH {POINTS_SQL}
        SELECT model, segment, score AS threshold, round(cum_neg::DOUBLE / nullif(n_neg, 0), 6) AS fpr,
               round(cum_pos::DOUBLE / nullif(n_pos, 0), 6) AS tpr FROM points
        WHERE i = 1 OR next_pos IS NULL OR pos <> next_pos OR neg <> next_neg
        UNION ALL SELECT model, segment, 'inf'::DOUBLE, 0, 0 FROM points WHERE i = 1""",
)
def roc_curve(spark, sf):
    points = ev.score_points(scored_lines(spark, sf), BY, with_next=True)
    return rounded(ev.roc_curve(points, BY), "fpr", "tpr")


@query(
    "e05_roc_curve_small_buckets",
    f"""WITH {POINTS_SQL}
        SELECT model, segment, score AS threshold, round(cum_neg::DOUBLE / nullif(n_neg, 0), 6) AS fpr,
               round(cum_pos::DOUBLE / nullif(n_pos, 0), 6) AS tpr FROM points
        WHERE i = 1 OR next_pos IS NULL OR pos <> next_pos OR neg <> next_neg
        UNION ALL SELECT model, segment, 'inf'::DOUBLE, 0, 0 FROM points WHERE i = 1""",
)
def roc_curve_small_buckets(spark, sf):
    # So that the running sums across buckets are used on any test size.
    points = ev.score_points(scored_lines(spark, sf), BY, with_next=True, bucket_rows=20_000)
    return rounded(ev.roc_curve(points, BY), "fpr", "tpr")


@query(
    "e05_roc_curve_full",
    f"""WITH {POINTS_SQL}
        SELECT model, segment, score AS threshold, round(cum_neg::DOUBLE / nullif(n_neg, 0), 6) AS fpr,
               round(cum_pos::DOUBLE / nullif(n_pos, 0), 6) AS tpr FROM points
        UNION ALL SELECT model, segment, 'inf'::DOUBLE, 0, 0 FROM points WHERE i = 1""",
)
def roc_curve_full(spark, sf):
    return rounded(ev.roc_curve(_points(spark, sf), BY, drop_collinear=False), "fpr", "tpr")


@query("e06_roc_auc", f"WITH {RECORD_SQL} SELECT model, segment, round(roc_auc, 6) AS roc_auc FROM record")
def roc_auc(spark, sf):
    return rounded(ev.roc_auc(_points(spark, sf), BY), "roc_auc")


@query(
    "e07_pr_curve",
    f"""WITH {POINTS_SQL}
        SELECT model, segment, score AS threshold, round(cum_pos::DOUBLE / (cum_pos + cum_neg), 6) AS precision,
               round(coalesce(cum_pos::DOUBLE / nullif(n_pos, 0), 1), 6) AS recall FROM points
        UNION ALL SELECT model, segment, NULL, 1, 0 FROM points WHERE i = 1""",
)
def pr_curve(spark, sf):
    return rounded(ev.precision_recall_curve(_points(spark, sf), BY), "precision", "recall")


@query(
    "e08_average_precision",
    f"""WITH {POINTS_SQL}, steps AS (
          SELECT model, segment, i, cum_pos::DOUBLE / (cum_pos + cum_neg) AS p, cum_pos::DOUBLE / n_pos AS r FROM points),
        diffs AS (SELECT *, r - coalesce(lag(r) OVER (PARTITION BY model, segment ORDER BY i), 0) AS step FROM steps)
        SELECT model, segment, round(sum(step * p), 6) AS average_precision FROM diffs GROUP BY model, segment""",
)
def average_precision(spark, sf):
    return rounded(ev.average_precision(_points(spark, sf), BY), "average_precision")


@query(
    "e09_log_loss",
    f"""WITH {SCORED_SQL}, clipped AS (
          SELECT *, greatest(1e-7::DOUBLE, least(1.0::DOUBLE - 1e-7::DOUBLE, score)) AS p FROM scored)
        SELECT model, segment, round(avg(-(label * ln(p) + (1 - label) * ln(1 - p))), 6) AS log_loss
        FROM clipped GROUP BY model, segment""",
)
def log_loss(spark, sf):
    return rounded(ev.log_loss(scored_lines(spark, sf), BY), "log_loss")


@query(
    "e10_grid_auc",
    f"""WITH {SCORED_SQL}, placed AS (
          SELECT model, segment, label, least(199, greatest(1, CAST(ceil(score * 199) AS INTEGER))) AS place FROM scored),
        tallied AS (SELECT model, segment, place, count(*) FILTER (WHERE label = 1) AS pos,
                  count(*) FILTER (WHERE label = 0) AS neg FROM placed GROUP BY ALL),
        curve AS (SELECT model, segment, t.thr, coalesce(sum(pos) FILTER (WHERE place > t.thr), 0) AS tp,
                  coalesce(sum(neg) FILTER (WHERE place > t.thr), 0) AS fp, sum(pos) AS p, sum(neg) AS n
                  FROM tallied, (SELECT unnest(range(0, 200)) AS thr) t GROUP BY model, segment, t.thr),
        steps AS (SELECT *, lead(tp) OVER w AS tp2, lead(fp) OVER w AS fp2 FROM curve
                  WINDOW w AS (PARTITION BY model, segment ORDER BY thr))
        SELECT model, segment, round(sum((fp - fp2)::DOUBLE / n * (tp + tp2)::DOUBLE / p / 2), 6) AS grid_auc
        FROM steps WHERE tp2 IS NOT NULL GROUP BY model, segment""",
)
def grid_auc(spark, sf):
    return rounded(ev.grid_auc(scored_lines(spark, sf), BY), "grid_auc")


def _record(spark, sf):
    return ev.evaluate(scored_lines(spark, sf), BY)


@query(
    "e11_evaluate",
    f"WITH {RECORD_SQL} SELECT model, segment, tn, fp, fn, tp, {ROUNDED_RATES}, round(roc_auc, 6) AS roc_auc FROM record",
)
def evaluate(spark, sf):
    return rounded(_record(spark, sf), *compare.METRICS)


@query(
    "e12_comparison_wide",
    f"""WITH {RECORD_SQL} SELECT model, segment, printf('%.4f', accuracy) AS accuracy, printf('%.4f', precision) AS precision,
          printf('%.4f', recall) AS recall, printf('%.4f', f1) AS f1, printf('%.4f', roc_auc) AS roc_auc FROM record""",
)
def comparison_wide(spark, sf):
    return compare.wide_table(_record(spark, sf), within=["segment"])


LONG_SQL = (
    RECORD_SQL
    + """, long AS (
      SELECT model, segment, 'accuracy' AS metric, accuracy AS value FROM record
      UNION ALL SELECT model, segment, 'precision', precision FROM record
      UNION ALL SELECT model, segment, 'recall', recall FROM record
      UNION ALL SELECT model, segment, 'f1', f1 FROM record
      UNION ALL SELECT model, segment, 'roc_auc', roc_auc FROM record),
    pairs AS (SELECT a.segment, a.metric, a.value AS va, b.value AS vb FROM long a JOIN long b
      ON a.segment = b.segment AND a.metric = b.metric AND a.model = 'mixed' AND b.model = 'quantity')
"""
)


@query(
    "e13_difference_table",
    f"""WITH {LONG_SQL} SELECT segment, metric, round(va, 6) AS mixed, round(vb, 6) AS quantity,
          round(va - vb, 6) AS difference FROM pairs""",
)
def difference_table(spark, sf):
    out = compare.difference_table(_record(spark, sf), "mixed", "quantity", within=["segment"])
    return rounded(out, "mixed", "quantity", "difference")


@query(
    "e14_relative_improvement",
    f"""WITH {LONG_SQL} SELECT segment, round((va - vb) / vb * 100, 6) AS gain,
          CASE WHEN va > vb THEN 'mixed' ELSE 'quantity' END AS better,
          round(abs(va - vb) / least(va, vb) * 100, 6) AS improvement FROM pairs WHERE metric = 'f1'""",
)
def relative_improvement(spark, sf):
    out = compare.relative_improvement(_record(spark, sf), "mixed", "quantity", within=["segment"])
    return rounded(out, "gain", "improvement")


ORDER_SQL = "list_position(['quantity', 'unit_price', 'mixed', 'discount'], model)"


@query(
    "e15_pick_best",
    f"""WITH {LONG_SQL}, ranked AS (
          SELECT *, row_number() OVER (PARTITION BY segment, metric ORDER BY value DESC, {ORDER_SQL}) AS rk FROM long
          WHERE metric = 'f1')
        SELECT segment, metric, model, round(value, 6) AS value FROM ranked WHERE rk = 1""",
)
def pick_best(spark, sf):
    return rounded(compare.best_model(_record(spark, sf), "f1", MODELS, within=["segment"]), "value")


@query(
    "e15_pick_pair",
    f"""WITH {LONG_SQL} SELECT segment, CASE WHEN va >= vb THEN 'mixed' ELSE 'quantity' END AS choice
        FROM pairs WHERE metric = 'roc_auc'""",
)
def pick_pair(spark, sf):
    return compare.pick_pair(_record(spark, sf), "mixed", "quantity", "roc_auc", tie="first", within=["segment"])


@query(
    "e15_pick_recall_tie",
    f"""WITH {LONG_SQL} SELECT segment, CASE WHEN va > vb THEN 'mixed' WHEN va < vb THEN 'quantity' ELSE 'equal' END AS choice
        FROM pairs WHERE metric = 'recall'""",
)
def pick_recall_tie(spark, sf):
    return compare.pick_pair(_record(spark, sf), "mixed", "quantity", "recall", tie="equal", within=["segment"])


VERDICTS = {
    "recall": ("finds more of the costly lines", "finds no more of the costly lines"),
    "precision": ("raises fewer false alarms", "raises no fewer false alarms"),
}


@query(
    "e15_verdicts",
    f"""WITH {LONG_SQL} SELECT segment, metric, CASE
          WHEN metric = 'recall' AND va > vb THEN 'finds more of the costly lines'
          WHEN metric = 'recall' THEN 'finds no more of the costly lines'
          WHEN va > vb THEN 'raises fewer false alarms' ELSE 'raises no fewer false alarms' END AS verdict
        FROM pairs WHERE metric IN ('recall', 'precision')""",
)
def verdict_texts(spark, sf):
    return compare.verdicts(_record(spark, sf), "mixed", "quantity", VERDICTS, within=["segment"])


@query(
    "e16_cost_benefit",
    f"""WITH {CELLS_SQL} SELECT model, segment, tp + fn AS positives, tp AS caught, fn AS missed, tp * 500 AS saved,
          fp * 50 AS cost, tp * 500 - fp * 50 AS net FROM cells""",
)
def cost_benefit(spark, sf):
    return compare.cost_benefit(ev.confusion(scored_lines(spark, sf), BY))


@query(
    "e17_point_difference",
    f"""WITH {LONG_SQL} SELECT segment, metric, round((va - vb) * 100, 6) AS points, round(abs(va - vb) * 100, 6) AS abs_points
        FROM pairs WHERE metric IN ('recall', 'precision')""",
)
def point_difference(spark, sf):
    out = compare.point_difference(_record(spark, sf), "mixed", "quantity", within=["segment"])
    return rounded(out, "points", "abs_points")


@query(
    "a17_best_by_metric",
    f"""WITH {LONG_SQL}, ranked AS (
          SELECT *, row_number() OVER (PARTITION BY segment, metric ORDER BY value DESC, {ORDER_SQL}) AS rk FROM long)
        SELECT segment, metric, model, round(value, 6) AS value FROM ranked WHERE rk = 1""",
)
def best_by_metric(spark, sf):
    return rounded(compare.best_by_metric(_record(spark, sf), MODELS, within=["segment"]), "value")
