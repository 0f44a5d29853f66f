"""Evaluation of scored rows, many models and segments at once.

Input is one long table: a row per scored case with ``label`` (0/1), ``score``
and ``prediction``, and any grouping columns such as ``model``. Every metric is a
grouped aggregation over it; no group is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outcomekit.functions import bce_loss
from outcomekit.operators.ranking import BUCKET_ROWS, score_bounds, with_score_bucket
from outcomekit.session import join_groups, stage

CELLS = ["tn", "fp", "fn", "tp"]


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b as double; NULL where b is 0."""
    x, y = (F.col(v) if isinstance(v, str) else v for v in (a, b))
    return F.try_divide(x.cast("double"), y.cast("double"))


def _or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _or_zero(ratio(F.lit(2.0) * precision * recall, precision + recall))


def confusion(
    scored: DataFrame, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row per group with the four cells of its confusion matrix."""
    y, p = F.col(label), F.col(prediction)
    cell = lambda a, b: F.count_if((y == a) & (p == b))
    return scored.groupBy(*by).agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def confusion_long(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The matrix as rows (label, prediction, n), empty cells included."""
    pairs = [("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1)]
    parts = [
        F.struct(F.lit(y).alias("label"), F.lit(p).alias("prediction"), F.col(c).alias("n")) for c, y, p in pairs
    ]
    return cells.select(*by, F.inline(F.array(*parts)))


def add_rates(cells: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1; a zero denominator gives 0."""
    tn, fp, fn, tp = (F.col(c) for c in CELLS)
    rated = cells.withColumns(
        {
            "accuracy": _or_zero(ratio(tp + tn, tn + fp + fn + tp)),
            "precision": _or_zero(ratio(tp, tp + fp)),
            "recall": _or_zero(ratio(tp, tp + fn)),
        }
    )
    return rated.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def accuracy_gap(scored: DataFrame, by: Sequence[str] = (), split: str = "split") -> DataFrame:
    """Accuracy on the training and validation parts and how far the first is above the second."""
    hit = (F.col("label") == F.col("prediction")).cast("double")
    part = lambda name: F.avg(F.when(F.col(split) == name, hit))
    return (
        scored.groupBy(*by)
        .agg(part("train").alias("accuracy"), part("validation").alias("val_accuracy"))
        .withColumn("accuracy_gap", F.col("accuracy") - F.col("val_accuracy"))
    )


def class_report(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows ``0``, ``1``, ``accuracy``, ``macro avg`` and ``weighted avg`` for each group.

    The accuracy row holds the accuracy in ``f1``, as printed reports do.
    """
    tn, fp, fn, tp = (F.col(c) for c in CELLS)
    named = cells.select(
        *by,
        *CELLS,
        _or_zero(ratio(tn, tn + fn)).alias("p0"),
        _or_zero(ratio(tn, tn + fp)).alias("r0"),
        (tn + fp).alias("s0"),
        _or_zero(ratio(tp, tp + fp)).alias("p1"),
        _or_zero(ratio(tp, tp + fn)).alias("r1"),
        (fn + tp).alias("s1"),
    )
    c = F.col
    named = named.withColumns({"f0": _f1(c("p0"), c("r0")), "f1": _f1(c("p1"), c("r1")), "s": c("s0") + c("s1")})
    empty = F.lit(None).cast("double")

    def macro(m):
        return (c(f"{m}0") + c(f"{m}1")) / F.lit(2.0)

    def weighted(m):
        return ratio(c(f"{m}0") * c("s0") + c(f"{m}1") * c("s1"), c("s"))

    def line(name, p, r, f, s):
        return F.struct(
            F.lit(name).alias("class"),
            p.alias("precision"),
            r.alias("recall"),
            f.alias("f1"),
            s.alias("support"),
        )

    lines = [
        line("0", c("p0"), c("r0"), c("f0"), c("s0")),
        line("1", c("p1"), c("r1"), c("f1"), c("s1")),
        line("accuracy", empty, empty, ratio(c("tn") + c("tp"), c("s")), c("s")),
        line("macro avg", macro("p"), macro("r"), macro("f"), c("s")),
        line("weighted avg", weighted("p"), weighted("r"), weighted("f"), c("s")),
    ]
    return named.select(*by, F.inline(F.array(*lines)))


def report_text(report: DataFrame, digits: int = 4) -> DataFrame:
    """Add a printable ``line`` to every row of a class report."""
    number = lambda m: F.when(F.col(m).isNull(), F.lit(" " * 10)).otherwise(F.format_string(f"%10.{digits}f", m))
    text = F.concat(
        F.format_string("%12s", "class"),
        number("precision"),
        number("recall"),
        number("f1"),
        F.format_string("%10d", "support"),
    )
    return report.withColumn("line", text)


def score_points(
    scored: DataFrame,
    by: Sequence[str] = (),
    label: str = "label",
    score: str = "score",
    prediction: str | None = None,
    with_next: bool = False,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Every distinct score of a group with its counts and the counts at or above it.

    Columns: ``score``; ``pos`` and ``neg`` at the score; ``cum_pos`` and
    ``cum_neg`` at or above it; ``n_pos`` and ``n_neg`` of the group. With
    ``prediction`` also ``hits`` and ``alarms``, the predicted positives among
    ``pos`` and ``neg``; ``with_next`` adds ``next_pos`` and ``next_neg`` of the next
    lower score.

    The rows are read once: equal scores collapse on the map side, and what is left, a
    row per group and score, is staged. Running sums go bucket by bucket of scores: a
    task sorts one bucket of one group, never a whole group.
    """
    by = list(by)
    y = F.col(label)
    sides = [F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")]
    flags = []
    if prediction:
        predicted = F.col(prediction) == 1
        flags = [F.count_if((y == 1) & predicted).alias("hits"), F.count_if((y == 0) & predicted).alias("alarms")]
    carried = ["hits", "alarms"] if prediction else []
    rows = scored.where(F.col(score).isNotNull() & y.isNotNull()).withColumn("score", F.col(score).cast("double"))
    if not by:
        rows = rows.withColumn("_all", F.lit(0))
    keys = by or ["_all"]
    down = F.desc("score")
    counts = stage(rows.groupBy(*keys, "score").agg(*sides, *flags))
    bounds = score_bounds(counts, "score", bucket_rows)
    if not bounds:
        # Few enough scores in all for one sort per group.
        group = W.partitionBy(*keys)
        order = group.orderBy(down)
        whole = group.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        following = [F.lead(c).over(order).alias(f"next_{c}") for c in ("pos", "neg")] if with_next else []
        return counts.select(
            *by,
            "score",
            "pos",
            "neg",
            *carried,
            F.sum("pos").over(order).alias("cum_pos"),
            F.sum("neg").over(order).alias("cum_neg"),
            F.sum("pos").over(whole).alias("n_pos"),
            F.sum("neg").over(whole).alias("n_neg"),
            *following,
        )
    counts = with_score_bucket(counts, "score", bounds, "bucket")
    # A group has at most one total per bucket.
    totals = counts.groupBy(*keys, "bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    group = W.partitionBy(*keys)
    lower = group.orderBy(F.desc("bucket"))
    whole = group.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    if with_next:
        head = F.max_by(F.struct("pos", "neg"), "score").alias("head")
        totals = totals.unionByName(counts.groupBy(*keys, "bucket").agg(head), allowMissingColumns=True)
        totals = totals.groupBy(*keys, "bucket").agg(
            F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.max("head").alias("head")
        )
    else:
        totals = totals.withColumn("head", F.lit(None).cast("struct<pos:bigint,neg:bigint>"))
    # One leading row per bucket brings in the sums of the buckets before it, so the totals
    # need no join: the window's own shuffle brings them together.
    leading = totals.select(
        *keys,
        "bucket",
        F.lit(True).alias("leads"),
        (F.sum("pos").over(lower) - F.col("pos")).alias("pos"),
        (F.sum("neg").over(lower) - F.col("neg")).alias("neg"),
        F.sum("pos").over(whole).alias("n_pos"),
        F.sum("neg").over(whole).alias("n_neg"),
        F.lead("head").over(lower).alias("after"),
    )
    both = counts.withColumn("leads", F.lit(False)).unionByName(leading, allowMissingColumns=True)
    inside = W.partitionBy(*keys, "bucket").orderBy(F.desc("leads"), down)
    following = []
    if with_next:
        after = F.first("after").over(inside)
        following = [F.coalesce(F.lead(c).over(inside), after[c]).alias(f"next_{c}") for c in ("pos", "neg")]
    summed = both.select(
        *by,
        "leads",
        "score",
        "pos",
        "neg",
        *carried,
        F.sum("pos").over(inside).alias("cum_pos"),
        F.sum("neg").over(inside).alias("cum_neg"),
        F.first("n_pos").over(inside).alias("n_pos"),
        F.first("n_neg").over(inside).alias("n_neg"),
        *following,
    )
    return summed.where(~F.col("leads")).drop("leads")


def _is_first() -> Column:
    return (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))


def roc_curve(points: DataFrame, by: Sequence[str] = (), drop_collinear: bool = True) -> DataFrame:
    """False and true positive rate at each threshold, from (0, 0) at an infinite one.

    ``drop_collinear`` leaves out points on a straight line between their
    neighbors, which do not change the curve; it needs points made ``with_next``.
    """
    if drop_collinear:
        is_last = (F.col("cum_pos") == F.col("n_pos")) & (F.col("cum_neg") == F.col("n_neg"))
        bend = (F.col("pos") != F.col("next_pos")) | (F.col("neg") != F.col("next_neg"))
        points = points.where(_is_first() | is_last | bend)
    here = F.struct(
        F.col("score").alias("threshold"),
        ratio("cum_neg", "n_neg").alias("fpr"),
        ratio("cum_pos", "n_pos").alias("tpr"),
    )
    start = F.struct(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.select(*by, F.inline(F.when(_is_first(), F.array(start, here)).otherwise(F.array(here))))


def precision_recall_curve(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at each threshold, and the closing point (1, 0) without one."""
    here = F.struct(
        F.col("score").alias("threshold"),
        ratio("cum_pos", F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        F.coalesce(ratio("cum_pos", "n_pos"), F.lit(1.0)).alias("recall"),
    )
    closing = F.struct(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.select(*by, F.inline(F.when(_is_first(), F.array(closing, here)).otherwise(F.array(here))))


def roc_auc(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve; ties count one half; NULL where a class is absent."""
    return points.groupBy(*by).agg(_auc().alias("roc_auc"))


def _auc() -> Column:
    wins = F.col("n_neg") - F.col("cum_neg") + F.col("neg") / F.lit(2.0)
    pairs = F.first("n_pos").cast("double") * F.first("n_neg").cast("double")
    return F.try_divide(F.sum(F.col("pos") * wins), pairs)


def average_precision(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum of precision times the step in recall over all thresholds."""
    step = ratio("pos", "n_pos")
    precision = ratio("cum_pos", F.col("cum_pos") + F.col("cum_neg"))
    return points.groupBy(*by).agg(F.sum(step * precision).alias("average_precision"))


def log_loss(scored: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score") -> DataFrame:
    return scored.groupBy(*by).agg(F.avg(bce_loss(label, score)).alias("log_loss"))


def grid_auc(
    scored: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score", thresholds: int = 200
) -> DataFrame:
    """Area under the ROC curve read at evenly spaced thresholds: cheap and approximate.

    Rows are counted between thresholds, so no more than ``thresholds`` rows of a
    group are left for the sum over the curve.
    """
    y, steps = F.col(label), thresholds - 1
    place = F.least(F.lit(steps), F.greatest(F.lit(1), F.ceil(F.col(score).cast("double") * steps))).cast("int")
    cells = (
        scored.where(F.col(score).isNotNull())
        .groupBy(*by, place.alias("place"))
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    )
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    cum = F.sum("pos").over(group.orderBy(F.desc("place")))
    height = (F.col("cum_pos") - F.col("pos") / F.lit(2.0)) * F.col("neg")
    total = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return cells.withColumn("cum_pos", cum).groupBy(*by).agg(F.try_divide(F.sum(height), total).alias("grid_auc"))


def evaluate(
    scored: DataFrame,
    by: Sequence[str] = ("model",),
    label: str = "label",
    score: str = "score",
    prediction: str = "prediction",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One metric record per group: confusion cells, rates and ROC AUC, in one job for all groups.

    Cells count every row with a label and a prediction; the curve has only rows with a score.
    """
    cells = confusion(scored, by, label, prediction)
    areas = score_points(scored, by, label, score, bucket_rows=bucket_rows).groupBy(*by).agg(_auc().alias("roc_auc"))
    if by:
        joined = join_groups(cells, areas, list(by), "left")
    else:
        joined = cells.withColumn("roc_auc", F.lit(areas.first()["roc_auc"]).cast("double"))
    return add_rates(joined).select(*by, *CELLS, "accuracy", "precision", "recall", "f1", "roc_auc")
