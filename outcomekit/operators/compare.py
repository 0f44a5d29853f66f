"""Comparison of metric records: tables, winners, differences and value.

Input is the output of ``evaluate``: a row per model, or per model within each
group of ``within``. Model names given in order settle ties.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outcomekit.functions import fixed_decimals

METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc"]


def _position(model_order: Sequence[str]) -> Column:
    """Place of a model in the given order; others come after, by name."""
    names = F.array(*[F.lit(m) for m in model_order])
    place = F.array_position(names, F.col("model"))
    return F.when(place > 0, place).otherwise(F.lit(len(model_order) + 1))


def metrics_long(metrics: DataFrame, names: Sequence[str] = METRICS, within: Sequence[str] = ()) -> DataFrame:
    return metrics.unpivot([*within, "model"], list(names), "metric", "value")


def best_by_metric(
    metrics: DataFrame,
    model_order: Sequence[str],
    names: Sequence[str] = METRICS,
    within: Sequence[str] = (),
) -> DataFrame:
    """The model with the highest value of each metric; ties go to the first in order."""
    rank = W.partitionBy(*within, "metric").orderBy(F.desc_nulls_last("value"), _position(model_order), "model")
    long = metrics_long(metrics, names, within)
    return long.withColumn("rk", F.row_number().over(rank)).where("rk = 1").drop("rk")


def best_model(
    metrics: DataFrame, metric: str, model_order: Sequence[str], within: Sequence[str] = ()
) -> DataFrame:
    """The overall winner by one metric."""
    return best_by_metric(metrics, model_order, [metric], within)


def wide_table(metrics: DataFrame, names: Sequence[str] = METRICS, within: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """A row per model, metrics as text with fixed decimals."""
    return metrics.select(*within, "model", *[fixed_decimals(m, digits).alias(m) for m in names])


def difference_table(
    metrics: DataFrame, first: str, second: str, names: Sequence[str] = METRICS, within: Sequence[str] = ()
) -> DataFrame:
    """A row per metric, a column per model and the first minus the second."""
    table = (
        metrics_long(metrics.where(F.col("model").isin(first, second)), names, within)
        .groupBy(*within, "metric")
        .pivot("model", [first, second])
        .agg(F.first("value"))
    )
    return table.withColumn("difference", F.col(f"`{first}`") - F.col(f"`{second}`"))


def _pair(metrics: DataFrame, first: str, second: str, names: Sequence[str], within: Sequence[str]) -> DataFrame:
    """Metrics of two models side by side, as ``<metric>_a`` and ``<metric>_b``."""
    value = lambda m, model: F.max(F.when(F.col("model") == model, F.col(m)))
    aggs = []
    for m in names:
        aggs += [value(m, first).alias(f"{m}_a"), value(m, second).alias(f"{m}_b")]
    return metrics.where(F.col("model").isin(first, second)).groupBy(*within).agg(*aggs)


def relative_improvement(
    metrics: DataFrame, first: str, second: str, metric: str = "f1", within: Sequence[str] = ()
) -> DataFrame:
    """How many percent the better of two models is above the other.

    ``gain`` is that of the first over the second, whichever is better.
    """
    a, b = F.col(f"{metric}_a"), F.col(f"{metric}_b")
    better = F.when(a > b, F.lit(first)).otherwise(F.lit(second))
    return _pair(metrics, first, second, [metric], within).select(
        *within,
        F.try_divide((a - b) * 100.0, b).alias("gain"),
        better.alias("better"),
        F.try_divide(F.abs(a - b) * 100.0, F.least(a, b)).alias("improvement"),
    )


def pick_pair(
    metrics: DataFrame,
    first: str,
    second: str,
    metric: str,
    tie: str = "second",
    within: Sequence[str] = (),
) -> DataFrame:
    """Choose between two models; ``tie`` says who gets a draw: first, second or ``equal``."""
    a, b = F.col(f"{metric}_a"), F.col(f"{metric}_b")
    drawn = {"first": first, "second": second, "equal": "equal"}[tie]
    choice = F.when(a > b, F.lit(first)).when(a < b, F.lit(second)).when(a == b, F.lit(drawn))
    return _pair(metrics, first, second, [metric], within).select(*within, choice.alias("choice"))


def verdicts(
    metrics: DataFrame, first: str, second: str, texts: Mapping[str, tuple[str, str]], within: Sequence[str] = ()
) -> DataFrame:
    """A sentence per metric: the first text where the first model is higher, else the second."""
    parts = [
        F.struct(
            F.lit(m).alias("metric"),
            F.when(F.col(f"{m}_a") > F.col(f"{m}_b"), F.lit(t[0])).otherwise(F.lit(t[1])).alias("verdict"),
        )
        for m, t in texts.items()
    ]
    return _pair(metrics, first, second, list(texts), within).select(*within, F.inline(F.array(*parts)))


def cost_benefit(metrics: DataFrame, value_per_tp: int = 500, cost_per_fp: int = 50) -> DataFrame:
    """Positives, how many were caught and missed, value saved, cost of false alarms, net."""
    saved = F.col("tp") * F.lit(value_per_tp)
    cost = F.col("fp") * F.lit(cost_per_fp)
    keys = [c for c in metrics.columns if c not in ("tn", "fp", "fn", "tp", *METRICS)]
    return metrics.select(
        *keys,
        (F.col("tp") + F.col("fn")).alias("positives"),
        F.col("tp").alias("caught"),
        F.col("fn").alias("missed"),
        saved.alias("saved"),
        cost.alias("cost"),
        (saved - cost).alias("net"),
    )


def point_difference(
    metrics: DataFrame, first: str, second: str, names: Sequence[str] = ("recall", "precision"), within: Sequence[str] = ()
) -> DataFrame:
    """Difference of two models in percentage points, signed and absolute."""
    parts = [
        F.struct(
            F.lit(m).alias("metric"),
            ((F.col(f"{m}_a") - F.col(f"{m}_b")) * 100.0).alias("points"),
            F.abs((F.col(f"{m}_a") - F.col(f"{m}_b")) * 100.0).alias("abs_points"),
        )
        for m in names
    ]
    return _pair(metrics, first, second, names, within).select(*within, F.inline(F.array(*parts)))
