"""Random forests whose classes are weighted anew in the bootstrap sample of every tree.

How often a row is in the sample of a tree is a Poisson draw by hash of (key, tree), so samples follow the rows
alone. Every draw is made once and kept with its row, a byte per tree. The classes of each sample are counted in
one pass for all trees. A tree is then a ``pyspark.ml`` forest of
one tree without sampling, on those rows weighted by copies x class weight; several are fitted at a time. The
saved trees are joined into one saved forest, which loads as a usual ``RandomForestClassificationModel``.

Rows are dealt by key into a number of partitions that follows from their number, and ordered there; weights are
multiples of 2**-20, whose sums are exact in any order. So the same rows give the same model, however they come.
The price is a pass over the rows per tree and level where Spark's own forest shares one among trees.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomekit.functions import draw, map_values
from outcomekit.operators.features import MAX_CLASSES
from outcomekit.operators.models import load_model, save_model
from outcomekit.session import new_stage

#: Copies of one row above which the chance of more is below one in 2**32.
MOST_COPIES = 12
#: Weights are multiples of one by this.
GRAIN = 1 << 20


def poisson_cuts() -> list[int]:
    """Draws of 32 bits from which on a row has at least 1, 2, .. copies, at one copy a row on average."""
    share = [math.exp(-1) / math.factorial(k) for k in range(MOST_COPIES)]
    return [int(sum(share[: k + 1]) * 2**32) for k in range(MOST_COPIES)]


def copies(drawn: Column | str) -> Column:
    """Number of copies that a draw stands for."""
    drawn = F.col(drawn) if isinstance(drawn, str) else drawn
    cuts = poisson_cuts()
    # Small numbers come first, as most rows end there.
    out = F.when(drawn < F.lit(cuts[0]), F.lit(0))
    for n, c in enumerate(cuts[1:], 1):
        out = out.when(drawn < F.lit(c), F.lit(n))
    return out.when(drawn.isNotNull(), F.lit(len(cuts)))


def with_copies(rows: DataFrame, key: str, trees: int, seed: int) -> DataFrame:
    """``rows`` and, as ``_copies``, how often each is in the sample of every tree.

    To be persisted: a reader that filters on a number of copies would make its draw anew for each cut.
    """
    drawn = rows.select("*", *[draw(key, seed, f"tree {t}").alias(f"_draw_{t}") for t in range(trees)])
    numbers = F.array(*[copies(f"_draw_{t}").cast("tinyint") for t in range(trees)])
    return drawn.select(*[F.col(f"`{c}`") for c in rows.columns], numbers.alias("_copies"))


def class_weights(
    rows: DataFrame, key: str, label: str, trees: int, seed: int, balanced: bool = True
) -> list[dict[float, float]]:
    """For each tree the weight n / (k x n_c) of the k classes in its sample; a class not in it has none."""
    return _weights_of(with_copies(rows.select(key, label), key, trees, seed), label, trees, balanced)


def _weights_of(sampled: DataFrame, label: str, trees: int, balanced: bool) -> list[dict[float, float]]:
    drawn = [F.sum(F.col("_copies")[t].cast("int")).alias(f"_{t}") for t in range(trees)]
    counted = sampled.groupBy(F.col(label).alias("_class")).agg(*drawn)
    counts = counted.limit(MAX_CLASSES + 1).collect()
    if len(counts) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    out = []
    for t in range(trees):
        held = {float(r["_class"]): r[f"_{t}"] for r in counts if r[f"_{t}"]}
        n = sum(held.values())
        even = {c: n / (len(held) * m) if balanced else 1.0 for c, m in held.items()}
        out.append({c: max(1, math.floor(w * GRAIN + 0.5)) / GRAIN for c, w in even.items()})
    return out


def fit_bootstrap_forest(
    train: DataFrame,
    key: str,
    features: str = "features",
    label: str = "label",
    trees: int = 100,
    depth: int = 10,
    seed: int = 42,
    balanced: bool = True,
    subset: str = "auto",
    rows_each: int = 100_000,
    parallelism: int = 8,
) -> RandomForestClassificationModel:
    """Forest of trees on bootstrap samples, each with the class weights of its own sample.

    ``key`` tells rows apart. ``subset`` says how many features a split is chosen from (``auto``: the square
    root of their number), ``parallelism`` how many trees are fitted at a time. Rows without a label are left
    out; a table without labelled rows, or one whose rows no sample holds, is refused.
    """
    spark = train.sparkSession
    rows = train.select(key, F.col(label).cast("double").alias(label), features).where(F.col(label).isNotNull())
    n = rows.count()
    if n == 0:
        raise ValueError("no labelled rows to fit on")
    # Every tree reads the rows again; lost blocks are made anew from the source.
    rows = rows.repartition(max(1, -(-n // rows_each)), key).sortWithinPartitions(key)
    rows = with_copies(rows, key, trees, seed).persist()
    try:
        weights = _weights_of(rows, label, trees, balanced)
        if not any(weights):
            raise ValueError("no sample holds a row: more rows or another seed")
        # Stated, as a sample may lack the last class.
        classes = {"ml_attr": {"type": "nominal", "num_vals": 1 + int(max(c for held in weights for c in held))}}

        def fit(t: int) -> str | None:
            if not weights[t]:
                return None
            times = F.col("_copies")[t]
            mine = rows.where(times > 0).withColumn("_weight", times * map_values(label, weights[t]))
            mine = mine.drop("_copies").withMetadata(label, classes)
            estimator = RandomForestClassifier(
                featuresCol=features, labelCol=label, weightCol="_weight", numTrees=1, bootstrap=False, maxDepth=depth,
                featureSubsetStrategy="sqrt" if subset == "auto" else subset, seed=seed * 10_007 + t,
            )
            path, _ = new_stage(spark)
            save_model(estimator.fit(mine), path)
            return path

        with ThreadPoolExecutor(parallelism) as pool:
            paths = list(pool.map(inheritable_thread_target(spark)(fit), range(trees)))
    finally:
        rows.unpersist()
    return join_forests([p for p in paths if p], spark)


def join_forests(paths: Sequence[str], spark: SparkSession) -> RandomForestClassificationModel:
    """One forest of the trees of several saved ones, in their order.

    The trees' nodes stay a table; forests that saw different numbers of classes or features are refused.
    """
    about = [json.loads(spark.read.text(f"{p}/metadata").first()[0]) for p in paths]
    for size in ("numFeatures", "numClasses"):
        if len({a[size] for a in about}) > 1:
            raise ValueError(f"forests differ in {size}")
    first, path = [0], new_stage(spark)[0]
    for a in about:
        first.append(first[-1] + a["numTrees"])
    for part in ("data", "treesMetadata"):
        # Both tables hold the number of the tree in their first column.
        saved = [spark.read.parquet(f"{p}/{part}") for p in paths]
        moved = [
            df.withColumn(df.columns[0], (F.col(df.columns[0]) + F.lit(shift)).cast("int"))
            for df, shift in zip(saved, first, strict=False)
        ]
        reduce(DataFrame.unionByName, moved).coalesce(8).write.parquet(f"{path}/{part}")
    joined = about[0] | {"numTrees": first[-1]}
    joined["paramMap"] = joined["paramMap"] | {"numTrees": first[-1]}
    text = spark.createDataFrame([(json.dumps(joined),)], "value string")
    text.coalesce(1).write.text(f"{path}/metadata")
    return load_model(path, spark)
