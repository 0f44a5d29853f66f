"""Oversampling of rare classes with synthetic neighbors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outcomekit.functions import DRAW_SPAN, draw
from outcomekit.operators.features import MAX_CLASSES
from outcomekit.operators.neighbors import LEAF_ROWS, nearest_neighbors
from outcomekit.operators.pivots import nearest_by_pivots
from outcomekit.operators.ranking import BUCKET_ROWS, with_rank
from outcomekit.session import stage

# A vector shared by more than this part of a class is dealt with on its own.
HOT_SHARE = 1_000


def smote(
    df: DataFrame,
    key: str,
    label: str,
    features: Sequence[str],
    k: int = 5,
    seed: int = 42,
    leaf_rows: int = LEAF_ROWS,
    bucket_rows: int = BUCKET_ROWS,
    index: str = "boxes",
) -> DataFrame:
    """Grow every class to the size of the largest one.

    A synthetic row lies between a drawn row of the class and one of its ``k``
    nearest neighbors in the class. Returns key, label, features and
    ``is_synthetic``; synthetic rows have no key. Pass training rows only. Raises on
    features without a number, which have no neighbors. ``index`` is how neighbors are found, with one
    result: by bounding ``boxes``, or by distances to ``pivots`` where there are many features.
    """
    features = list(features)
    base = stage(df.select(key, label, *[F.col(f"`{c}`").cast("double").alias(c) for c in features]))
    unknown = reduce(or_, [F.col(f"`{c}`").isNull() | F.isnan(f"`{c}`") for c in features], F.lit(False))
    counts = base.groupBy(label).agg(F.count("*").alias("n"), F.count_if(unknown).alias("bad"))
    counts = counts.limit(MAX_CLASSES + 1).collect()
    if any(r["bad"] for r in counts):
        raise ValueError("features hold nulls or NaN: fill or drop them first")
    if len(counts) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    largest = max((r["n"] for r in counts), default=0)
    out = base.withColumn("is_synthetic", F.lit(False))
    for row in sorted(counts, key=lambda r: r[label]):
        missing = largest - row["n"]
        if missing:
            made = _synthetic(base, key, label, row[label], row["n"], missing, features, k, seed, leaf_rows, bucket_rows, index)
            out = out.unionByName(made)
    return out


def _synthetic(base, key, label, value, m, missing, features, k, seed, leaf_rows, bucket_rows, index) -> DataFrame:
    if m < 2:
        raise ValueError(f"class {value} has one row: no neighbor to move towards")
    k, width, spark = min(k, m - 1), len(features), base.sparkSession
    rows = (
        base.where(F.col(label) == F.lit(value))
        .select(F.col(key).alias("id"), F.array(*[F.col(f"`{c}`") for c in features]).alias("vec"))
        .withColumn("u", draw("id", seed, "rank"))
    )
    rows = with_rank(rows, "u", "id", m, bucket_rows=bucket_rows).drop("u")
    # Copies. A vector with more than k copies has only copies among its k nearest, so a
    # synthetic row is one more copy. At most HOT_SHARE vectors can be this frequent.
    hot_vectors = (
        rows.groupBy("vec")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > max(k, m // HOT_SHARE))
        .select("vec", F.lit(True).alias("hot"))
        .toArrow()
    )
    if hot_vectors.num_rows:
        rows = rows.join(F.broadcast(spark.createDataFrame(hot_vectors)), "vec", "left")
        rows = rows.withColumn("hot", F.coalesce("hot", F.lit(False)))
    else:
        rows = rows.withColumn("hot", F.lit(False))
    rows = stage(rows)
    share = lambda tag: draw("no", seed, f"{tag}|{value}") / F.lit(float(DRAW_SPAN))
    drawn = spark.range(missing).withColumnRenamed("id", "no").select(
        F.floor(share("base") * F.lit(float(m))).cast("bigint").alias("rank"),
        F.floor(share("neighbor") * F.lit(float(k))).cast("int").alias("pick"),
        share("gap").alias("gap"),
    )
    points = rows.where(~F.col("hot")).select("id", "vec")
    if hot_vectors.num_rows:
        # Any query needs no more than k copies of a vector: those of lowest id.
        copy = F.row_number().over(W.partitionBy("vec").orderBy("id"))
        few = rows.where("hot").select("id", "vec").withColumn("rk", copy).where(F.col("rk") <= k)
        points = points.unionByName(few.drop("rk"))
    wanted = rows.where(~F.col("hot")).join(drawn.select("rank").distinct(), "rank", "left_semi").select("id", "vec")
    if index == "pivots":
        near = nearest_by_pivots(wanted, points, k, width, seed=seed)
    else:
        near = nearest_neighbors(wanted, points, k, width, leaf_rows, seed, at_most=m)
    pairs = (
        drawn.join(rows.select("rank", "id", "vec"), "rank")
        .join(near, "id", "left")
        .withColumn("near", F.coalesce(F.try_element_at("neighbors", F.col("pick") + 1)["near_vec"], F.col("vec")))
    )
    moved = lambda i: F.col("vec")[i] + F.col("gap") * (F.col("near")[i] - F.col("vec")[i])
    return pairs.select(
        F.lit(None).cast(base.schema[key].dataType).alias(key),
        F.lit(value).cast(base.schema[label].dataType).alias(label),
        *[moved(i).alias(c) for i, c in enumerate(features)],
        F.lit(True).alias("is_synthetic"),
    )
