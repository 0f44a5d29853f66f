"""Ranks and running sums without a window over the whole table.

Rows are spread over buckets whose bounds are literals in the plan. Totals per
bucket are few, so their running sum is cheap; each bucket adds the sum of those
before it to its own running sum. The bounds decide only how even the work is,
never the result, and nothing depends on which partition a row sits in.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET_ROWS = 250_000
MAX_BITS = 16
FEW_BUCKETS = 256
MAX_BUCKETS = 2_048
SAMPLE_SHARE = 0.125


def bucket_bits(n_rows: int, bucket_rows: int = BUCKET_ROWS, max_bits: int = MAX_BITS) -> int:
    """How many leading bits of a 32-bit draw to use, so that a bucket holds about ``bucket_rows``."""
    return min(max_bits, max(0, (max(n_rows, 1) - 1) // bucket_rows).bit_length())


def draw_bucket(draw: Column, bits: int) -> Column:
    """Bucket of a draw in [0, 2^32). Draws of unique keys are even, so buckets are too."""
    return F.shiftright(draw, 32 - bits)


def with_rank(
    df: DataFrame, draw: str, key: str, n_rows: int, rank: str = "rank", bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Add the position, from 0, of each row in the order of (draw, key)."""
    bits = bucket_bits(n_rows, bucket_rows)
    if bits == 0:
        order = W.partitionBy(F.lit(0)).orderBy(draw, key)
        return df.withColumn(rank, F.row_number().over(order).cast("bigint") - 1)
    rows = df.withColumn("_bucket", draw_bucket(F.col(draw), bits))
    totals = rows.groupBy("_bucket").agg(F.count("*").alias("_n"))
    # At most 2^MAX_BITS totals.
    before = F.sum("_n").over(W.partitionBy(F.lit(0)).orderBy("_bucket")) - F.col("_n")
    base = totals.select("_bucket", before.alias("_base"))
    inside = F.row_number().over(W.partitionBy("_bucket").orderBy(draw, key)).cast("bigint")
    return rows.join(base, "_bucket").withColumn(rank, F.col("_base") + inside - 1).drop("_bucket", "_base")


def score_bounds(df: DataFrame, score: str, bucket_rows: int = BUCKET_ROWS) -> list[float]:
    """Ascending cut points that part the rows into even buckets of scores.

    Read off a sample: the points need only be roughly even, any will do for the
    result.
    """
    drawn = df.select(F.col(score).cast("double").alias("x"), F.rand(42).alias("r"))
    sampled = F.when(F.col("r") < SAMPLE_SHARE, F.col("x"))

    def points(parts: int):
        probes = F.array(*[F.lit(i / parts) for i in range(1, parts)])
        return F.percentile_approx(sampled, probes, 8 * parts).alias("q")

    row = drawn.agg(F.count("x").alias("n"), points(FEW_BUCKETS)).first()
    buckets, parts = min(MAX_BUCKETS, -(-row["n"] // bucket_rows)), FEW_BUCKETS
    if buckets <= 1 or row["q"] is None:
        return []
    if buckets > FEW_BUCKETS:
        row, parts = drawn.agg(points(MAX_BUCKETS)).first(), MAX_BUCKETS
    return sorted({row["q"][int(i * parts / buckets) - 1] for i in range(1, buckets)})


def with_score_bucket(df: DataFrame, score: str, bounds: Sequence[float], to: str) -> DataFrame:
    """Add the bucket number of each score, by binary search over the cut points."""
    if not bounds:
        return df.withColumn(to, F.lit(0))
    splits = [-math.inf, *bounds, math.inf]
    bucketizer = Bucketizer(splits=splits, inputCol=score, outputCol=to, handleInvalid="keep")
    return bucketizer.transform(df).withColumn(to, F.col(to).cast("int"))
