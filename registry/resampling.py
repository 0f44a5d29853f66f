"""Oversampling and what is fitted on its result."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomekit.operators import features
from outcomekit.operators.pivots import nearest_by_pivots
from outcomekit.operators.resample import smote
from registry.core import draw_sql, query, table
from registry.preparing import FILLED_SQL, filled
from registry.profiling import rounded

SMOTE_COLUMNS = ["senior", "tenure", "monthly_charges", "total_charges", "paperless_Yes"]


def share_sql(tag: str) -> str:
    key = "no"
    return f"({draw_sql(key, repr(tag))} / 4294967296.0::DOUBLE)"


_DISTANCE = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in SMOTE_COLUMNS)
_MOVED = ", ".join(f"a.{c} + s.gap * (b.{c} - a.{c}) AS {c}" for c in SMOTE_COLUMNS)
_COLUMNS = ", ".join(SMOTE_COLUMNS)

SMOTE_SQL = (
    FILLED_SQL
    + f""", prepared AS (SELECT customer_id, label, split, senior::DOUBLE AS senior, tenure::DOUBLE AS tenure,
        monthly_charges, total_charges, CASE WHEN paperless = 'Yes' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS paperless_Yes
      FROM filled),
    train AS (SELECT * FROM prepared WHERE split = 'train'),
    rare AS (SELECT *, row_number() OVER (ORDER BY {draw_sql('customer_id', "'rank'")}, customer_id) - 1 AS rank,
        count(*) OVER () AS m FROM train WHERE label = 1),
    near AS (SELECT a.customer_id, b.customer_id AS near_id, row_number() OVER (
          PARTITION BY a.customer_id ORDER BY {_DISTANCE}, b.customer_id) AS rk
        FROM rare a JOIN rare b ON a.customer_id <> b.customer_id),
    drawn AS (SELECT no, floor({share_sql('base|1')} * (SELECT any_value(m) FROM rare))::BIGINT AS rank,
        floor({share_sql('neighbor|1')} * 5.0::DOUBLE)::INTEGER AS pick, {share_sql('gap|1')} AS gap
        FROM (SELECT unnest(range(0, (SELECT sum(CASE WHEN label = 0 THEN 1 ELSE -1 END) FROM train)::BIGINT)) AS no)),
    resampled AS (
        SELECT customer_id, label, {_COLUMNS}, false AS is_synthetic FROM train
        UNION ALL
        SELECT NULL, 1, {_MOVED}, true FROM drawn s JOIN rare a ON a.rank = s.rank
        JOIN near n ON n.customer_id = a.customer_id AND n.rk = s.pick + 1
        JOIN rare b ON b.customer_id = n.near_id)
"""
)


def prepared(spark, sf):
    df = filled(spark, sf)
    df = df.withColumn("paperless_Yes", F.when(F.col("paperless") == "Yes", 1.0).otherwise(0.0))
    return df.select("customer_id", "label", "split", *[F.col(c).cast("double").alias(c) for c in SMOTE_COLUMNS])


def resampled_train(df, **options):
    train = df.where(F.col("split") == "train")
    return smote(train, "customer_id", "label", SMOTE_COLUMNS, **options)



@query("f12_smote", f"WITH {SMOTE_SQL} SELECT customer_id, label, {_COLUMNS}, is_synthetic FROM resampled")
def smote_rows(spark, sf):
    # Both sides do the same steps in the same order, so the figures agree to the last digit.
    return resampled_train(prepared(spark, sf))


@query("f12_smote_small_cells", f"WITH {SMOTE_SQL} SELECT customer_id, label, {_COLUMNS}, is_synthetic FROM resampled")
def smote_small_cells(spark, sf):
    # So that the search across cells is used on any test size.
    return resampled_train(prepared(spark, sf), leaf_rows=64)


@query("f12_smote_pivots", f"WITH {SMOTE_SQL} SELECT customer_id, label, {_COLUMNS}, is_synthetic FROM resampled")
def smote_pivots(spark, sf):
    # The same neighbors, found by distances to pivots.
    return resampled_train(prepared(spark, sf), index="pivots")


@query(
    "f12_neighbors_pivots",
    """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
       pairs AS (
         SELECT a.vec_id, b.vec_id AS near_id,
                list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS gap
         FROM v a JOIN v b ON a.vec_id <> b.vec_id),
       ranked AS (SELECT vec_id, round(gap, 6) AS distance, row_number() OVER (PARTITION BY vec_id ORDER BY gap) AS rk FROM pairs)
       SELECT vec_id, rk, distance FROM ranked WHERE rk <= 5""",
)
def neighbors_pivots(spark, sf):
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    width = F.size("vec")
    near = nearest_by_pivots(rows, rows, 5, rows.agg(F.max(width)).first()[0] or 0)
    each = near.select(F.col("id").alias("vec_id"), F.posexplode("neighbors"))
    return rounded(each.select("vec_id", (F.col("pos") + 1).cast("bigint").alias("rk"), F.col("col.distance").alias("distance")), "distance")


@query(
    "f12_smote_counts",
    f"WITH {SMOTE_SQL} SELECT label, is_synthetic, count(*) AS n FROM resampled GROUP BY ALL",
)
def smote_counts(spark, sf):
    return resampled_train(prepared(spark, sf)).groupBy("label", "is_synthetic").agg(F.count("*").alias("n"))


@query(
    "f07_standardize_resampled",
    f"""WITH {SMOTE_SQL}, stats AS (SELECT {", ".join(
        f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS s_{c}" for c in SMOTE_COLUMNS)} FROM resampled)
        SELECT customer_id, split, {", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in SMOTE_COLUMNS)}
        FROM prepared, stats""",
)
def standardize_resampled(spark, sf):
    df = prepared(spark, sf)
    scaler = features.Standardize.fit(resampled_train(df), SMOTE_COLUMNS)
    return rounded(scaler.transform(df.select("customer_id", "split", *SMOTE_COLUMNS)), *SMOTE_COLUMNS)
