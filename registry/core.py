"""Registration of queries and the tables they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomekit.sources import customer_outcomes, read_parquet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SEED = 42


def query(name: str, oracle: str | None = None):
    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["customer", "orders", "lineitem", "nation", "region"]
    return customer_outcomes(*[table(spark, sf_dir, n) for n in names])


# The same table in SQL. Starts a WITH list: a query adds further parts after it.
CUSTOMERS_SQL = """
cut AS (SELECT max(o_orderdate) - INTERVAL 320 DAY AS c FROM orders),
returned AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R'),
pre AS (
  SELECT o.*, r.l_orderkey IS NOT NULL AS has_r,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders o LEFT JOIN returned r ON o.o_orderkey = r.l_orderkey
  WHERE o.o_orderdate < (SELECT c FROM cut)),
per_customer AS (
  SELECT o_custkey, min(o_orderdate) AS first_order,
         sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total,
         max(CASE WHEN rn = 1 THEN o_orderpriority END) AS contract,
         bool_or(o_orderstatus = 'P') AS any_p, bool_or(has_r) AS any_r
  FROM pre GROUP BY o_custkey),
kept AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= (SELECT c FROM cut)),
customers0 AS (
  SELECT c.*, p.*, r_name,
         CASE WHEN p.first_order IS NULL THEN 0
              ELSE CAST(floor(date_diff('day', p.first_order, (SELECT c FROM cut)) / 30.0) AS INTEGER)
         END AS tenure,
         k.o_custkey IS NOT NULL AS is_kept
  FROM customer c
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN per_customer p ON p.o_custkey = c_custkey
  LEFT JOIN kept k ON k.o_custkey = c_custkey),
customers AS (
  SELECT c_custkey AS customer_id, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS senior,
         c_mktsegment AS segment, r_name AS region, tenure,
         coalesce(CAST(total AS DOUBLE) / greatest(tenure, 1), 0.0::DOUBLE) AS monthly_charges,
         coalesce(CAST(total AS VARCHAR), ' ') AS total_charges_raw,
         coalesce(contract, 'No orders') AS contract,
         CASE WHEN any_p THEN 'Yes' ELSE 'No' END AS paperless,
         CASE WHEN first_order IS NULL THEN 'No orders' WHEN any_r THEN 'Yes' ELSE 'No' END AS has_returns,
         CASE WHEN is_kept THEN 'No' ELSE 'Yes' END AS churn
  FROM customers0)
"""


def draw_sql(key: str, tag: str, seed: int = SEED) -> str:
    """SQL text of the same draw the library makes for a key."""
    return f"(('0x' || substr(md5(concat_ws('|', {key}, '{seed}', {tag})), 1, 8))::BIGINT)"


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line scored by four fixed rules for 'costs more than 50,000'.

    One row per line and model: the long form that evaluation works on.
    """
    line = table(spark, sf_dir, "lineitem").where(F.col("l_quantity") > 0)
    quantity = F.col("l_quantity") / F.lit(50.0)
    discount = F.col("l_discount") * F.lit(10.0)
    unit = F.least(F.lit(1.0), F.col("l_extendedprice") / F.col("l_quantity") / F.lit(4000.0))
    models = F.array(
        F.struct(F.lit("discount").alias("model"), discount.alias("score")),
        F.struct(F.lit("mixed").alias("model"), (quantity * F.lit(0.5) + unit * F.lit(0.5)).alias("score")),
        F.struct(F.lit("quantity").alias("model"), quantity.alias("score")),
        F.struct(F.lit("unit_price").alias("model"), unit.alias("score")),
    )
    return line.select(
        F.col("l_returnflag").alias("segment"),
        (F.col("l_extendedprice") > 50000.0).cast("int").alias("label"),
        F.inline(models),
    ).withColumn("prediction", (F.col("score") > 0.5).cast("int"))


SCORED_SQL = """
base AS (
  SELECT l_returnflag AS segment, CASE WHEN l_extendedprice > 50000 THEN 1 ELSE 0 END AS label,
         l_quantity / 50.0::DOUBLE AS q, l_discount * 10.0::DOUBLE AS d,
         least(1.0::DOUBLE, l_extendedprice / l_quantity / 4000.0::DOUBLE) AS u
  FROM lineitem WHERE l_quantity > 0),
scored0 AS (
  SELECT segment, label, 'discount' AS model, d AS score FROM base
  UNION ALL SELECT segment, label, 'mixed', q * 0.5::DOUBLE + u * 0.5::DOUBLE FROM base
  UNION ALL SELECT segment, label, 'quantity', q FROM base
  UNION ALL SELECT segment, label, 'unit_price', u FROM base),
scored AS (SELECT *, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction FROM scored0)
"""
