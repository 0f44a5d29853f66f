"""One row per customer with an outcome, derived from the order tables.

Features use orders before the cutoff, the outcome orders on or after it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUTCOME_DAYS = 320
DAYS_PER_MONTH = 30

CUSTOMER_SCHEMA = (
    "customer_id bigint, senior int, segment string, region string, tenure int, "
    "monthly_charges double, total_charges_raw string, contract string, "
    "paperless string, has_returns string, churn string"
)


def outcome_cutoff(orders: DataFrame, days: int = OUTCOME_DAYS) -> dt.datetime:
    last = orders.agg(F.max("o_orderdate")).first()[0]
    return last - dt.timedelta(days=days)


def customer_outcomes(
    customer: DataFrame,
    orders: DataFrame,
    lineitem: DataFrame,
    nation: DataFrame,
    region: DataFrame,
    cutoff: dt.datetime | None = None,
) -> DataFrame:
    """Build the customer table.

    Returned lines are reduced to distinct order keys, and orders to one row per
    customer, before anything is joined on those keys: both reductions combine on
    the map side, so one order or customer with a third of all rows costs no more
    than any other.
    """
    cut = F.lit(cutoff or outcome_cutoff(orders))
    returned = (
        lineitem.where(F.col("l_returnflag") == "R")
        .select(F.col("l_orderkey").alias("o_orderkey"))
        .distinct()
        .withColumn("returned", F.lit(True))
    )
    before = F.col("o_orderdate") < cut
    latest = F.max(
        F.when(before, F.struct("o_orderdate", "o_orderkey", "o_orderpriority"))
    )
    per_customer = (
        orders.join(returned, "o_orderkey", "left")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.min(F.when(before, F.col("o_orderdate"))).alias("first_order"),
            F.sum(F.when(before, F.col("o_totalprice").cast("decimal(12,2)"))).alias("total"),
            latest.alias("latest"),
            F.max(F.when(before, F.col("o_orderstatus") == "P")).alias("any_p"),
            F.max(F.when(before, F.coalesce("returned", F.lit(False)))).alias("any_r"),
            F.max(~before).alias("kept"),
        )
    )
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("region")
    )
    had_orders = F.col("first_order").isNotNull()
    tenure = F.when(
        had_orders, F.floor(F.datediff(cut, "first_order") / F.lit(DAYS_PER_MONTH))
    ).otherwise(0)
    yes_no = lambda c: F.when(c, "Yes").otherwise("No")
    return (
        customer.join(places, "c_nationkey")
        .join(per_customer, "c_custkey", "left")
        .withColumn("tenure", tenure.cast("int"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            (F.col("c_acctbal") < 0).cast("int").alias("senior"),
            F.col("c_mktsegment").alias("segment"),
            "region",
            "tenure",
            F.coalesce(
                F.col("total").cast("double") / F.greatest("tenure", F.lit(1)).cast("double"),
                F.lit(0.0),
            ).alias("monthly_charges"),
            F.coalesce(F.col("total").cast("string"), F.lit(" ")).alias("total_charges_raw"),
            F.coalesce(F.col("latest.o_orderpriority"), F.lit("No orders")).alias("contract"),
            yes_no(F.coalesce("any_p", F.lit(False))).alias("paperless"),
            F.when(~had_orders, "No orders").otherwise(yes_no(F.col("any_r"))).alias("has_returns"),
            yes_no(~F.coalesce("kept", F.lit(False))).alias("churn"),
        )
    )
