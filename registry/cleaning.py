"""Projections, filters, predicates and row cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from outcomekit.functions import (
    any_substring,
    first_match,
    fixed_decimals,
    lenient_double,
    map_values,
    percent_text,
    threshold_label,
)
from outcomekit.operators import clean
from outcomekit.session import stage
from registry.core import CUSTOMERS_SQL, SCORED_SQL, customers, query, scored_lines, table

NUMBER_SQL = r"regexp_full_match(lower({c}), '\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*')"
LENIENT_SQL = "CASE WHEN " + NUMBER_SQL + " THEN TRY_CAST({c} AS DOUBLE) END"

REPLACED = {"No orders": "No"}


@query(
    "p01_drop_column",
    "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def drop_column(spark, sf):
    return clean.drop_columns(table(spark, sf, "customer"), "c_name", "not_there")


@query("p02_column_subset", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def column_subset(spark, sf):
    return clean.pick_columns(table(spark, sf, "orders"), ["o_orderkey", "o_totalprice", "o_orderpriority"])


@query(
    "p03_equality_filter",
    f"WITH {CUSTOMERS_SQL} SELECT customer_id, tenure FROM customers WHERE churn = 'Yes'",
)
def equality_filter(spark, sf):
    return clean.equals_filter(customers(spark, sf), "churn", "Yes", ["customer_id", "tenure"])


@query(
    "p04_conditional_count",
    """SELECT l_linestatus, count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
              count(*) FILTER (WHERE l_returnflag <> 'R') AS n_other
       FROM lineitem GROUP BY l_linestatus""",
)
def conditional_count(spark, sf):
    returned = F.col("l_returnflag") == "R"
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_linestatus")
        .agg(F.count_if(returned).alias("n_returned"), F.count_if(~returned).alias("n_other"))
    )


@query(
    "p05_isin_filter",
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
)
def isin_filter(spark, sf):
    kept = clean.member_filter(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])
    return kept.select("o_orderkey", "o_orderpriority")


@query(
    "p05_isin_table",
    """SELECT l_orderkey, l_linenumber FROM lineitem
       WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#2')""",
)
def isin_table(spark, sf):
    wanted = table(spark, sf, "part").where(F.col("p_brand") == "Brand#2").select("p_partkey")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return clean.member_filter(lines, "l_partkey", wanted).select("l_orderkey", "l_linenumber")


@query(
    "p06_any_substring",
    """SELECT p_partkey, p_name FROM part
       WHERE contains(p_name, 'ring') OR contains(p_name, 'gear') OR contains(p_name, 'Bolt')""",
)
def substring_filter(spark, sf):
    return (
        table(spark, sf, "part")
        .where(any_substring("p_name", ["ring", "gear", "Bolt"]))
        .select("p_partkey", "p_name")
    )


@query(
    "p07_select_by_type",
    f"""WITH {CUSTOMERS_SQL} SELECT customer_id, senior, tenure, monthly_charges FROM customers""",
)
def select_by_type(spark, sf):
    df = customers(spark, sf)
    return df.select(*clean.columns_of_kind(df, "numeric"))


@query(
    "p07_select_by_exclusion",
    f"""WITH {CUSTOMERS_SQL}
        SELECT segment, region, contract, paperless, has_returns FROM customers""",
)
def select_by_exclusion(spark, sf):
    df = customers(spark, sf)
    return df.select(*clean.columns_of_kind(df, "text", exclude=["churn", "total_charges_raw"]))


@query(
    "p08_lenient_cast",
    f"""WITH {CUSTOMERS_SQL}
        SELECT customer_id, {LENIENT_SQL.format(c="total_charges_raw")} AS total_charges,
               {LENIENT_SQL.format(c="contract")} AS contract_number FROM customers""",
)
def lenient_cast(spark, sf):
    return customers(spark, sf).select(
        "customer_id",
        lenient_double("total_charges_raw").alias("total_charges"),
        lenient_double("contract").alias("contract_number"),
    )


@query(
    "p09_trim_cast",
    f"""WITH {CUSTOMERS_SQL}, padded AS (
          SELECT customer_id, trim('  ' || total_charges_raw || ' ') AS v FROM customers)
        SELECT customer_id, {LENIENT_SQL.format(c="v")} AS total_charges FROM padded""",
)
def trim_cast(spark, sf):
    padded = customers(spark, sf).withColumn(
        "padded", F.concat(F.lit("  "), "total_charges_raw", F.lit(" "))
    )
    cast = clean.lenient_numeric(padded, "padded", to="total_charges", trim=True)
    return cast.select("customer_id", "total_charges")


@query(
    "p10_median_fill",
    f"""WITH {CUSTOMERS_SQL}, num AS (
          SELECT customer_id, {LENIENT_SQL.format(c="total_charges_raw")} AS v FROM customers)
        SELECT customer_id, coalesce(v, (SELECT median(v) FROM num)) AS total_charges FROM num""",
)
def median_fill(spark, sf):
    numeric = clean.lenient_numeric(customers(spark, sf), "total_charges_raw", to="total_charges")
    numeric = stage(numeric.select("customer_id", "total_charges"))
    return clean.MedianFill.fit(numeric, ["total_charges"]).transform(numeric)


@query(
    "p11_drop_null_rows",
    f"""WITH {CUSTOMERS_SQL}, num AS (
          SELECT customer_id, {LENIENT_SQL.format(c="total_charges_raw")} AS total_charges,
                 CASE contract WHEN '1-URGENT' THEN 1 WHEN '5-LOW' THEN 5 WHEN '3-MEDIUM' THEN 3 END AS urgency
          FROM customers)
        SELECT * FROM num WHERE total_charges IS NOT NULL AND urgency IS NOT NULL""",
)
def drop_null_rows(spark, sf):
    df = customers(spark, sf).select(
        "customer_id",
        lenient_double("total_charges_raw").alias("total_charges"),
        map_values("contract", {"1-URGENT": 1, "5-LOW": 5, "3-MEDIUM": 3}).alias("urgency"),
    )
    return clean.drop_null_rows(df)


@query(
    "p12_drop_null_subset",
    f"""WITH {CUSTOMERS_SQL}, num AS (
          SELECT customer_id, {LENIENT_SQL.format(c="total_charges_raw")} AS total_charges,
                 CASE contract WHEN '1-URGENT' THEN 1 WHEN '5-LOW' THEN 5 END AS urgency
          FROM customers)
        SELECT * FROM num WHERE total_charges IS NOT NULL""",
)
def drop_null_subset(spark, sf):
    df = customers(spark, sf).select(
        "customer_id",
        lenient_double("total_charges_raw").alias("total_charges"),
        map_values("contract", {"1-URGENT": 1, "5-LOW": 5}).alias("urgency"),
    )
    return clean.drop_null_rows(df, ["total_charges"])


@query(
    "p13_value_map",
    f"""WITH {CUSTOMERS_SQL}
        SELECT customer_id, CASE churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS label,
               CASE has_returns WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS returns_flag
        FROM customers""",
)
def value_map(spark, sf):
    yes_no = {"Yes": 1, "No": 0}
    return customers(spark, sf).select(
        "customer_id",
        map_values("churn", yes_no).alias("label"),
        map_values("has_returns", yes_no).alias("returns_flag"),
    )


@query(
    "p14_value_replace",
    f"""WITH {CUSTOMERS_SQL}
        SELECT customer_id, CASE WHEN contract = 'No orders' THEN 'No' ELSE contract END AS contract,
               CASE WHEN has_returns = 'No orders' THEN 'No' ELSE has_returns END AS has_returns,
               paperless, churn
        FROM customers""",
)
def value_replace(spark, sf):
    df = customers(spark, sf).select("customer_id", "contract", "has_returns", "paperless", "churn")
    return clean.replace_values(df, REPLACED)


@query(
    "p15_cast_int",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS label,
              CAST(trunc(o_totalprice) AS INTEGER) AS whole_price FROM orders""",
)
def cast_int(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        (F.col("o_orderstatus") == "P").cast("int").alias("label"),
        F.col("o_totalprice").cast("int").alias("whole_price"),
    )


@query(
    "p16_threshold",
    f"""WITH {SCORED_SQL}
        SELECT model, count(*) AS n_rows, sum(CASE WHEN score > 0.5 THEN 1 ELSE 0 END)::BIGINT AS above,
               sum(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END)::BIGINT AS at_or_above,
               sum(CASE WHEN score > 0.4 THEN 1 ELSE 0 END)::BIGINT AS above_lower
        FROM scored GROUP BY model""",
)
def threshold(spark, sf):
    return (
        scored_lines(spark, sf)
        .groupBy("model")
        .agg(
            F.count("*").alias("n_rows"),
            F.sum(threshold_label("score")).alias("above"),
            F.sum(threshold_label("score", inclusive=True)).alias("at_or_above"),
            F.sum(threshold_label("score", 0.4)).alias("above_lower"),
        )
    )


PART_RULES = [
    (["ring"], "ring: check the seal"),
    (["bolt", "rod"], "fastener: check the thread"),
    (["gear"], "gear: check the teeth"),
    (["small"], "small part: check the count"),
    (["Widget"], "never: names are lower case"),
]
PART_DEFAULT = "other: no check"


@query(
    "p17_rule_chain",
    """SELECT p_partkey, CASE WHEN contains(p_name, 'ring') THEN 'ring: check the seal'
              WHEN contains(p_name, 'bolt') OR contains(p_name, 'rod') THEN 'fastener: check the thread'
              WHEN contains(p_name, 'gear') THEN 'gear: check the teeth'
              WHEN contains(p_name, 'small') THEN 'small part: check the count'
              ELSE 'other: no check' END AS advice FROM part""",
)
def rule_chain(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", first_match("p_name", PART_RULES, PART_DEFAULT).alias("advice")
    )


@query(
    "p18_number_format",
    """SELECT l_returnflag, printf('%.4f', CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE) / count(*)) AS fixed4,
              printf('%.1f%%', CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) * 100.0::DOUBLE) AS percent1,
              format('{:,}', CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT)) AS thousands
       FROM lineitem GROUP BY l_returnflag""",
)
def number_format(spark, sf):
    finished = F.sum((F.col("l_linestatus") == "F").cast("int")) / F.count("*")
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_returnflag")
        .agg(finished.alias("share"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
        .select(
            "l_returnflag",
            fixed_decimals("share").alias("fixed4"),
            percent_text("share").alias("percent1"),
            F.format_number("quantity", 0).alias("thousands"),
        )
    )
