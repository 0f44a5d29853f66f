"""Profiles, sorts and top-k."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from outcomekit.functions import any_substring, lenient_double, map_values
from outcomekit.operators import profile, topk
from outcomekit.operators.clean import MedianFill
from outcomekit.session import scratch_dir, stage
from outcomekit.sources import CUSTOMER_SCHEMA, read_csv, write_csv
from outcomekit.sources.checked import read_csv_checked
from registry.core import CUSTOMERS_SQL, customers, query, table

YES_NO = {"Yes": 1, "No": 0}

LABELED_SQL = (
    CUSTOMERS_SQL
    + ", labeled AS (SELECT *, CASE churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS label, "
    + "TRY_CAST(nullif(trim(total_charges_raw), '') AS DOUBLE) AS total_charges FROM customers)"
)


def labeled(spark, sf):
    return (
        customers(spark, sf)
        .withColumn("label", map_values("churn", YES_NO))
        .withColumn("total_charges", lenient_double("total_charges_raw"))
    )


def rounded(df, *cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def _scratch_path(spark, name):
    return os.path.join(scratch_dir(spark), f"{name}-{uuid.uuid4().hex}")


@query(
    "s01_csv_scan",
    f"""WITH {CUSTOMERS_SQL} SELECT region, contract, count(*) AS n, sum(tenure)::BIGINT AS months,
           count(*) FILTER (WHERE total_charges_raw = ' ') AS n_blank
        FROM customers GROUP BY region, contract""",
)
def csv_scan(spark, sf):
    path = _scratch_path(spark, "customers-csv")
    write_csv(customers(spark, sf), path)
    scanned = read_csv(spark, path, CUSTOMER_SCHEMA, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return scanned.groupBy("region", "contract").agg(
        F.count("*").alias("n"),
        F.sum("tenure").alias("months"),
        F.count_if(F.trim(F.coalesce("total_charges_raw", F.lit(""))) == "").alias("n_blank"),
    )


@query(
    "s01_checked_scan",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_custkey + 0.5::DOUBLE ELSE o_custkey::DOUBLE END AS o_custkey,
          CASE WHEN o_orderpriority = '1-URGENT' THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS price
        FROM orders""",
)
def checked_scan(spark, sf):
    """Keys that are whole numbers or not, and prices with words among them, found out from few lines."""
    half = F.when(F.col("o_orderstatus") == "P", F.lit(".5")).otherwise(F.lit(""))
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    dirty = table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.col("o_custkey").cast("string"), half).alias("o_custkey"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "n/a").otherwise(price).alias("price"),
    )
    path = _scratch_path(spark, "dirty-csv")
    write_csv(dirty, path)
    rows = read_csv_checked(spark, path, sample_rows=5).rows
    return rows.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query(
    "s02_schema_listing",
    """SELECT d.column_name AS "column", CASE d.column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double'
              WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS dtype, n.non_null
       FROM (DESCRIBE orders) d JOIN (
         SELECT 'o_orderkey' AS c, count(o_orderkey) AS non_null FROM orders
         UNION ALL SELECT 'o_custkey', count(o_custkey) FROM orders
         UNION ALL SELECT 'o_orderstatus', count(o_orderstatus) FROM orders
         UNION ALL SELECT 'o_totalprice', count(o_totalprice) FROM orders
         UNION ALL SELECT 'o_orderdate', count(o_orderdate) FROM orders
         UNION ALL SELECT 'o_orderpriority', count(o_orderpriority) FROM orders) n
       ON n.c = d.column_name""",
)
def schema_listing(spark, sf):
    return profile.schema_listing(table(spark, sf, "orders"))


@query(
    "s03_shape",
    f"""WITH {CUSTOMERS_SQL} SELECT count(*) AS n_rows, 11::BIGINT AS n_columns, 10::BIGINT AS n_features
        FROM customers""",
)
def shape(spark, sf):
    return profile.shape(customers(spark, sf), target="churn")


@query("s04_first_rows", "SELECT * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 5")
def first_rows(spark, sf):
    return topk.first_rows(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 5
    )


@query("s05_csv_sink", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def csv_sink(spark, sf):
    path = _scratch_path(spark, "orders-csv")
    kept = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    write_csv(kept, path)
    return read_csv(spark, path, kept.schema)


@query("a01_value_counts", "SELECT l_returnflag AS value, count(*) AS n FROM lineitem GROUP BY 1")
def value_counts(spark, sf):
    return profile.value_counts(table(spark, sf, "lineitem"), "l_returnflag")


@query(
    "a01_value_counts_by",
    "SELECT l_linestatus, l_returnflag AS value, count(*) AS n FROM lineitem GROUP BY ALL",
)
def value_counts_by(spark, sf):
    return profile.value_counts(table(spark, sf, "lineitem"), "l_returnflag", by=["l_linestatus"])


@query(
    "a02_value_shares",
    """SELECT l_linestatus, l_returnflag AS value, count(*) AS n,
              sum(count(*)) OVER (PARTITION BY l_linestatus)::BIGINT AS group_n,
              round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY l_linestatus), 6) AS share
       FROM lineitem GROUP BY l_linestatus, l_returnflag""",
)
def value_shares(spark, sf):
    return rounded(profile.value_shares(table(spark, sf, "lineitem"), "l_returnflag", ["l_linestatus"]), "share")


@query(
    "a02_percent_labels",
    f"""WITH {CUSTOMERS_SQL} SELECT churn AS value, count(*) AS n,
           printf('%.1f%%', count(*)::DOUBLE / sum(count(*)) OVER () * 100.0::DOUBLE) AS percent
        FROM customers GROUP BY churn""",
)
def percent_labels(spark, sf):
    shares = profile.value_shares(stage(customers(spark, sf).select("churn")), "churn")
    return shares.select("value", "n", F.format_string("%.1f%%", F.col("share") * 100.0).alias("percent"))


@query(
    "a03_null_counts",
    f"""WITH {LABELED_SQL}, n AS (
          SELECT 'total_charges' AS "column", count(*) FILTER (WHERE total_charges IS NULL) AS n_missing FROM labeled
          UNION ALL SELECT 'contract_code', count(*) FILTER (WHERE contract NOT IN ('1-URGENT', '5-LOW')) FROM labeled
          UNION ALL SELECT 'tenure', count(*) FILTER (WHERE tenure IS NULL) FROM labeled)
        SELECT * FROM n WHERE n_missing > 0""",
)
def null_counts(spark, sf):
    df = labeled(spark, sf).select(
        "customer_id",
        "tenure",
        "total_charges",
        map_values("contract", {"1-URGENT": 1, "5-LOW": 5}).alias("contract_code"),
    )
    return profile.null_counts(df)


@query(
    "a04_null_count",
    f"WITH {LABELED_SQL} SELECT count(*) FILTER (WHERE total_charges IS NULL) AS n_missing FROM labeled",
)
def null_count(spark, sf):
    return profile.null_count(labeled(spark, sf), "total_charges")


@query(
    "a05_total_nulls",
    f"""WITH {LABELED_SQL} SELECT (count(*) FILTER (WHERE total_charges IS NULL)
           + count(*) FILTER (WHERE contract NOT IN ('1-URGENT', '5-LOW')))::BIGINT AS n_missing FROM labeled""",
)
def total_nulls(spark, sf):
    df = labeled(spark, sf).withColumn("contract_code", map_values("contract", {"1-URGENT": 1, "5-LOW": 5}))
    return profile.total_nulls(df)


@query(
    "a06_distinct_values",
    """SELECT DISTINCT 'l_returnflag' AS "column", l_returnflag AS value FROM lineitem
       UNION ALL SELECT DISTINCT 'l_linestatus', l_linestatus FROM lineitem
       UNION ALL SELECT DISTINCT 'l_partkey', l_partkey::VARCHAR FROM lineitem""",
)
def distinct_values(spark, sf):
    return profile.distinct_values(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_partkey"])


@query(
    "a06_estimated_levels",
    """SELECT 'l_returnflag' AS "column", count(DISTINCT l_returnflag) AS n FROM lineitem
       UNION ALL SELECT 'l_linestatus', count(DISTINCT l_linestatus) FROM lineitem
       UNION ALL SELECT 'l_linenumber', count(DISTINCT l_linenumber) FROM lineitem""",
)
def estimated_levels(spark, sf):
    # Sketches are exact for a few values.
    names = ["l_returnflag", "l_linestatus", "l_linenumber"]
    return profile.distinct_estimates(table(spark, sf, "lineitem"), names)


@query(
    "a07_domain_test",
    f"""WITH {CUSTOMERS_SQL}
        SELECT 'paperless' AS "column", bool_and(paperless IN ('Yes', 'No')) AS yes_no,
               bool_and(paperless IN ('Yes', 'No', 'No orders')) AS yes_no_none FROM customers
        UNION ALL SELECT 'has_returns', bool_and(has_returns IN ('Yes', 'No')),
               bool_and(has_returns IN ('Yes', 'No', 'No orders')) FROM customers
        UNION ALL SELECT 'contract', bool_and(contract IN ('Yes', 'No')),
               bool_and(contract IN ('Yes', 'No', 'No orders')) FROM customers""",
)
def domain_test(spark, sf):
    return profile.domain_test(
        customers(spark, sf),
        ["paperless", "has_returns", "contract"],
        {"yes_no": ["Yes", "No"], "yes_no_none": ["Yes", "No", "No orders"]},
    )


@query(
    "a08_describe",
    """SELECT 'l_quantity' AS "column", count(l_quantity) AS n, round(avg(l_quantity), 4) AS mean,
              median(l_quantity) AS median, min(l_quantity) AS min, max(l_quantity) AS max FROM lineitem
       UNION ALL SELECT 'l_extendedprice', count(l_extendedprice), round(avg(l_extendedprice), 4),
              median(l_extendedprice), min(l_extendedprice), max(l_extendedprice) FROM lineitem
       UNION ALL SELECT 'l_discount', count(l_discount), round(avg(l_discount), 4),
              median(l_discount), min(l_discount), max(l_discount) FROM lineitem""",
)
def describe(spark, sf):
    out = profile.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return rounded(out, "mean", digits=4)


@query(
    "a09_target_rate",
    f"""WITH {LABELED_SQL}, filled AS (
          SELECT *, coalesce(total_charges, (SELECT median(total_charges) FROM labeled)) AS charges FROM labeled)
        SELECT segment, count(label) AS n_rows, count(*) FILTER (WHERE label = 1) AS positives,
               count(*) FILTER (WHERE label = 0) AS negatives, round(avg(label), 6) AS rate,
               sum(CAST(charges AS DECIMAL(18,2))) AS charges
        FROM filled GROUP BY segment""",
)
def target_rate(spark, sf):
    df = stage(labeled(spark, sf).select("segment", "label", "total_charges"))
    df = MedianFill.fit(df, ["total_charges"]).transform(df)
    charges = F.sum(F.col("total_charges").cast("decimal(18,2)")).alias("charges")
    return rounded(profile.class_rate(df, "label", ["segment"], [charges]), "rate")


@query(
    "a12_imbalance_ratio",
    f"""WITH {LABELED_SQL} SELECT count(*) FILTER (WHERE label = 0) AS n_majority,
           count(*) FILTER (WHERE label = 1) AS n_minority,
           round(count(*) FILTER (WHERE label = 0)::DOUBLE / nullif(count(*) FILTER (WHERE label = 1), 0), 6) AS ratio
        FROM labeled""",
)
def imbalance_ratio(spark, sf):
    return rounded(profile.imbalance_ratio(labeled(spark, sf), "label"), "ratio")


@query(
    "a11_dense_class_counts",
    """SELECT g.label, count(l.l_quantity) AS n
       FROM (SELECT unnest(range(0, (SELECT max(CAST(l_quantity AS BIGINT)) FROM lineitem) + 1)) AS label) g
       LEFT JOIN lineitem l ON CAST(l.l_quantity AS BIGINT) = g.label GROUP BY g.label""",
)
def dense_class_counts(spark, sf):
    return profile.dense_class_counts(table(spark, sf, "lineitem"), "l_quantity")


HIST_SQL = """
edges AS (
  SELECT {by} bin, lo, hi, group_n, bin * ((hi - lo) / 30.0::DOUBLE) + lo AS bin_lo,
         CASE WHEN bin = 29 THEN hi ELSE (bin + 1) * ((hi - lo) / 30.0::DOUBLE) + lo END AS bin_hi
  FROM (SELECT {by} min(x) AS lo, max(x) AS hi, count(x) AS group_n FROM v {group}) s,
       (SELECT unnest(range(0, 30)) AS bin) b),
counted AS (
  SELECT {eby} e.bin, e.bin_lo, e.bin_hi, e.group_n, count(v.x) AS n
  FROM edges e LEFT JOIN v ON {match} v.x >= e.bin_lo AND (v.x < e.bin_hi OR (e.bin = 29 AND v.x <= e.bin_hi))
  GROUP BY ALL)
"""


@query(
    "a13_histogram",
    "WITH v AS (SELECT l_extendedprice AS x FROM lineitem), "
    + HIST_SQL.format(by="", group="", eby="", match="")
    + "SELECT bin, round(bin_lo, 6) AS bin_lo, round(bin_hi, 6) AS bin_hi, n FROM counted",
)
def histogram(spark, sf):
    return rounded(profile.histogram(table(spark, sf, "lineitem"), "l_extendedprice"), "bin_lo", "bin_hi")


@query(
    "a13_histogram_months",
    f"WITH {CUSTOMERS_SQL}, v AS (SELECT tenure::DOUBLE AS x FROM customers), "
    + HIST_SQL.format(by="", group="", eby="", match="")
    + "SELECT bin, round(bin_lo, 6) AS bin_lo, round(bin_hi, 6) AS bin_hi, n FROM counted",
)
def histogram_months(spark, sf):
    return rounded(profile.histogram(stage(customers(spark, sf).select("tenure")), "tenure"), "bin_lo", "bin_hi")


@query(
    "a14_density_hist",
    "WITH v AS (SELECT event_type, value AS x FROM events), "
    + HIST_SQL.format(
        by="event_type,", group="GROUP BY event_type", eby="e.event_type,", match="v.event_type = e.event_type AND"
    )
    + """SELECT event_type, bin, round(bin_lo, 6) AS bin_lo, round(bin_hi, 6) AS bin_hi, n,
                round(n / (group_n * (bin_hi - bin_lo)), 9) AS density FROM counted""",
)
def density_hist(spark, sf):
    out = profile.histogram(table(spark, sf, "events"), "value", by=["event_type"], density=True)
    return rounded(rounded(out, "bin_lo", "bin_hi"), "density", digits=9)


@query(
    "a14_density_by_outcome",
    f"WITH {CUSTOMERS_SQL}, v AS (SELECT churn, tenure::DOUBLE AS x FROM customers), "
    + HIST_SQL.format(by="churn,", group="GROUP BY churn", eby="e.churn,", match="v.churn = e.churn AND")
    + """SELECT churn, bin, round(bin_lo, 6) AS bin_lo, round(bin_hi, 6) AS bin_hi, n,
                round(n / (group_n * (bin_hi - bin_lo)), 9) AS density FROM counted""",
)
def density_by_outcome(spark, sf):
    rows = stage(customers(spark, sf).select("churn", "tenure"))
    out = profile.histogram(rows, "tenure", by=["churn"], density=True)
    return rounded(rounded(out, "bin_lo", "bin_hi"), "density", digits=9)


@query(
    "a15_matrix_moments",
    """WITH cells AS (SELECT l_quantity AS x FROM lineitem UNION ALL SELECT l_discount * 100 FROM lineitem
                      UNION ALL SELECT l_tax * 100 FROM lineitem)
       SELECT count(x) AS n_cells, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std FROM cells""",
)
def matrix_moments(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_quantity", (F.col("l_discount") * 100).alias("discount"), (F.col("l_tax") * 100).alias("tax")
    )
    return rounded(profile.matrix_moments(df, df.columns), "mean", "std")


@query(
    "a18_vector_stats",
    """WITH cells AS (SELECT unnest(range(0, len(embedding))) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings)
       SELECT pos, count(x) AS n, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std,
              round(avg(abs(x)), 6) AS mean_abs FROM cells GROUP BY pos""",
)
def vector_stats(spark, sf):
    return rounded(profile.vector_stats(table(spark, sf, "embeddings"), "embedding"), "mean", "std", "mean_abs")


# A (name, value) table that grows with the data: revenue of each part.
PART_VALUE_SQL = """
part_value AS (
  SELECT p_partkey, p_name || ' ' || lpad(p_partkey::VARCHAR, 9, '0') AS name, revenue AS value
  FROM part JOIN (SELECT l_partkey, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS revenue FROM lineitem GROUP BY 1) r
    ON l_partkey = p_partkey)
"""


def part_value(spark, sf):
    revenue = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("value"))
    )
    name = F.concat_ws(" ", "p_name", F.lpad(F.col("p_partkey").cast("string"), 9, "0"))
    return table(spark, sf, "part").join(revenue, "p_partkey").select(name.alias("name"), "value")


@query(
    "a16_top_share",
    f"""WITH {PART_VALUE_SQL}, ranked AS (SELECT *, row_number() OVER (ORDER BY value DESC, name) AS rk FROM part_value)
        SELECT sum(value) AS head_total, sum(value) FILTER (WHERE rk <= 3) AS top_total,
               round(sum(value) FILTER (WHERE rk <= 3)::DOUBLE / sum(value)::DOUBLE, 6) AS top_share
        FROM ranked WHERE rk <= 15""",
)
def top_share(spark, sf):
    out = topk.share_of_top(part_value(spark, sf), "name", "value", k=3)
    return out.withColumn("top_share", F.round(F.col("top_total").cast("double") / F.col("head_total").cast("double"), 6))


@query(
    "a16_group_share",
    f"""WITH {PART_VALUE_SQL}, ranked AS (SELECT *, row_number() OVER (ORDER BY value DESC, name) AS rk FROM part_value)
        SELECT count(*) FILTER (WHERE contains(name, 'ring') OR contains(name, 'gear')) AS members,
               round(sum(value)::DOUBLE, 2) AS head_total,
               round(coalesce(sum(value) FILTER (WHERE contains(name, 'ring') OR contains(name, 'gear')), 0)::DOUBLE, 2) AS group_total,
               round(coalesce(sum(value) FILTER (WHERE contains(name, 'ring') OR contains(name, 'gear')), 0)::DOUBLE / sum(value)::DOUBLE, 6) AS group_share
        FROM ranked WHERE rk <= 15""",
)
def group_share(spark, sf):
    values = part_value(spark, sf).withColumn("value", F.col("value").cast("double"))
    out = topk.share_of_group(values, "name", "value", any_substring("name", ["ring", "gear"]))
    return rounded(rounded(out, "group_share"), "head_total", "group_total", digits=2)


@query("t01_sort_head", f"WITH {PART_VALUE_SQL} SELECT name, value FROM part_value ORDER BY value DESC, name LIMIT 15")
def sort_head(spark, sf):
    return topk.top_k(part_value(spark, sf), "name", "value", 15)


@query(
    "t02_nlargest",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
       ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 10""",
)
def nlargest(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return lines.orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey").limit(10)


@query(
    "t03_top_reversed",
    f"""WITH {PART_VALUE_SQL}, best AS (SELECT name, value FROM part_value ORDER BY value DESC, name LIMIT 10)
        SELECT name, value FROM best ORDER BY value, name DESC""",
)
def top_reversed(spark, sf):
    return topk.top_k(part_value(spark, sf), "name", "value", 10, ascending_output=True)


@query(
    "t04_row_number",
    f"""WITH {PART_VALUE_SQL} SELECT name, value, row_number() OVER (ORDER BY value DESC, name) AS position
        FROM part_value QUALIFY position <= 10""",
)
def row_number(spark, sf):
    return topk.numbered(part_value(spark, sf), "name", "value", 10)
