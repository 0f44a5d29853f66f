"""Encoding, splits, scaling and weights."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from outcomekit.operators import clean, features, profile
from outcomekit.operators.levels import LevelTable
from outcomekit.operators.split import HashSplit, tail_split
from outcomekit.session import stage
from registry.core import CUSTOMERS_SQL, customers, draw_sql, query, table
from registry.profiling import LABELED_SQL, labeled, rounded

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
CONTRACTS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "No orders"]


def split_sql(source: str, key: str, parts: dict[str, float], stratum: str | None = None, rest: str = "train") -> str:
    """SQL of the same split: a CTE body that adds ``split`` to every row of ``source``."""
    over = f"PARTITION BY {stratum}" if stratum else ""
    cases, reached = [], "0"
    for part, fraction in parts.items():
        reached += f" + floor(n_g * {fraction}::DOUBLE + 0.5::DOUBLE)"
        cases.append(f"WHEN rn <= {reached} THEN '{part}'")
    return f"""
      SELECT * EXCLUDE (u, rn, n_g), CASE {' '.join(cases)} ELSE '{rest}' END AS split FROM (
        SELECT *, row_number() OVER ({over} ORDER BY u, {key}) AS rn, count(*) OVER ({over}) AS n_g
        FROM (SELECT *, {draw_sql(key, "'split'")} AS u FROM {source}) a) b"""


def one_hot_sql(column: str, levels: list[str]) -> str:
    return ", ".join(
        f"CASE WHEN {column} = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"{column}_{v}\"" for v in levels[1:]
    )


@query(
    "f01_one_hot",
    f"""WITH {CUSTOMERS_SQL} SELECT customer_id, tenure, {one_hot_sql("segment", SEGMENTS)},
        {one_hot_sql("contract", CONTRACTS)} FROM customers""",
)
def one_hot(spark, sf):
    df = stage(customers(spark, sf).select("customer_id", "segment", "tenure", "contract"))
    return features.OneHot.fit(df, ["segment", "contract"]).transform(df)


PRIORITIES = CONTRACTS[:5]


@query(
    "f01_one_hot_orders",
    f"""SELECT o_orderkey, o_totalprice, {one_hot_sql("o_orderpriority", PRIORITIES)},
        {one_hot_sql("o_orderstatus", ["F", "O", "P"])} FROM orders""",
)
def one_hot_orders(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    return features.OneHot.fit(df, ["o_orderpriority", "o_orderstatus"]).transform(df)


@query(
    "f01_one_hot_vector",
    """WITH places AS (
         SELECT p_name, p_brand, dense_rank() OVER (ORDER BY p_name) - 1 AS name_at, dense_rank() OVER (ORDER BY p_brand) - 1 AS brand_at,
                p_partkey FROM part)
       SELECT p_partkey, name_at, brand_at, (SELECT count(DISTINCT p_name) - 1 FROM part) AS name_size,
              (SELECT count(DISTINCT p_brand) - 1 FROM part) AS brand_size FROM places""",
)
def one_hot_vector(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    coded = features.OneHotVector.fit(df, ["p_name", "p_brand"]).transform(df)
    cells = {c: vector_to_array(f"p_{c}_onehot") for c in ("name", "brand")}
    return coded.select(
        "p_partkey",
        *[F.array_position(x, 1.0).alias(f"{c}_at") for c, x in cells.items()],
        *[F.size(x).cast("bigint").alias(f"{c}_size") for c, x in cells.items()],
    )


@query(
    "f01_level_table",
    """WITH places AS (
         SELECT c_custkey, dense_rank() OVER (ORDER BY c_name) - 2 AS name_at, dense_rank() OVER (ORDER BY c_mktsegment) - 2 AS segment_at
         FROM customer)
       SELECT c_custkey, nullif(name_at, -1)::INTEGER AS name_at, nullif(segment_at, -1)::INTEGER AS segment_at,
              (SELECT count(DISTINCT c_name) - 1 FROM customer)::INTEGER AS name_size,
              (SELECT count(DISTINCT c_mktsegment) - 1 FROM customer)::INTEGER AS segment_size FROM places""",
)
def level_table(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    levels = LevelTable.fit(df, ["c_name", "c_mktsegment"])
    coded = levels.one_hot(levels.one_hot(df, "c_name", "name"), "c_mktsegment", "segment")
    parts = coded.select("c_custkey", *[F.unwrap_udt(c).alias(c) for c in ("name", "segment")])
    return parts.select(
        "c_custkey",
        *[F.get(f"{c}.indices", F.lit(0)).alias(f"{c}_at") for c in ("name", "segment")],
        *[F.col(f"{c}.size").alias(f"{c}_size") for c in ("name", "segment")],
    )


@query(
    "f02_auto_encode",
    f"""WITH {CUSTOMERS_SQL} SELECT customer_id, CASE WHEN customer_id % 2 = 0 THEN 1 ELSE 0 END AS gender,
          CASE paperless WHEN 'Yes' THEN 1 ELSE 0 END AS paperless,
          CASE has_returns WHEN 'Yes' THEN 1 ELSE 0 END AS has_returns,
          CASE churn WHEN 'Yes' THEN 1 ELSE 0 END AS churn,
          {one_hot_sql("segment", SEGMENTS)} FROM customers""",
)
def auto_encode(spark, sf):
    gender = F.when(F.col("customer_id") % 2 == 0, "Male").otherwise("Female")
    df = customers(spark, sf).withColumn("gender", gender)
    df = df.select("customer_id", "gender", "paperless", "has_returns", "segment", "churn")
    df = stage(clean.replace_values(df, {"No orders": "No"}))
    return features.AutoEncode.fit(df, clean.columns_of_kind(df, "text")).transform(df)


@query(
    "f03_assemble",
    f"""WITH {LABELED_SQL} SELECT customer_id, label, senior::DOUBLE AS f0, tenure::DOUBLE AS f1,
          monthly_charges AS f2 FROM labeled""",
)
def assemble(spark, sf):
    df = labeled(spark, sf).select("customer_id", "senior", "tenure", "monthly_charges", "label")
    names = features.feature_columns(df, "label", others=["customer_id"])
    parts = features.assemble(df, names, keep=["customer_id", "label"])
    cells = parts.withColumn("x", vector_to_array("features"))
    return cells.select("customer_id", "label", *[F.col("x")[i].alias(f"f{i}") for i in range(len(names))])


THREE_WAY = {"test": 0.15, "validation": 0.15}
SIXTY = {"test": 0.2, "validation": 0.2}
TWO_WAY = {"test": 0.2}

SPLIT3_SQL = LABELED_SQL + f", parts AS ({split_sql('labeled', 'customer_id', THREE_WAY, 'label')})"


def with_split(df, parts, key="customer_id", stratum="label"):
    return HashSplit.fit(df, key, parts, stratum).transform(df)


@query(
    "f08_split2",
    f"""WITH {LABELED_SQL}, parts AS ({split_sql('labeled', 'customer_id', TWO_WAY, 'label')})
        SELECT customer_id, label, split FROM parts""",
)
def split2(spark, sf):
    return with_split(stage(labeled(spark, sf).select("customer_id", "label")), TWO_WAY)


@query(
    "f09_split3",
    f"WITH {SPLIT3_SQL} SELECT customer_id, label, split FROM parts",
)
def split3(spark, sf):
    return with_split(stage(labeled(spark, sf).select("customer_id", "label")), THREE_WAY)


@query(
    "f09_split3_orders",
    f"""WITH flagged AS (SELECT o_orderkey, o_orderstatus FROM orders),
          parts AS ({split_sql('flagged', 'o_orderkey', SIXTY, 'o_orderstatus')})
        SELECT o_orderkey, o_orderstatus, split FROM parts""",
)
def split3_orders(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return with_split(df, SIXTY, "o_orderkey", "o_orderstatus")


@query(
    "f10_split_plain",
    f"""WITH flagged AS (SELECT o_orderkey, o_custkey FROM orders),
          parts AS ({split_sql('flagged', 'o_orderkey', TWO_WAY)})
        SELECT o_orderkey, o_custkey, split FROM parts""",
)
def split_plain(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return with_split(df, TWO_WAY, "o_orderkey", None)


@query(
    "f13_tail_split",
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey) > floor(count(*) OVER () * 0.9::DOUBLE)
              THEN 'validation' ELSE 'train' END AS split FROM orders""",
)
def validation_tail(spark, sf):
    return tail_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.1)


@query(
    "a10_split_profile",
    f"""WITH {SPLIT3_SQL} SELECT split, count(*) AS n_rows, count(*) FILTER (WHERE label = 1) AS positives,
          count(*) FILTER (WHERE label = 0) AS negatives, round(avg(label), 6) AS rate,
          round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share FROM parts GROUP BY split""",
)
def split_profile(spark, sf):
    df = with_split(stage(labeled(spark, sf).select("customer_id", "label")), THREE_WAY)
    return rounded(profile.split_profile(df, "label"), "rate", "share")


NUMBERS = ["tenure", "monthly_charges", "total_charges"]
FILLED_SQL = (
    SPLIT3_SQL
    + """, filled AS (SELECT * REPLACE (coalesce(total_charges,
          (SELECT median(total_charges) FROM parts WHERE split = 'train')) AS total_charges) FROM parts)"""
)


def filled(spark, sf):
    """Labeled customers with a split, charges filled from the training part."""
    names = ["customer_id", "label", "senior", "segment", "region", "contract", "paperless", "has_returns", *NUMBERS]
    df = stage(labeled(spark, sf).select(*names))
    df = with_split(df, THREE_WAY)
    return clean.MedianFill.fit(df, ["total_charges"], F.col("split") == "train").transform(df)


def scaled_sql(columns: list[str], source: str = "filled", fit_where: str = "split = 'train'", digits: int = 6) -> str:
    stats = ", ".join(
        f"avg({c}::DOUBLE) AS m_{c}, coalesce(nullif(stddev_pop({c}::DOUBLE), 0), 1) AS s_{c}" for c in columns
    )
    out = ", ".join(f"round(({c} - m_{c}) / s_{c}, {digits}) AS {c}" for c in columns)
    return f"SELECT customer_id, split, {out} FROM {source}, (SELECT {stats} FROM {source} WHERE {fit_where}) s"


@query("f04_standardize", f"WITH {FILLED_SQL} " + scaled_sql(NUMBERS))
def standardize(spark, sf):
    df = filled(spark, sf).select("customer_id", "split", *NUMBERS)
    return rounded(features.Standardize.fit(df, NUMBERS, F.col("split") == "train").transform(df), *NUMBERS)


# All encoded features: one row per customer and 0/1 column; the first level of a text column has none.
TEXTS = ["segment", "region", "contract", "paperless", "has_returns"]
LEVELS_SQL = "levels AS (" + " UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS col, {c} AS level FROM filled WHERE {c} > (SELECT min({c}) FROM filled)" for c in TEXTS
) + ")"
FLAGS_SQL = "flags AS (" + " UNION ALL ".join(
    f"""SELECT customer_id, split, label, '{c}_' || level AS feature,
          CASE WHEN {c} = level THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value FROM filled, levels WHERE col = '{c}'"""
    for c in TEXTS
) + ")"
FIGURES_SQL = "figures AS (SELECT * FROM flags" + "".join(
    f" UNION ALL SELECT customer_id, split, label, '{c}', {c}::DOUBLE FROM filled" for c in ["senior", *NUMBERS]
) + ")"


@query(
    "f05_standardize_all",
    f"""WITH {FILLED_SQL}, {LEVELS_SQL}, {FLAGS_SQL}, {FIGURES_SQL}, scales AS (
          SELECT feature, avg(value) AS m, coalesce(nullif(stddev_pop(value), 0), 1) AS s
          FROM figures WHERE split = 'train' GROUP BY feature)
        SELECT customer_id, split, feature, round((value - m) / s, 6) AS value FROM figures JOIN scales USING (feature)""",
)
def standardize_all(spark, sf):
    df = filled(spark, sf).drop("label")
    df = features.OneHot.fit(df, TEXTS).transform(df)
    names = features.feature_columns(df, "label", others=["customer_id", "split"])
    df = df.select("customer_id", "split", *[F.col(f"`{c}`").cast("double").alias(c) for c in names])
    scaled = features.Standardize.fit(df, names, F.col("split") == "train").transform(df)
    tall = scaled.unpivot(["customer_id", "split"], [F.col(f"`{c}`") for c in names], "feature", "value")
    return rounded(tall, "value")


@query("f06_standardize_full", f"WITH {FILLED_SQL} " + scaled_sql(NUMBERS, fit_where="true"))
def standardize_full(spark, sf):
    df = filled(spark, sf).select("customer_id", "split", *NUMBERS)
    return rounded(features.Standardize.fit(df, NUMBERS).transform(df), *NUMBERS)


@query(
    "f11_class_weights",
    f"""WITH {SPLIT3_SQL}, n AS (SELECT label AS l, count(*) AS n_c, sum(count(*)) OVER () AS n_all,
            count(*) OVER () AS k FROM parts WHERE split = 'train' GROUP BY label)
        SELECT customer_id, label, round(n_all::DOUBLE / (k * n_c), 6) AS weight
        FROM parts JOIN n ON l = label WHERE split = 'train'""",
)
def class_weights(spark, sf):
    df = with_split(stage(labeled(spark, sf).select("customer_id", "label")), THREE_WAY).where(F.col("split") == "train")
    weighted = features.ClassWeights.fit(df, "label").transform(df, "label")
    return rounded(weighted.select("customer_id", "label", "weight"), "weight")


