"""Table and column profiles.

Each function asks for all its figures in one aggregation, however many columns
it covers; only the histogram and the median need an earlier look at the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outcomekit.operators.quantiles import exact_medians
from outcomekit.session import join_groups, small_table, stage


def _long(row_df: DataFrame, names: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One wide row with columns ``<field>__<name>`` to one row per name."""
    parts = [
        F.struct(F.lit(n).alias("column"), *[F.col(f"`{f}__{n}`").alias(f) for f in fields]) for n in names
    ]
    return row_df.select(F.inline(F.array(*parts)))


def schema_listing(df: DataFrame) -> DataFrame:
    """Column, type, count of values that are not null."""
    types = dict(df.dtypes)
    wide = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"non_null__{c}") for c in df.columns])
    listing = _long(wide, df.columns, ["non_null"])
    kinds = F.create_map(*[F.lit(x) for c in df.columns for x in (c, types[c])])
    return listing.select("column", kinds[F.col("column")].alias("dtype"), "non_null")


def shape(df: DataFrame, target: str | None = None) -> DataFrame:
    """Rows, columns and feature columns (all but the target)."""
    width = len(df.columns)
    features = width - (1 if target in df.columns else 0)
    return df.agg(F.count("*").alias("n_rows")).select(
        "n_rows",
        F.lit(width).cast("bigint").alias("n_columns"),
        F.lit(features).cast("bigint").alias("n_features"),
    )


def null_counts(df: DataFrame, only_missing: bool = True) -> DataFrame:
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n_missing__{c}") for c in df.columns])
    listing = _long(wide, df.columns, ["n_missing"])
    return listing.where(F.col("n_missing") > 0) if only_missing else listing


def null_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNull()).alias("n_missing"))


def total_nulls(df: DataFrame) -> DataFrame:
    return null_counts(df, only_missing=False).agg(F.sum("n_missing").alias("n_missing"))


def value_counts(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per value, nulls left out, most frequent first within each group."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(*by, F.col(column).alias("value"))
        .agg(F.count("*").alias("n"))
    )
    return counts.orderBy(*by, F.desc("n"), "value")


def value_shares(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Value counts with the share of the group's rows that are not null."""
    counts = stage(value_counts(df, column, by))
    totals = counts.groupBy(*by).agg(F.sum("n").alias("group_n"))
    if by:
        joined = join_groups(counts, small_table(totals), by)
    else:
        joined = counts.withColumn("group_n", F.lit(totals.first()["group_n"]))
    shares = joined.withColumn("share", F.col("n") / F.col("group_n"))
    return shares.orderBy(*by, F.desc("n"), "value")


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All (column, value) pairs, as text, without nulls.

    One scan for all columns. Pairs are made distinct on the map side first, so
    neither a frequent value nor a column of many values lands in one task.
    """
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols
    ]
    long = df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull())
    return long.distinct()


def distinct_estimates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """About how many distinct values each column has, from mergeable sketches of all columns in one scan.

    Nothing but one sketch a column and task is shuffled; the error is about 2 %, and none for a few values.
    """
    sketches = [F.hll_sketch_estimate(F.hll_sketch_agg(F.col(f"`{c}`").cast("string"))).alias(f"n__{c}") for c in cols]
    return _long(df.agg(*sketches), cols, ["n"])


def domain_test(
    df: DataFrame, cols: Sequence[str], domains: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Per column and named domain: does every value belong to the domain?"""
    aggs = []
    for c in cols:
        for label, members in domains.items():
            outside = F.count_if(F.col(f"`{c}`").isNotNull() & ~F.col(f"`{c}`").isin(list(members)))
            aggs.append((outside == 0).alias(f"{label}__{c}"))
    return _long(df.agg(*aggs), cols, list(domains))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, exact median, minimum and maximum of each column."""
    medians = exact_medians(df, cols)
    aggs = []
    for c in cols:
        x = F.col(f"`{c}`").cast("double")
        aggs += [
            F.count(x).alias(f"n__{c}"),
            F.avg(x).alias(f"mean__{c}"),
            F.lit(medians[c]).cast("double").alias(f"median__{c}"),
            F.min(x).alias(f"min__{c}"),
            F.max(x).alias(f"max__{c}"),
        ]
    return _long(df.agg(*aggs), cols, ["n", "mean", "median", "min", "max"])


def class_rate(df: DataFrame, label: str, by: Sequence[str] = (), more: Sequence[Column] = ()) -> DataFrame:
    """Rows, positives, negatives and positive rate, per group if asked; ``more`` aggregates go along."""
    y = F.col(label)
    return df.groupBy(*by).agg(
        F.count(y).alias("n_rows"),
        F.count_if(y == 1).alias("positives"),
        F.count_if(y == 0).alias("negatives"),
        F.avg(y.cast("double")).alias("rate"),
        *more,
    )


def split_profile(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Size, share of all rows, positives and positive rate of each split part."""
    parts = class_rate(df, label, [split])
    # A handful of rows: the window runs over the parts, not over the table.
    total = F.sum("n_rows").over(W.partitionBy(F.lit(1)))
    return parts.withColumn("share", F.col("n_rows") / total)


def dense_class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class for every whole number from 0 to the highest label.

    Raises on negative and fractional labels, which have no place on that ladder.
    """
    y = F.col(label)
    counts = df.where(y.isNotNull()).groupBy(y.cast("bigint").alias("label"))
    counts = stage(counts.agg(F.count("*").alias("n"), F.max(y.cast("double") != F.floor(y.cast("double"))).alias("odd")))
    lowest, highest, odd = counts.agg(F.min("label"), F.max("label"), F.max("odd")).first()
    if odd or (lowest is not None and lowest < 0):
        raise ValueError(f"labels of {label} must be whole numbers from 0")
    counts = counts.select("label", "n")
    ladder = df.sparkSession.range(0, 0 if highest is None else highest + 1).withColumnRenamed("id", "label")
    return ladder.join(counts, "label", "left").select("label", F.coalesce("n", F.lit(0)).alias("n"))


def imbalance_ratio(df: DataFrame, label: str, majority: int = 0, minority: int = 1) -> DataFrame:
    y = F.col(label)
    return df.agg(
        F.count_if(y == majority).alias("n_majority"), F.count_if(y == minority).alias("n_minority")
    ).withColumn("ratio", F.try_divide(F.col("n_majority").cast("double"), F.col("n_minority").cast("double")))


def _edge(i: Column, lo: Column, hi: Column, bins: int) -> Column:
    return F.when(i >= bins, hi).otherwise(i.cast("double") * ((hi - lo) / F.lit(float(bins))) + lo)


def histogram(
    df: DataFrame, column: str, bins: int = 30, by: Sequence[str] = (), density: bool = False
) -> DataFrame:
    """Equal-width histogram between the smallest and largest value.

    With ``by`` each group has its own range and bins. The last bin includes its
    upper edge; a range of one value is widened by a half on both sides; empty
    bins are listed with zero.
    """
    by = list(by)
    x = F.col(column).cast("double")
    rows = df.select(*by, x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    stats = rows.groupBy(*by).agg(
        F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("group_n")
    )
    flat = F.col("lo") == F.col("hi")
    stats = stats.where(F.col("group_n") > 0).select(
        *by,
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        "group_n",
    )
    stats = small_table(stats)
    if by:
        ranged = join_groups(rows, stats, by)
    else:
        got = stats.first()
        if got is None:
            ranged = rows.select("x", F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi")).limit(0)
        else:
            ranged = rows.select("x", F.lit(got["lo"]).alias("lo"), F.lit(got["hi"]).alias("hi"))
    lo, hi, last = F.col("lo"), F.col("hi"), F.lit(bins - 1)
    guess = F.least(last, F.greatest(F.lit(0), F.floor((F.col("x") - lo) / (hi - lo) * bins).cast("int")))
    # Division can land one bin off at an edge; the edges decide.
    bin_no = (
        F.when(F.col("x") < _edge(F.col("guess"), lo, hi, bins), F.col("guess") - 1)
        .when((F.col("x") >= _edge(F.col("guess") + 1, lo, hi, bins)) & (F.col("guess") < last), F.col("guess") + 1)
        .otherwise(F.col("guess"))
    )
    counts = (
        ranged.withColumn("guess", guess)
        .groupBy(*by, bin_no.alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    ladder = stats.withColumn("bin", F.explode(F.sequence(F.lit(0), last)))
    out = join_groups(ladder, counts, [*by, "bin"], "left").select(
        *by,
        F.col("bin").cast("bigint").alias("bin"),
        _edge(F.col("bin"), lo, hi, bins).alias("bin_lo"),
        _edge(F.col("bin") + 1, lo, hi, bins).alias("bin_hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
        "group_n",
    )
    if density:
        width = F.col("bin_hi") - F.col("bin_lo")
        out = out.withColumn("density", F.col("n") / (F.col("group_n") * width))
    return out.drop("group_n")


def matrix_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation over every cell of the columns.

    Columns are combined from their own moments around the common mean, which keeps
    digits that a plain sum of squares would lose.
    """
    aggs = []
    for c in cols:
        x = F.col(f"`{c}`").cast("double")
        aggs += [F.count(x).alias(f"n__{c}"), F.avg(x).alias(f"mean__{c}"), F.stddev_pop(x).alias(f"std__{c}")]
    # From here on one row per column of the matrix.
    moments = _long(df.agg(*aggs), cols, ["n", "mean", "std"]).where(F.col("n") > 0)
    everything = W.partitionBy(F.lit(1))
    common = F.sum(F.col("n") * F.col("mean")).over(everything) / F.sum("n").over(everything)
    off = F.col("mean") - F.col("common")
    return (
        moments.withColumn("common", common)
        .agg(
            F.sum("n").alias("n_cells"),
            F.first("common").alias("mean"),
            F.sqrt(F.sum(F.col("n") * (F.col("std") * F.col("std") + off * off)) / F.sum("n")).alias("std"),
        )
    )


def vector_stats(df: DataFrame, column: str) -> DataFrame:
    """Mean, population standard deviation and mean absolute value per vector position."""
    cells = df.select(F.posexplode(F.col(column)).alias("pos", "x")).withColumn("x", F.col("x").cast("double"))
    return cells.groupBy(F.col("pos").cast("bigint").alias("pos")).agg(
        F.count("x").alias("n"),
        F.avg("x").alias("mean"),
        F.stddev_pop("x").alias("std"),
        F.avg(F.abs("x")).alias("mean_abs"),
    )
