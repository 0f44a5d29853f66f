"""Top rows and shares of (name, value) tables of any length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_rows(df: DataFrame, key: str | Sequence[str], n: int = 5) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(*keys).limit(n)


def top_k(df: DataFrame, name: str, value: str, k: int, ascending_output: bool = False) -> DataFrame:
    """The k rows of highest value, ties by name.

    Sort and limit run as one top-k operator: each partition keeps k rows and only
    those meet.
    """
    best = df.orderBy(F.desc_nulls_last(value), name).limit(k)
    return best.orderBy(F.asc(value), F.desc(name)) if ascending_output else best


def numbered(df: DataFrame, name: str, value: str, k: int, number: str = "position") -> DataFrame:
    """Top k with a running number from 1; the numbering sees k rows, not the table."""
    order = W.orderBy(F.desc_nulls_last(value), name)
    return top_k(df, name, value, k).withColumn(number, F.row_number().over(order).cast("bigint"))


def share_of_top(df: DataFrame, name: str, value: str, k: int, head: int = 15) -> DataFrame:
    """What part of the head's total its k best rows hold.

    The denominator is the ``head`` best rows, not the whole table.
    """
    ranked = numbered(df, name, value, head)
    return ranked.agg(
        F.sum(value).alias("head_total"),
        F.sum(F.when(F.col("position") <= k, F.col(value))).alias("top_total"),
    ).withColumn("top_share", F.try_divide("top_total", "head_total"))


def share_of_group(df: DataFrame, name: str, value: str, member: Column, head: int = 15) -> DataFrame:
    """What part of the head's total the matching rows hold."""
    return (
        top_k(df, name, value, head)
        .agg(
            F.count_if(member).alias("members"),
            F.sum(value).alias("head_total"),
            F.coalesce(F.sum(F.when(member, F.col(value))), F.lit(0.0)).alias("group_total"),
        )
        .withColumn("group_share", F.try_divide("group_total", "head_total"))
    )
