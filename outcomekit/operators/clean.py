"""Row and column cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomekit.functions import lenient_double
from outcomekit.operators.quantiles import exact_medians
from outcomekit.session import small_table

LIST_FILTER_LIMIT = 1_000


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Without the named columns; a name that is absent is passed over."""
    return df.drop(*names)


def pick_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*names)


def columns_of_kind(df: DataFrame, kind: str, exclude: Sequence[str] = ()) -> list[str]:
    """Names of the ``text`` or ``numeric`` columns, in table order."""
    kinds = {"text": T.StringType, "numeric": T.NumericType}
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, kinds[kind]) and f.name not in exclude
    ]


def equals_filter(df: DataFrame, column: str, value, keep: Sequence[str]) -> DataFrame:
    return df.where(F.col(column) == F.lit(value)).select(*keep)


def member_filter(df: DataFrame, column: str, members: Sequence | DataFrame) -> DataFrame:
    """Rows whose value is a member.

    A short list becomes an IN predicate that reaches the scan; a one-column
    table of members becomes a semi join.
    """
    if isinstance(members, DataFrame):
        keys = members.select(F.col(members.columns[0]).alias(column)).distinct()
        return df.join(small_table(keys), column, "left_semi")
    values = list(members)
    if len(values) > LIST_FILTER_LIMIT:
        keys = df.sparkSession.createDataFrame([(v,) for v in values], T.StructType([df.schema[column]]))
        return member_filter(df, column, keys)
    return df.where(F.col(column).isin(values))


def lenient_numeric(df: DataFrame, column: str, to: str | None = None, trim: bool = False) -> DataFrame:
    return df.withColumn(to or column, lenient_double(column, trim))


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(subset) if subset else None)


def replace_values(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Replace whole values in every text column."""
    texts = columns_of_kind(df, "text")
    return df.na.replace(dict(mapping), subset=texts) if texts else df


@dataclass(frozen=True)
class MedianFill:
    """Fill nulls with exact medians learned from a table."""

    medians: dict[str, float | None] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], where: Column | None = None) -> MedianFill:
        rows = df if where is None else df.where(where)
        return cls(exact_medians(rows, cols))

    def transform(self, df: DataFrame) -> DataFrame:
        fills = {c: F.coalesce(F.col(c), F.lit(m)) for c, m in self.medians.items() if m is not None}
        return df.withColumns(fills) if fills else df
