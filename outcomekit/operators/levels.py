"""Levels of text columns as a stored table of ranks, for columns of any number of levels.

A one-hot encoding needs the place of each level in sorted order. Here places are worked out by ranges: the
distinct values are sorted over range partitions, each numbers its own, and the counts of the
ranges before it are added. So no level reaches the driver, and neither the plan nor a task grows with them.
Frequent levels are looked up in a map of bounded size; the rest by a join on the value, whose other side
has each level once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomekit.session import stage

#: Levels of a column that are looked up without a join, and the part of its rows from which one counts as frequent.
FREQUENT, FREQUENT_SHARE = 500, 1e-4
#: Begins the key of a row that looks nothing up.
NO_LEVEL = "\x00none "
RANK_SCHEMA = "column string, value string, n long, place long, part int"


@dataclass(frozen=True)
class LevelTable:
    """Levels (column, value, rank from 0) of some columns; the number of levels; frequent ones with their rank."""

    ranks: DataFrame
    sizes: dict[str, int]
    frequent: dict[str, dict[str, int]]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> LevelTable:
        """Rank the distinct values of each column in ascending order; nulls are no level."""
        pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols]
        long = df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull())
        counts = stage(long.groupBy("column", "value").agg(F.count("*").alias("n")))

        def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, before = TaskContext.get().partitionId(), 0
            for batch in batches:
                place = np.arange(before, before + batch.num_rows)
                before += batch.num_rows
                yield pa.record_batch(
                    [*batch.columns, pa.array(place), pa.array(np.full(batch.num_rows, part, np.int32))],
                    names=["column", "value", "n", "place", "part"],
                )

        # Places count on within a partition, whatever its columns; what a column begins with is taken off below.
        ranged = counts.repartitionByRange("column", "value").sortWithinPartitions("column", "value")
        held = stage(ranged.mapInArrow(number, RANK_SCHEMA))
        parts = held.groupBy("column", "part").agg(F.min("place").alias("first"), F.count("*").alias("m"), F.sum("n").alias("rows"))
        # A row per column and partition that it reaches into.
        found = parts.orderBy("column", "part").collect()
        sizes, rows, shifts = dict.fromkeys(cols, 0), dict.fromkeys(cols, 0), []
        for r in found:
            shifts.append((r["column"], r["part"], sizes[r["column"]] - r["first"]))
            sizes[r["column"]] += r["m"]
            rows[r["column"]] += r["rows"]
        spark = df.sparkSession
        moved = F.broadcast(spark.createDataFrame(shifts, "column string, part int, shift long"))
        ranks = stage(
            held.join(moved, ["column", "part"]).select("column", "value", "n", (F.col("place") + F.col("shift")).alias("rank"))
        )
        frequent: dict[str, dict[str, int]] = {}
        for c in cols:
            often = ranks.where((F.col("column") == c) & (F.col("n") >= max(2, rows[c] * FREQUENT_SHARE)))
            top = often.orderBy(F.desc("n"), "value").limit(FREQUENT).collect()
            frequent[c] = {r["value"]: r["rank"] for r in sorted(top, key=lambda r: r["rank"])}
        return cls(ranks, sizes, frequent)

    def rank_column(self, df: DataFrame, column: str, to: str) -> DataFrame:
        """``df`` with the rank of its value in ``to``; null for a null and for a value that is no level."""
        value = F.col(f"`{column}`").cast("string")
        known = self.frequent[column]
        mapped: Column = F.lit(None).cast("long")
        if known:
            pairs = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
            mapped = F.try_element_at(pairs, value).cast("long")
        marked = df.withColumn("__level_known", mapped)
        if len(known) == self.sizes[column]:
            return marked.withColumnRenamed("__level_known", to)
        # Rows that need no lookup get one of many keys that are no level, so that they are no hot key of the join.
        other = F.concat(F.lit(NO_LEVEL), F.pmod(F.monotonically_increasing_id(), F.lit(10_007)).cast("string"))
        marked = marked.withColumn("__level_value", F.when(F.col("__level_known").isNull() & value.isNotNull(), value).otherwise(other))
        rest = self.ranks.where(F.col("column") == column).select(F.col("value").alias("__level_value"), F.col("rank").alias("__level_rank"))
        joined = marked.join(rest.hint("shuffle_merge"), "__level_value", "left")
        kept = [F.col(f"`{c}`") for c in df.columns]
        return joined.select(*kept, F.when(value.isNotNull(), F.coalesce("__level_known", "__level_rank")).alias(to))

    def one_hot(self, df: DataFrame, column: str, to: str | None = None) -> DataFrame:
        """``df`` with the column as a sparse vector, in ``to``: a place per level but the first, in sorted order.

        The first level, null and values that are no level are the zero vector.
        """
        n, to = self.sizes[column], to or f"{column}_onehot"
        if n < 2:
            return df.withColumn(to, array_to_vector(F.array().cast("array<double>")))
        ranked = self.rank_column(df, column, "__level_rank")
        last = float(n - 1)
        index = F.when(F.col("__level_rank") > 0, (F.col("__level_rank") - 1).cast("double")).otherwise(F.lit(last))
        # The encoder takes the number of places from what the column says of itself: it reads no rows.
        about = {"ml_attr": {"type": "nominal", "num_vals": n}}
        coded = ranked.withColumn("__level_index", index).withMetadata("__level_index", about)
        encoder = OneHotEncoder(inputCol="__level_index", outputCol=to, dropLast=True).fit(coded)
        return encoder.transform(coded).drop("__level_rank", "__level_index")
