"""Feature encoding, scaling and weighting.

Each step learns a small state from one aggregation and applies it as literals
in a projection, so that new data is treated exactly like the data it was fitted
on.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomekit.functions import map_values
from outcomekit.operators.profile import distinct_estimates, distinct_values, domain_test

MAX_LEVELS = 2_000
MAX_VECTOR_LEVELS = 1_000_000
MAX_CLASSES = 1_000
#: A sketch that tells so many times as many levels as allowed is beyond its error.
SURE_EXCESS = 1.2

# Two-valued domains that become 1 and 0.
YES_NO = {"Yes": 1, "No": 0}
MALE_FEMALE = {"Male": 1, "Female": 0}


def column_levels(df: DataFrame, cols: Sequence[str], max_levels: int = MAX_LEVELS) -> dict[str, list[str]]:
    """Sorted distinct values of each text column.

    Levels end up as columns, so a column of more than ``max_levels`` is refused: if sketches tell that it has
    clearly more, before any of its values are shuffled.
    """
    if not cols:
        return {}
    cols = list(dict.fromkeys(cols))
    about = {r["column"]: r["n"] for r in distinct_estimates(df, cols).collect()}
    wide = [c for c in cols if (about[c] or 0) > SURE_EXCESS * max_levels]
    if wide:
        raise ValueError(f"more than {max_levels} levels in {wide}")
    limit = max_levels * len(cols)
    rows = distinct_values(df, cols).limit(limit + 1).collect()
    levels = {c: sorted(r["value"] for r in rows if r["column"] == c) for c in cols}
    broad = [c for c in cols if len(levels[c]) > max_levels]
    if broad or len(rows) > limit:
        raise ValueError(f"more than {max_levels} levels in {broad or cols}")
    return levels


@dataclass(frozen=True)
class OneHot:
    """A 0/1 column per level but the first, in sorted order.

    Null and levels not seen in the fit give all zeros. The new columns follow
    the kept ones and are named ``column_level``.
    """

    levels: dict[str, list[str]]
    drop_first: bool = True

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], drop_first: bool = True, max_levels: int = MAX_LEVELS) -> OneHot:
        return cls(column_levels(df, cols, max_levels), drop_first)

    def output_columns(self) -> list[str]:
        return [f"{c}_{v}" for c, v in self._pairs()]

    def _pairs(self):
        skip = 1 if self.drop_first else 0
        return [(c, v) for c, levels in self.levels.items() for v in levels[skip:]]

    def transform(self, df: DataFrame) -> DataFrame:
        kept = [F.col(f"`{c}`") for c in df.columns if c not in self.levels]
        flags = [
            F.when(F.col(f"`{c}`") == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{c}_{v}")
            for c, v in self._pairs()
        ]
        return df.select(*kept, *flags)


@dataclass(frozen=True)
class OneHotVector:
    """The same encoding as one sparse vector per column, for columns of very many levels.

    The plan does not grow with the levels: values are looked up in the label index
    of a fitted indexer. The first level, null and unseen levels share the place
    that the encoder drops, so all of them are the zero vector.
    """

    levels: dict[str, list[str]]
    suffix: str = "_onehot"

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], max_levels: int = MAX_VECTOR_LEVELS) -> OneHotVector:
        return cls(column_levels(df, cols, max_levels))

    def names(self, column: str) -> list[str]:
        return [f"{column}_{v}" for v in self.levels[column][1:]]

    def transform(self, df: DataFrame) -> DataFrame:
        for c, levels in self.levels.items():
            index, vector = f"{c}_index", f"{c}{self.suffix}"
            if len(levels) < 2:
                df = df.withColumn(vector, array_to_vector(F.array().cast("array<double>"))).drop(c)
                continue
            indexer = StringIndexerModel.from_labels(levels[1:], inputCol=c, outputCol=index, handleInvalid="keep")
            coded = indexer.transform(df)
            # The sizes come from the indexer's metadata: fitting reads no rows.
            encoder = OneHotEncoder(inputCol=index, outputCol=vector, dropLast=True).fit(coded)
            df = encoder.transform(coded).drop(c, index)
        return df


@dataclass(frozen=True)
class AutoEncode:
    """Per text column: a Yes/No or Male/Female domain becomes 1/0, any other one-hot columns."""

    mapped: dict[str, dict[str, int]]
    one_hot: OneHot

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], max_levels: int = MAX_LEVELS) -> AutoEncode:
        if not cols:
            return cls({}, OneHot({}))
        cols = list(dict.fromkeys(cols))
        domains = {"yes_no": YES_NO, "male_female": MALE_FEMALE}
        mapped = {}
        # One row tells which columns need no levels.
        for r in domain_test(df, cols, {name: list(d) for name, d in domains.items()}).collect():
            fits = [d for name, d in domains.items() if r[name]]
            if fits:
                mapped[r["column"]] = fits[0]
        return cls(mapped, OneHot(column_levels(df, [c for c in cols if c not in mapped], max_levels)))

    def transform(self, df: DataFrame) -> DataFrame:
        coded = df.withColumns({c: map_values(c, d) for c, d in self.mapped.items()}) if self.mapped else df
        return self.one_hot.transform(coded)


def feature_columns(df: DataFrame, label: str, others: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if c != label and c not in others]


def assemble(df: DataFrame, features: Sequence[str], to: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """Features as one vector column; the names stay in the column's metadata."""
    # The assembler reads dots in a name as field access, so columns go in by position.
    places = [f"_{i}" for i in range(len(features))]
    kept = [F.col(f"`{c}`").alias(f"_kept_{i}") for i, c in enumerate(keep)]
    values = [F.col(f"`{c}`").cast("double").alias(p) for c, p in zip(features, places, strict=True)]
    rows = VectorAssembler(inputCols=places, outputCol="_vector").transform(df.select(*kept, *values))
    named = [{"idx": i, "name": c} for i, c in enumerate(features)]
    about = {"ml_attr": {"attrs": {"numeric": named}, "num_attrs": len(named)}}
    return rows.select(*[F.col(f"_kept_{i}").alias(c) for i, c in enumerate(keep)], F.col("_vector").alias(to, metadata=about))


@dataclass(frozen=True)
class Standardize:
    """Subtract the mean and divide by the population standard deviation (by 1 where that is 0)."""

    stats: dict[str, tuple[float, float]]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], where: Column | None = None) -> Standardize:
        rows = df if where is None else df.where(where)
        aggs = []
        for i, c in enumerate(cols):
            x = F.col(f"`{c}`").cast("double")
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
        row = rows.agg(*aggs).first()
        return cls({c: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(cols) if row[f"m{i}"] is not None})

    def transform(self, df: DataFrame) -> DataFrame:
        scaled = {
            c: (F.col(f"`{c}`").cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in self.stats.items()
        }
        # One select keeps names with dots and the column order.
        return df.select(*[scaled[c].alias(c) if c in scaled else F.col(f"`{c}`") for c in df.columns])


@dataclass(frozen=True)
class ClassWeights:
    """Weight n / (k x n_c) for each of the k classes."""

    weights: dict[float, float]

    @classmethod
    def fit(cls, df: DataFrame, label: str, where: Column | None = None) -> ClassWeights:
        rows = (df if where is None else df.where(where)).where(F.col(label).isNotNull())
        counts = rows.groupBy(F.col(label).alias("c")).agg(F.count("*").alias("n")).limit(MAX_CLASSES + 1).collect()
        if len(counts) > MAX_CLASSES:
            raise ValueError(f"more than {MAX_CLASSES} classes")
        n = sum(r["n"] for r in counts)
        return cls({r["c"]: n / (len(counts) * r["n"]) for r in sorted(counts, key=lambda r: r["c"])})

    def column(self, label: str) -> Column:
        return map_values(label, self.weights)

    def transform(self, df: DataFrame, label: str, to: str = "weight") -> DataFrame:
        return df.withColumn(to, self.column(label))

