"""CSV of unknown types, read once: types are guessed from a sample and checked on every row.

The first lines give a type to each column. The one pass over the files reads every value as text, tries the
guessed type, and stages what came of it as Parquet: the typed value, and the text where it did not fit or would
be written otherwise (as ``007``). One aggregate over that tells which wider type holds all values of a column
(int, bigint, double, text; date, timestamp, text; boolean, text). A column is widened from the staged values, so
the files are not read again, and text comes back as it was.

Defined cases: empty fields are null and fit every type. Rows with too few or too many fields are counted, and kept
with what fields they have. A file of a header alone gives text columns without rows. Of columns of one name the
later ones are named as Spark names them in its own CSV scan. A field cannot hold a line break. Files of one path
are taken to have the same header.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomekit.session import new_stage, stage
from outcomekit.sources.files import _load

#: Types a value may be read as when it does not fit the guessed one, narrowest first.
WIDER = {
    "int": ("bigint", "double", "string"),
    "bigint": ("double", "string"),
    "double": ("string",),
    "date": ("timestamp", "string"),
    "timestamp": ("string",),
    "boolean": ("string",),
    "string": (),
}
BROKEN = "_broken_record"


@dataclass(frozen=True)
class CheckedCsv:
    """Typed rows; per column the guessed and the final type and how many values did not fit; odd rows."""

    rows: DataFrame
    columns: dict[str, tuple[str, str, int, int]]
    n_rows: int
    n_broken: int

    def report(self) -> DataFrame:
        """One row per column: column, guessed, type, n_misfits of the guess, n_lost as null."""
        out = [(c, *of) for c, of in self.columns.items()]
        return self.rows.sparkSession.createDataFrame(
            out, "column string, guessed string, type string, n_misfits long, n_lost long"
        )


def guessed_types(spark: SparkSession, path: str, sample_rows: int, options: dict) -> list[tuple[str, str]]:
    """Names and types as the first ``sample_rows`` lines tell; types without a wider one are read as text."""
    lines = _load(spark, path, "text", None, {}).limit(sample_rows + 1)
    sample, _ = new_stage(spark)
    lines.coalesce(1).write.text(sample)
    schema = spark.read.options(**options).csv(sample, header=True, inferSchema=True).schema
    kinds = [f.dataType.simpleString() for f in schema]
    return [(f.name, k if k in WIDER else "string") for f, k in zip(schema, kinds, strict=True)]


def _read_as(text: Column, kind: str) -> Column:
    # A cast to date would drop the time of a timestamp.
    fits = text if kind != "date" else F.when(F.length(F.trim(text)) <= len("2000-01-01"), text)
    return fits.try_cast(kind)


def _text_of(value: Column, kind: str) -> Column:
    return value if kind == "string" else value.cast("string")


def read_csv_checked(
    spark: SparkSession, path: str, sample_rows: int = 10_000, allow: float = 0.0, **options
) -> CheckedCsv:
    """CSV with a header line, each column of the narrowest type that all its values fit.

    A column keeps a narrower type if no more than a share ``allow`` of its values do not fit; these become null
    and are counted as lost.
    """
    named = guessed_types(spark, path, sample_rows, options)
    texts = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(named))])
    texts = texts.add(BROKEN, T.StringType())
    # Names go by position: the header's may repeat or hold dots.
    raw = _load(spark, path, "csv", texts, {
        **options, "header": True, "enforceSchema": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN,
    })
    kept = [F.col(BROKEN).isNotNull().alias("broken")]
    for i, (_, kind) in enumerate(named):
        text = F.col(f"_{i}")
        value = _read_as(text, kind)
        plain = value.isNotNull() & (_text_of(value, kind) == text)
        kept += [value.alias(f"v{i}"), F.when(~F.coalesce(plain, F.lit(False)), text).alias(f"t{i}")]
    staged = stage(raw.select(*kept))
    aggs = [F.count("*").alias("n"), F.count_if("broken").alias("broken")]
    for i, (_, kind) in enumerate(named):
        misfit = F.col(f"v{i}").isNull() & F.col(f"t{i}").isNotNull()
        aggs.append(F.count_if(misfit).alias(f"m{i}_0"))
        for k, wide in enumerate(WIDER[kind], 1):
            aggs.append(F.count_if(misfit & F.col(f"t{i}").try_cast(wide).isNull()).alias(f"m{i}_{k}"))
        aggs.append(F.count_if(F.col(f"v{i}").isNotNull() | F.col(f"t{i}").isNotNull()).alias(f"n{i}"))
    counts = staged.agg(*aggs).first()
    out, about = [], {}
    for i, (name, kind) in enumerate(named):
        ladder = (kind, *WIDER[kind])
        left = [counts[f"m{i}_{k}"] for k in range(len(ladder))]
        at = next(k for k, lost in enumerate(left) if lost <= allow * counts[f"n{i}"])
        final, value, text = ladder[at], F.col(f"v{i}"), F.col(f"t{i}")
        if at and final == "string":
            value = F.coalesce(text, _text_of(value, kind))
        elif at:
            value = F.coalesce(value.cast(final), text.try_cast(final))
        out.append(value.alias(name))
        about[name] = (kind, final, left[0], left[at])
    return CheckedCsv(staged.select(*out), about, counts["n"], counts["broken"])
