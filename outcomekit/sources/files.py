"""File scans and sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class SourceNotFound(FileNotFoundError):
    """The path to read does not exist."""


def _load(spark: SparkSession, path: str, fmt: str, schema, options: dict) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            raise SourceNotFound(f"no data at {path}") from err
        raise


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """CSV with a header line.

    With a schema the files are read once. Without one Spark infers types, which
    costs one more pass over all files: for exploration only.
    """
    opts = {"header": True, "inferSchema": schema is None, **options}
    return _load(spark, path, "csv", schema, opts)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    return _load(spark, path, "parquet", schema, {})


def write_csv(df: DataFrame, path: str, single_file: bool = False, max_single_rows: int = 1_000_000) -> None:
    """Write with a header and no row index, one file per partition.

    ``single_file`` is for reports: it sends every row through one task, so a
    table above ``max_single_rows`` is refused.
    """
    if single_file:
        if df.limit(max_single_rows + 1).count() > max_single_rows:
            raise ValueError(f"more than {max_single_rows} rows: write one file per partition")
        df = df.coalesce(1)
    df.write.option("header", True).mode("overwrite").csv(path)
