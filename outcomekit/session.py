"""Session settings, staging of intermediate tables and size-checked broadcasts."""

from __future__ import annotations

import atexit
import shutil
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAGE_FOLDER = "outcomekit-stage"
#: Deletes the shuffle files of an execution at its end; earlier versions of Spark do not know it.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SMALL_ROWS = 50_000

_local_folders: set[str] = set()
_runs: list[list[tuple[str, str]]] = []


def build_session(app: str = "outcomekit", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators assume.

    A cluster passes its own ``master`` and partition counts; ``conf`` wins over
    everything set here.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables: as ``spark.checkpoint.dir`` names it, else in the warehouse.

    Executors share both. A local session without the setting has its folder of the warehouse deleted
    when the process ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{STAGE_FOLDER}-{spark.sparkContext.applicationId}"
    if spark.sparkContext.master.startswith("local") and folder not in _local_folders:
        _local_folders.add(folder)
        atexit.register(shutil.rmtree, folder.removeprefix("file:"), ignore_errors=True)
    return folder


def new_stage(spark: SparkSession) -> tuple[str, str]:
    """Path and table name of a staged table that does not exist yet; the innermost open run deletes both.

    The name is for tables that are saved with a layout, as buckets; others have a path alone.
    """
    name = uuid.uuid4().hex
    made = f"{scratch_dir(spark).rstrip('/')}/{STAGE_FOLDER}/{name}", f"stage_{name}"
    if _runs:
        _runs[-1].append(made)
    return made


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go as soon as it is written, not when the driver collects garbage.

    Only for results that are read from where they were written.
    """
    known = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if known is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, known)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage of a table that several jobs read: the parts survive the
    loss of executors, and later scans still prune columns and push filters.
    """
    spark = df.sparkSession
    path, _ = new_stage(spark)
    with freed_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged_run(spark: SparkSession) -> Iterator[Callable[[], None]]:
    """Collect what is staged inside; the value deletes it, once nothing reads it any more."""
    made: list[tuple[str, str]] = []
    _runs.append(made)

    def release() -> None:
        while made:
            path, name = made.pop()
            if spark.sparkContext._jsc is not None:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            _delete(spark, path)

    try:
        yield release
    finally:
        # By identity: lists of equal content are other runs.
        _runs[:] = [r for r in _runs if r is not made]


def _delete(spark: SparkSession, path: str) -> None:
    # A session that has ended leaves its folder to whoever owns it.
    if spark.sparkContext._jsc is not None:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release_stages(spark: SparkSession) -> None:
    """Delete all staged tables of this folder; tables still read from them are lost."""
    _delete(spark, f"{scratch_dir(spark).rstrip('/')}/{STAGE_FOLDER}")


def small_table(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` ready to be the small side of a join.

    Up to ``max_rows`` rows it comes back as a local relation with a broadcast
    hint: the size is known, not guessed. A larger one comes back unchanged, for
    a shuffled join whose skew AQE can split.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return df
    if rows.num_rows == 0:
        return df.limit(0)
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema=df.schema))


def join_groups(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal columns where NULL equals NULL, so that a group without a name is kept."""
    marked = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on])
    return left.join(marked, same, how).drop(*[f"_right_{c}" for c in on])
