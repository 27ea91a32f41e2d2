"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  memory: str = "16g", app_name: str = "sheafline",
                  checkpoint_dir: str | None = None) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.checkpoint.dir", checkpoint_dir or tempfile.mkdtemp(prefix="sheafline-"))
        .getOrCreate()
    )


def ensure_folder(spark: SparkSession) -> None:
    """Give a local session that names no ``spark.checkpoint.dir`` a temporary one.

    Only entry points call this; a cluster session has to name a folder that all its
    executors share.
    """
    context = spark.sparkContext
    if (not context.getCheckpointDir() and spark.conf.get("spark.checkpoint.dir", None) is None
            and context.master.startswith("local[")):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="sheafline-"))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


_written: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one table in the shared folder."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def mark() -> int:
    """How many tables this process has stored so far; see :func:`clean`."""
    return len(_written)


def clean(spark: SparkSession, since: int = 0, until: int | None = None) -> None:
    """Delete the tables that this process has stored in the shared folder, or those
    between two marks. Call it when results have been written: DataFrames that read a
    deleted table are void after it."""
    context = spark.sparkContext
    for path in map(context._jvm.org.apache.hadoop.fs.Path, _written[since:until]):
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    del _written[since:until]


@contextlib.contextmanager
def without_old_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a job go when the job has ended, not when the driver
    happens to collect its garbage. For plans that store each step and read it back."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back.

    Cuts the lineage so that a lost executor costs a re-read instead of a
    recomputation, and lets each later pass read only the columns it needs.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
