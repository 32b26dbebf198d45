"""Sessions, table access and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def session(app: str = "foliospark", master: str | None = None, shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; on a cluster the submitter's settings hold."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FOLIO_DRIVER_MEMORY", "8g"))
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, read where only Spark need reach it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as there are cores: a file of one row group is else one task's work, however costly its texts are. Large inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() <= cores else df


_local: dict[str, str] = {}  # application -> folder of a session in one process


def shared_dir(spark: SparkSession) -> str:
    """This application's folder below spark.checkpoint.dir, which driver and executors share.

    Where that is unset, a session whose master is local gets a temporary folder; any other is refused, as its executors would
    not see such a folder.
    """
    name = spark.sparkContext.applicationId
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors reach")
        found = _local.get(name) or _local.setdefault(name, "file://" + tempfile.mkdtemp(prefix="folio-"))
    return f"{found.rstrip('/')}/foliospark-{name}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Removes the shuffle files of each write inside as soon as it ends, where else they stay until the driver happens to collect garbage. For tables of which a text is moved."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


ROWS_A_FILE = 50_000


def written(df: DataFrame, label: str, rows: int | None = None, **options: str) -> DataFrame:
    """df written once as Parquet into the shared folder and read back: lineage ends here, and a lost executor only rereads it.

    rows: about how many rows there are at most, where that is known; small tables of iterations then get few files. Tables stay
    until discard() or clear_scratch() removes them, as a returned DataFrame may still read them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if rows is not None:
        df = df.coalesce(max(8, rows // ROWS_A_FILE + 1))
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def _found(spark: SparkSession, where: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, where: str) -> bool:
    """Whether there is a file or folder of that name, in whatever store it names."""
    fs, path = _found(spark, where)
    return fs.exists(path)


def remove(spark: SparkSession, where: str) -> None:
    fs, path = _found(spark, where)
    fs.delete(path, True)


def discard(*frames: DataFrame) -> None:
    """Removes tables that written() made and nothing reads any more."""
    for df in frames:
        remove(df.sparkSession, df._written_at)


def clear_scratch(spark: SparkSession) -> None:
    """Removes all that this application has written into the shared folder; call it once its results are saved elsewhere."""
    remove(spark, shared_dir(spark))
