"""Spark session settings and shared folders."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job of this package relies on; all can be set at run time.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Times of 96 bits, the default, have no statistics in Parquet, so no scan could skip by them.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
#: Fixed when a session starts. Recording the Python call site of every column
#: would triple the time to build a plan.
START_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the results depend on to an existing session."""
    for key, value in SQL_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "gaugeline", master: str | None = None, **conf: str) -> SparkSession:
    """Session with this package's settings; on a cluster leave ``master`` to spark-submit.

    The number of shuffle partitions is left to the cluster: adaptive execution
    merges small ones, so set it for the largest shuffle.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_CONF, **START_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_root(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names, or one beside the tables of the warehouse.

    A warehouse in a folder of one machine is no place for that, unless driver and executors are on it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return f"{warehouse}/_checkpoints"


def shared_folder(spark: SparkSession, name: str) -> str:
    """Folder ``name`` below the shared checkpoint folder."""
    return f"{shared_root(spark)}/{name}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of any file system, if there is one."""
    context = spark.sparkContext
    if context._jsc is None:  # the session has ended, and nothing can be reached through it
        return
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def folder_values(spark: SparkSession, pattern: str) -> list[str]:
    """Sorted values of the ``<name>=<value>`` folders that a pattern finds; one that ends in a file gives those that hold it."""
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(at) or []
    paths = [f.getPath() if "=" in f.getPath().getName() else f.getPath().getParent() for f in found]
    return sorted(p.getName().split("=", 1)[1] for p in paths)


def list_paths(spark: SparkSession, patterns: list[str]) -> list[str]:
    """Sorted paths that the patterns find, of any file system."""
    context, found = spark.sparkContext, []
    for pattern in patterns:
        at = context._jvm.org.apache.hadoop.fs.Path(pattern)
        found += at.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(at) or []
    return sorted(f.getPath().toString() for f in found)


def create_file(spark: SparkSession, path: str) -> None:
    """An empty file; it is there at once or not at all."""
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(context._jsc.hadoopConfiguration()).create(at, True).close()


def folder_numbers(spark: SparkSession, pattern: str) -> list[int]:
    """:func:`folder_values` as ascending numbers."""
    return sorted(int(v) for v in folder_values(spark, pattern))


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, for tables that are read until the driver ends, and then removed."""
    folder = shared_folder(spark, f"runs/{name}-{uuid.uuid4().hex[:12]}")
    atexit.register(remove_folder, spark, folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows of ``df`` from a reliable checkpoint in the shared folder.

    For a frame that several later steps read: its plan is run once, survives the
    loss of executors, and later plans start from it. A folder that is set here is removed when the driver ends.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_root(df.sparkSession))
        atexit.register(remove_folder, df.sparkSession, context.getCheckpointDir())
    return df.checkpoint()
