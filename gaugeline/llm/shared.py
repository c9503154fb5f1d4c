"""Written tables that cut lineage, and document keys."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANED: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application that driver and executors share.

    It lies in ``spark.checkpoint.dir``; where that is unset, as in tests, in the warehouse.
    It is removed when the driver's Python ends.
    """
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{top.rstrip('/')}/llm-{spark.sparkContext.applicationId}"
    if folder not in _CLEANED:
        _CLEANED.add(folder)
        atexit.register(_remove, spark, folder)
    return folder


def _remove(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is None:
        return
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def repeats_ids(docs: DataFrame, id_col: str) -> bool:
    """Whether ids can't serve as keys: not whole numbers, null, or on several rows."""
    if dict(docs.dtypes)[id_col] not in ("bigint", "int", "smallint", "tinyint"):
        return True
    return docs.groupBy(F.col(id_col).alias("id")).count().filter("count > 1 OR id IS NULL").limit(1).count() > 0


def with_keys(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``(key long, text)`` with one row per key, and a function that turns ``key`` of a result into ids again.

    The function takes the names of further columns that hold keys.

    Ids that are long, not null and unique are the keys. Otherwise each distinct pair of id and text
    becomes one document; keys follow the order of ids (null first), then of texts, and
    the result has a row for each row of ``docs``.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    if not repeats_ids(docs, id_col):
        kind = dict(plain.dtypes)["id"]
        keyed = plain.select(F.col("id").cast("long").alias("key"), "text")
        return keyed, lambda out, *more: out.withColumns({c: F.col(c).cast(kind) for c in ("key", *more)}).withColumnRenamed("key", id_col)
    distinct = plain.groupBy("id", "text").agg(F.count("*").alias("copies"))
    ordered = distinct.repartitionByRange("id", "text").sortWithinPartitions("id", "text")
    table = materialize(ordered.withColumn("key", F.monotonically_increasing_id()), "keys")

    def restore(out: DataFrame, *more: str) -> DataFrame:
        names = [c for c in out.columns if c != "key"]
        for name in more:
            ids = table.select(F.col("key").alias(name), F.col("id").alias("_id"))
            out = out.join(ids, name).drop(name).withColumnRenamed("_id", name)
        back = table.select(F.col("key"), F.col("id").alias(id_col),
                            F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"))
        return back.join(out, "key").select(id_col, *names)

    return table.select("key", "text"), restore
