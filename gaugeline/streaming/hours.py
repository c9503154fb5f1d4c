"""Hourly means that late readings still correct: partial sums by batch, merged when read."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeline import constants as C
from gaugeline.functions import as_moment, interval_seconds, time_bin
from gaugeline.session import folder_numbers
from gaugeline.streaming.daylog import BATCH, DayLog

_SUMS = [f"{kind}_{part}" for kind in C.FEATURES for part in ("sum", "n")]
PARTIAL = ("station_id string, hour timestamp, "
           + ", ".join(f"{name} {'double' if name.endswith('_sum') else 'bigint'}" for name in _SUMS) + ", n_readings bigint")


def partials(spark: SparkSession, path: str) -> DayLog:
    return DayLog(spark, f"{path}/hours", PARTIAL)


def newest_before(spark: SparkSession, path: str, batch_id: int | None = None):
    """The newest time of all batches before ``batch_id``, None without any."""
    done = [n for n in folder_numbers(spark, f"{path}/newest/{BATCH}=*/_SUCCESS") if batch_id is None or n < batch_id]
    return spark.read.parquet(f"{path}/newest/{BATCH}={done[-1]}").first()["newest"] if done else None


def store_batch(micro: DataFrame, batch_id: int, path: str, late_path: str, delay: str, interval: str, clock) -> None:
    """Readings of one micro-batch as partial sums per station and hour, and as dead letters with a ``problem``."""
    spark = micro.sparkSession
    newest = newest_before(spark, path, batch_id)
    late = F.lit(False) if newest is None else F.col("ts") < F.lit(newest) - F.make_interval(secs=F.lit(interval_seconds(delay)))
    problem = (F.when(F.col("ts").isNull(), "NO_TIME").when(F.col("ts") > as_moment(clock), "FUTURE").when(late, "LATE"))
    judged = micro.withColumn("problem", problem).persist()
    try:
        good = judged.filter("problem IS NULL")
        sums = []
        for kind in C.FEATURES:
            value = F.when(F.col("data_type") == kind, F.col("value"))
            sums += [F.sum(value).alias(f"{kind}_sum"), F.count(value).alias(f"{kind}_n")]
        hours = good.groupBy("station_id", time_bin(F.col("ts"), interval_seconds(interval)).alias("hour")).agg(
            *sums, F.count(F.lit(1)).alias("n_readings"))
        partials(spark, path).write(hours.withColumn("day", F.to_date("hour")), batch_id)
        judged.filter("problem IS NOT NULL").write.mode("overwrite").parquet(f"{late_path}/{BATCH}={batch_id}")
        mark = good.agg(F.greatest(F.max("ts"), F.lit(newest).cast("timestamp")).alias("newest"))
        mark.coalesce(1).write.mode("overwrite").parquet(f"{path}/newest/{BATCH}={batch_id}")
    finally:
        judged.unpersist()


def _merged(rows: DataFrame) -> DataFrame:
    return rows.groupBy("station_id", "hour").agg(*[F.sum(name).alias(name) for name in [*_SUMS, "n_readings"]])


def store_hours(readings: DataFrame, path: str, late_path: str, delay: str = C.EXPIRY, interval: str = C.SAMPLING, clock=None,
                checkpoint: str | None = None, trigger: dict | None = None, name: str = "hours", merge_every: int = 100) -> StreamingQuery:
    """Hourly sums and counts per station; every reading ends in an hour or, with its ``problem``, in ``late_path``.

    A reading is LATE if it is more than ``delay`` older than the newest one of the batches before; one that is
    not corrects its hour, however long ago that was first written. NO_TIME and FUTURE (after ``clock``, the time of processing) are
    the other problems, and neither moves the newest time. A batch that runs again replaces its own sums. Days with ``merge_every`` batches
    are merged. :func:`read_hours` gives the means.
    """
    from gaugeline.streaming.jobs import _start

    def store(micro: DataFrame, batch_id: int) -> None:
        store_batch(micro, batch_id, path, late_path, delay, interval, clock)
        if batch_id and batch_id % merge_every == 0:
            merge_hours(micro.sparkSession, path, batch_id, merge_every)

    return _start(readings, readings.sparkSession, name, checkpoint, "append", trigger).foreachBatch(store).start()


def merge_hours(spark: SparkSession, path: str, before: int, many: int) -> None:
    """One row per station and hour for what batches before ``before`` wrote on days with ``many`` of them."""
    partials(spark, path).merge(before, many, lambda rows: _merged(rows).withColumn(BATCH, F.lit(before - 1).cast("long")))


def read_hours(spark: SparkSession, path: str, days: Iterable[str] | None = None, delay: str = C.EXPIRY, interval: str = C.SAMPLING) -> DataFrame:
    """Means per station and hour of the ``days`` (as text; all by default) and ``closed``: no reading can change the hour any more."""
    newest = newest_before(spark, path)
    end = F.col("hour") + F.make_interval(secs=F.lit(interval_seconds(interval) + interval_seconds(delay)))
    means = [F.when(F.col(f"{kind}_n") > 0, F.col(f"{kind}_sum") / F.col(f"{kind}_n")).alias(kind) for kind in C.FEATURES]
    closed = F.coalesce(end <= F.lit(newest).cast("timestamp"), F.lit(False))
    return _merged(partials(spark, path).read(days)).select("station_id", "hour", *means, "n_readings", closed.alias("closed"))
