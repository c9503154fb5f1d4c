"""The newest days of every series, from a small table kept beside the stored one, so that forecasts open no other days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeline import constants as C
from gaugeline.functions import epoch, interval_seconds
from gaugeline.sources import commits

DAY = "day"


def index_rows(bins: DataFrame, keys: Sequence[str], time_col: str, measures: Sequence[str]) -> DataFrame:
    """One row per series and day: its last bin, and which measures have a known value."""
    known = [F.max(F.col(m).isNotNull()).alias(f"known_{m}") for m in measures]
    return bins.groupBy(*keys, F.to_date(time_col).alias(DAY)).agg(F.max(time_col).alias("last_bin"), *known)


def store_index(bins: DataFrame, path: str, batch: str, keys: Sequence[str], time_col: str, measures: Sequence[str]) -> None:
    """Append what a batch of the stored table adds to the index; the batch may be stored again."""
    commits.append_batch(index_rows(bins, keys, time_col, measures), path, batch)


def tail_days(index: DataFrame, keys: Sequence[str], measures: Sequence[str], last: int = C.WINDOW_ROWS,
              interval: str = C.SAMPLING) -> DataFrame:
    """The days of each series that its last ``last`` bins depend on: those these bins lie on, the last day before them, and for each measure
    the last day before them with a known value, as far back as that is.

    A series has a row per day here, so its days are few however many rows they have.
    """
    merged = index.groupBy(*keys, DAY).agg(F.max("last_bin").alias("last_bin"), *[F.max(f"known_{m}").alias(f"known_{m}") for m in measures])
    whole = W.partitionBy(*keys)
    first = F.to_date(F.timestamp_seconds(epoch(F.max("last_bin").over(whole)) - (last - 1) * interval_seconds(interval)))
    placed = merged.withColumn("_first", first)
    before = F.when(F.col(DAY) < F.col("_first"), F.col(DAY))
    needed = {"_before": F.max(before).over(whole)} | {
        f"_known_{i}": F.max(F.when(F.col(f"known_{m}"), before)).over(whole) for i, m in enumerate(measures)}
    wanted = F.col(DAY) >= F.col("_first")
    for name in needed:
        wanted = wanted | F.coalesce(F.col(DAY) == F.col(name), F.lit(False))
    return placed.withColumns(needed).filter(wanted).select(*keys, DAY)


def read_tail(stored: DataFrame, days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``stored``, which is partitioned by day, on the days that :func:`tail_days` names; other days are not opened."""
    opened = [r[DAY] for r in days.select(DAY).distinct().collect()]  # at most one for each day of the table
    if not opened:
        return stored.limit(0)
    wanted = days.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(DAY).alias("_day"))
    same = F.col(DAY) == F.col("_day")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return stored.filter(F.col(DAY).isin(opened)).join(wanted, same, "left_semi")


def load(spark: SparkSession, path: str) -> DataFrame:
    return commits.read_batches(spark, path)
