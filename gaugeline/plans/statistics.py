"""Statistics per series and day that are stored as days arrive and merged when read, so that scaling new days reads no history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions import guarded
from gaugeline.sources import commits

DAY = "day"
_PARTS = ("n", "mean", "squares", "min", "max")


def _name(measure: str, part: str) -> str:
    return f"{measure}__{part}"


def day_statistics(df: DataFrame, keys: Sequence[str], time_col: str, measures: Sequence[str]) -> DataFrame:
    """Count, mean, sum of squares about it, least and largest value of each measure per series and day."""
    parts = []
    for m in measures:
        x = F.col(m).cast("double")
        parts += [F.count(x).alias(_name(m, "n")), F.avg(x).alias(_name(m, "mean")), (F.var_pop(x) * F.count(x)).alias(_name(m, "squares")),
                  F.min(x).alias(_name(m, "min")), F.max(x).alias(_name(m, "max"))]
    return df.groupBy(*keys, F.to_date(time_col).alias(DAY)).agg(*parts)


def store(df: DataFrame, path: str, batch: str, keys: Sequence[str], time_col: str, measures: Sequence[str]) -> None:
    """Append the statistics of the days in ``df``; the batch may be stored again, and a day may come in several batches."""
    commits.append_batch(day_statistics(df, keys, time_col, measures), path, batch)


def merged(stored: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per series: ``<measure>__<part>`` for count, mean, squares, min and max of all its days.

    Means are merged first and the squares about the merged mean after them, so nothing is taken from a large
    difference. The table has a row per series and day; sums of a series are combined on the map side.
    """
    means = stored.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(*[e for m in measures for e in (
        F.sum(_name(m, "n")).alias(f"_n_{m}"),
        (F.sum(F.col(_name(m, "n")) * F.col(_name(m, "mean"))) / F.greatest(F.sum(_name(m, "n")), F.lit(1))).alias(f"_mean_{m}"))])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    near = stored.join(means, same)
    sums = []
    for m in measures:
        n, away = F.col(_name(m, "n")), F.col(_name(m, "mean")) - F.col(f"_mean_{m}")
        sums += [F.sum(n).alias(_name(m, "n")), F.first(f"_mean_{m}").alias(_name(m, "mean")),
                 F.sum(F.col(_name(m, "squares")) + n * away * away).alias(_name(m, "squares")),
                 F.min(_name(m, "min")).alias(_name(m, "min")), F.max(_name(m, "max")).alias(_name(m, "max"))]
    return near.groupBy(*keys).agg(*sums)


def _attached(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the statistics of their series; the series of a day's rows are few, so Spark sends the smaller side."""
    side = stats.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in stats.columns if c not in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(side, same, "left").drop(*[f"_{k}" for k in keys])


def _scaled(df: DataFrame, stats: DataFrame, keys: Sequence[str], changes) -> DataFrame:
    return _attached(df, stats, keys).withColumns(changes).select(*df.columns, *[c for c in changes if c not in df.columns])


def standardize(df: DataFrame, stats: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Z-scores of new rows by the merged statistics of their series; a constant column scales to 0."""
    spread = {m: guarded(F.sqrt(F.col(_name(m, "squares")) / F.greatest(F.col(_name(m, "n")), F.lit(1)))) for m in measures}
    return _scaled(df, stats, keys, {m: (F.col(m) - F.col(_name(m, "mean"))) / spread[m] for m in measures})


def normalize(df: DataFrame, stats: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Min-max scaling of new rows by the merged statistics of their series."""
    low = {m: F.col(_name(m, "min")) for m in measures}
    return _scaled(df, stats, keys, {m: (F.col(m) - low[m]) / guarded(F.col(_name(m, "max")) - low[m]) for m in measures})


def anomalies(df: DataFrame, stats: DataFrame, keys: Sequence[str], measures: Sequence[str], threshold: float = 3.0) -> DataFrame:
    """Adds ``is_anomaly_<measure>``: farther than ``threshold`` sample deviations from the mean of the series."""
    flags = {}
    for m in measures:
        n = F.col(_name(m, "n"))
        deviation = F.when(n > 1, F.sqrt(F.col(_name(m, "squares")) / F.greatest(n - 1, F.lit(1))))
        flags[f"is_anomaly_{m}"] = F.coalesce(F.abs(F.col(m) - F.col(_name(m, "mean"))) > threshold * deviation, F.lit(False))
    return _scaled(df, stats, keys, flags)


def load(spark: SparkSession, path: str) -> DataFrame:
    """All stored rows, one per series, day and batch."""
    return commits.read_batches(spark, path)
