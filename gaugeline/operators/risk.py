"""Risk grades and display bands of a water level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeline import constants as C


def grade(level: Column, thresholds=tuple(C.WARNING_THRESHOLDS)) -> Column:
    """``struct(level, name, confidence)`` of the highest threshold reached.

    The confidence is a constant of the grade, not a probability. A NULL or NaN
    level has no grade.
    """
    def entry(number, name, confidence):
        return F.struct(F.lit(number).alias("level"), F.lit(name).alias("name"),
                        F.lit(confidence).alias("confidence"))

    result = None
    for number, name, lowest, confidence in sorted(thresholds, key=lambda t: -t[2]):
        reached = level >= lowest
        result = (F.when(reached, entry(number, name, confidence)) if result is None
                  else result.when(reached, entry(number, name, confidence)))
    return F.when(level.isNotNull() & ~F.isnan(level.cast("double")), result.otherwise(entry(*C.NO_RISK)))


def with_grade(df: DataFrame, level_col: str) -> DataFrame:
    """Adds ``risk_level``, ``risk_name`` and ``confidence``."""
    return (df.withColumn("_grade", grade(F.col(level_col)))
            .withColumns({"risk_level": F.col("_grade.level"), "risk_name": F.col("_grade.name"),
                          "confidence": F.col("_grade.confidence")}).drop("_grade"))


def display_band(level: Column) -> Column:
    """Band shown beside a reading; its bounds are exclusive, unlike the grades."""
    return F.when(level > 25, "high").when(level > 20, "elevated").when(level.isNotNull(), "normal")


def bands(thresholds: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Thresholds per key as half-open bands ``[min_level, below)`` that never overlap."""
    rising = W.partitionBy(*keys).orderBy("min_level")
    return thresholds.withColumn("below", F.lead("min_level").over(rising))


def grade_by_band(df: DataFrame, level_col: str, thresholds: DataFrame,
                  keys: tuple[str, ...] = ()) -> DataFrame:
    """The same grades from a thresholds table: each row meets at most one band.

    ``keys`` are columns, such as a station id, by which thresholds differ; then
    this is an equi-join with a range condition. The handful of global thresholds
    is packed into one constant array, so rows are not compared with a table.
    """
    level = F.col(level_col)
    if keys:
        band = bands(thresholds, keys).select(*[F.col(k).alias(f"_k_{k}") for k in keys], "min_level", "below",
                             F.col("level").alias("_level"), F.col("name").alias("_name"),
                             F.col("confidence").alias("_confidence"))
        on = [F.col(k) == F.col(f"_k_{k}") for k in keys]
        on += [level >= F.col("min_level"), F.col("below").isNull() | (level < F.col("below"))]
        condition = on[0]
        for part in on[1:]:
            condition = condition & part
        joined = df.join(band, condition, "left")
        found = {"risk_level": F.col("_level"), "risk_name": F.col("_name"),
                 "confidence": F.col("_confidence")}
    else:
        packed = thresholds.agg(F.sort_array(F.collect_list(
            F.struct("min_level", "level", "name", "confidence")))).scalar()
        joined = df.withColumn("_packed", packed).withColumn("_band", F.try_element_at(
            F.filter("_packed", lambda t: t["min_level"] <= level), F.lit(-1)))
        found = {"risk_level": F.col("_band.level"), "risk_name": F.col("_band.name"),
                 "confidence": F.col("_band.confidence")}
    number, name, confidence = C.NO_RISK
    rest = {"risk_level": number, "risk_name": name, "confidence": confidence}
    graded = {c: F.when(level.isNotNull(), F.coalesce(value, F.lit(rest[c])))
              for c, value in found.items()}
    return joined.withColumns(graded).select(*df.columns, *graded)
