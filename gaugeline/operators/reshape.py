"""Nested batches to flat readings, storage records and station-hour rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline import constants as C
from gaugeline.functions import nan_to_null, parse_iso, time_bin
from gaugeline.schemas import CORRUPT, READING, SOURCE


def flatten(batches: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """One row per reading, with the ``carried`` columns of its batch; a batch without readings gives none.

    Batches read as JSON lines carry the text of a line that is no batch: it gives one row with that
    text in ``malformed`` and nothing else, which no rule can accept.
    """
    if CORRUPT not in batches.columns:
        readings, text = F.explode("readings"), []
    else:
        rows = F.when(F.col(CORRUPT).isNotNull(), F.array(F.lit(None).cast(READING))).otherwise(F.col("readings"))
        readings, text = F.explode(rows), [F.col(CORRUPT).alias("malformed")]
    inner = batches.select(F.col("station_id").alias("_station"), *text, *carried, readings.alias("r"))
    return inner.select(
        *([F.col("malformed")] if text else []),
        F.coalesce("_station", "r.station_id").alias("station_id"), F.col("r.data_type").alias("data_type"),
        nan_to_null(F.col("r.value")).alias("value"), F.col("r.unit").alias("unit"),
        nan_to_null(F.col("r.parameters.ph")).alias("ph"),
        nan_to_null(F.col("r.parameters.turbidity")).alias("turbidity"),
        nan_to_null(F.col("r.parameters.dissolved_oxygen")).alias("dissolved_oxygen"),
        F.col("r.error").alias("error"), parse_iso(F.col("r.timestamp")).alias("ts"), *carried)


def storage_records(readings: DataFrame) -> DataFrame:
    """One storage record per reading; what the reading does not measure is NULL."""
    kind = F.col("data_type")

    def measure(name):
        return F.when(kind == name, F.col("value")).alias(name)

    def quality(name):
        return F.when(kind == "water_quality", F.col(name))

    return readings.select(
        *([F.col("malformed")] if "malformed" in readings.columns else []),
        F.col("station_id").alias("location_id"), F.col("ts").alias("timestamp"),
        F.when(F.col("error").isNotNull(), C.QUALITY_ABNORMAL).otherwise(C.QUALITY_OK)
        .alias("data_quality"),
        measure("water_level"), measure("flow_rate"), measure("rainfall"), measure("temperature"),
        quality("ph").alias("ph_value"), quality("turbidity").alias("turbidity"),
        quality("dissolved_oxygen").alias("dissolved_oxygen"), *[c for c in SOURCE if c in readings.columns])


def first_per_hour(readings: DataFrame, kinds: Sequence[str] = ("water_level", "rainfall"),
                   keys: Sequence[str] = ("station_id",), time_col: str = "ts",
                   tie: Sequence[str] = (), seconds: int = 3600,
                   default: Column | None = None) -> DataFrame:
    """One row per station and hour with the first reading of each type.

    The first reading counts even when it failed and has no value; ``default``
    replaces a missing value. Name ``tie`` columns where times repeat; without
    them the order key is a plain number and this stays a hash aggregate.
    """
    when = F.struct(time_col, *tie) if tie else F.col(time_col)

    def first(kind):
        value = F.min_by("value", F.when(F.col("data_type") == kind, when))
        return (value if default is None else F.coalesce(value, default)).alias(kind)

    return (readings.groupBy(*keys, time_bin(F.col(time_col), seconds).alias("hour"))
            .agg(*[first(k) for k in kinds]))


def append_rows(records: DataFrame, more: DataFrame) -> DataFrame:
    """Bag union by column name; columns one side lacks are NULL."""
    return records.unionByName(more, allowMissingColumns=True)
