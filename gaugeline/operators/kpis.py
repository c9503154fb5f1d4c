"""Lookups and key figures: names, overview, counts, collection log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline import constants as C
from gaugeline.functions import as_moment


def with_station_name(df: DataFrame, stations: DataFrame, key: str = "station_id",
                      name: str = "station_name", fallback: Column | None = None) -> DataFrame:
    """Station name by id; an unknown id falls back to ``fallback``, by default the id itself.

    The join carries no hint: Spark broadcasts the stations while their size
    allows it and splits a hot station otherwise.
    """
    names = stations.select(F.col("id").alias("_id"), F.col("name").alias("_name"))
    other = F.col(key) if fallback is None else fallback
    return (df.join(names, F.col(key) == F.col("_id"), "left")
            .withColumn(name, F.coalesce("_name", other)).drop("_id", "_name"))


def with_station_place(df: DataFrame, stations: DataFrame, key: str = "station_id",
                       unknown: str = "unknown", blank: str = "-") -> DataFrame:
    """Name and coordinates as display text, with literals for unknown stations."""
    place = stations.select(F.col("id").alias("_id"), F.col("name").alias("_name"),
                            F.col("lat").cast("string").alias("_lat"),
                            F.col("lng").cast("string").alias("_lng"))
    return (df.join(place, F.col(key) == F.col("_id"), "left").withColumns({
        "station_name": F.coalesce("_name", F.lit(unknown)),
        "lat": F.coalesce("_lat", F.lit(blank)), "lng": F.coalesce("_lng", F.lit(blank))})
        .drop("_id", "_name", "_lat", "_lng"))


def latest_readings(readings: DataFrame, keys=("station_id", "data_type"), time_col: str = "ts",
                    value: str = "value") -> DataFrame:
    """Newest reading per station and sensor type."""
    return readings.groupBy(*keys).agg(F.max(time_col).alias(time_col),
                                       F.max_by(value, time_col).alias(value))


def station_overview(stations: DataFrame, latest: DataFrame) -> DataFrame:
    """Every station with its newest water level and rainfall; NULL where it has none."""
    def newest(kind):
        return F.max(F.when(F.col("data_type") == kind, F.col("value"))).alias(kind)

    wide = latest.groupBy("station_id").agg(newest("water_level"), newest("rainfall"),
                                            F.max("ts").alias("updated"))
    return (stations.join(wide, F.col("id") == F.col("station_id"), "left")
            .select("id", "name", "water_level", "rainfall", "updated"))


def readings_per_station(readings: DataFrame) -> DataFrame:
    return readings.groupBy("station_id").agg(F.count(F.lit(1)).alias("n_readings"))


def collection_log(readings: DataFrame, sweep: Column, kind: str = "realtime") -> DataFrame:
    """One log row per collection sweep: its time, kind and number of stations."""
    swept = readings.select(sweep.alias("collected_at"), "station_id").distinct()
    return (swept.groupBy("collected_at")
            .agg(F.count(F.lit(1)).alias("stations_count"))
            .select("collected_at", F.lit(kind).alias("kind"), "stations_count"))


def station_collection_log(readings: DataFrame, sweep: Column, station_id: str) -> DataFrame:
    """The same for collections of a single station."""
    own = readings.filter(F.col("station_id") == station_id)
    return own.select(sweep.alias("collected_at"), F.lit("station_realtime").alias("kind"),
                      "station_id").distinct()


def collection_stats(log: DataFrame) -> DataFrame:
    """Number of collections and the last one, in a single row; an empty log has no last one."""
    return log.agg(F.count(F.lit(1)).alias("total_collections"),
                   F.max("collected_at").alias("last_time"),
                   F.max_by("kind", "collected_at").alias("last_kind"),
                   F.max_by("stations_count", "collected_at").alias("last_stations"))


def overview(stations: DataFrame, active_warnings: DataFrame, as_of=None) -> DataFrame:
    """Stations, sensors and active warnings, in a single row."""
    active = active_warnings.select(F.count(F.lit(1))).scalar()
    return (stations.agg(F.count(F.lit(1)).alias("stations"))
            .select("stations", active.alias("active_warnings"),
                    (F.col("stations") * C.SENSORS_PER_STATION).alias("sensors"),
                    as_moment(as_of).alias("updated")))
