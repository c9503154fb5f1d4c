"""Monitoring tables read out of the shared test tables.

``events`` becomes sensor readings of a few stations, ``lineitem`` daily series
and station batches of many stations. Everything is a projection or a grouped
aggregate, so it grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.constants import FEATURES
from gaugeline.functions import time_bin
from gaugeline.session import configure

AS_OF = "2024-01-25 00:00:00"
#: S005 is left out, so name lookups meet an unknown station.
KNOWN_STATIONS = [
    ("S001", "upper reach", 30.05, 120.10),
    ("S002", "middle reach", 30.15, 120.30),
    ("S003", "lower reach", 30.25, 120.50),
    ("S004", "reservoir", 29.50, 119.20),
]


def load(spark: SparkSession, sf_dir: str, name: str, stream: bool = False) -> DataFrame:
    """A test table, read once or as a stream, with its times as TIMESTAMP."""
    path = f"{sf_dir}/{name}.parquet"
    df = configure(spark).read.parquet(path)
    if stream:
        # A pattern, as a plain path would have to be a folder and the table may be one file.
        df = spark.readStream.schema(df.schema).parquet(path[:-1] + "[t]")
    times = {f.name: F.col(f.name).cast("timestamp") for f in df.schema
             if f.dataType.simpleString() == "timestamp_ntz"}
    return df.withColumns(times) if times else df


def reading(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Long readings, one row per event; a NaN value counts as not measured."""
    events = load(spark, sf_dir, "events", stream).selectExpr(
        "event_id", "ts", "user_id", "event_type AS kind", "CASE WHEN NOT isnan(value) THEN value END AS value",
        "cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k")
    return events.selectExpr(
        "concat('S00', cast(user_id % 5 + 1 AS string)) AS station_id",
        "CASE kind WHEN 'view' THEN 'water_level' WHEN 'click' THEN 'rainfall' WHEN 'purchase' THEN 'flow_rate' "
        "WHEN 'signup' THEN 'temperature' ELSE 'water_quality' END AS data_type",
        "ts",
        "CASE WHEN k = 0 THEN NULL WHEN kind = 'view' THEN value / 5D WHEN kind = 'click' THEN value "
        "WHEN kind = 'purchase' THEN value * 10D WHEN kind = 'signup' THEN value / 2D - 10D END AS value",
        "CASE WHEN k > 0 AND kind = 'error' THEN k * 15 / 100D END AS ph",
        "CASE WHEN k > 0 AND kind = 'error' THEN value END AS turbidity",
        "CASE WHEN k > 0 AND kind = 'error' THEN value / 20D END AS dissolved_oxygen",
        "CASE WHEN k = 0 THEN 'sensor failure' END AS error", "event_id")


def hour_wide(readings: DataFrame, failed: bool = False) -> DataFrame:
    """Hourly means per station, one column per measure; with ``failed`` also ``n_failed``, the readings that failed."""
    means = [F.expr(f"avg(CASE WHEN data_type = '{kind}' THEN value END) AS {kind}") for kind in FEATURES]
    return (readings.groupBy("station_id", time_bin(F.col("ts"), 3600).alias("hour"))
            .agg(*means, F.expr("count(*) AS n_readings"), *([F.count("error").alias("n_failed")] if failed else [])))


def daily_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series of many stations."""
    return (load(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_suppkey").cast("string").alias("station_id"),
                     F.col("l_shipdate").alias("day"))
            .agg(F.avg("l_quantity").alias("water_level"), F.sum("l_quantity").alias("flow_rate"),
                 F.avg("l_discount").alias("rainfall"), F.count(F.lit(1)).alias("n_readings")))


#: What a batch is made of.
_LINE = ("l_suppkey", "l_shipdate", "l_quantity", "l_discount", "l_tax", "l_returnflag")


def station_batches(spark: SparkSession, sf_dir: str, stream: bool = False, parts: int | None = None) -> DataFrame:
    """Nested batches: every line is one sweep over a station's three sensors.

    The rainfall sensor fails on returned lines and then reports an error. With ``parts`` the lines are dealt to that
    many partitions before they become batches, which are several times as large.
    """
    line = load(spark, sf_dir, "lineitem", stream).select(*_LINE)
    if parts:
        line = line.repartition(parts, *_LINE)
    station = F.col("l_suppkey").cast("string")
    moment = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")
    none = F.lit(None)
    failed = F.col("l_returnflag") == "R"

    def entry(kind, value, unit, parameters, error):
        return F.struct(station.alias("station_id"), F.lit(kind).alias("data_type"),
                        value.cast("double").alias("value"), unit.cast("string").alias("unit"),
                        parameters.cast("struct<ph:double,turbidity:double,dissolved_oxygen:double>")
                        .alias("parameters"),
                        error.cast("string").alias("error"), moment.alias("timestamp"))

    quality = F.struct((F.col("l_tax") * 100).alias("ph"), F.col("l_quantity").alias("turbidity"),
                       (F.col("l_discount") * 100).alias("dissolved_oxygen"))
    readings = F.array(
        entry("water_level", F.col("l_quantity"), F.lit("m"), none, none),
        entry("rainfall", F.when(~failed, F.col("l_discount") * 1000),
              F.when(~failed, F.lit("mm")), none, F.when(failed, F.lit("sensor failure"))),
        entry("water_quality", none, none, quality, none))
    return line.select(station.alias("station_id"), readings.alias("readings"))
