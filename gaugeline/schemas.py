"""Schemas: nested readings as collected, storage tables as kept."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

#: One reading as collected. Scalar readings carry ``value``, water-quality
#: readings ``parameters``, failed ones ``error``; what is absent is NULL.
READING = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("parameters", T.StructType([
        T.StructField("ph", T.DoubleType()),
        T.StructField("turbidity", T.DoubleType()),
        T.StructField("dissolved_oxygen", T.DoubleType()),
    ])),
    T.StructField("error", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

#: Text of a JSON line that is no batch; Spark fills it where the schema names it.
CORRUPT = "_corrupt_record"
#: Where a row came from: the file, the first byte of the piece of it that one task reads, and the number of the row in there.
SOURCE = ("source_file", "source_block", "source_row")
#: Readings of one station taken in one sweep over its sensors.
STATION_BATCH = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("readings", T.ArrayType(READING)),
])


@dataclass(frozen=True)
class Table:
    """A storage table: column types and the rules rows must meet to be kept."""

    columns: dict[str, str]
    required: tuple[str, ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)
    codes: dict[str, tuple[int, int]] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)
    partition_time: str | None = None
    sort_by: tuple[str, ...] = ()


#: Column types, defaults, code ranges and text lengths per table.
#: ``ph_value`` has two digits before the point, as its range reaches 14.
TABLES = {
    "monitor_station": Table(
        columns={"id": "string", "name": "string", "latitude": "decimal(10,6)",
                 "longitude": "decimal(10,6)", "river_system": "string", "status": "smallint",
                 "created_at": "timestamp", "updated_at": "timestamp"},
        required=("id", "name"), defaults={"status": 1}, codes={"status": (0, 1)},
        lengths={"id": 50, "name": 100, "river_system": 100}),
    "water_monitoring_data": Table(
        columns={"location_id": "string", "timestamp": "timestamp",
                 "water_level": "decimal(8,2)", "flow_rate": "decimal(10,2)",
                 "rainfall": "decimal(6,2)", "temperature": "decimal(5,2)",
                 "data_quality": "smallint", "status": "smallint",
                 "created_at": "timestamp", "updated_at": "timestamp"},
        required=("location_id", "timestamp"), defaults={"data_quality": 1, "status": 1},
        codes={"data_quality": (1, 3)}, lengths={"location_id": 50},
        partition_time="timestamp", sort_by=("location_id", "timestamp")),
    "water_quality_data": Table(
        columns={"location_id": "string", "timestamp": "timestamp", "ph_value": "decimal(4,2)",
                 "turbidity": "decimal(6,2)", "dissolved_oxygen": "decimal(5,2)",
                 "ammonia_nitrogen": "decimal(6,3)", "chemical_oxygen_demand": "decimal(6,2)",
                 "water_quality_level": "smallint", "created_at": "timestamp"},
        required=("location_id", "timestamp"), codes={"water_quality_level": (1, 5)},
        lengths={"location_id": 50},
        partition_time="timestamp", sort_by=("location_id", "timestamp")),
    "flood_prediction_record": Table(
        columns={"location_id": "string", "predict_time": "timestamp", "predict_hour": "smallint",
                 "predicted_water_level": "decimal(8,2)", "confidence_score": "decimal(5,4)",
                 "risk_level": "smallint", "model_version": "string",
                 "input_data_summary": "string", "created_at": "timestamp"},
        required=("location_id", "predict_time"), codes={"risk_level": (0, 4)},
        lengths={"location_id": 50, "model_version": 50},
        partition_time="predict_time", sort_by=("location_id", "predict_hour")),
    "warning_info": Table(
        columns={"id": "string", "warning_type": "smallint", "warning_level": "smallint",
                 "title": "string", "content": "string", "affected_location": "string",
                 "publish_time": "timestamp", "expire_time": "timestamp", "status": "smallint",
                 "created_by": "string", "created_at": "timestamp"},
        required=("warning_type", "warning_level", "title", "publish_time"),
        defaults={"status": 1},
        codes={"warning_type": (1, 3), "warning_level": (1, 4), "status": (0, 1)},
        lengths={"title": 200, "affected_location": 200, "created_by": 50},
        partition_time="publish_time", sort_by=("id",)),
    "model_version": Table(
        columns={"version": "string", "description": "string", "accuracy": "decimal(5,4)",
                 "parameters_summary": "string", "training_data_range": "string",
                 "status": "smallint", "deployed_by": "string", "deployed_at": "timestamp",
                 "created_at": "timestamp"},
        required=("version",), defaults={"status": 1}, codes={"status": (0, 1)},
        lengths={"version": 50, "training_data_range": 200, "deployed_by": 50}),
}
