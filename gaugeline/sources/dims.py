"""Dimension tables that ship with the package.

They become local relations, whose exact size the optimizer knows, so joins to
them broadcast without a hint. A caller's own dimension read from files is
broadcast only while its size stays under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gaugeline import constants as C


def local_table(spark: SparkSession, rows: list[tuple], **types) -> DataFrame:
    """DataFrame of a few fixed rows; ``types`` maps column name to Arrow type."""
    columns = list(zip(*rows)) if rows else [[] for _ in types]
    arrays = [pa.array(values, kind) for values, kind in zip(columns, types.values())]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=list(types)))


def stations(spark: SparkSession, rows=None) -> DataFrame:
    return local_table(spark, C.STATIONS if rows is None else rows, id=pa.string(), name=pa.string(),
                       lat=pa.float64(), lng=pa.float64())


def sensor_ranges(spark: SparkSession, rows=None) -> DataFrame:
    return local_table(spark, C.SENSOR_RANGES if rows is None else rows, data_type=pa.string(),
                       min=pa.float64(), max=pa.float64(), unit=pa.string())


def warning_thresholds(spark: SparkSession, rows=None) -> DataFrame:
    return local_table(spark, C.WARNING_THRESHOLDS if rows is None else rows, level=pa.int32(),
                       name=pa.string(), min_level=pa.float64(), confidence=pa.float64())


def flood_texts(spark: SparkSession, rows=None) -> DataFrame:
    return local_table(spark, C.FLOOD_TEXTS if rows is None else rows, risk_level=pa.int32(),
                       title_format=pa.string(), content_format=pa.string())
