"""Readings: scans of nested batches, the realtime view, submitted JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.functions import nan_to_null, parse_iso
from gaugeline.schemas import CORRUPT, READING, STATION_BATCH
from gaugeline.sources import commits


def _batch_schema(kind: str) -> T.StructType:
    """JSON batches also have the text of a line that is no batch."""
    return T.StructType([*STATION_BATCH.fields, T.StructField(CORRUPT, T.StringType())]) if kind == "json" else STATION_BATCH


def read_batches(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    """Station batches from JSON Lines or parquet files; the schema is given, not inferred."""
    return spark.read.schema(_batch_schema(kind)).format(kind).load(path)


def stream_batches(spark: SparkSession, path: str, kind: str = "json",
                   max_files: int | None = 1000) -> DataFrame:
    """The same files as a stream, ``max_files`` new ones per micro-batch, or all there are."""
    reader = spark.readStream.schema(_batch_schema(kind))
    return (reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)).format(kind).load(path)


def station_readings(readings: DataFrame, station_id: str, data_type: str | None = None,
                     station: Column | None = None) -> DataFrame:
    """Readings of one station, of one sensor type if given; unknown stations give no rows.

    Both conditions are plain column predicates, so a parquet scan skips row
    groups by them. ``station`` names the key where it is not ``station_id``.
    """
    key = F.col("station_id") if station is None else station
    picked = readings.filter(key == station_id)
    return picked if data_type is None else picked.filter(F.col("data_type") == data_type)


def parse_submissions(lines: DataFrame, text: str = "value",
                      required: tuple[str, ...] = ("station_id",)) -> DataFrame:
    """Submitted JSON lines with the reading fields, ``problems`` and ``accepted``.

    A line that is no JSON object, or lacks a required field, keeps its text and
    the reasons; nothing is dropped. A text column with the name of a reading's field becomes ``line``.
    """
    if text in READING.fieldNames():
        lines, text = lines.withColumnRenamed(text, "line"), "line"
    corrupt = "_corrupt_record"
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in READING.fields)
    parsed = lines.withColumn(
        "_r", F.from_json(F.col(text), f"{schema}, {corrupt} string",
                          {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}))
    malformed = F.col(f"_r.{corrupt}").isNotNull() | F.col("_r").isNull()
    problems = F.array_compact(F.array(
        F.when(malformed, F.lit("MALFORMED")),
        *[F.when(~malformed & F.col(f"_r.{name}").isNull(), F.lit(f"MISSING_{name.upper()}"))
          for name in required]))
    def field(f: T.StructField) -> Column:
        value = F.col(f"_r.{f.name}")
        if f.name == "timestamp":
            value = parse_iso(value)
        elif f.name == "value":
            value = nan_to_null(value)
        elif f.name == "parameters":
            value = F.when(value.isNotNull(), F.struct(*[nan_to_null(value[p.name]).alias(p.name) for p in f.dataType.fields]))
        return value.alias(f.name)

    fields = [field(f) for f in READING.fields]
    return (parsed.select(*[F.col(c) for c in lines.columns], *fields, problems.alias("problems"))
            .withColumn("accepted", F.size("problems") == 0))


def store_submissions(parsed: DataFrame, accepted_path: str, rejected_path: str, batch: str, text: str = "line") -> None:
    """Both parts of :func:`split_submissions` into two tables, accepted ones by day; the batch may be stored again.

    The rejected lines are committed first, so no line is ever in neither table once its batch is accepted.
    """
    accepted, rejected = split_submissions(parsed, text)
    commits.append_batch(rejected, rejected_path, batch)
    commits.append_batch(commits.with_day(accepted, "timestamp"), accepted_path, batch, ["day"])


def split_submissions(parsed: DataFrame, text: str = "line") -> tuple[DataFrame, DataFrame]:
    """Accepted readings, and rejected lines with their problems."""
    accepted = parsed.filter("accepted").drop("accepted", "problems", text)
    rejected = parsed.filter("NOT accepted").drop(*READING.fieldNames(), "accepted")
    return accepted, rejected
