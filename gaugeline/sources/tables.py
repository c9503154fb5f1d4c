"""Typed storage tables: conforming rows, appending, reading back, JSON export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions import as_moment
from gaugeline.schemas import TABLES
from gaugeline.session import list_paths
from gaugeline.sources import commits

#: Six fraction digits keep JSON timestamps exact.
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _stored(value: Column, kind: str) -> Column:
    if kind.startswith("decimal"):
        scale = int(kind.rstrip(")").split(",")[1])
        return F.round(value.try_cast("double"), scale).try_cast(kind)
    return value.try_cast(kind)


def conform(df: DataFrame, table: str, as_of=None) -> DataFrame:
    """Rows in the column types of ``table`` plus ``problems``, the broken rules.

    Columns the input lacks become NULL or their default; ``created_at`` and ``updated_at`` default to
    ``as_of``. A value that does not fit its column becomes NULL with the problem ``OVERFLOW_<COL>``
    (a number too large) or ``TYPE_<COL>`` (anything else), so its row is not accepted. NaN is NULL.
    """
    spec = TABLES[table]
    defaults = {**spec.defaults, "created_at": as_moment(as_of), "updated_at": as_moment(as_of)}

    def lost(name: str, kind: str) -> Column:
        """The problem of a value that its column cannot hold."""
        number = F.col(name).try_cast("double")
        given = F.col(name).isNotNull() & ~F.coalesce(F.isnan(number), F.lit(False))
        whole = kind.startswith("decimal") or kind in ("tinyint", "smallint", "int", "bigint")
        reason = F.when(number.isNotNull(), F.lit(f"OVERFLOW_{name.upper()}")) if whole else F.lit(None)
        return F.when(given & _stored(F.col(name), kind).isNull(), F.coalesce(reason, F.lit(f"TYPE_{name.upper()}")))

    kinds = dict(df.dtypes)
    unfit = [lost(name, kind) for name, kind in spec.columns.items()
             if kinds.get(name, kind) != kind and not (kind == "string" or kinds[name] in ("date", "timestamp", "timestamp_ntz", "void"))]

    def stored(name: str, kind: str) -> Column:
        value = _stored(F.col(name) if name in df.columns else F.lit(None), kind)
        if name in defaults:
            default = defaults[name]
            default = default if isinstance(default, Column) else F.lit(default)
            value = F.coalesce(value, default.cast(kind))
        return value.alias(name)

    lost_values = F.array_compact(F.array(*unfit)) if unfit else F.array().cast("array<string>")
    rows = df.select(*[stored(name, kind) for name, kind in spec.columns.items()], lost_values.alias("_unfit"))
    broken = [F.when(F.col(name).isNull(), F.lit(f"MISSING_{name.upper()}")) for name in spec.required]
    broken += [F.when((F.col(name) < low) | (F.col(name) > high), F.lit(f"CODE_{name.upper()}"))
               for name, (low, high) in spec.codes.items()]
    broken += [F.when(F.length(name) > size, F.lit(f"LENGTH_{name.upper()}"))
               for name, size in spec.lengths.items()]
    return rows.withColumn("problems", F.concat("_unfit", F.array_compact(F.array(*broken)))).drop("_unfit")


def accepted(conformed: DataFrame) -> DataFrame:
    return conformed.filter(F.size("problems") == 0).drop("problems")


def rejected(conformed: DataFrame) -> DataFrame:
    return conformed.filter(F.size("problems") > 0)


def laid_out(conformed: DataFrame, table: str) -> tuple[DataFrame, list[str]]:
    """The accepted rows as they are stored, and the columns they are partitioned by.

    The rebalance hint gathers each day into few files and lets adaptive
    execution split a day that holds most of the rows among many tasks.
    """
    spec = TABLES[table]
    rows = accepted(conformed)
    if spec.partition_time is None:
        return rows, []
    rows = commits.with_day(rows, spec.partition_time)
    return rows.hint("rebalance", F.col("day")).sortWithinPartitions("day", *spec.sort_by), ["day"]


def append(conformed: DataFrame, table: str, path: str, batch: str | None = None) -> None:
    """Append the accepted rows, partitioned by day and sorted within files.

    With ``batch``, a name for what is appended, the append may run again: the rows replace those of
    the last run of the batch, and readers see all of them or none. A table is written in one of the two ways.
    """
    rows, partitions = laid_out(conformed, table)
    if batch is not None:
        commits.append_batch(rows, path, batch, partitions)
    else:
        rows.write.mode("append").partitionBy(*partitions).parquet(path)


def read_table(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """A stored table; one of batches that may be empty needs the name of its ``table``."""
    if not commits.is_committed(spark, path):
        if table is None or list_paths(spark, [path]):
            return spark.read.parquet(path)
    schema = None
    if table is not None:
        spec = TABLES[table]
        schema = ", ".join(f"{n} {k}" for n, k in spec.columns.items()) + (", day date" if spec.partition_time else "")
    return commits.read_batches(spark, path, schema)


def export_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON Lines in UTF-8, one object per row, written by all tasks."""
    df.write.mode(mode).options(**JSON_TIMES).json(path)


def import_json(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).options(**JSON_TIMES).json(path)


def row_json(*columns) -> Column:
    """Row as JSON text with exact timestamps; NULL fields are left out."""
    return F.to_json(F.struct(*columns), JSON_TIMES)


def register_model(version: str, training: DataFrame, time_col: str, parameters: dict,
                   accuracy: Column, description: str, as_of=None) -> DataFrame:
    """One ``model_version`` row; the data range is taken from the training rows."""
    spark = training.sparkSession
    span = training.agg(F.min(time_col).alias("lo"), F.max(time_col).alias("hi"))
    settings = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in parameters.items()])) \
        if parameters else F.lit("{}")
    pattern = "yyyy-MM-dd HH:mm:ss"
    row = span.select(
        F.lit(version).alias("version"), F.lit(description).alias("description"),
        accuracy.alias("accuracy"), settings.alias("parameters_summary"),
        F.concat(F.date_format("lo", pattern), F.lit(" .. "), F.date_format("hi", pattern))
        .alias("training_data_range"),
        F.lit(1).alias("status"), F.lit(spark.sparkContext.sparkUser()).alias("deployed_by"),
        as_moment(as_of).alias("deployed_at"))
    return conform(row, "model_version", as_of)
