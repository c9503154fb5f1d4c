"""Which source row a reading is, and which readings were seen before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.schemas import SOURCE
from gaugeline.streaming.daylog import DayLog

KEYS = ("station_id", "data_type", "ts")
SEEN_SCHEMA = "station_id string, data_type string, ts timestamp"
REPEAT_SCHEMA = f"{SEEN_SCHEMA}, repeats bigint"
_FILE, _BLOCK, _ROW = SOURCE


def with_source(batches: DataFrame) -> DataFrame:
    """Rows of a file source with the file they are from and the piece of it that a task reads."""
    return batches.select("*", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_block_start").alias(_BLOCK))


def has_key() -> Column:
    """Whether a reading says what it measures where and when; only then can another one repeat it."""
    found = F.lit(True)
    for key in KEYS:
        found = found & F.col(key).isNotNull()
    return found


def place_rows(micro: DataFrame) -> DataFrame:
    """A micro-batch with the place of each row in the order of its files as ``source_row``; before any shuffle."""
    return micro.withColumn(_ROW, F.monotonically_increasing_id())


def number_rows(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """``source_row`` as the number of each of the ``rows`` in its piece of a file, from the places of the whole micro-batch.

    A batch that runs again reads the same pieces in the same order, so file, piece and number name a row for good, also
    one with nothing else to tell it by. There is a row per piece to look up, and the ``rows`` stay where they are.
    """
    firsts = placed.groupBy(_FILE, _BLOCK).agg(F.min(_ROW).alias("_first"))
    return rows.join(F.broadcast(firsts), [_FILE, _BLOCK]).withColumn(_ROW, F.col(_ROW) - F.col("_first")).select(*rows.columns)


def judge_keys(placed: DataFrame, seen: DayLog, batch_id: int) -> DataFrame:
    """The first reading of each key of a micro-batch, with ``_n``, how many rows have it, and ``_seen`` if a batch before had it.

    Keys lie by the day of their time, so only the days that occur in the batch are looked up. A key is combined
    on the map side, so one that is repeated without end is no hot task.
    """
    keyed = placed.filter(has_key())
    rest = [c for c in placed.columns if c not in KEYS]
    first = F.min_by(F.struct(*rest), F.struct(_FILE, _BLOCK, _ROW))
    groups = keyed.groupBy(*KEYS).agg(first.alias("r"), F.count(F.lit(1)).alias("_n"))
    days = [str(r.day) for r in keyed.select(F.to_date("ts").alias("day")).distinct().collect()]
    before = seen.read(days, batch_id).select(*KEYS).distinct().withColumn("_seen", F.lit(True))
    return groups.join(before, list(KEYS), "left").select(*KEYS, *[F.col(f"r.{c}").alias(c) for c in rest], "_n", "_seen")


def split_repeats(placed: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(fresh, keyless, repeats)`` of a micro-batch and its judged keys: readings of keys that no batch before had, the first one
    of each; rows without a whole key, which are never repeats; and the keys that came again, with how many rows were left out."""
    fresh = keys.filter(F.col("_seen").isNull()).select(*placed.columns)
    left_out = F.col("_n") - F.when(F.col("_seen").isNull(), 1).otherwise(0)
    return fresh, placed.filter(~has_key()), keys.select(*KEYS, left_out.alias("repeats")).filter("repeats > 0")
